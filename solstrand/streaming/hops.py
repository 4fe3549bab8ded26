"""The hops of the article stream, each a query of its own with its own checkpoint.

messages -> bronze (parsed, by day) -> silver (flat, first per id, analysed) -> surveys -> options
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from solstrand.operators.articles import (
    bronze_rules,
    flatten_articles,
    identified,
    parse_messages,
)
from solstrand.operators.enrich import Scorer, analysed
from solstrand.operators.quality import expect
from solstrand.operators.surveys import survey_options, survey_rows
from solstrand.sources.messages import file_stream
from solstrand.streaming.dedup import first_seen


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Settings a query takes over when it starts; the session has its own again afterwards.

    The ids seen so far outgrow the executors' memory, where the default store keeps them: state
    goes to RocksDB, and only the changes of a batch to the checkpoint, from where any executor
    takes over.  A session that names another store keeps it.  What a batch has shuffled is removed
    from the executors' disks when it ends, not when the driver happens to collect its garbage.
    """
    wanted = {SHUFFLES_REMOVED: "true"}
    if spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        state = "org.apache.spark.sql.execution.streaming.state"
        wanted[PROVIDER] = f"{state}.RocksDBStateStoreProvider"
        wanted["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def append(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append the stream to a folder of parquet files.

    Without `every` the query works off all there is and ends; started again with the same
    checkpoint it goes on behind the last row, so a finished history is never written twice.
    """
    with state_on_disk(stream.sparkSession):
        return _writer(stream, checkpoint, partition_by, every).start(table)


def append_to_table(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """The same into a catalog table, which is created if need be."""
    with state_on_disk(stream.sparkSession):
        return _writer(stream, checkpoint, partition_by, every).toTable(name)


def _writer(
    stream: DataFrame, checkpoint: str, partition_by: Sequence[str], every: str | None
) -> DataStreamWriter:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        # Articles are long texts, held twice or more in each hop's table.
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .trigger(**trigger)
    )


def bronze(messages: DataFrame) -> DataFrame:
    """Parsed messages; broken rules show up in the progress as `bronze`, the rows are kept."""
    return expect(messages.transform(parse_messages), bronze_rules(), counts="bronze")


def silver(bronze_stream: DataFrame, scorer: Scorer, **dedup) -> DataFrame:
    """Flat articles, the first per id, with the model's analysis.

    Text that was no article has no id: it is dropped here, else one such row would pass as the
    article with id NULL.  Copies are removed before flattening, since the flat columns hold the
    article a second time and would be exchanged with it.
    """
    articles = expect(bronze_stream, [identified()])
    unique = first_seen(articles.withColumn("id", F.col("parsed_records.id")), **dedup)
    return analysed(flatten_articles(unique), scorer)


class ArticleStream:
    """The four hops below one folder: `<root>/<hop>` holds a table, `<root>/_checkpoints/<hop>`
    its progress.

    `files_per_trigger` caps what one micro-batch of the later hops takes in, so that a long
    backlog is worked off in steps; the first hop's cap is an option of its source.
    `bytes_per_trigger` caps it by bytes instead, which bounds what a batch shuffles; of the rows of
    later batches, those more than the `delay` behind are late.
    """

    HOPS = ("bronze", "silver", "surveys", "options")

    def __init__(
        self,
        root: str,
        article_scorer: Scorer,
        survey_scorer: Scorer,
        files_per_trigger: int = 10_000,
        bytes_per_trigger: int | None = None,
        **dedup,
    ) -> None:
        self.files_per_trigger = None if bytes_per_trigger else files_per_trigger
        self.bytes_per_trigger = bytes_per_trigger
        self.root = root.rstrip("/")
        self.article_scorer = article_scorer
        self.survey_scorer = survey_scorer
        self.dedup = dedup
        self.schemas: dict[str, StructType] = {}

    def path(self, hop: str) -> str:
        return f"{self.root}/{hop}"

    def start(self, hop: str, stream: DataFrame, every: str | None = None) -> StreamingQuery:
        """Start one hop on the rows of the hop before (or the messages)."""
        if hop == "bronze":
            rows, by = bronze(stream), ["eh_enqueued_date"]
        elif hop == "silver":
            rows, by = silver(stream, self.article_scorer, **self.dedup), []
        elif hop == "surveys":
            rows, by = survey_rows(stream, self.survey_scorer), []
        elif hop == "options":
            rows, by = survey_options(stream), []
        else:
            raise ValueError(f"unknown hop {hop}")
        self.schemas[hop] = rows.schema
        return append(rows, self.path(hop), f"{self.root}/_checkpoints/{hop}", by, every)

    def read(self, spark: SparkSession, hop: str) -> DataFrame:
        """The table a started hop has written so far."""
        return spark.read.schema(self.schemas[hop]).parquet(self.path(hop))

    def run(self, messages: DataFrame, upto: str = "options") -> dict[str, StreamingQuery]:
        """Work off everything there is, hop by hop, and end."""
        spark = messages.sparkSession
        ended, stream = {}, messages
        for hop in self.HOPS[: self.HOPS.index(upto) + 1]:
            query = self.start(hop, stream)
            query.awaitTermination()
            ended[hop] = query
            if hop != upto:
                stream = file_stream(
                    spark, self.path(hop), self.schemas[hop], self.files_per_trigger, self.bytes_per_trigger
                )
        return ended
