"""The article stream: parse messages, flatten articles, remove repeated ones.

Every step but the two batch-only ones works on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solstrand.operators.quality import Rule
from solstrand.sources.schemas import ARTICLE_FIELDS, article_schema

# Columns carried from the message, and those added while parsing.
MESSAGE_COLUMNS = ["topic", "partition", "offset", "timestamp", "timestampType"]
AUDIT_COLUMNS = [
    "eh_enqueued_timestamp", "eh_enqueued_date", "etl_processed_timestamp", "etl_rec_uuid",
]


def parse_messages(messages: DataFrame, topics: str = "objects") -> DataFrame:
    """Bronze: the message value as an article struct, with enqueue and processing marks.

    Text that is no JSON gives a struct of NULLs, empty or missing text gives NULL.  `topics` says
    which form of that field is read; the other form comes out as NULL ("objects") or as JSON text
    per element ("names", see `topic_names`).
    """
    parsed = F.from_json(F.col("value").cast("string"), article_schema(topics))
    return messages.select(
        *MESSAGE_COLUMNS,
        parsed.alias("parsed_records"),
        F.col("timestamp").alias("eh_enqueued_timestamp"),
        F.to_date("timestamp").alias("eh_enqueued_date"),
        F.current_timestamp().alias("etl_processed_timestamp"),
        F.uuid().alias("etl_rec_uuid"),
    )


def bronze_rules() -> list[Rule]:
    """The two rules of the bronze table; rows that break them are counted and kept."""
    return [
        Rule("valid_topic", F.col("topic").isNotNull()),
        Rule("valid records", F.col("parsed_records").isNotNull()),
    ]


def identified() -> Rule:
    """Removes text that was no article: parsed, but without an id."""
    return Rule("identified article", F.col("parsed_records.id").isNotNull(), "drop")


def topic_names(topics: Column) -> Column:
    """Topics read as "names", each element the topic's name whichever form was sent."""
    return F.transform(
        topics,
        lambda t: F.when(t.startswith("{"), F.get_json_object(t, "$.name")).otherwise(t),
    )


def flatten_articles(bronze: DataFrame) -> DataFrame:
    """Silver columns: message columns, 32 article columns, the struct, audit columns.

    The author's name comes out as `name`, its id as `author_id`.
    """
    article: list[Column] = []
    for field in ARTICLE_FIELDS:
        if field == "author":
            article += [
                F.col("parsed_records.author.id").alias("author_id"),
                F.col("parsed_records.author.name"),
            ]
        else:
            article.append(F.col(f"parsed_records.{field}"))
    return bronze.select(*MESSAGE_COLUMNS, *article, "parsed_records", *AUDIT_COLUMNS)


def first_per_id(articles: DataFrame, key: str = "id", order: tuple[str, ...] | None = None) -> DataFrame:
    """Batch: one row per id, the earliest message; rows without id count as one id.

    The rank limit runs in the map tasks too, so at most one row per id and task is exchanged,
    however often an id repeats.
    """
    order = order or ("timestamp", "partition", "offset")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return articles.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
