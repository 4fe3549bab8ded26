"""Message streams: a Kafka topic, a stored table, or files with the columns of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from solstrand.sources.schemas import MESSAGE
from solstrand.sources.tables import job_parameter

# Kafka source option -> job parameter below `<prefix>.`; the rate cap and the start position are
# options of the source, not of the query.
_FROM_PARAMETERS = {
    "kafka.bootstrap.servers": "kafka.servers",
    "subscribe": "kafka.topic",
    "kafka.request.timeout.ms": "kafka.requestTimeout",
    "kafka.session.timeout.ms": "kafka.sessionTimeout",
    "maxOffsetsPerTrigger": "spark.maxOffsetsPerTrigger",
    "failOnDataLoss": "spark.failOnDataLoss",
    "startingOffsets": "spark.startingOffsets",
}


def kafka_options(
    spark: SparkSession, prefix: str = "ingestion", jaas_config: str | None = None
) -> dict[str, str]:
    """Options of the Kafka source from the job's parameters.

    `jaas_config` carries the credentials of a SASL login; it is passed in by the caller, who has
    it from a secret store, and never read from plain configuration.
    """
    options = {
        option: job_parameter(spark, f"{prefix}.{name}") for option, name in _FROM_PARAMETERS.items()
    }
    if jaas_config:
        options |= {
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.jaas.config": jaas_config,
        }
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream; needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = MESSAGE,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files as a stream, by default with the columns of a Kafka source.

    `files_per_trigger` caps the rate as `maxOffsetsPerTrigger` does for a topic; `bytes_per_trigger`
    does so by the files' bytes.  The source takes one of the two.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def table_stream(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or the table of another stream, as a stream of its new rows."""
    return spark.readStream.table(name)


def stored_table_stream(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """`<folder>/<name>.parquet` as a stream, be it one file or a folder of part files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # A file source takes folders and patterns; the pattern matches exactly this one name.
    return file_stream(spark, f"{folder}/{name}.parque[t]", schema, files_per_trigger)
