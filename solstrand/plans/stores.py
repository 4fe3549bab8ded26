"""Queries on tables, files, snapshots, listings and landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators.frames import drop_void_columns
from solstrand.operators.snapshots import snapshot_changes
from solstrand.plans.shown import as_text, as_text_sql
from solstrand.sinks import tables as sinks
from solstrand.sinks.scratch import scratch_path
from solstrand.sources.api_pages import articles_of, parse_pages
from solstrand.sources.listings import named_like, share_of
from solstrand.sources.schemas import LISTING, LISTING_DETAIL_FIELDS, LISTING_SUMMARY_FIELDS
from solstrand.sources.tables import preview, table


def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over a stored table, read by SQL."""
    sinks.replace_view(table(spark, sf_dir, "customer"), "solstrand_customer")
    return preview(spark, "solstrand_customer")


def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by day, read back and counted per day."""
    path = scratch_path(spark, "by-day")
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    sinks.write_partitioned(events, path, "day")
    back = spark.read.schema(events.schema).parquet(path)
    return back.groupBy(F.col("day").cast("string").alias("day"), "event_type").agg(
        F.count("*").alias("n")
    )


def clustered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written sorted by part; read back and summed per part."""
    path = scratch_path(spark, "clustered")
    items = table(spark, sf_dir, "lineitem")
    sinks.write_clustered(items, path, "l_partkey")
    back = spark.read.schema(items.schema).parquet(path)
    return back.groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


def replaced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files overwritten by rows of another schema."""
    path = scratch_path(spark, "replaced")
    sinks.replace_files(table(spark, sf_dir, "part"), path)
    narrow = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"), "p_name"
    )
    sinks.replace_files(narrow, path)
    return spark.read.parquet(path)


def _order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and after: open ones came, filled ones went, urgent pending ones changed."""
    orders = table(spark, sf_dir, "orders")
    status, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    price = F.when(urgent & (status == "P"), F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    return orders.filter(status != "O"), orders.filter(status != "F").withColumn(
        "o_totalprice", price
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed between two snapshots of the orders."""
    return snapshot_changes(*_order_snapshots(spark, sf_dir), "o_orderkey").select(
        "change_type", F.col("copies").cast("int").alias("copies"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a marketplace listing under the fixed nested schema."""
    given = {
        "name": F.col("p_name"),
        "subtitle": F.col("p_type"),
        "share": F.struct(
            F.concat("p_brand", F.lit("/"), "p_partkey").alias("name"), F.lit("FULL").alias("type")
        ),
        "categories": F.array("p_type"),
    }
    summary = F.struct(
        *[
            given.get(n, F.lit(None)).cast(kind).alias(n)
            for n, kind in LISTING_SUMMARY_FIELDS.items()
        ]
    )
    detail = F.struct(
        *[
            (F.col("p_retailprice") if n == "size" else F.lit(None)).cast(kind).alias(n)
            for n, kind in LISTING_DETAIL_FIELDS.items()
        ]
    )
    rows = table(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("id"),
        detail.alias("detail"),
        summary.alias("summary"),
    )
    return rows.to(spark.createDataFrame([], LISTING).schema)


def listing_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose nested name contains a word."""
    return named_like(_listings(spark, sf_dir), "widget").select(
        "id",
        F.col("summary.name").alias("name"),
        F.col("summary.share.name").alias("share"),
        F.col("detail.size").alias("size"),
    )


def listing_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and share of the first such listing."""
    return share_of(_listings(spark, sf_dir), "widget")


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page texts: every document is a page, each of its lines an article.

    Only documents with a label state a source and an author.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    known = F.col("quality").isNotNull()
    article = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.col("doc_id").alias("id"),
            (i + 1).cast("string").alias("title"),
            line.alias("body"),
            F.col("lang").alias("language"),
            F.when(known, F.struct(F.col("doc_id").alias("id"), F.col("source").alias("name"))).alias(
                "author"
            ),
            F.when(
                known,
                F.struct(
                    F.col("source").alias("name"),
                    F.col("quality").alias("rank"),
                    F.struct(F.col("lang").alias("country")).alias("location"),
                ),
            ).alias("source"),
            F.array("lang").alias("keywords"),
        ),
    )
    return documents.select(F.to_json(F.struct(article.alias("results"))).alias("page"))


def articles_shown(flat: DataFrame) -> DataFrame:
    rows = flat.select(
        "id",
        "title",
        "body",
        "excerpt",
        "language",
        "author_id",
        "author_name",
        "author_href",
        "source_name",
        "source_rank",
        "source_location",
        F.array_join("keywords", ",").alias("keywords"),
        "is_duplicate",
        "canonical_url",
    )
    return as_text(rows, "author_id", "is_duplicate")


def api_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles out of page texts."""
    return articles_shown(articles_of(parse_pages(api_pages(spark, sf_dir), "page")))


def without_void(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with two columns nothing is known of, which are dropped before writing."""
    suppliers = table(spark, sf_dir, "supplier").select("*", F.lit(None).alias("x"))
    path = scratch_path(spark, "no-void")
    sinks.replace_files(drop_void_columns(suppliers.withColumn("y", F.lit(None))), path)
    return spark.read.parquet(path)


QUERIES = {
    "table_preview": table_preview,
    "sink_partitioned": partitioned_sink,
    "sink_clustered": clustered_sink,
    "sink_schema_replaced": replaced_files,
    "snapshot_changes": changes,
    "nested_name_contains": listing_name,
    "listing_share": listing_share,
    "results_array_explode": api_articles,
    "drop_void_columns": without_void,
}

_OLD = "(SELECT * FROM orders WHERE o_orderstatus <> 'O')"
_NEW = """(SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
    THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
    FROM orders WHERE o_orderstatus <> 'F')"""
_SHOWN = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"

ORACLES = {
    "table_preview": "SELECT * FROM customer",
    "sink_partitioned": """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n
        FROM events GROUP BY 1, 2""",
    "sink_clustered": """SELECT l_partkey, count(*) AS n,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1""",
    "sink_schema_replaced": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part",
    "snapshot_changes": f"""
        SELECT CASE WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update_preimage' END
          AS change_type, 1 AS copies, {', '.join('o.' + c for c in _SHOWN.split(', '))}
        FROM {_OLD} AS o LEFT JOIN {_NEW} AS n ON o.o_orderkey = n.o_orderkey
        WHERE n.o_orderkey IS NULL OR n.o_totalprice <> o.o_totalprice
        UNION ALL
        SELECT CASE WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update_postimage' END
          AS change_type, 1 AS copies, {', '.join('n.' + c for c in _SHOWN.split(', '))}
        FROM {_NEW} AS n LEFT JOIN {_OLD} AS o ON o.o_orderkey = n.o_orderkey
        WHERE o.o_orderkey IS NULL OR n.o_totalprice <> o.o_totalprice""",
    "nested_name_contains": """SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS id,
        p_name AS name, p_brand || '/' || CAST(p_partkey AS VARCHAR) AS share,
        p_retailprice AS size FROM part WHERE contains(p_name, 'widget')""",
    "listing_share": """SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS id,
        p_brand || '/' || CAST(p_partkey AS VARCHAR) AS name FROM part
        WHERE contains(p_name, 'widget') ORDER BY id LIMIT 1""",
    "results_array_explode": as_text_sql(
        """SELECT d.doc_id AS id, CAST(i AS VARCHAR) AS title,
        string_split(text, chr(10))[i] AS body, CAST(NULL AS VARCHAR) AS excerpt,
        lang AS language, CASE WHEN l.doc_id IS NOT NULL THEN d.doc_id END AS author_id,
        CASE WHEN l.doc_id IS NOT NULL THEN source END AS author_name,
        CAST(NULL AS VARCHAR) AS author_href,
        CASE WHEN l.doc_id IS NOT NULL THEN source END AS source_name,
        CAST(l.quality AS VARCHAR) AS source_rank,
        CASE WHEN l.doc_id IS NOT NULL THEN '{"country":"' || lang || '"}' END AS source_location,
        lang AS keywords, CAST(NULL AS BOOLEAN) AS is_duplicate,
        CAST(NULL AS VARCHAR) AS canonical_url
        FROM (SELECT *, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i
          FROM documents) AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id""",
        "author_id",
        "is_duplicate",
    ),
    "drop_void_columns": "SELECT * FROM supplier",
}
