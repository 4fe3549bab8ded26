"""Queries on the news feeds.

The four feeds are the stored pages, split by the language segment of their address; every page
belongs to one feed.  Addresses and dates are dirtied by rules on the page's own address, so that
missing, relative and broken values occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators import feeds as ops
from solstrand.plans.shown import as_text, as_text_sql
from solstrand.sinks.tables import row_count
from solstrand.sources.tables import table

LANGUAGE_OF_FEED = {"bbc": "en", "cnn": "de", "google": "fr", "reuters": "es"}
COUNTRY_OF_LANGUAGE = {"en": "GB", "de": "DE", "fr": "FR", "es": "ES"}


def country_by_page_language(content: Column) -> Column:
    """A rule in place of a model: the country code that goes with the page's declared language."""
    language = F.regexp_extract(content, 'lang="([a-z]{2})"', 1)
    return F.coalesce(*[F.when(language == k, F.lit(v)) for k, v in COUNTRY_OF_LANGUAGE.items()])


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stories, with every column any feed has."""
    address = F.col("url")
    path = F.regexp_replace(address, "^https?://[^/]+", "")
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    stamp = F.concat(F.lit('"2024-01-'), day, F.lit('T08:30:00Z"'))
    dirty_url = (
        F.when(address.contains("spam-farm"), "not a url")
        .when(address.endswith("#top"), F.lit(None))
        .when(address.contains("utm_source"), path)
        .otherwise(address)
    )
    dirty_date = (
        F.when(address.startswith("http://"), "unknown")
        .when(address.startswith("https://m."), F.lit(None))
        .otherwise(stamp)
    )
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    host = F.regexp_extract(address, "^https?://([^/?#]+)", 1)
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract(address, "^https?://[^/]+/([a-z]{2})/", 1).alias("language"),
        F.col("page_id").alias("id"),
        dirty_url.alias("url"),
        host.alias("author"),
        title.alias("headline"),
        path.alias("topics"),
        dirty_date.alias("publication_date"),
        F.col("html").alias("content"),
        F.lit(None).cast("string").alias("videos"),
        F.size(F.split("html", "<img")).cast("string").alias("images"),
        F.size(F.split("html", "<a ")).cast("string").alias("related_articles"),
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("keyword"),
        dirty_date.alias("updated_last"),
        title.alias("description"),
        host.alias("publisher"),
        title.alias("title"),
        path.alias("category"),
        dirty_date.alias("date"),
        F.lit("FR").alias("country"),
    )


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    stories = _stories(spark, sf_dir)
    return {
        name: stories.filter(F.col("language") == language).select(*ops.FEED_READS[name])
        for name, language in LANGUAGE_OF_FEED.items()
    }


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.checked(ops.stacked(feeds(spark, sf_dir)), country_by_page_language)


UNION_TEXT = ["local_id", "try_parse_publication_date"]


def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds in one table, ids running on from feed to feed."""
    rows = ops.feeds_union(feeds(spark, sf_dir), country_by_page_language)
    return as_text(rows, *UNION_TEXT)


def global_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the stories alone."""
    ids = ops.feeds_union(feeds(spark, sf_dir), country_by_page_language)
    return ids.select("id", "source", "url", "keyword")


def one_feed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(feeds(spark, sf_dir)["bbc"])


def invalid_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories of one feed without a usable address, numbered by publication date."""
    feed = feeds(spark, sf_dir)["bbc"]
    rows = ops.invalid_url_rows(feed, ["publication_date", "id"])
    return rows.select(
        F.col("id").alias("local_id"),
        F.lit("bbc").alias("source"),
        "try_parse_url",
        "url",
        "author",
        "headline",
        "topics",
        "publication_date",
        F.lit(None).cast("string").alias("updated_last"),
        F.lit(None).cast("string").alias("description"),
        "content",
        "videos",
        "images",
        "related_articles",
        "keyword",
        F.lit(None).cast("string").alias("country"),
        "rownumber",
    )


def url_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_validity(_stack(spark, sf_dir))


def scheme_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(ops.count_by_scheme(_stack(spark, sf_dir)), "has_http")


def http_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_http(_stack(spark, sf_dir))


def dates_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid stories with their cleaned publication date."""
    checked = ops.date_check(_stack(spark, sf_dir))
    rows = checked.select("trycast", "source", "local_id", "url", "publication_date")
    return as_text(rows, "trycast", "local_id")


def story_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check for the one story with a given id: the middle one of the first feed."""
    stories = feeds(spark, sf_dir)
    ids = ops.feeds_union(stories, country_by_page_language)
    middle = stories["bbc"].count() // 2
    rows = ops.date_check(ids, row_id=middle).select("trycast", "id", "source", "url")
    return as_text(rows, "trycast")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories per feed and guessed country."""
    return (
        _stack(spark, sf_dir)
        .groupBy("source", "country", "try_parse_country")
        .agg(F.count("*").alias("n"))
    )


QUERIES = {
    "feeds_union": union,
    "feed_global_ids": global_ids,
    "feed_row_count": one_feed_count,
    "feed_invalid_urls": invalid_urls,
    "feed_url_validity": url_validity,
    "feed_scheme_validity": scheme_validity,
    "feed_http_count": http_count,
    "feed_dates_clean": dates_clean,
    "feed_story_by_id": story_by_id,
    "feed_country": countries,
}


# --- SQL twins ----------------------------------------------------------------------------------

_STORIES = """(SELECT *, CASE WHEN host IS NULL THEN NULL ELSE 'VALID' END AS try_parse_url,
      try_cast(replace(publication_date, '"', '') AS TIMESTAMP) AS try_parse_publication_date
    FROM (SELECT *, nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host
      FROM (SELECT
        CASE regexp_extract(p.url, '^https?://[^/]+/([a-z]{2})/', 1)
          WHEN 'en' THEN 'bbc' WHEN 'de' THEN 'cnn' WHEN 'fr' THEN 'google' WHEN 'es' THEN 'reuters'
          END AS source,
        page_id AS id,
        CASE WHEN contains(p.url, 'spam-farm') THEN 'not a url' WHEN p.url LIKE '%#top' THEN NULL
          WHEN contains(p.url, 'utm_source') THEN regexp_replace(p.url, '^https?://[^/]+', '')
          ELSE p.url END AS url,
        regexp_extract(p.url, '^https?://([^/?#]+)', 1) AS author,
        regexp_extract(html, '<title>([^<]*)</title>', 1) AS headline,
        regexp_replace(p.url, '^https?://[^/]+', '') AS topics,
        CASE WHEN p.url LIKE 'http://%' THEN 'unknown' WHEN p.url LIKE 'https://m.%' THEN NULL
          ELSE '"2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || 'T08:30:00Z"' END
          AS publication_date,
        html AS content,
        CAST(len(string_split(html, '<img')) AS VARCHAR) AS images,
        CAST(len(string_split(html, '<a ')) AS VARCHAR) AS related_articles,
        'page ' || CAST(page_id AS VARCHAR) AS keyword,
        CASE regexp_extract(html, 'lang="([a-z]{2})"', 1) WHEN 'en' THEN 'GB' WHEN 'de' THEN 'DE'
          WHEN 'fr' THEN 'FR' WHEN 'es' THEN 'ES' END AS guess
      FROM pages AS p) AS raw) AS hosted)"""
_ALIGNED = f"""(SELECT source, CASE WHEN source = 'google' THEN NULL ELSE id END AS local_id,
      try_parse_url, url, author, headline, topics, try_parse_publication_date, publication_date,
      CASE WHEN source IN ('cnn', 'reuters') THEN publication_date END AS updated_last,
      CASE WHEN source = 'reuters' THEN headline END AS description,
      CASE WHEN source <> 'google' THEN content END AS content, CAST(NULL AS VARCHAR) AS videos,
      CASE WHEN source <> 'google' THEN images END AS images,
      CASE WHEN source <> 'google' THEN related_articles END AS related_articles, keyword,
      CASE WHEN source = 'google' THEN 'FR' END AS country,
      CASE WHEN source = 'google' THEN 'FR' ELSE guess END AS try_parse_country
    FROM {_STORIES} AS s)"""
_BY_URL = "url NULLS FIRST, local_id NULLS FIRST, keyword, headline"
_NUMBERED = f"""(SELECT row_number() OVER (ORDER BY
      CASE source WHEN 'bbc' THEN 1 WHEN 'cnn' THEN 2 WHEN 'google' THEN 3 ELSE 4 END, {_BY_URL})
      AS id, * FROM {_ALIGNED} AS a)"""

ORACLES = {
    "feeds_union": as_text_sql(f"SELECT * FROM {_NUMBERED} AS n", *UNION_TEXT),
    "feed_global_ids": f"SELECT id, source, url, keyword FROM {_NUMBERED} AS n",
    "feed_row_count": f"SELECT count(*) AS n FROM {_STORIES} AS s WHERE source = 'bbc'",
    "feed_invalid_urls": f"""SELECT id AS local_id, source, host AS try_parse_url, url, author,
        headline, topics, publication_date, CAST(NULL AS VARCHAR) AS updated_last,
        CAST(NULL AS VARCHAR) AS description, content, CAST(NULL AS VARCHAR) AS videos, images,
        related_articles, keyword, CAST(NULL AS VARCHAR) AS country,
        row_number() OVER (ORDER BY publication_date NULLS FIRST, id) AS rownumber
        FROM {_STORIES} AS s WHERE source = 'bbc' AND host IS NULL""",
    "feed_url_validity": f"""SELECT source, try_parse_url, count(*) AS n FROM {_ALIGNED} AS a
        GROUP BY source, try_parse_url""",
    "feed_scheme_validity": as_text_sql(
        f"""SELECT source, try_parse_url, starts_with(url, 'http') AS has_http,
        count(*) AS n FROM {_ALIGNED} AS a GROUP BY 1, 2, 3""",
        "has_http",
    ),
    "feed_http_count": f"SELECT count(*) AS n FROM {_ALIGNED} AS a WHERE starts_with(url, 'http')",
    "feed_dates_clean": as_text_sql(
        f"""SELECT try_parse_publication_date AS trycast, source, local_id, url,
        publication_date FROM {_ALIGNED} AS a WHERE try_parse_url = 'VALID'""",
        "trycast",
        "local_id",
    ),
    "feed_story_by_id": as_text_sql(
        f"""SELECT try_parse_publication_date AS trycast, id, source, url
        FROM {_NUMBERED} AS n WHERE try_parse_url = 'VALID'
        AND id = (SELECT count(*) // 2 FROM {_STORIES} AS s WHERE source = 'bbc')""",
        "trycast",
    ),
    "feed_country": f"""SELECT source, country, try_parse_country, count(*) AS n
        FROM {_ALIGNED} AS a GROUP BY 1, 2, 3""",
}
