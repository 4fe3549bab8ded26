"""Alignment of unlike news feeds into one table, and the checks on it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.functions.text import clean_timestamp, url_host, url_validity
from solstrand.operators.ids import numbered

# The columns of the union, in order.
FEED_COLUMNS = [
    "id", "local_id", "source", "try_parse_url", "url", "author", "headline", "topics",
    "try_parse_publication_date", "publication_date", "updated_last", "description", "content",
    "videos", "images", "related_articles", "keyword", "country", "try_parse_country",
]
# What is added to the row number of each feed.
ID_OFFSETS = {"bbc": 0, "cnn": 1500, "google": 3000, "reuters": 4500}
# The columns read from each feed, and the common names of those that differ.
_STORY = [
    "id", "url", "author", "headline", "topics", "publication_date", "content", "videos", "images",
    "related_articles", "keyword",
]
FEED_READS = {
    "bbc": _STORY,
    "cnn": [*_STORY, "updated_last"],
    "google": ["url", "publisher", "title", "category", "date", "keyword", "country"],
    "reuters": [*_STORY, "updated_last", "description"],
}
COMMON_NAMES = {
    "id": "local_id", "publisher": "author", "title": "headline", "category": "topics",
    "date": "publication_date",
}

CountryGuess = Callable[[Column], Column]


def aligned(name: str, rows: DataFrame) -> DataFrame:
    """One feed under the common column names; columns the feed lacks are left out."""
    common = [F.col(c).alias(COMMON_NAMES.get(c, c)) for c in FEED_READS[name]]
    return rows.select(F.lit(name).alias("source"), *common)


def stacked(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """All feeds one below the other, matched by name; no shuffle.

    A column only some feeds have is NULL, of the type it has there, in the others.
    """
    frames = [aligned(name, rows) for name, rows in feeds.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    given = [c for c in FEED_COLUMNS if c != "id" and not c.startswith("try_")]
    missing = {c: F.lit(None).cast("string") for c in given if c not in union.columns}
    return union.withColumns(missing).select(*given)


def checked(rows: DataFrame, country_guess: CountryGuess) -> DataFrame:
    """The checks next to the stacked columns: URL, publication date, country.

    Feeds that state their country keep it, the others get the guess from their content.
    """
    own = [name for name, reads in FEED_READS.items() if "country" in reads]
    guess = country_guess(F.col("content"))
    return rows.withColumns(
        {
            "try_parse_url": url_validity(F.col("url")),
            "try_parse_publication_date": clean_timestamp(F.col("publication_date")),
            "try_parse_country": F.when(F.col("source").isin(own), F.col("country")).otherwise(guess),
        }
    )


def _last_ids(id_offsets: Mapping[str, int]) -> dict[str, int | None]:
    """The last id each feed may have; none is set for the one with the highest offset."""
    above = sorted(id_offsets.values())
    return {n: next((o for o in above if o > own), None) for n, own in id_offsets.items()}


def feeds_union(
    feeds: Mapping[str, DataFrame],
    country_guess: CountryGuess,
    id_offsets: Mapping[str, int] | None = None,
) -> DataFrame:
    """The feeds in one table with an `id` by order of `url`.

    The feeds are numbered one behind the other, so ids are unique at any size.  With `id_offsets`
    the numbers restart in every feed and its fixed offset is added; the job fails when a feed
    outgrows the gap to the next offset, where ids would collide.

    One range exchange numbers all feeds together, so a feed with most of the rows is spread over
    as many tasks as its size asks for.  The country is guessed after it: the exchange looks at
    its input twice, and a model should be asked once.
    """
    rows = stacked(feeds)
    # Rows with the same url, or none, follow in the order of the next columns.
    by_url = [F.col(c).asc_nulls_first() for c in ("url", "local_id", "keyword", "headline")]
    source = F.col("source")
    if id_offsets is None:
        place = F.array_position(F.array(*[F.lit(name) for name in feeds]), source)
        ids = numbered(rows, [place, *by_url])
    else:
        if missing := set(feeds) - set(id_offsets):
            raise ValueError(f"no id offset for {sorted(missing)}")
        offset = F.coalesce(*[F.when(source == n, F.lit(o)) for n, o in id_offsets.items()])
        last = F.coalesce(*[F.when(source == n, F.lit(o)) for n, o in _last_ids(id_offsets).items()])
        ranked = numbered(rows, by_url, "_rank", group="source")
        number = F.col("_rank") + offset
        outgrown = F.raise_error(F.concat(F.lit("ids of feed "), source, F.lit(" outgrow its offset")))
        ids = ranked.withColumn("id", F.when(number > last, outgrown).otherwise(number))
    return checked(ids, country_guess).select(*FEED_COLUMNS)


def invalid_url_rows(feed: DataFrame, order: Sequence[str] = ("publication_date",)) -> DataFrame:
    """Rows whose URL has no host, numbered in the given order as `rownumber`."""
    bad = feed.withColumn("try_parse_url", url_host(F.col("url"))).filter(
        F.col("try_parse_url").isNull()
    )
    return numbered(bad, [F.col(c).asc_nulls_first() for c in order], "rownumber")


def count_by_validity(union: DataFrame) -> DataFrame:
    """Rows per feed and URL validity; NULL is a group of its own."""
    return union.groupBy("source", "try_parse_url").agg(F.count("*").alias("n"))


def count_by_scheme(union: DataFrame) -> DataFrame:
    """Rows per feed, URL validity and whether the URL starts with `http`."""
    return union.groupBy(
        "source", "try_parse_url", F.startswith("url", F.lit("http")).alias("has_http")
    ).agg(F.count("*").alias("n"))


def count_http(union: DataFrame) -> DataFrame:
    return union.filter(F.startswith("url", F.lit("http"))).agg(F.count("*").alias("n"))


def date_check(union: DataFrame, row_id: int | None = None) -> DataFrame:
    """Valid rows with the cleaned publication date in front; one row of them with `row_id`."""
    valid = union.filter(F.col("try_parse_url") == "VALID")
    if row_id is not None:
        valid = valid.filter(F.col("id") == row_id)
    return valid.select(clean_timestamp(F.col("publication_date")).alias("trycast"), "*")
