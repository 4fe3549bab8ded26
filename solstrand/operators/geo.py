"""The geographic hierarchy and rollups over grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.functions.grid import FINEST, cell, cell_columns, coarser

# The attributes of each level, as named in the source tables.
CITY = "id name latitude longitude native timezone translations wikiDataId".split()
STATE = (
    "id name fips_code iso2 iso3166_2 type level parent_id native latitude longitude timezone "
    "translations wikiDataId"
).split()
COUNTRY = (
    "id name iso2 iso3 numeric_code phonecode capital currency currency_name currency_symbol tld "
    "native population gdp nationality timezones translations latitude longitude emoji wikiDataId"
).split()
SUBREGION = "id name translations wikiDataId".split()
REGION = "id name translations wikiDataId".split()


def _level(
    df: DataFrame,
    prefix: str,
    names: Sequence[str],
    parent: str = "",
) -> DataFrame:
    """The level's columns under its prefix, the parent's id as `_parent_<prefix>`.

    Attributes the table lacks are left out.
    """
    have = [c for c in names if c in df.columns]
    columns = [F.col(c).alias(f"{prefix}_{c}") for c in have]
    if parent:
        columns.append(F.col(parent).alias(f"_parent_{prefix}"))
    return df.select(*columns)


def world(
    cities: DataFrame,
    states: DataFrame,
    countries: DataFrame,
    subregions: DataFrame,
    regions: DataFrame,
    resolutions: Sequence[int] = range(FINEST + 1),
) -> DataFrame:
    """One row per city with its state, country, subregion and region.

    Cities, states and countries carry their cell at each of `resolutions`: 48 columns by default.

    A city without a match on every level above drops out.  The levels are joined from the top
    down, so the cities, by far the largest level, are joined once.  How is the planner's choice: a
    side below spark.sql.autoBroadcastJoinThreshold is broadcast, else both are exchanged and
    adaptive execution splits a state that holds a large part of the cities.  Only coordinates
    travel; the cells are worked out behind the last join.
    """
    steps = [
        (_level(subregions, "subregion", SUBREGION, "region_id"), "subregion", "region_id"),
        (_level(countries, "country", COUNTRY, "subregion_id"), "country", "subregion_id"),
        (_level(states, "state", STATE, "country_id"), "state", "country_id"),
        (_level(cities, "cities", CITY, "state_id"), "cities", "state_id"),
    ]
    top = _level(regions, "region", REGION)
    for level, prefix, parent_id in steps:
        own = f"_parent_{prefix}"
        top = level.join(top, F.col(own) == F.col(parent_id)).drop(own)
    finest, columns = {}, []
    for level, prefix, _ in reversed(steps):
        columns += [F.col(c) for c in level.columns if c != f"_parent_{prefix}"]
        place = [f"{prefix}_longitude", f"{prefix}_latitude"]
        if resolutions and set(place) <= set(top.columns):
            finest[f"_finest_{prefix}"] = cell(*[F.col(c) for c in place])
            columns += cell_columns(prefix, f"_finest_{prefix}", resolutions)
    last = [F.col(c) for c in top.columns if c.startswith("region_")]
    return top.withColumns(finest).select(*columns, *last)


def cell_rollup(
    df: DataFrame, longitude: Column, latitude: Column, value: Column, name: str = "total"
) -> DataFrame:
    """Rows and the exact sum of `value` per cell at all sixteen resolutions.

    Rows are summed into the finest cells first, within each task before the exchange; only these
    sums are copied to the coarser cells above them.  Rows without a place on the globe are in the
    NULL cell of every resolution.
    """
    placed = longitude.between(-180, 180) & latitude.between(-90, 90)
    finest = (
        df.select(F.when(placed, cell(longitude, latitude)).alias("_cell"), value.alias("_value"))
        .groupBy("_cell")
        .agg(F.count("*").alias("_n"), F.sum("_value").alias("_sum"))
    )
    levels = F.explode(F.array(*[F.lit(r) for r in range(FINEST + 1)]))
    return (
        finest.select("*", levels.alias("resolution"))
        .groupBy("resolution", coarser(F.col("_cell"), FINEST, F.col("resolution")).alias("cell"))
        .agg(F.sum("_n").alias("n"), F.sum("_sum").alias(name))
    )


def join_on_cell(rows: DataFrame, places: DataFrame, rows_cell: str, places_cell: str) -> DataFrame:
    """Rows with the places in the same cell; rows whose cell holds no place drop out."""
    return rows.join(places, rows[rows_cell] == places[places_cell])
