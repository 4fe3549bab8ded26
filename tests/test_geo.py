from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from solstrand.functions.grid import FINEST, cell, cell_columns, coarser
from solstrand.operators import geo


def plain_cell(lon: float, lat: float, r: int) -> int:
    side = 1 << r
    column = min(math.floor((lon + 180.0) / 360.0 * side), side - 1)
    row = min(math.floor((lat + 90.0) / 180.0 * side), side - 1)
    return row * side + column


def points() -> list[tuple[float, float]]:
    rng = random.Random(3)
    spots = [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0), (179.999999, 89.999999), (9.19, 45.46)]
    return spots + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)]


def test_cells_at_all_resolutions(spark):
    df = spark.createDataFrame(points(), "lon double, lat double").withColumn(
        "finest", cell(F.col("lon"), F.col("lat"))
    )
    direct = [cell(F.col("lon"), F.col("lat"), r).alias(f"d{r}") for r in range(FINEST + 1)]
    up = [coarser(F.col("finest"), FINEST, r).alias(f"u{r}") for r in range(FINEST + 1)]
    for row in df.select("*", *direct, *up, *cell_columns("p", "finest")).collect():
        for r in range(FINEST + 1):
            want = plain_cell(row["lon"], row["lat"], r)
            assert row[f"d{r}"] == row[f"u{r}"] == row[f"p_cell_res_{r}"] == want


def test_no_cell_without_a_place(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (181.0, 0.0), (0.0, -90.5)], "x double, y double")
    rows = df.withColumn("c", cell(F.col("x"), F.col("y"))).select("c", *cell_columns("p", "c"))
    assert all(v is None for r in rows.collect() for v in r)


def test_rollup_equals_brute_force_with_a_hot_cell(spark):
    pts = points() + [(9.19, 45.46)] * 100 + [(None, 3.0), (500.0, 0.0)]
    df = spark.createDataFrame([(x, y, i) for i, (x, y) in enumerate(pts)], "x double, y double, v long")
    got = {
        (r["resolution"], r["cell"]): (r["n"], r["total"])
        for r in geo.cell_rollup(df, F.col("x"), F.col("y"), F.col("v")).collect()
    }
    want: dict = {}
    for i, (x, y) in enumerate(pts):
        off = x is None or abs(x) > 180
        for r in range(FINEST + 1):
            place = (r, None if off else plain_cell(x, y, r))
            n, s = want.get(place, (0, 0))
            want[place] = (n + 1, s + i)
    assert got == want


def levels(spark):
    place = "longitude double, latitude double"
    cities = spark.createDataFrame(
        [(i, f"c{i}", 9.0, 45.0, 1 if i < 40 else i % 4) for i in range(100)]
        + [(1000, "lost", 0.0, 0.0, 99), (1001, "none", 0.0, 0.0, None)],
        f"id int, name string, {place}, state_id int",
    )
    states = spark.createDataFrame(
        [(i, f"s{i}", 9.0, 45.0, 0 if i < 3 else 7) for i in range(4)],
        f"id int, name string, {place}, country_id int",
    )
    countries = spark.createDataFrame(
        [(0, "k0", 9.0, 45.0, 0)], f"id int, name string, {place}, subregion_id int"
    )
    subregions = spark.createDataFrame([(0, "sr", 0)], "id int, name string, region_id int")
    regions = spark.createDataFrame([(0, "r")], "id int, name string")
    return cities, states, countries, subregions, regions


def test_world_drops_cities_without_all_levels(spark):
    world = geo.world(*levels(spark))
    rows = world.collect()
    # State 3 has no country, states 99 and NULL do not exist.
    want = [i for i in range(100) if (1 if i < 40 else i % 4) != 3]
    assert sorted(r["cities_id"] for r in rows) == want
    assert sum(c.count("_cell_res_") for c in world.columns) == 48
    assert {r["region_name"] for r in rows} == {"r"}
    assert not [c for c in world.columns if c.startswith("_")]


def test_world_is_the_same_without_broadcasts(spark):
    plain = sorted(map(tuple, geo.world(*levels(spark)).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = geo.world(*levels(spark))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        # No cell is worked out below an exchange: only coordinates travel.
        assert "_cell_res_" not in plan[plan.index("Exchange") :]
        assert sorted(map(tuple, merged.collect())) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rows_off_the_globe_stay_in_the_null_cell(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (None, 2.0, 2), (500.0, 2.0, 4)], "x double, y double, v int")
    rolled = geo.cell_rollup(df, F.col("x"), F.col("y"), F.col("v"))
    rows = rolled.filter("cell IS NULL").select("resolution", "n", "total").collect()
    assert sorted(map(tuple, rows)) == [(r, 2, 6) for r in range(16)]
