"""Queries on the geographic hierarchy.

Five stored tables that refer to one another stand in for the five levels: line items are the
cities, then orders, customers, nations and regions.  Coordinates are arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.functions.grid import FINEST, cell
from solstrand.operators import geo as ops
from solstrand.sources.tables import table


def longitude(key: str) -> Column:
    return F.col(key) * 137 % 36000 / F.lit(100.0) - F.lit(180.0)


def latitude(key: str) -> Column:
    return F.col(key) * 61 % 18000 / F.lit(100.0) - F.lit(90.0)


def _levels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    city = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    cities = (
        table(spark, sf_dir, "lineitem")
        .withColumn("id", city)
        .select(
            "id",
            F.col("l_shipdate").alias("name"),
            longitude("id").alias("longitude"),
            latitude("id").alias("latitude"),
            F.col("l_returnflag").alias("native"),
            F.col("l_orderkey").alias("state_id"),
        )
    )
    states = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("type"),
        longitude("o_orderkey").alias("longitude"),
        latitude("o_orderkey").alias("latitude"),
        F.col("o_custkey").alias("country_id"),
    )
    countries = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("currency"),
        longitude("c_custkey").alias("longitude"),
        latitude("c_custkey").alias("latitude"),
        F.col("c_nationkey").alias("subregion_id"),
    )
    subregions = table(spark, sf_dir, "nation").toDF("id", "name", "region_id")
    regions = table(spark, sf_dir, "region").toDF("id", "name")
    return cities, states, countries, subregions, regions


def world_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every city with its four upper levels and its 48 cells."""
    world = ops.world(*_levels(spark, sf_dir))
    return world.withColumn("cities_name", F.col("cities_name").cast("string"))


def chain_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities per region, subregion and country segment; unused columns are pruned to the scans."""
    return (
        ops.world(*_levels(spark, sf_dir), resolutions=())
        .groupBy("region_name", "subregion_name", "country_currency")
        .agg(F.count("*").alias("n_cities"), F.count_distinct("state_id").alias("n_states"))
    )


def cell_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and their balances per cell, at all sixteen resolutions."""
    customers = table(spark, sf_dir, "customer")
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    rolled = ops.cell_rollup(
        customers, longitude("c_custkey"), latitude("c_custkey"), balance, "balance"
    )
    return rolled.withColumn("balance", F.col("balance").cast("double"))


def cell_rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the largest table, by the supplier's place: few cells, many rows each."""
    return ops.cell_rollup(
        table(spark, sf_dir, "lineitem"),
        longitude("l_suppkey"),
        latitude("l_suppkey"),
        F.col("l_quantity").cast("bigint"),
        "quantity",
    )


def cell_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed in the same cell of resolution 6 as a supplier, counted per supplier.

    Orders are counted per cell before they meet the suppliers.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(cell(longitude("o_custkey"), latitude("o_custkey"), 6).alias("cell"))
        .agg(F.count("*").alias("n_orders"))
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", cell(longitude("s_suppkey"), latitude("s_suppkey"), 6).alias("s_cell")
    )
    return ops.join_on_cell(orders, suppliers, "cell", "s_cell").select(
        "s_suppkey", "cell", "n_orders"
    )


QUERIES = {
    "geo_world_view": world_view,
    "geo_chain_join": chain_join,
    "geo_cell_rollup": cell_rollup,
    "geo_cell_rollup_lineitem": cell_rollup_lineitem,
    "geo_cell_join": cell_join,
}


# --- SQL twins ----------------------------------------------------------------------------------

def _lon(key: str) -> str:
    return f"({key} * 137 % 36000 / 100.0::DOUBLE - 180.0::DOUBLE)"


def _lat(key: str) -> str:
    return f"({key} * 61 % 18000 / 100.0::DOUBLE - 90.0::DOUBLE)"


def _cell(key: str, resolution: int | str) -> str:
    side = f"pow(2, {resolution})"
    row = f"floor(({_lat(key)} + 90.0) / 180.0 * {side})"
    column = f"floor(({_lon(key)} + 180.0) / 360.0 * {side})"
    return f"CAST({row} * {side} + {column} AS BIGINT)"


def _cells(prefix: str, key: str) -> str:
    return ", ".join(
        f"{_cell(key, r)} AS {prefix}_cell_res_{r}" for r in range(FINEST + 1)
    )


_CITY_KEY = "(l_orderkey * 8 + l_linenumber)"
_CHAIN = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _rollup(source: str, key: str, value: str, name: str) -> str:
    return f"""SELECT CAST(r AS INTEGER) AS resolution, {_cell(key, 'r')} AS cell, count(*) AS n,
        {value} AS {name} FROM {source}, generate_series(0, {FINEST}) AS s(r) GROUP BY 1, 2"""


ORACLES = {
    "geo_world_view": f"""SELECT {_CITY_KEY} AS cities_id,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS cities_name,
        {_lon(_CITY_KEY)} AS cities_longitude, {_lat(_CITY_KEY)} AS cities_latitude,
        l_returnflag AS cities_native, {_cells('cities', _CITY_KEY)},
        o_orderkey AS state_id, o_orderpriority AS state_name, o_orderstatus AS state_type,
        {_lon('o_orderkey')} AS state_longitude, {_lat('o_orderkey')} AS state_latitude,
        {_cells('state', 'o_orderkey')},
        c_custkey AS country_id, c_name AS country_name, c_mktsegment AS country_currency,
        {_lon('c_custkey')} AS country_longitude, {_lat('c_custkey')} AS country_latitude,
        {_cells('country', 'c_custkey')},
        n_nationkey AS subregion_id, n_name AS subregion_name,
        r_regionkey AS region_id, r_name AS region_name FROM {_CHAIN}""",
    "geo_chain_join": f"""SELECT r_name AS region_name, n_name AS subregion_name,
        c_mktsegment AS country_currency, count(*) AS n_cities,
        count(DISTINCT o_orderkey) AS n_states FROM {_CHAIN} GROUP BY 1, 2, 3""",
    "geo_cell_rollup": _rollup(
        "customer", "c_custkey", "CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE)", "balance"
    ),
    "geo_cell_rollup_lineitem": _rollup(
        "lineitem", "l_suppkey", "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)", "quantity"
    ),
    "geo_cell_join": f"""SELECT s_suppkey, cell, n_orders
        FROM (SELECT {_cell('o_custkey', 6)} AS cell, count(*) AS n_orders FROM orders GROUP BY 1)
          AS o JOIN (SELECT s_suppkey, {_cell('s_suppkey', 6)} AS s_cell FROM supplier) AS s
          ON o.cell = s.s_cell""",
}
