"""Queries on customers: value, churn, paths to a purchase, records of one person, baskets, items alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators import attribution, baskets, nearest, resolution
from solstrand.operators.matching import near_texts
from solstrand.operators.running import tiled
from solstrand.operators.survival import product_limit, retention
from solstrand.sinks.scratch import written
from solstrand.sources.tables import table

GONE_AFTER = 180
LEAST_SHARE = 200  # a set of brands counts from one in so many baskets on
EDITS = 2
THRESHOLD = 13.5
FIELDS = (
    resolution.Field("name", 0.95, typos=1),
    resolution.Field("nation", 0.98),
    resolution.Field("cents", 0.9),
    resolution.Field("segment", 0.9),
    resolution.Field("since", 0.95),
)
BLOCKS = (("nation", "cents"), ("since", "segment"), ("since", "nation"), ("name",))
NEIGHBOURS = 5
LISTS, PROBES = 12, 9


def rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in fifths by how lately, how often and for how much they ordered."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last"),
        F.count("*").alias("n"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )
    rows = written(orders, "rfm")
    for name, by in (("recency", "last"), ("frequency", "n"), ("monetary", "cents")):
        rows = written(tiled(rows, [F.col(by), F.col("o_custkey")], 5, name), name)
    return rows.select("o_custkey", "n", "cents", "recency", "frequency", "monetary")


def survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long customers of a segment keep ordering; who ordered lately has not ended yet."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    end = orders.agg(F.max("day")).first()[0]
    lives = orders.groupBy("o_custkey").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    lives = lives.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    months = F.floor(F.datediff("last", "first") / 30)
    gone = F.datediff(F.lit(end), F.col("last")) > GONE_AFTER
    found = product_limit(lives.select("c_mktsegment", months.alias("months"), gone.alias("gone")), "c_mktsegment", "months", F.col("gone"))
    return found.withColumns({"survival": F.round("survival", 9), "variance": F.round("variance", 9)})


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the customers first seen in a quarter, how many ordered so many quarters later."""
    quarter = F.year("o_orderdate") * 4 + F.quarter("o_orderdate")
    return retention(table(spark, sf_dir, "orders"), "o_custkey", quarter)


def _stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    buys: Column = F.col("event_type") == "purchase"
    return written(attribution.steps(events, "user_id", [F.col("ts"), F.col("event_id")], "event_type", buys), "steps")


def channel_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came first, last and on the way to a purchase."""
    return attribution.position_credit(_stepped(spark, sf_dir)).withColumn("linear", F.round("linear", 6))


def channel_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows what on the way to a purchase."""
    return attribution.transitions(_stepped(spark, sf_dir))


def brand_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands that are often ordered together."""
    rows = _brands(spark, sf_dir)
    least = max(2, rows.select("l_orderkey").distinct().count() // LEAST_SHARE)
    sets = baskets.frequent_sets(rows, "l_orderkey", "p_brand", least)
    return sets.select(F.array_join("items", " ").alias("items"), "n")


def brand_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which brand goes with which others."""
    rows = _brands(spark, sf_dir)
    n = rows.select("l_orderkey").distinct().count()
    sets = written(baskets.frequent_sets(rows, "l_orderkey", "p_brand", max(2, n // LEAST_SHARE), 2), "sets")
    return baskets.rules(sets, n).withColumn("items", F.array_join("items", " "))


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")


ITEM = "p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_size"
# What shops write: a letter lost, two letters more, one changed and one lost, three changed, or as it is.
OFFER = f"""CASE p_partkey % 5 WHEN 0 THEN substring({ITEM}, 1, 2) || substring({ITEM}, 4)
    WHEN 1 THEN {ITEM} || ' x' WHEN 2 THEN 'q' || substring({ITEM}, 2, 4) || substring({ITEM}, 7)
    WHEN 3 THEN replace({ITEM}, 'Brand', 'Mark') ELSE {ITEM} END"""


def item_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each written offer the catalogue's text that is nearest, and how many are within two edits."""
    parts = table(spark, sf_dir, "part")
    offers, items = parts.select(F.expr(OFFER).alias("text")), parts.select(F.expr(ITEM).alias("text"))
    near = near_texts(offers, items, EDITS)
    return near.groupBy(F.col("left_text").alias("offer")).agg(
        F.min(F.struct("distance", "right_text")).alias("best"), F.count("*").alias("n_near")
    ).select("offer", F.col("best.right_text").alias("item"), F.col("best.distance").alias("distance"), "n_near")


# Records of customers, and of every third one a second record with a fault in one or two fields.
_PERSON = "c_custkey * 2 AS id, c_name AS name, c_nationkey AS nation, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_mktsegment AS segment, since"
_COPY = """c_custkey * 2 + 1 AS id,
    CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, '#', '') ELSE c_name END AS name,
    CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE c_nationkey END AS nation,
    CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(round(c_acctbal * 100) AS BIGINT) END AS cents,
    CASE WHEN c_custkey % 9 = 0 THEN 'OTHER' ELSE c_mktsegment END AS segment, since"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("since"))
    known = table(spark, sf_dir, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    columns = lambda text: known.selectExpr(*_split(text))
    copies = known.filter("c_custkey % 3 = 0").selectExpr(*_split(_COPY))
    return written(columns(_PERSON).unionByName(copies), "people")


def _split(text: str) -> list[str]:
    """The expressions of a select list whose commas inside brackets do not count."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def person_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the least record of the same person."""
    return resolution.resolved(people(spark, sf_dir), "id", FIELDS, BLOCKS, THRESHOLD)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors to every fiftieth one, by a scan of all."""
    vectors = _vectors(spark, sf_dir)
    return nearest.exact_neighbours(vectors, vectors.filter("id % 50 = 0"), NEIGHBOURS)


def vector_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the index; these vectors point everywhere, so most of its lists must be looked into."""
    vectors = _vectors(spark, sf_dir)
    centres = nearest.fit_centres(vectors, LISTS)
    return nearest.index_neighbours(nearest.index(vectors, centres), centres, vectors.filter("id % 50 = 0"), NEIGHBOURS, PROBES)


QUERIES = {
    "customer_rfm": rfm,
    "churn_survival": survival,
    "retention_cohorts": cohorts,
    "channel_credit": channel_credit,
    "channel_moves": channel_moves,
    "brand_sets": brand_sets,
    "brand_rules": brand_rules,
    "item_matches": item_matches,
    "person_entities": person_entities,
    "vector_neighbours": vector_neighbours,
    "vector_index_search": vector_index_search,
}

_PATHS = """
    marked AS (SELECT *, event_type = 'purchase' AS converts,
        coalesce(lag(event_type) OVER w = 'purchase', true) AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    pathed AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS path FROM marked)"""
_BRANDS = "b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey)"
_LEAST = f"(SELECT greatest(2, count(DISTINCT o) // {LEAST_SHARE}) FROM b)"

ORACLES = {
    "customer_rfm": """
        WITH o AS (SELECT o_custkey, max(o_orderdate) AS last, count(*) AS n,
            CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1)
        SELECT o_custkey, n, cents, CAST(ntile(5) OVER (ORDER BY last, o_custkey) AS INT) AS recency,
          CAST(ntile(5) OVER (ORDER BY n, o_custkey) AS INT) AS frequency,
          CAST(ntile(5) OVER (ORDER BY cents, o_custkey) AS INT) AS monetary FROM o""",
    "churn_survival": f"""
        WITH lives AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders GROUP BY 1),
        counts AS (SELECT c_mktsegment, (z - a) // 30 AS months,
            count(*) FILTER ((SELECT max(z) FROM lives) - z > {GONE_AFTER}) AS n_ended,
            count(*) FILTER ((SELECT max(z) FROM lives) - z <= {GONE_AFTER}) AS n_censored
            FROM lives JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
        risked AS (SELECT *, CAST(sum(n_ended + n_censored) OVER (PARTITION BY c_mktsegment ORDER BY months
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS at_risk FROM counts),
        made AS (SELECT *, product(1 - n_ended / at_risk) OVER w AS s,
            sum(CASE WHEN at_risk > n_ended THEN n_ended / (at_risk * (at_risk - n_ended)) ELSE 0 END) OVER w AS g
            FROM risked WINDOW w AS (PARTITION BY c_mktsegment ORDER BY months))
        SELECT c_mktsegment, months, at_risk, n_ended, n_censored, round(s, 9) AS survival,
          CASE WHEN s > 0 THEN round(s * s * g, 9) END AS variance FROM made""",
    "retention_cohorts": """
        WITH seen AS (SELECT DISTINCT o_custkey, year(o_orderdate) * 4 + quarter(o_orderdate) AS q FROM orders),
        born AS (SELECT o_custkey, min(q) AS cohort FROM seen GROUP BY 1)
        SELECT CAST(cohort AS INT) AS cohort, CAST(q - cohort AS INT) AS age, count(*) AS n FROM seen JOIN born USING (o_custkey) GROUP BY 1, 2""",
    "channel_credit": f"""
        WITH {_PATHS},
        touches AS (SELECT *, count(*) OVER p AS m, row_number() OVER (p ORDER BY ts, event_id) AS i FROM pathed AS a WHERE NOT converts
            AND EXISTS (SELECT 1 FROM pathed AS b WHERE b.user_id = a.user_id AND b.path = a.path AND b.converts)
            WINDOW p AS (PARTITION BY user_id, path))
        SELECT event_type AS channel, count(*) FILTER (i = 1) AS first, count(*) FILTER (i = m) AS last,
          round(sum(1 / m), 6) AS linear FROM touches GROUP BY 1""",
    "channel_moves": f"""
        WITH {_PATHS},
        moves AS (SELECT event_type AS source, CASE lead(event_type) OVER w WHEN 'purchase' THEN '(sale)' ELSE coalesce(lead(event_type) OVER w, '(none)') END AS target,
            converts FROM pathed WINDOW w AS (PARTITION BY user_id, path ORDER BY ts, event_id))
        SELECT source, target, count(*) AS n FROM (SELECT source, target FROM moves WHERE NOT converts
            UNION ALL SELECT '(start)', CASE WHEN converts THEN '(sale)' ELSE event_type END FROM pathed WHERE opens) GROUP BY 1, 2""",
    "brand_sets": f"""
        WITH {_BRANDS}
        SELECT i AS items, count(*) AS n FROM b GROUP BY 1 HAVING n >= {_LEAST}
        UNION ALL SELECT x.i || ' ' || y.i, count(*) AS n FROM b AS x JOIN b AS y ON x.o = y.o AND x.i < y.i GROUP BY 1 HAVING n >= {_LEAST}
        UNION ALL SELECT x.i || ' ' || y.i || ' ' || z.i, count(*) AS n FROM b AS x JOIN b AS y ON x.o = y.o AND x.i < y.i
          JOIN b AS z ON z.o = y.o AND y.i < z.i GROUP BY 1 HAVING n >= {_LEAST}""",
    "brand_rules": f"""
        WITH {_BRANDS}, s AS (SELECT i, count(*) AS n FROM b GROUP BY 1),
        p AS (SELECT x.i AS a, y.i AS c, count(*) AS n FROM b AS x JOIN b AS y ON x.o = y.o AND x.i <> y.i GROUP BY 1, 2 HAVING n >= {_LEAST})
        SELECT a AS items, c AS then, p.n, p.n / s.n AS confidence,
          CAST(p.n * (SELECT count(DISTINCT o) FROM b) AS DOUBLE) / (s.n * t.n) AS lift
        FROM p JOIN s ON s.i = a JOIN s AS t ON t.i = c""",
    "item_matches": f"""
        WITH a AS (SELECT DISTINCT {OFFER} AS offer FROM part), c AS (SELECT DISTINCT {ITEM} AS item FROM part),
        near AS (SELECT offer, item, levenshtein(offer, item) AS d FROM a JOIN c ON abs(length(offer) - length(item)) <= {EDITS}
            AND levenshtein(offer, item) <= {EDITS})
        SELECT offer, arg_min(item, (d, item)) AS item, CAST(min(d) AS INT) AS distance, count(*) AS n_near FROM near GROUP BY 1""",
    "person_entities": f"""
        WITH RECURSIVE known AS (SELECT * FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS since FROM orders GROUP BY 1) ON o_custkey = c_custkey),
        r AS MATERIALIZED (SELECT {_PERSON} FROM known UNION ALL SELECT {_COPY} FROM known WHERE c_custkey % 3 = 0),
        {', '.join(f"u_{f.name} AS (SELECT {f.name} AS v, count(*) / (SELECT count(*) FROM r) AS u FROM r WHERE {f.name} IS NOT NULL GROUP BY 1)" for f in FIELDS)},
        w AS MATERIALIZED (SELECT r.*, {', '.join(f"u_{f.name}.u AS u_{f.name}" for f in FIELDS)} FROM r
            {' '.join(f"LEFT JOIN u_{f.name} ON u_{f.name}.v = r.{f.name}" for f in FIELDS)}),
        pairs AS (SELECT x.id AS a, y.id AS b, {' + '.join(f'''CASE WHEN x.{f.name} IS NULL OR y.{f.name} IS NULL THEN 0
            WHEN x.{f.name} = y.{f.name} THEN log2({f.agrees} / least(x.u_{f.name}, y.u_{f.name}))
            {f'WHEN levenshtein(x.{f.name}, y.{f.name}) <= {f.typos} THEN log2({f.agrees} / least(x.u_{f.name}, y.u_{f.name})) / 2' if f.typos else ''}
            ELSE log2({1 - f.agrees} / (1 - (SELECT sum(u * u) FROM u_{f.name}))) END''' for f in FIELDS)} AS weight
            FROM w AS x JOIN w AS y ON x.id < y.id AND ({' OR '.join('(' + ' AND '.join(f'x.{c} = y.{c}' for c in block) + ')' for block in BLOCKS)})),
        links AS MATERIALIZED (SELECT a, b FROM pairs WHERE weight >= {THRESHOLD} UNION SELECT b, a FROM pairs WHERE weight >= {THRESHOLD}),
        walk(id, other) AS (SELECT id, id FROM r UNION SELECT walk.id, links.b FROM walk JOIN links ON links.a = walk.other)
        SELECT id, min(other) AS entity FROM walk GROUP BY 1""",
    "vector_neighbours": f"""
        WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda c: CAST(round_even(CAST(c AS DOUBLE) * 1024, 0) AS BIGINT)) AS x FROM embeddings),
        s AS (SELECT q.id AS query, v.id, CAST(list_sum(list_transform(range(1, len(v.x) + 1), lambda i: v.x[i] * q.x[i])) AS BIGINT) AS score
            FROM v JOIN v AS q ON q.id % 50 = 0 AND q.id <> v.id),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS INT) AS rank FROM s)
        SELECT query, id, score, rank FROM ranked WHERE rank <= {NEIGHBOURS}""",
}
