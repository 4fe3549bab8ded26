"""Mixing sources to target weights: budgets down a tree domain - language - source.

A leaf can give its tokens at most `max_epochs` times.  The budget of a node is shared among its
children by weight; what a child cannot give goes to its siblings first, and only what a whole
family cannot give reaches the family's siblings (capacities are summed up the tree before budgets
come down it).  A leaf then takes whole epochs and, of the next one, the prefix of its documents in
that epoch's seeded order.  The document that crosses the budget is taken whole.

Budgets are whole tokens, rounded down at each node, so the mix may miss the total by less than one
token per node.  The prefix is found without sorting a leaf in one task: documents are summed by
the first hex digits of their order hash, whole ranges are taken or left, and only the one range
that holds the budget is sorted.  The number of digits follows the counted rows of the largest leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solstrand.llm.common import col, estimated_tokens, fresh, set_aside
from solstrand.sinks.scratch import written

RANGE_ROWS = 2048
_WIDE = "decimal(38,0)"
ADDED = ["domain", "leaf_tokens", "leaf_budget", "doc_tokens", "repeats"]
#: Share of the whole in thousandths for each domain, and the sources of each; others are `web`.
DOMAIN_WEIGHTS = {"reference": 300, "code": 200, "web": 500}
DOMAIN_SOURCES = {
    "reference": ["src1", "src2", "src3", "src4"],
    "code": ["src5", "src6", "src7"],
}
LANG_WEIGHTS = {"en": 600, "de": 150, "fr": 150, "es": 100}


def chosen(value: Column, weights: dict[str, int], other: int) -> Column:
    """The weight listed for a value."""
    out = F.lit(other)
    for name, weight in weights.items():
        out = F.when(value == name, weight).otherwise(out)
    return out.cast("long")


def source_domain(source: Column, sources: dict[str, list[str]], other: str = "web") -> Column:
    out = F.lit(other)
    for name, members in sources.items():
        out = F.when(source.isin(members), name).otherwise(out)
    return out


def shares(children: DataFrame, parent: list[str], budget: str, out: str) -> DataFrame:
    """Each child's part of its parent's `budget`, from columns `weight` and `cap`.

    Children that can give least for their weight are served first.  Child i is full when the
    parent's budget reaches what it takes to fill all up to i at an equal rate; the others share
    the rest by weight.  Integer arithmetic; a child of weight 0 gets nothing.
    """
    by_rate = Window.partitionBy(*parent).orderBy(
        F.when(col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), "cap", "child"
    )
    wide = lambda c: F.col(c).cast(_WIDE)
    before = by_rate.rowsBetween(Window.unboundedPreceding, -1)
    after = by_rate.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    placed = children.withColumns(
        {
            "cap_before": F.coalesce(F.sum(wide("cap")).over(before), F.lit(0)).cast(_WIDE),
            "weight_after": F.sum(wide("weight")).over(after).cast(_WIDE),
        }
    )
    # Children ahead in the order are full only if this one's rate is not reached before.
    left = F.greatest(wide(budget) - F.col("cap_before"), F.lit(0)).cast(_WIDE)
    full = (F.col("weight") > 0) & (
        (wide("cap") * F.col("weight_after")).cast(_WIDE) <= (left * wide("weight")).cast(_WIDE)
    )
    flagged = placed.withColumn("full", full)
    rest = flagged.withColumns(
        {
            "full_caps": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(
                Window.partitionBy(*parent)
            ),
            "open_weight": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(
                Window.partitionBy(*parent)
            ),
        }
    )
    part = F.when(F.col("full"), F.col("cap")).when(
        F.col("open_weight") > 0,
        F.expr(
            f"((cast({budget} as decimal(38,0)) - cast(full_caps as decimal(38,0)))"
            " * cast(weight as decimal(38,0))) div cast(open_weight as decimal(38,0))"
        ),
    )
    kept = [c for c in children.columns]
    return rest.select(*kept, F.coalesce(part, F.lit(0)).cast("long").alias(out))


def leaf_budgets(leaves: DataFrame, budget_permille: int, max_epochs: int) -> DataFrame:
    """(domain, language, leaf, tokens, rows, budget) from a frame of leaves with their weights.

    `leaves` has one row per leaf: its path, tokens, rows and the weights at each level.  The total
    budget is `budget_permille` thousandths of all tokens, or all the leaves can give if that is less.
    """
    cap = (F.col("tokens") * max_epochs).cast("long")
    leaves = leaves.withColumn("cap", cap)
    langs = leaves.groupBy("domain", "language").agg(
        F.sum("cap").alias("cap"), F.max("lang_weight").alias("weight")
    )
    domains = leaves.groupBy("domain").agg(
        F.sum("tokens").alias("tokens"), F.sum("cap").alias("cap"), F.max("domain_weight").alias("weight")
    )
    # The windows over everything hold one row per domain.
    whole = Window.partitionBy("root")
    top = domains.withColumns({"root": F.lit(0), "child": F.col("domain")}).withColumns(
        {"all_tokens": F.sum("tokens").over(whole), "all_cap": F.sum("cap").over(whole)}
    )
    wanted = F.expr(f"least((all_tokens * {int(budget_permille)}) div 1000, all_cap)")
    top = shares(top.withColumn("total", wanted), ["root"], "total", "domain_budget")
    top = top.select("domain", "domain_budget")
    middle = shares(
        langs.join(top, "domain").withColumn("child", F.col("language")),
        ["domain"],
        "domain_budget",
        "lang_budget",
    ).select("domain", "language", "lang_budget")
    bottom = leaves.join(middle, ["domain", "language"]).withColumns(
        {"child": F.col("leaf"), "weight": F.col("leaf_weight")}
    )
    return shares(bottom, ["domain", "language"], "lang_budget", "budget").select(
        "domain", "language", "leaf", "tokens", "rows", "budget"
    )


def mixed_documents(
    docs: DataFrame,
    seed: int = 17,
    budget_permille: int = 1000,
    max_epochs: int = 4,
    domain_weights: dict[str, int] | None = None,
    domain_sources: dict[str, list[str]] | None = None,
    lang_weights: dict[str, int] | None = None,
) -> DataFrame:
    """The documents of the mix with `domain`, `leaf_tokens`, `leaf_budget`, `doc_tokens`, `repeats`.

    NULL or unlisted languages and sources are children like others ('' stands for NULL), with
    weight 100; sources weigh the same.  Documents without text have no tokens: they cost nothing
    and are taken in whole epochs and in the prefix; a leaf without any tokens gives nothing.  Repeated rows are rows of their
    own.  Columns of these names in `docs` are replaced; `docs` may be empty.
    """
    domain_weights = DOMAIN_WEIGHTS if domain_weights is None else domain_weights
    domain_sources = DOMAIN_SOURCES if domain_sources is None else domain_sources
    lang_weights = LANG_WEIGHTS if lang_weights is None else lang_weights
    docs = docs.drop(*ADDED)
    lang, source, tokens, digits = fresh(docs, "lang_", "source_", "tokens_", "text_md5_")
    full, rest, order, span, edge, run = fresh(
        docs, "mix_epochs_", "mix_rest_", "mix_order_", "mix_range_", "edge_", "run_"
    )
    keyed = docs.withColumns(
        {
            lang: F.coalesce(col("lang"), F.lit("")),
            source: F.coalesce(col("source"), F.lit("")),
            tokens: estimated_tokens(col("text")),
            digits: F.md5(F.coalesce(col("text"), F.lit("")).cast("binary")),
        }
    ).withColumn("domain", source_domain(col(source), domain_sources))
    leaves = (
        keyed.groupBy("domain", col(lang).alias("language"), col(source).alias("leaf"))
        .agg(F.sum(tokens).alias("tokens"), F.count("*").alias("rows"))
        .withColumns(
            {
                "domain_weight": chosen(F.col("domain"), domain_weights, 100),
                "lang_weight": chosen(F.col("language"), lang_weights, 100),
                "leaf_weight": F.lit(100).cast("long"),
            }
        )
    )
    budgets = leaf_budgets(leaves, budget_permille, max_epochs).withColumns(
        {
            "epochs": F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0),
            "rest": F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0),
        }
    )
    largest = leaves.agg(F.max("rows")).first()[0] or 0
    width = max(1, (max(largest, 1) // RANGE_ROWS).bit_length() // 4 + 1)
    leaf = ["domain", lang, source]
    budgets = budgets.select(
        "domain",
        F.col("language").alias(lang),
        F.col("leaf").alias(source),
        F.col("tokens").alias("leaf_tokens"),
        F.col("budget").alias("leaf_budget"),
        F.col("epochs").alias(full),
        F.col("rest").alias(rest),
    )
    ids = F.coalesce(col("doc_id").cast("string"), F.lit(""))

    def ordered(plan: DataFrame) -> DataFrame:
        """Leaf facts on each document, and its order hash in the leaf's broken epoch."""
        number = col(full).cast("string")
        return (
            keyed.join(plan, leaf)
            .withColumn(order, F.md5(F.concat_ws(":", F.lit(str(seed)), number, ids, digits).cast("binary")))
            .withColumn(span, F.substring(order, 1, width))
        )

    earlier = Window.partitionBy(*leaf).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    # Of each leaf, the one range in which its prefix ends: all before are in, all after are out.
    edges = (
        ordered(budgets)
        .groupBy(*leaf, span)
        .agg(F.sum(tokens).alias("sum_"), F.max(rest).alias("rest_"))
        .withColumn("before_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0)))
        .filter("before_ + sum_ >= rest_")
        .groupBy(*leaf)
        .agg(F.min(F.struct(col(span).alias("span"), "before_")).alias(edge))
    )
    plan = written(budgets.join(edges, leaf), "mix")
    placed = ordered(plan)
    last = col(edge).getField("span")
    final = [*[col(c) for c in docs.columns], col("domain"), col("leaf_tokens"), col("leaf_budget")]
    taken = F.when(col(span) < last, 1).otherwise(0)
    whole = placed.filter(col(span) != last).select(
        *final, col(tokens).alias("doc_tokens"), (col(full) + taken).cast("long").alias("repeats")
    )
    inside = (
        Window.partitionBy(*leaf)
        .orderBy(order, digits)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = col(edge).getField("before_") + F.coalesce(F.sum(tokens).over(inside), F.lit(0))
    cut = (
        placed.filter(col(span) == last)
        .withColumn(run, before)
        .select(
            *final,
            col(tokens).alias("doc_tokens"),
            (col(full) + F.when(col(run) < col(rest), 1).otherwise(0))
            .cast("long")
            .alias("repeats"),
        )
    )
    return whole.unionByName(cut).filter("repeats > 0")


def epochs(mix: DataFrame) -> DataFrame:
    """One row per epoch in which a document of the mix is read, with `epoch` from 0."""
    return mix.withColumn("epoch", F.explode(F.sequence(F.lit(0), (F.col("repeats") - 1).cast("int"))))


def mixed_copies(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of `docs`: each document as often as epochs read it, with its own columns."""
    own, back = set_aside(docs, [*ADDED, "epoch"])
    rows = epochs(mixed_documents(own, **options)).select(*[col(c) for c in own.columns])
    return rows.withColumnsRenamed(back)


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """The mix without texts."""
    slim = docs.select("doc_id", "lang", "source", "text")
    return mixed_documents(slim, **options).select(
        "doc_id", "domain", "lang", "source", "leaf_tokens", "leaf_budget", "doc_tokens", "repeats"
    )
