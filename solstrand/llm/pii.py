"""Personal data: generators propose spans, boosted trees score them, thresholds select.

Base spans follow fixed rules and always stay.  Wider generators propose more: national phone
numbers, spelled-out mail addresses, other groupings of card digits, IPv6 addresses, keys and other
secrets, and what the base patterns matched but their checks refused.  Each candidate has a few
binned features of its form and its context, together its cell.

Boosted trees learn the cells from a labelled book: value shapes set into contexts that speak for
them, for nothing, or against them.  The labels come from the book, not from the checks.  A third of
the contexts is held out; per kind the least score that keeps the target precision there is the limit.
The book is of fixed size (BOOK, contexts and COPIES), so a document's spans do not depend on the rest
of the corpus.  The cells are bounded by the product of the bins.  All columns are built-in expressions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from solstrand.llm.common import col, fresh
from solstrand.sinks.scratch import written

#: The kinds in their order and the base patterns.
KINDS = ["email", "ip", "card", "phone"]
#: Kinds that only the method adds, behind them.
ALL_KINDS = [*KINDS, "secret"]
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The same matches, without a retry from every character of a long run and without recursion.
_FAST = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PHONE,
}
_WIDE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}"
        r"(?:(?:\x20?[\[(](?:dot|DOT)[\])]\x20?|\.)[A-Za-z0-9-]{1,63}){1,8}"
    ),
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){2}[./_][0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])",
    # Runs of 16 or more with a digit and a letter.
    "secret": (
        r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])"
        r"[A-Za-z0-9_/+-]{16,}+(?![A-Za-z0-9_/+-])"
    ),
}
_CUES = {
    "email": r"(?i)mail|contact|write|@",
    "ip": r"(?i)\bip\b|addr|host|server",
    "card": r"(?i)card|visa|pay|credit",
    "phone": r"(?i)phone|tel|call|mobile|fax",
    "secret": r"(?i)token|secret|key|passw|auth|bearer|credential",
}
_AGAINST = r"(?i)order|invoice|isbn|serial|version|commit|sha|checksum|ticket|track|item|article|\bref|uuid|build"
CONTEXT = 24
#: Features and their numbers of bins; their product bounds the cells.
BINS = {"kind": 5, "digits": 7, "form": 4, "left": 4, "right": 4, "cue": 3, "wide": 2}
TARGET_PRECISION = 0.98

#: The labelled book: kind, shape of the value (# a digit, ~ a hexadecimal one, * a letter or digit),
#: and whether it is personal data behind words that speak for it, for nothing, against it.
BOOK = [
    ("email", "****[at]******.com", (1, 1, 1)),
    ("email", "***** (at) ****.org", (1, 1, 1)),
    ("email", "**.****[AT]mail.****[DOT]net", (1, 1, 1)),
    ("email", "******(at)*****(dot)com", (1, 1, 1)),
    ("ip", "~~~~:~~~~:~~~~:~~~~:~~~~:~~~~:~~~~:~~~~", (1, 1, 0)),
    ("ip", "~~~~:~~~:0:0:~~:~~~~:~~~~:~", (1, 1, 0)),
    ("ip", "###.###.###.###", (0, 0, 0)),
    ("ip", "#.####.###.####", (0, 0, 0)),
    ("ip", "####.##.##.#####", (0, 0, 0)),
    ("card", "################", (1, 0, 0)),
    ("card", "#### #### #### ####", (1, 0, 0)),
    ("card", "####-####-####-####", (1, 0, 0)),
    ("card", "####.####.####.####", (1, 0, 0)),
    ("card", "####/####/####/####", (1, 0, 0)),
    ("card", "####_####_####_####", (1, 1, 0)),
    ("card", "###############", (1, 0, 0)),
    ("card", "##", (0, 0, 0)),
    ("card", "####", (0, 0, 0)),
    ("card", "####-##-##", (0, 0, 0)),
    ("card", "########", (0, 0, 0)),
    ("card", "## ## ####", (0, 0, 0)),
    ("card", "##########", (0, 0, 0)),
    ("card", "############", (0, 0, 0)),
    ("card", "######################", (0, 0, 0)),
    ("phone", "(###) ###-####", (1, 1, 0)),
    ("phone", "###-###-####", (1, 1, 0)),
    ("phone", "###.###.####", (1, 0, 0)),
    ("phone", "### ### ####", (1, 0, 0)),
    ("phone", "+# ###", (0, 0, 0)),
    ("phone", "+##.##", (0, 0, 0)),
    ("phone", "+###### ####### #######", (0, 0, 0)),
    ("secret", "~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~", (1, 0, 0)),
    ("secret", "~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~", (1, 0, 0)),
    ("secret", "************************", (1, 0, 0)),
    ("secret", "****************************************", (1, 0, 0)),
    ("secret", "**-************************", (1, 0, 0)),
    ("secret", "****/******+**********/*****", (1, 0, 0)),
    ("secret", "~~~~~~~~-~~~~-~~~~-~~~~-~~~~~~~~~~~~", (1, 0, 0)),
]
#: Contexts (before, behind); of each list every third is held out.
FOR = {
    "email": [
        ("mail me: ", " today"), ("contact ", "."), ("write to ", ", please"),
        ("e-mail ", ""), ("my mail is ", ")"), ("contacts <", ">"),
    ],
    "ip": [
        ("host ", " is up"), ("server at ", "."), ("ip: ", ""),
        ("the address ", ", port"), ("from host (", ")"), ("ip ", " failed"),
    ],
    "card": [
        ("card number ", " until"), ("visa: ", "."), ("pay with ", ", thanks"),
        ("credit card ", ""), ("card (", ")"), ("my card is \"", "\""),
    ],
    "phone": [
        ("call ", " now"), ("phone: ", "."), ("tel. ", ", or"),
        ("fax ", ""), ("mobile (", ")"), ("phone ", " today"),
    ],
    "secret": [
        ("token = \"", "\""), ("api key: ", " here"), ("secret=", ""),
        ("the token is ", "."), ("password: \"", "\","), ("auth key ", " works"),
    ],
}
PLAIN = [
    ("the ", " of it"), ("we saw ", "."), ("", ""), ("and then (", ")"), ("about \"", "\""), ("on that day ", ", so"),
    ("was=", ";"), ("in ", " places"), ("was: ", "!"),
]
AGAINST = [
    ("order ", " came"), ("commit ", "."), ("serial no ", ""), ("invoice (", ")"), ("version \"", "\""), ("item: ", ", new"),
    ("sha=", ""), ("ticket ", " is open"), ("checksum: \"", "\""),
]
COPIES = 6


class Model(NamedTuple):
    """Boosted trees and, by number of kind, the least score that is selected."""

    trees: GBTClassificationModel
    limits: dict[int, float]


def _may_hold(text: Column) -> Column:
    """Whether a text can hold any candidate; almost all texts end here."""
    return F.coalesce(text.rlike("[0-9@]|[\\[(](at|AT)[\\])]"), F.lit(False))


def _bound(value: Column, use) -> Column:
    """use(value), with `value` computed once however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost matches as (gap, match, before, behind), `gap` being the width of the text between."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<gap:int,match:string,before:string,behind:string>>")

    def listed(s: Column) -> Column:
        def one(i: Column) -> Column:
            gap = F.get(s["gaps"], i)
            return F.struct(
                F.char_length(gap).alias("gap"),
                F.get(s["found"], i).alias("match"),
                F.right(gap, F.lit(CONTEXT)).alias("before"),
                F.left(F.get(s["gaps"], i + 1), F.lit(2)).alias("behind"),
            )

        n = F.size(s["found"])
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(none)

    return _bound(F.struct(found.alias("found"), gaps.alias("gaps")), listed)


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))

    def weigh(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.transform(numbers, weigh), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def candidates(docs: DataFrame, row: str) -> DataFrame:
    """All proposed spans: row, doc_id, kind, start, stop, base, and the features; row without any too.

    One row with a NULL kind stands for each document without candidates.
    """
    text = col("text")
    lists = []
    for n, kind in enumerate(ALL_KINDS):
        for wide, pattern in ((0, _FAST.get(kind)), (1, _WIDE[kind])):
            if pattern is None:
                continue
            lists.append(
                F.struct(F.lit(n).alias("kind"), F.lit(wide).alias("wide"), _matches(text, pattern).alias("list"))
            )
    per_list = F.when(
        _may_hold(text), F.filter(F.array(*lists), lambda x: F.size(x["list"]) > 0)
    )
    rows = (
        docs.select(col(row).alias("row"), col("doc_id").alias("doc_id"), per_list.alias("lists"))
        .select("row", "doc_id", F.explode_outer("lists").alias("l"))
        .select(
            "row",
            "doc_id",
            F.col("l.kind").alias("kind"),
            F.col("l.wide").alias("wide"),
            F.posexplode_outer("l.list").alias("place", "m"),
        )
    )
    earlier = Window.partitionBy("row", "kind", "wide").orderBy("place")
    width = F.char_length("m.match")
    stop = F.sum(F.col("m.gap") + width).over(earlier)
    spans = rows.withColumn("stop", stop).select(
        "row",
        "doc_id",
        "kind",
        "wide",
        (F.col("stop") - width).alias("start"),
        "stop",
        F.col("m.match").alias("match"),
        F.col("m.before").alias("before"),
        F.col("m.behind").alias("behind"),
    )
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.char_length(digits)
    parts = F.split("match", r"\.")
    valid = (
        F.when(F.col("kind") == 0, F.lit(True))
        .when(
            F.col("kind") == 1,
            # A part of more digits than 255 has is at most 255 only behind zeros.
            F.forall(parts, lambda p: F.char_length(F.regexp_replace(p, "^0+", "")) <= 3)
            & F.forall(
                parts,
                lambda p: F.coalesce(
                    F.right(F.concat(F.lit("000"), p), F.lit(3)).try_cast("int") <= 255, F.lit(False)
                ),
            ),
        )
        .when(F.col("kind") == 2, n.between(13, 19) & _luhn(digits))
        .otherwise((F.col("kind") == 3) & n.between(9, 15))
    )
    side = lambda c: (
        F.when(F.coalesce(c, F.lit("")).rlike(r"^\s?$"), 0).when(c.rlike("[A-Za-z]"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)
    )
    speaks = F.lit(False)
    for k, kind in enumerate(ALL_KINDS):
        speaks = F.when(F.col("kind") == k, F.col("before").rlike(_CUES[kind])).otherwise(speaks)
    cue = F.when(speaks, 1).when(F.col("before").rlike(_AGAINST), 2).otherwise(0)
    # Separators inside: none, even groups, groups as in a phone number, others.  Of a secret: lower
    # hexadecimal, one case, both cases, separators.
    form = (
        F.when((F.col("kind") == 4) & F.col("match").rlike("^[0-9a-f]+$"), 0)
        .when((F.col("kind") == 4) & F.col("match").rlike("^(?:[0-9a-z]+|[0-9A-Z]+)$"), 1)
        .when((F.col("kind") == 4) & ~F.col("match").rlike("[^0-9A-Za-z]"), 2)
        .when(~F.col("match").rlike("[^0-9A-Za-z]"), 0)
        .when(F.col("match").rlike(r"^[0-9]{4}([\x20./_-][0-9]{4})+$"), 1)
        .when(F.col("match").rlike(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"), 2)
        .otherwise(3)
    )
    size = (
        F.when(n < 7, 0).when(n < 9, 1).when(n <= 11, 2).when(n <= 13, 3).when(n <= 15, 4).when(n == 16, 5).otherwise(6)
    )
    known = F.col("kind").isNotNull()
    return spans.select(
        "row",
        "doc_id",
        "kind",
        "start",
        "stop",
        F.when(known, (F.col("wide") == 0) & valid).alias("base"),
        F.when(known, size).alias("digits"),
        F.when(known, form).alias("form"),
        F.when(known, side(F.right("before", F.lit(1)))).alias("left"),
        F.when(known, side(F.left("behind", F.lit(1)))).alias("right"),
        F.when(known, F.coalesce(cue, F.lit(0))).alias("cue"),
        "wide",
    )


def _cell() -> Column:
    """The number of a candidate's cell, from its features."""
    out = F.lit(0)
    for name, bins in BINS.items():
        out = out * bins + F.col(name)
    return out.cast("int")


def book_texts(spark: SparkSession) -> DataFrame:
    """(id, text, kind, start, stop, label, held): the labelled book, written out.

    Digits and letters of a value follow from a hash of its shape, context and copy.
    """
    lit = lambda x: F.struct(*[F.lit(v).alias(f"v{i}") for i, v in enumerate(x)])
    shapes = F.array(*[lit((ALL_KINDS.index(k), shape, *says)) for k, shape, says in BOOK])
    contexts = F.array(
        *[
            F.array(
                *[
                    lit((before, behind, role, n % 3 == 2))
                    for role, listed in enumerate((FOR[kind], PLAIN, AGAINST))
                    for n, (before, behind) in enumerate(listed)
                ]
            )
            for kind in ALL_KINDS
        ]
    )
    rows = (
        spark.range(COPIES)
        .select("id", F.explode(shapes).alias("s"))
        .select("id", "s", F.explode(F.get(contexts, F.col("s.v0"))).alias("c"))
        .withColumn("id", F.xxhash64("id", "s.v0", "s.v1", "c.v0", "c.v2"))
    )

    def drawn(letters: str, i: Column) -> Column:
        at = F.pmod(F.xxhash64(F.col("id"), i), F.lit(len(letters))).cast("int")
        return F.substring(F.lit(letters), at + 1, F.lit(1))

    def filled(c: Column, i: Column) -> Column:
        digits, small = "0123456789", "abcdefghijklmnopqrstuvwxyz"
        return (
            F.when(c == "#", drawn(digits, i))
            .when(c == "~", drawn(digits + "abcdef", i))
            .when(c == "*", drawn(digits + small + small.upper(), i))
            .otherwise(c)
        )

    value = F.array_join(F.transform(F.split("s.v1", ""), filled), "")
    start = F.char_length("c.v0")
    label = F.when(F.col("c.v2") == 0, F.col("s.v2")).when(F.col("c.v2") == 1, F.col("s.v3")).otherwise(F.col("s.v4"))
    return rows.select(
        "id",
        F.concat("c.v0", value, "c.v1").alias("text"),
        F.col("s.v0").alias("kind"),
        start.alias("start"),
        (start + F.char_length(value)).alias("stop"),
        label.alias("label"),
        F.col("c.v3").alias("held"),
    )


def _least_scores(scored: list, target: float) -> dict[int, float]:
    """Per kind, the least score of held-out candidates above which the target precision holds."""
    out = {}
    for kind in range(len(ALL_KINDS)):
        mine = sorted((c for c in scored if c["kind"] == kind), key=lambda c: -c["score"])
        right, all_ = 0, 0
        for i, c in enumerate(mine):
            right, all_ = right + c["yes"], all_ + c["yes"] + c["no"]
            last = i + 1 == len(mine) or mine[i + 1]["score"] < c["score"]
            if last and c["yes"] and right >= target * all_:
                out[kind] = float(c["score"])
    return out


def fit(spark: SparkSession, target: float = TARGET_PRECISION) -> Model:
    """Learns from the book; the limits come from contexts that the trees have not seen.

    A candidate is right if its kind is the value's, it lies within the value, and the book says so.
    Base spans stay whatever the score, so they are left out.  A cell is one weighted row.
    """
    book = book_texts(spark)
    placed = book.select("id", F.lit(0).alias("doc_id"), "text")
    told = book.select(
        F.col("id").alias("row"),
        F.col("kind").alias("of"),
        F.col("start").alias("a"),
        F.col("stop").alias("b"),
        "label",
        "held",
    )
    right = (F.col("kind") == F.col("of")) & (F.col("start") >= F.col("a")) & (F.col("stop") <= F.col("b"))
    yes = F.when(right, F.col("label")).otherwise(0)
    count = lambda held, value: F.count_if((F.col("held") == held) & (F.col("yes") == value))
    cells = (
        candidates(placed, "id")
        .filter("kind IS NOT NULL AND NOT base")
        .join(told, "row")
        .withColumn("yes", yes)
        .groupBy(_cell().alias("cell"), *BINS)
        .agg(
            count(False, 1).alias("learn_yes"),
            count(False, 0).alias("learn_no"),
            count(True, 1).alias("yes"),
            count(True, 0).alias("no"),
        )
    )
    cells = written(cells.coalesce(1).sortWithinPartitions("cell"), "cells")
    ready = VectorAssembler(inputCols=list(BINS), outputCol="features").transform(cells)
    train = (
        ready.select("features", F.lit(1.0).alias("label"), F.col("learn_yes").alias("weight"))
        .unionByName(ready.select("features", F.lit(0.0).alias("label"), F.col("learn_no").alias("weight")))
        .filter("weight > 0")
        .withColumn("weight", F.col("weight").cast("double"))
    )
    trees = GBTClassifier(
        weightCol="weight", maxIter=10, maxDepth=5, stepSize=0.3, seed=7, minInstancesPerNode=1, checkpointInterval=-1
    ).fit(train)
    scored = trees.transform(ready.filter("yes + no > 0")).select("kind", "yes", "no", "probability").collect()
    rows = [
        {"kind": r["kind"], "yes": r["yes"], "no": r["no"], "score": round(r["probability"][1], 6)} for r in scored
    ]
    return Model(trees, _least_scores(rows, target))


def selected_cells(spans: DataFrame, model: Model) -> list[int]:
    """The cells of `spans` at or above their kind's limit; at most the product of BINS."""
    cells = spans.filter("kind IS NOT NULL AND NOT base").select(_cell().alias("cell"), *BINS).distinct()
    ready = VectorAssembler(inputCols=list(BINS), outputCol="features").transform(cells)
    scored = model.trees.transform(ready).select("cell", "kind", "probability").collect()
    return sorted(
        r["cell"] for r in scored if round(r["probability"][1], 6) >= model.limits.get(r["kind"], 2.0)
    )


def selected(spans: DataFrame, model: Model) -> DataFrame:
    """Base spans, and the selected others that overlap neither a base span nor an earlier one."""
    cells = selected_cells(spans, model)
    listed = F.array(*[F.lit(c) for c in cells]).cast("array<int>")
    chosen = spans.filter(F.col("base") | F.array_contains(listed, _cell())) if cells else spans.filter("base")
    by_place = Window.partitionBy("row").orderBy("start", F.desc("base"), F.desc("stop"), "kind")
    ahead = by_place.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_place.rowsBetween(1, Window.unboundedFollowing)
    free = chosen.withColumns(
        {
            "reach": F.max("stop").over(ahead),
            "next_base": F.min(F.when(F.col("base"), F.col("start"))).over(behind),
        }
    ).filter(
        F.col("base")
        | (
            (F.coalesce("reach", F.lit(0)) <= F.col("start"))
            & (F.coalesce("next_base", F.col("stop")) >= F.col("stop"))
        )
    )
    return free.select("row", "kind", "start", "stop", "base")


def _joined(list_: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    one = lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
    )
    return F.array_join(F.transform(list_, one), ",")


def personal_data(docs: DataFrame, target: float = TARGET_PRECISION) -> DataFrame:
    """(row, doc_id, found): per document its spans in order of kind and start, each with `base`."""
    (row,) = fresh(docs, "row")
    placed = docs.select(
        F.monotonically_increasing_id().alias(row), col("doc_id").alias("doc_id"), col("text").alias("text")
    )
    spans = written(candidates(placed, row), "spans")
    found = (
        selected(spans, fit(docs.sparkSession, target))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop", "base"))).alias("found"))
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint,base:boolean>>")
    ids = spans.select("row", "doc_id").distinct()
    return ids.join(found, "row", "left").select("row", "doc_id", F.coalesce("found", none).alias("found"))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts, checksum and list of the spans of each document; NULL and empty texts have none.

    The counts of the base kinds and the checksum are of base spans; `n_added` and `spans` hold the others.
    """
    found = personal_data(docs)
    base = F.filter("found", lambda s: s["base"])
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")
    return found.withColumn("base", base).select(
        "doc_id",
        *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        F.size("found").cast("long").alias("n_spans"),
        (F.size("found") - F.size("base")).cast("long").alias("n_added"),
    )


BLOCK = 1024


def redacted_text(text: Column, islands: Column) -> Column:
    """`text` with each of `islands` (start, stop, label; apart and in order) replaced by its label.

    The text is cut into blocks first, so a piece costs its own length and two blocks, wherever it lies.
    """

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        count = F.greatest(F.floor((b - 1) / BLOCK).cast("int") - first + 1, F.lit(0))
        some = F.array_join(F.slice(blocks, first + 1, count), "")
        return F.when(b > a, F.substring(some, (a % BLOCK + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    def whole(blocks: Column) -> Column:
        n = F.size(islands)
        parts = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.concat(
                piece(
                    blocks,
                    F.when(i == 0, F.lit(0)).otherwise(F.get(islands, i - 1)["stop"]),
                    F.get(islands, i)["start"],
                ),
                F.lit("["),
                F.get(islands, i)["label"],
                F.lit("]"),
            ),
        )
        tail = piece(blocks, F.get(islands, n - 1)["stop"], F.char_length(text).cast("long"))
        return F.concat(F.array_join(parts, ""), tail)

    return _bound(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0)), whole)


def redacted(docs: DataFrame, target: float = TARGET_PRECISION) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets, as in [EMAIL].

    Overlapping spans become one, named after the first.  Texts without candidates are not
    exchanged at all.  Rows are told apart by a number that is stored with them once.
    """
    (row,) = fresh(docs, "row")
    placed = written(docs.withColumn(row, F.monotonically_increasing_id()), "placed")
    maybe = _may_hold(col("text"))
    spans = written(
        candidates(placed.filter(maybe).select(col(row).alias("r"), F.lit(0).alias("doc_id"), col("text").alias("text")), "r"),
        "spans",
    )
    chosen = selected(spans, fit(docs.sparkSession, target))
    by_start = Window.partitionBy("row").orderBy("start", F.desc("stop"), "kind")
    reach = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    names = F.array(*[F.lit(k.upper()) for k in ALL_KINDS])
    islands = (
        chosen.withColumn("opens", (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int"))
        .withColumn("island", F.sum("opens").over(by_start))
        .groupBy("row", "island")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.min_by("kind", F.struct("start", "kind")).alias("kind"),
        )
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", "stop", F.get(names, F.col("kind")).alias("label")))
            ).alias("islands")
        )
        .select(col("row").alias(row), "islands")
    )
    text = F.when(F.col("islands").isNotNull(), redacted_text(col("text"), F.col("islands"))).otherwise(col("text"))
    keep = [text.alias("text") if c == "text" else col(c) for c in docs.columns]
    changed = placed.filter(maybe).join(islands, row, "left").select(*keep)
    return changed.unionByName(placed.filter(~maybe).select(*[col(c) for c in docs.columns]))
