"""URL filter: allow and block rules, else the reputation of the host.

Labelled page outcomes are counted per host and summed up to the registered domain and the suffix.
Each level shrinks towards the next: a suffix towards the whole, a domain towards the posterior mean
of its suffix, a host towards that of its domain.  The strength of a level's prior (its number of
pseudo-outcomes) is estimated by moments from the spread of bad rates between its members.  A page
is blocked when even the lower posterior bound of its host's bad rate, a quantile of its beta
distribution, reaches the limit.  A host without labels has the posterior of its domain, else of its
suffix, else of the whole, as its own.

The limit is calibrated: pages are split in two by a hash of their id, hosts get their bounds from one
half's labels, and the other half tells how bad the pages are above each limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.llm.common import col, fresh
from solstrand.sinks.scratch import written

#: (host, path, verdict); the longest rule that fits wins.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Suffixes of more than one label under which names are registered.
LONG_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in"]
#: Blocking pays where more than this share of the pages is bad.
WORTH = 0.5
#: Chance that a host is better than its lower bound.
TAIL = 0.05
#: Limits tried are multiples of 1 / STEPS; above them none is blocked.
STEPS = 100
GRID = 512
#: The strongest prior, taken where members do not differ.
MOST_PSEUDO = 1000.0


def _behind_scheme(url: Column) -> Column:
    """What follows the first `://`; empty for NULL and without it."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.char_length(url))), F.lit(""))


def url_host(url: Column) -> Column:
    raw = F.regexp_extract(_behind_scheme(url), "^[^/?#]*+", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*+([^?#]*+)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule for a host, its subdomains and a path prefix."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, name + prefix).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column, long_suffixes: list[str]) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address or a single label is its own domain."""
    last = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    address = host.rlike(r"^[0-9.]+(:[0-9]+)?$")
    long = two.isin(long_suffixes)
    suffix = F.when(address, F.lit("")).when(long, two).otherwise(last)
    domain = F.when(address, host).when(long, F.substring_index(host, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(members: DataFrame) -> float:
    """Pseudo-outcomes of the prior from the members' `bad` of `n`; two rows reach the driver."""
    known = members.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.count("*").alias("k")).first()
    if not known["n"]:
        return MOST_PSEUDO
    mean = known["bad"] / known["n"]
    off = F.col("bad") / F.col("n") - mean
    spread = members.agg(
        F.sum(F.col("n") * off * off).alias("ss"), F.sum((F.col("n") * F.col("n")).cast("double")).alias("nn")
    ).first()
    # Spread within members is what binomial chance gives; the rest is spread between them.
    chance = mean * (1 - mean)
    room = known["n"] - spread["nn"] / known["n"]
    between = (spread["ss"] - (known["k"] - 1) * chance) / room if room > 0 else 0.0
    if between <= 0:
        return MOST_PSEUDO
    return round(min(max(chance / between - 1, 1.0), MOST_PSEUDO), 3)


def beta_quantile(a: Column, b: Column, p: float, grid: int = GRID) -> Column:
    """The p-quantile of Beta(a, b), by the density of its logit on an even grid around the mode.

    The logit's density has one peak and falls off at least exponentially, so sums over the grid converge
    fast.  The odds are right to 0.002 % where `a` and `b` exceed 0.1.  Without `a` the distribution is all at 0, without `b` at 1.
    """
    softplus = lambda t: F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t)))
    peak = F.log(a) - F.log(b)
    wide = 7 * F.sqrt(1 / a + 1 / b)
    left = peak - wide - 10 / a
    step = (peak + wide + 10 / b - left) / grid
    top = a * peak - (a + b) * softplus(peak)

    def found(s: Column) -> Column:
        height = lambda t: F.exp(s["a"] * t - (s["a"] + s["b"]) * softplus(t) - s["top"])
        weights = F.transform(
            F.sequence(F.lit(0), F.lit(grid - 1)), lambda i: height(s["left"] + s["step"] * (i + 0.5))
        )

        def below(w: Column) -> Column:
            """How many cells lie below the quantile as a whole, their sum, and the sum aimed at."""
            aim = F.aggregate(w, F.lit(0.0), lambda x, y: x + y) * p
            start = F.struct(
                F.lit(0.0).alias("sum"), F.lit(0).alias("k"), F.lit(True).alias("open"), aim.alias("aim")
            )

            def run(x: Column, y: Column) -> Column:
                fits = x["open"] & (x["sum"] + y <= x["aim"])
                return F.struct(
                    (x["sum"] + F.when(fits, y).otherwise(0.0)).alias("sum"),
                    (x["k"] + F.when(fits, 1).otherwise(0)).alias("k"),
                    fits.alias("open"),
                    x["aim"].alias("aim"),
                )

            return F.aggregate(w, start, run)

        def behind(c: Column) -> Column:
            """The quantile from the edge below it: an exponential step, then a Newton step by Simpson's rule."""
            edge = s["left"] + s["step"] * c["k"]
            slope = s["a"] - (s["a"] + s["b"]) / (1 + F.exp(-edge))
            # The sum of cells misses the integral below the edge by its slope there.
            rest = (c["aim"] - c["sum"]) * s["step"] - s["step"] * s["step"] * slope * height(edge) / 24
            first = rest / height(edge)
            bent = F.greatest(slope * first, F.lit(-0.9))
            state = F.struct(
                edge.alias("edge"),
                F.when(F.abs(bent) < 1e-9, first).otherwise(F.log1p(bent) / slope).alias("width"),
                rest.alias("rest"),
            )

            def nearer(n: Column) -> Column:
                end = n["edge"] + n["width"]
                middle = n["edge"] + n["width"] / 2
                area = n["width"] / 6 * (height(n["edge"]) + 4 * height(middle) + height(end))
                return end + (n["rest"] - area) / height(end)

            return F.get(F.transform(F.array(state), nearer), F.lit(0))

        return F.get(F.transform(F.transform(F.array(weights), below), behind), F.lit(0))

    state = F.struct(
        left.alias("left"), step.alias("step"), top.alias("top"), a.alias("a"), b.alias("b")
    )
    logit = F.get(F.transform(F.array(state), found), F.lit(0))
    return F.when(a <= 0, 0.0).when(b <= 0, 1.0).otherwise(1 / (1 + F.exp(-logit)))


def host_bounds(hosts: DataFrame, tail: float, long_suffixes: list[str]) -> DataFrame:
    """(host, n, bad, posterior, lower) of each of `hosts` (host, n, bad); see `host_reputation`."""
    domain, suffix = registered_domain(F.col("host"), long_suffixes)
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    seen = hosts.filter("n > 0")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = written(seen.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = domains.groupBy("suffix").agg(*sums)
    whole = suffixes.agg(*sums).first()
    prior = whole["bad"] / whole["n"] if whole["n"] else 0.0

    def shrunk(level: DataFrame, towards: Column) -> Column:
        strength = _strength(level)
        return (F.col("bad") + strength * towards) / (F.col("n") + strength)

    upper = suffixes.select("suffix", shrunk(suffixes, F.lit(prior)).alias("suffix_mean"))
    mean = shrunk(domains, F.col("suffix_mean"))
    middle = domains.join(upper, "suffix").select("domain", "suffix", mean.alias("domain_mean"))
    known = hosts.join(middle, ["domain", "suffix"], "left").join(upper, "suffix", "left")
    prior_mean = F.coalesce("domain_mean", "suffix_mean", F.lit(prior))
    strength = _strength(seen)
    a = F.col("bad") + strength * prior_mean
    b = F.col("n") - F.col("bad") + strength * (1 - prior_mean)
    return known.select(
        "host", "n", "bad", (a / (a + b)).alias("posterior"), beta_quantile(a, b, tail).alias("lower")
    )


def host_counts(outcomes: DataFrame) -> DataFrame:
    """(host, n0, bad0, n1, bad1): labelled and bad pages of each half, from `page_id`, `host`, `bad`."""
    half = F.pmod(F.xxhash64("page_id"), F.lit(2))
    counts = []
    for k in (0, 1):
        mine = F.when(half == k, F.col("bad"))
        counts += [F.count(mine).alias(f"n{k}"), F.coalesce(F.sum(mine), F.lit(0)).alias(f"bad{k}")]
    return written(outcomes.groupBy("host").agg(*counts), "hosts")


def calibrated_limit(counts: DataFrame, worth: float, tail: float, long_suffixes: list[str]) -> float:
    """The limit with the most gain on pages held out: bad ones above it less `worth` of all above it.

    Each half of `counts` is judged by bounds from the other.  Of equal limits the highest; 2.0, which no
    bound reaches, where none gains.  One row for each of STEPS limits reaches the driver.
    """
    judged = []
    for k in (0, 1):
        learnt = counts.select("host", F.col(f"n{k}").alias("n"), F.col(f"bad{k}").alias("bad"))
        held = counts.select("host", F.col(f"n{1 - k}").alias("held"), F.col(f"bad{1 - k}").alias("held_bad"))
        step = F.floor(F.col("lower") * STEPS).alias("step")
        bounds = host_bounds(learnt, tail, long_suffixes).select("host", step)
        judged.append(bounds.join(held.filter("held > 0"), "host"))
    rows = judged[0].unionByName(judged[1]).groupBy("step").agg(F.sum("held").alias("n"), F.sum("held_bad").alias("bad"))
    limit, gain, most = 2.0, 0.0, 0.0
    for row in sorted(rows.collect(), key=lambda r: -r["step"]):
        gain += row["bad"] - worth * row["n"]
        if gain > most:
            limit, most = row["step"] / STEPS, gain
    return limit


def host_reputation(
    outcomes: DataFrame,
    worth: float = WORTH,
    tail: float = TAIL,
    long_suffixes: list[str] = LONG_SUFFIXES,
    limit: float | None = None,
) -> DataFrame:
    """(host, n, bad, posterior, lower, reputation) of every host, from `page_id`, `host` and `bad`.

    `bad` is 0 or 1, or NULL where there is no label; a host with NULLs only has n = 0.  Hosts are few
    against pages: they are counted within each task first, and all levels above are sums of the host
    counts.  Hosts without labels take no part in the strengths of the priors.  Without `limit` it is
    calibrated.
    """
    counts = host_counts(outcomes)
    if limit is None:
        limit = calibrated_limit(counts, worth, tail, long_suffixes)
    both = counts.select(
        "host", (F.col("n0") + F.col("n1")).alias("n"), (F.col("bad0") + F.col("bad1")).alias("bad")
    )
    verdict = F.when(F.floor(F.col("lower") * STEPS) >= round(limit * STEPS), "block").otherwise("allow")
    return host_bounds(both, tail, long_suffixes).withColumn("reputation", verdict)


def judged_pages(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    worth: float = WORTH,
    tail: float = TAIL,
    long_suffixes: list[str] = LONG_SUFFIXES,
    limit: float | None = None,
) -> DataFrame:
    """`pages` with `host`, `path`, `rule`, `verdict` and the evidence for their host.

    `outcomes` has `page_id` and `bad` (0 or 1) for labelled pages; NULL outcomes do not count.
    A NULL url or one without `://` has empty host and path.  A host without labels is judged by the
    posterior of its domain, suffix or the whole, by the same bound.  `limit` is rounded to 1 / STEPS,
    and calibrated where it is not given.  Repeated page rows are judged one by one; existing columns are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "labelled", "labelled_bad", "bad_bound")
    parts = pages.withColumns({"host": url_host(col("url")), "path": url_path(col("url"))})
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    labelled = (
        parts.select(col("page_id").alias("page_id"), "host")
        .join(outcomes.filter("bad IS NOT NULL").select("page_id", "bad"), "page_id", "left")
        .select("page_id", "host", "bad")
    )
    # The evidence travels as one column under a name that `pages` does not have.
    (found,) = fresh(parts, "known_")
    known = host_reputation(labelled, worth, tail, long_suffixes, limit).select(
        "host", F.struct("n", "bad", "lower", "reputation").alias(found)
    )
    of = col(found).getField
    joined = parts.join(known, "host", "left")
    return joined.withColumns(
        {
            "rule": rule,
            "verdict": F.coalesce(says, of("reputation"), F.lit("allow")),
            "labelled": F.coalesce(of("n"), F.lit(0)),
            "labelled_bad": F.coalesce(of("bad"), F.lit(0)).cast("long"),
            "bad_bound": F.round(of("lower"), 6),
        }
    ).select(*[col(c) for c in pages.columns], "host", "path", "rule", "verdict", "labelled", "labelled_bad", "bad_bound")


def label_outcomes(labels: DataFrame) -> DataFrame:
    """Outcome of a page from its label: bad if toxic or of low quality."""
    bad = F.when((col("toxic") == 1) | (col("quality") == 0), 1).when(
        col("toxic").isNotNull() | col("quality").isNotNull(), 0
    )
    return labels.select(col("doc_id").alias("page_id"), bad.alias("bad"))
