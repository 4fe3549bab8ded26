"""Embedding whitening by shifted CholeskyQR.

Entries become integers, so counts and sums are exact, and every row is centred before anything is
multiplied.  Then, with X the centred rows and no triangular factor yet:

1. Gram pass.  Every task solves X = Y R1 for its rows, Y = Z R2, and so on through the factors found so
   far, and adds up its part of Z'Z; the parts are summed by cell.  Only the matrix of d x d cells
   reaches the driver.
2. Z'Z is factored by Cholesky, the first time with a shift that keeps it positive whatever the
   condition of X.
3. Both are repeated until Z'Z is the identity.  Then X = Q R with orthonormal Q and R the product of
   the factors, and the singular values and right vectors of R are those of X: e = s^2 / n,
   components = right vectors.

Memory of a task and of the driver depends on d alone, never on the number of rows.  A pass is a scan;
nothing is shuffled but d^2 / 2 cells a task.

Rows: a vector counts if it has as many entries as most others (of two such numbers the larger), and
all of them are numbers below 2^52 in size; beyond that 1024 * c has no exact place in a long, so
such an entry counts as infinite.  All other rows are dropped.  Directions in which the rows do not
differ have no component: k equal rows, or one row, have none, and give no result rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.llm.common import col, fresh

SCALE, OFFSET = 1024, 100000
LARGEST = 2.0**52
COMPONENTS = 8
# Entries of a block of rows that is worked off at once: bounds memory, not results.
BLOCK = 1 << 19
# Z'Z is the identity up to this; one more factor squares the rest.
DONE = 1e-10
# Eigenvalues of Z'Z below this part of the largest belong to directions without any spread.
NO_SPREAD = 1e-13
# A component whose variance is below this part of the first one's is rounding noise.
RANK = 1e-22
MOST_PASSES = 8
_EPS = float(np.finfo(np.float64).eps)


class Whitening(NamedTuple):
    """What a fit knows: n vectors with exact sums, unit components in columns, their variances."""

    n: int
    sums: list[int]
    components: np.ndarray  # d x k
    variances: np.ndarray  # k, falling
    total: float  # trace of the covariance
    passes: int


def _counts(vector: Column) -> Column:
    def fits(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LARGEST)

    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fits)


def usable(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int, int]:
    """The rows that count, their number of entries, and how many they are; (rows, 0, 0) if none."""
    valid = vectors.filter(_counts(col(vector)))
    by_size = valid.groupBy(F.size(col(vector)).alias("d")).agg(F.count("*").alias("n"))
    most = by_size.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not most:
        return valid, 0, 0
    return valid.filter(F.size(col(vector)) == most[0]["d"]), most[0]["d"], most[0]["n"]


def _blocks(column: pa.Array, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x) for blocks of rows, x as exact integers."""
    entries = column.flatten().to_numpy(zero_copy_only=False)
    rows = len(column)
    step = max(1, BLOCK // d)
    for a in range(0, rows, step):
        b = min(rows, a + step)
        part = entries[a * d : b * d].astype(np.float64).reshape(-1, d)
        yield a, np.floor(SCALE * part).astype(np.int64) + OFFSET


def _added(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers, exact."""
    if not len(x) or int(np.abs(x).max()) * len(x) < 2**62:
        return x.sum(0).astype(object)
    return x.astype(object).sum(0)


def _sums(d: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for batch in batches:
            for _, x in _blocks(batch.column(0), d):
                total = total + _added(x)
        yield pa.RecordBatch.from_pydict(
            {
                "j": pa.array(np.arange(d, dtype=np.int32)),
                "s": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
            }
        )

    return run


class _Centre(NamedTuple):
    """S / n as whole part and rest, so that centring rounds once whatever n is."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> _Centre:
        parts = [divmod(s, n) for s in sums]
        return cls(n, np.array([w for w, _ in parts], np.int64), np.array([r for _, r in parts], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / float(self.n)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2 of each row, exact."""
        y, n, rest = x - self.whole, self.n, self.rest
        far = (int(np.abs(y).max()) + 1) * n if len(y) else 0
        if far * far * y.shape[1] < 2**62:
            return ((n * y - rest) ** 2).sum(1).tolist()
        y, rest = y.astype(object), rest.astype(object)
        return ((n * y - rest) ** 2).sum(1).tolist()


def solved(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Y with Y r = x for an upper triangular r, column by column."""
    out = np.empty_like(x)
    for j in range(r.shape[0]):
        out[:, j] = (x[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _gram(rows: DataFrame, vector: str, d: int, of: Callable[[np.ndarray], np.ndarray], k: int) -> np.ndarray:
    """The k x k sum of y'y over all rows, y = of(x), and in row k the sums of y."""
    low, high = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for _, x in _blocks(batch.column(0), d):
                y = of(x)
                total += y.T @ y
                plain += y.sum(0)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(np.concatenate([low, np.full(k, k)]).astype(np.int32)),
                "j": pa.array(np.concatenate([high, np.arange(k)]).astype(np.int32)),
                "g": pa.array(np.concatenate([total[low, high], plain])),
            }
        )

    parts = rows.select(col(vector)).mapInArrow(run, "i int, j int, g double")
    cells = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    out = np.zeros((k + 1, k))
    i, j, g = (cells.column(c).to_numpy() for c in ("i", "j", "g"))
    out[i, j] = g
    square = i < k
    out[j[square], i[square]] = g[square]
    return out


def _shift(gram: np.ndarray) -> float:
    d = len(gram)
    return 11.0 * d * (d + 1) * _EPS * float(np.trace(gram))


def fit_whitening(vectors: DataFrame, vector: str = "embedding", k: int = COMPONENTS) -> Whitening:
    """The first k components of the usable rows of `vectors`, by falling variance."""
    rows, d, n = usable(vectors, vector)
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    found = rows.select(col(vector)).mapInArrow(_sums(d), "j int, s decimal(38,0)")
    by_dimension = {r["j"]: int(r["s"]) for r in found.groupBy("j").agg(F.sum("s").alias("s")).collect()}
    sums = [by_dimension[j] for j in range(d)]
    centre = _Centre.of(n, sums)

    factors: list[np.ndarray] = []

    def orthogonalised(x: np.ndarray) -> np.ndarray:
        y = centre.centred(x)
        for factor in factors:
            y = solved(y, factor)
        return y

    r = np.eye(d)  # the product of the factors
    last = np.zeros((0, d))
    for done in range(1, MOST_PASSES + 1):
        gram = _gram(rows, vector, d, orthogonalised, d)[:d]
        if not np.trace(gram) > 0:
            return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, done)
        if done == 1:
            factors.append(np.linalg.cholesky(gram + _shift(gram) * np.eye(d)).T)
            r = factors[-1]
            continue
        values, axes = np.linalg.eigh(gram)
        spread = values > NO_SPREAD * values[-1]
        if spread.all():
            last = np.linalg.cholesky(gram).T @ r
        else:  # no spread at all in some directions: they get no part in the result
            last = (np.sqrt(values[spread])[:, None] * axes[:, spread].T) @ r
            gram = gram + axes[:, ~spread] @ axes[:, ~spread].T
        if np.abs(values[spread] - 1).max() <= DONE:
            break
        factors.append(np.linalg.cholesky(gram).T)
        r = factors[-1] @ r
    _, singular, right = np.linalg.svd(last, full_matrices=False)
    variances = singular**2 / n
    kept = min(k, int((variances > RANK * variances[0]).sum()))
    return Whitening(n, sums, right[:kept].T.copy(), variances[:kept], float(variances.sum()), done)


def _projector(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centre = _Centre.of(model.n, model.sums)
    axes, scale = model.components, np.sqrt(model.variances)
    return lambda x: (centre.centred(x) @ axes) / scale


def identity_error(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity; a scan."""
    k = len(model.variances)
    if not k:
        return 0.0
    rows, d, n = usable(vectors, vector)
    found = _gram(rows, vector, d, _projector(model), k)
    mean = found[k] / n
    return float(np.abs(found[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The usable rows with all their columns, and `whitened` (array<double>) and `deviation`.

    `deviation` is decimal(38,0), NULL where it has more digits.  A column of one of these names that the
    rows have already stays, and the new one gets underscores in front.
    """
    d = len(model.sums)
    new, far = fresh(vectors, "whitened", "deviation")
    rows = vectors.filter(_counts(col(vector)) & (F.size(col(vector)) == d))
    centre, project = _Centre.of(max(model.n, 1), model.sums), _projector(model)
    place = vectors.columns.index(vector)
    most = 10**38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, x in _blocks(batch.column(place), d):
                y = project(x)
                n, k = y.shape
                own = batch.slice(a, n)
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * k)
                lists = pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))
                away = [Decimal(v) if v < most else None for v in centre.deviations(x)]
                columns = [*own.columns, lists, pa.array(away, pa.decimal128(38, 0))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, new, far])

    # Spark reads the returned columns by name, so the result has the names of the input.
    schema = rows.withColumns(
        {new: F.lit(None).cast("array<double>"), far: F.lit(None).cast("decimal(38,0)")}
    ).schema
    return rows.mapInArrow(run, schema)


def whitening_digest(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    `deviation` is NULL where it is beyond a long.  A NULL or repeated `vec_id` is a row like any other.
    """
    slim = vectors.select(col("vec_id").alias("vec_id"), col("embedding").alias("embedding"))
    model = fit_whitening(slim, k=k)
    error = identity_error(slim, model)
    parts = model.variances / model.total if model.total else model.variances
    explained = F.array(*[F.lit(float(p)) for p in parts]).cast("array<double>")
    rows = whitened(slim, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
