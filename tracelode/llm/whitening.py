"""Embedding whitening: leading principal components of all vectors, projected and scaled to unit variance.

Entries become integers, ``floor(1024 * c) + 100000``, so that every sum over the rows is exact and does not depend on the order of tasks:

1. the number of vectors and each dimension's sum;
2. the products of each two dimensions, of entries from which the dimension's mean, to the nearest integer, has been
   taken; what that integer is off the mean is taken out of the sums exactly;
3. the covariance's leading eigenpairs, on the driver, which holds the square of the number of dimensions (``spectrum``);
4. the covariance of what was projected, which shows how far it is from the identity.

Each pass sends one small result per task. Nothing else leaves the tasks.

Rows without a vector, or whose vector holds a null, NaN or infinite entry, or one beyond ``LARGEST``, are left out. So are vectors whose length is
not the commonest one (of two equally common lengths the longer counts). A null id stays; repeated rows count as often as they come. Directions
without variance are no components: one vector alone, or equal vectors, or an empty table, give no rows. Extra columns are not read. A vector
has to fit in memory, many thousands of dimensions are too many for the driver. Of tied eigenvalues any orthonormal basis is right.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm import spectrum

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond it count as infinite: their squares could not be summed up exactly.
LARGEST = float(1 << 33)
_SUM = pa.decimal128(38, 0)


class Model(NamedTuple):
    n: int
    #: Exact sum of each dimension.
    sums: list[int]
    #: Eigenvalues of the covariance, falling, and a unit eigenvector a column.
    values: np.ndarray
    vectors: np.ndarray
    #: Share of all variance.
    explained: np.ndarray
    #: Largest absolute entry of the projected rows' covariance less the identity.
    identity_error: float

    @property
    def nearest(self) -> np.ndarray:
        """Each dimension's mean, to the nearest integer."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def off(self) -> list[int]:
        """n times what the mean is over ``nearest``."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.nearest)]


def entries(column: pa.Array, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer entries of the usable vectors, of each length or of ``dims`` only."""
    lengths = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(lengths, 0))
    with np.errstate(invalid="ignore"):
        wrong = np.concatenate([[0], np.cumsum(~(np.abs(values) < LARGEST))])
    starts = ends - np.maximum(lengths, 0)
    usable = wrong[ends] == wrong[starts]
    for size in np.unique(lengths[usable & (lengths > 0)]) if dims is None else [dims]:
        rows = np.flatnonzero(usable & (lengths == size))
        if len(rows):
            own = values[starts[rows][:, None] + np.arange(size)]
            yield rows, np.floor(SCALE * own).astype(np.int64) + SHIFT


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left.T @ right`` as Python integers; float products of so few rows at once that each sum is exact."""
    bound = max(1.0, float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)))
    step = max(1, int(2.0**53 / bound))
    out = np.zeros((left.shape[1], right.shape[1]), object)
    for i in range(0, len(left), step):
        out += (left[i : i + step].T.astype(float) @ right[i : i + step].astype(float)).astype(np.int64).astype(object)
    return out


def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` exactly, for any entries below 2**45."""
    if np.abs(y).max(initial=0) < 1 << 21:
        return _exact(y, y)
    high, low = y >> 20, y & ((1 << 20) - 1)
    cross = _exact(high, low)
    return (_exact(high, high) << 40) + ((cross + cross.T) << 20) + _exact(low, low)


def _decimals(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.int64()).cast(_SUM) if all(abs(v) < 1 << 62 for v in values) else _from_text(values)


def _from_text(values) -> pa.Array:
    return pa.array([str(int(v)) for v in values]).cast(_SUM)


def _vectors(rows: DataFrame, vector: str) -> DataFrame:
    return rows.select(F.col(vector).alias("vector"))


def totals(rows: DataFrame, vector: str) -> tuple[int, list[int]]:
    """Number of vectors of the commonest length, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for _, x in entries(batch.column("vector")):
                n, s = found.get(x.shape[1], (0, np.zeros(x.shape[1], object)))
                found[x.shape[1]] = n + len(x), s + x.sum(axis=0).astype(object)
        for size, (n, s) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, size, np.int64)), pa.array(np.arange(size)), pa.array(np.full(size, n, np.int64)), _decimals(s)],
                names=["size", "i", "n", "s"],
            )

    parts = _vectors(rows, vector).mapInArrow(run, "size long, i long, n long, s decimal(38,0)")
    sums = parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    common = sums.filter("i = 0").orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not common:
        return 0, []
    own = sums.filter(F.col("size") == common[0]["size"]).orderBy("i").collect()  # one row a dimension
    return common[0]["n"], [int(r["s"]) for r in own]


def covariance(rows: DataFrame, vector: str, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the integer entries, divisor n; each entry is the exact value, rounded once."""
    start = Model(n, sums, *[np.zeros(0)] * 3, 0.0)
    nearest, off, d = start.nearest, start.off, len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            for _, x in entries(batch.column("vector"), d):
                total += products(x - nearest)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j), _decimals(total[i, j])], names=["at", "s"])

    parts = _vectors(rows, vector).mapInArrow(run, "at long, s decimal(38,0)")
    out = np.zeros((d, d))
    for r in parts.groupBy("at").agg(F.sum("s").alias("s")).collect():  # the square of the number of dimensions
        i, j = divmod(r["at"], d)
        out[i, j] = out[j, i] = (n * int(r["s"]) - off[i] * off[j]) / (n * n)
    return out


def _projected(x: np.ndarray, model: Model) -> np.ndarray:
    mean = np.array([s / model.n for s in model.sums])
    return (x - mean) @ (model.vectors / np.sqrt(model.values))


def _identity_error(rows: DataFrame, vector: str, model: Model) -> float:
    d, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in entries(batch.column("vector"), d):
                w = _projected(x, model)
                total += np.vstack([w.T @ w, w.sum(axis=0)])  # the mean is 0 but for rounding
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "s"])

    parts = _vectors(rows, vector).mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
    total = np.zeros((k + 1) * k)
    for r in parts.collect():
        total[r["at"]] = r["s"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """The model of all usable vectors; None where there are none, or no variance."""
    n, sums = totals(rows, vector)
    if not n:
        return None
    matrix = covariance(rows, vector, n, sums)
    trace = float(np.trace(matrix))
    pairs = spectrum.leading(matrix, components)
    if not pairs.certified.all():
        raise ArithmeticError("an eigenvalue's number is not certified by the counts around it")
    some = pairs.values > spectrum.CLOSE * len(matrix) * trace
    if not some.any():
        return None
    model = Model(n, sums, pairs.values[some], pairs.vectors[:, some], pairs.values[some] / trace, 0.0)
    return model._replace(identity_error=_identity_error(rows, vector, model))


def whitened(rows: DataFrame, model: Model, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key, deviation (n**2 times the squared distance from the mean, exact; null beyond a long) and whitened (one entry a component)."""
    d, k = len(model.sums), len(model.values)
    nearest, n = model.nearest, model.n
    off = np.array([int(o) for o in model.off], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in entries(batch.column("vector"), d):
                y = x - nearest
                about = ((float(n) * y - off) ** 2).sum(axis=1)
                apart = n * y - off  # modulo 2**64, as is the sum of squares: exact where that is below 2**63
                exact = (apart * apart).sum(axis=1)
                flat = pa.array(_projected(x, model).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(at)),
                        pa.array(exact, pa.int64(), mask=about > 0.999 * 2.0**63),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k, dtype=np.int32)), flat),
                    ],
                    names=["key", "deviation", "whitened"],
                )

    source = rows.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    return source.mapInArrow(run, "key long, deviation long, whitened array<double>").withColumnRenamed("key", key)
