"""Embedding whitening from a covariance over distinct vectors, weighted by how often each occurs.

A row's vector becomes integers, ``x = floor(scale * c) + offset``. Rows are
grouped by identical x vectors (counts merge before the shuffle, so a vector that
a third of all rows share is one row of each task) and the distinct vectors
are stored with their counts. Everything after works on distinct vectors:

1. sums S of every dimension, exact integers;
2. the covariance V: vectors minus S/n, then one weighted matrix product a
   batch; the partial d x d matrices are added row by row on the executors;
3. eigenvectors of V on the driver, which holds d x d numbers whatever the number of rows;
4. every distinct vector is whitened once and stored; its exact deviation comes
   along, from sums that stay within 64 bits by centring on whole numbers first;
5. the covariance of the whitened vectors, by the same two steps, gives the identity error;
6. rows join their whitened vector by a 128-bit hash of x: only ids and hashes
   of rows are shuffled, in an exchange that Spark may split at a hot vector.

``weights="count"`` fits on all rows, ``"one"`` on each distinct vector once.

Dropped: rows whose vector is null or empty, holds null or non-finite entries, or entries whose x
is beyond 2^52. The table's dimension is its most frequent vector length (ties: the longest); rows of
another length are dropped. Components without variance (below ``LEAST_VARIANCE`` of the largest) are not returned, so one
row, or equal rows, give none. A deviation beyond a long is null. Null and repeated ids: all rows stay. Empty
table: no rows. Extra columns are ignored. Texts are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.llm.common import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
LARGEST = float(1 << 52)
LONG = (1 << 63) - 1
#: A component whose variance is a smaller share of the largest one's has none beyond what double precision tells apart.
LEAST_VARIANCE = 1e-9


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` vectors, exact ``sums``, eigenvectors over root eigenvalues (``matrix``, d x k)."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray

    @property
    def base(self) -> np.ndarray:
        """Whole numbers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """``n`` times what the means are beyond ``base``."""
        return [s - self.n * int(b) for s, b in zip(self.sums, self.base)]


def integer_vectors(df: DataFrame, vector_col: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Rows of ``df`` with a usable vector, plus ``__x`` (array of long) and its hashes ``__h1`` and ``__h2``."""
    scaled = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * scale))
    usable = F.forall(F.col(vector_col), lambda c: F.coalesce(
        F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)))  # NaN is above every number
    return (df.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & usable)
            .withColumn("__x", F.transform(scaled, lambda c: c + offset))
            .withColumns({"__h1": F.xxhash64("__x"), "__h2": F.xxhash64(F.lit("second"), "__x")}))


def distinct_vectors(rows: DataFrame, weights: str = "count") -> DataFrame:
    """The stored distinct vectors of the most frequent length: ``__h1``, ``__h2``, ``__x``, ``__w``."""
    weight = {"count": F.count(F.lit(1)), "one": F.lit(1).cast("long")}[weights]
    groups = stored(rows.groupBy("__x", "__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"), weight.alias("__w")), "vectors")
    length = groups.groupBy(F.size("__x").alias("d")).agg(F.sum("__n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return groups.where(F.size("__x") == (length["d"] if length else 0)).drop("__n")


def _matrix(column, kind) -> np.ndarray:
    """Rows of equally long arrays as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _total(df: DataFrame, partial, kind: str) -> dict[int, list]:
    """Element-wise sums of ``partial(batch)`` (a list of equally long rows) over all batches, by row number.

    A task adds up its batches; the tasks' rows are then dealt by row number and
    added as they stream by, so no task or driver holds more than one matrix.
    """
    schema = f"i int, v array<{kind}>"
    item = pa.list_(pa.int64() if kind == "long" else pa.float64())

    def out(rows: dict):
        return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array([v.tolist() for v in rows.values()], item)],
                                          ["i", "v"])

    def first(batches):
        held = None
        for b in batches:
            if b.num_rows:
                part = partial(b)
                held = part if held is None else held + part
        if held is not None:
            yield out(dict(enumerate(held)))

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                v = v.values.to_numpy()
                held[i] = held[i] + v if i in held else v
        if held:
            yield out(held)

    rows = df.mapInArrow(first, schema).repartition("i").mapInArrow(merge, schema).collect()
    return {r["i"]: r["v"] for r in rows}


def _sums(vectors: DataFrame) -> tuple[int, tuple[int, ...]]:
    """n and the exact sums: values are cut into low and high halves, which stay within a long."""
    def partial(b):
        x, w = _matrix(b.column(0), np.int64), b.column(1).to_numpy(zero_copy_only=False)
        low, high = x & 0xFFFFF, x >> 20
        return np.stack([w @ low, w @ high, np.full(x.shape[1], w.sum())])

    got = _total(vectors.select("__x", "__w"), partial, "long")
    if not got:
        return 0, ()
    return got[2][0], tuple(lo + (hi << 20) for lo, hi in zip(got[0], got[1]))


def _covariance(df: DataFrame, centre, n: int) -> np.ndarray:
    """Covariance (divisor n) of ``centre(first column)``, weighted by the second column."""
    def partial(b):
        y, w = centre(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
        return (y * w[:, None]).T @ y

    got = _total(df, partial, "double")
    return np.array([got[i] for i in range(len(got))]) / n


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The transform fitted on stored distinct vectors; None if there are none."""
    n, sums = _sums(vectors)
    if not n:
        return None
    raw = Whitening(n, sums, np.empty(0), np.empty((len(sums), 0)), np.empty(0))
    base, shift = raw.base, np.array([r / n for r in raw.rest])
    v = _covariance(vectors.select("__x", "__w"), lambda c: (_matrix(c, np.int64) - base) - shift, n)
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    rank = int((values > max(values[0], 0) * LEAST_VARIANCE).sum())
    k = min(components, rank)
    values, vectors_ = values[:k], vectors_[:, :k]
    if k:  # of the two signs, the one whose largest entry is positive
        vectors_ = vectors_ * np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(k)])
    return Whitening(n, sums, values, vectors_ / np.sqrt(values), values / np.trace(v))


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Per row of whole numbers ``y``: the exact sum of (n * y - rest)^2, None beyond a long."""
    largest = max(int(np.abs(y).max(initial=0)), 1)
    bound = max(largest, max(map(abs, rest)), 1)
    if y.shape[1] * largest * bound >= LONG:
        y = y.astype(object)
    squares, products = (y * y).sum(axis=1), (y * np.array(rest, dtype=y.dtype)).sum(axis=1)
    rest2 = sum(r * r for r in rest)
    out = [n * n * int(a) - 2 * n * int(b) + rest2 for a, b in zip(squares, products)]
    return [v if v <= LONG else None for v in out]


def whiten_distinct(vectors: DataFrame, model: Whitening) -> DataFrame:
    """Stored: each distinct vector's hashes, weight, exact ``deviation`` and ``whitened`` components."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(model)  # d x k numbers

    def run(batches):
        m = shared.value
        base, rest = m.base, m.rest
        shift = np.array([r / m.n for r in rest])
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b.column(3), np.int64) - base
            z = (y - shift) @ m.matrix
            at = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(deviations(y, m.n, rest), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(z.ravel()))], ["__h1", "__h2", "__w", "deviation", "whitened"])

    return stored(vectors.select("__h1", "__h2", "__w", "__x").mapInArrow(
        run, "__h1 long, __h2 long, __w long, deviation long, whitened array<double>"), "whitened")


def identity_error(white: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance (over the fit list) minus the identity."""
    def partial(b):
        w = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
        return (w @ _matrix(b.column(0), np.float64))[None, :]

    z = white.select("whitened", "__w")
    mean = np.array(_total(z, partial, "double")[0]) / model.n
    c = _covariance(z, lambda col: _matrix(col, np.float64) - mean, model.n)
    return float(np.abs(c - np.eye(len(c))).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET, weights: str = "count") -> tuple[DataFrame, Whitening | None, float]:
    """Per usable row its id, ``deviation`` and ``whitened`` (array of double); the model; its identity error."""
    rows = integer_vectors(df.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__v")), "__v", scale, offset)
    vectors = distinct_vectors(rows, weights)
    model = fit(vectors, components)
    if model is None or not len(model.eigenvalues):
        kind = rows.schema["__id"].dataType.simpleString()
        return _empty(df.sparkSession, f"`{id_col}` {kind}, deviation long, whitened array<double>"), model, 0.0
    white = whiten_distinct(vectors, model)
    out = rows.select("__id", "__h1", "__h2").join(white.drop("__w"), ["__h1", "__h2"])
    return out.select(F.col("__id").alias(id_col), "deviation", "whitened"), model, identity_error(white, model)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def component_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """One row per usable row of ``df`` and component: the whitened value with the figures of the fit."""
    rows, model, error = whiten(df, id_col, vector_col, **options)
    share = F.array(*[F.lit(float(v)) for v in (model.explained if model else [])]).cast("array<double>")
    return (rows.select(id_col, "deviation", F.posexplode(F.arrays_zip(F.col("whitened").alias("w"), share.alias("e"))))
            .select(id_col, (F.col("pos") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                    "deviation", F.col("col.w").alias("whitened"), F.col("col.e").alias("explained"),
                    F.lit(error).alias("identity_error")))
