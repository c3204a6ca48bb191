"""Whitening of embeddings with a covariance from squared sums only.

Entries are scaled to whole numbers, so that sums are exact in any order. By polarisation, 2ab = (a + b)^2 - a^2 - b^2: the
squares of every centred dimension and of every sum of two centred dimensions are added up over all vectors, and their
differences give all covariances, which go to ``eigh``. The driver holds one number for each pair of dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Vectors that a task squares at a time.
BLOCK = 2048


def whole_numbers(vector: Column) -> Column:
    """The vector as longs: floor(SCALE * entry) + SHIFT."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(SHIFT).cast("long"))


def finite(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def as_matrix(vectors: pa.Array, shift: np.ndarray) -> np.ndarray:
    """Rows of whole numbers less ``shift``; Python integers where squares of sums would leave 64 bits."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    if len(x) and max(abs(int(x.max())), abs(int(x.min())), int(np.abs(shift).max())) >= 1 << 61:
        return x.astype(object) - shift
    z = x - shift
    # BLOCK rows of (2 z)^2 must stay below 2^63.
    return z if not len(z) or np.abs(z).max() < 1 << 24 else z.astype(object)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _summed(df: DataFrame, add: Callable[[pa.Array], dict[tuple[int, int], int]]) -> dict[tuple[int, int], int]:
    """Exact totals by (i, j) of what ``add`` gives for blocks of rows of ``x``; a task sends one row for each (i, j)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], int] = {}
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                for key, value in add(batch["x"].slice(k, BLOCK)).items():
                    totals[key] = totals.get(key, 0) + value
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in totals], pa.int32()), pa.array([j for _, j in totals], pa.int32()),
             _decimals(list(totals.values()))], ["i", "j", "value"])

    parts = df.select("x").mapInArrow(run, "i int, j int, value decimal(38,0)")
    return {(r[0], r[1]): int(r[2]) for r in parts.groupBy("i", "j").agg(F.sum("value")).collect()}


def _squares(shift: np.ndarray):
    """Sums of z_i^2 as (i, i) and of (z_i + z_j)^2 as (i, j), i < j; ``z`` is x less the whole part of its mean."""
    def add(vectors: pa.Array) -> dict[tuple[int, int], int]:
        z = as_matrix(vectors, shift)
        out = {}
        for i in range(z.shape[1]):
            out[i, i] = int((z[:, i] * z[:, i]).sum())
            if i + 1 < z.shape[1]:
                pair = z[:, i, None] + z[:, i + 1:]
                out |= {(i, i + 1 + k): int(v) for k, v in enumerate((pair * pair).sum(axis=0))}
        return out

    return add


def _totals(vectors: pa.Array) -> dict[tuple[int, int], int]:
    x = as_matrix(vectors, np.zeros(1, np.int64))
    return {(i, 0): int(x[:, i].sum()) for i in range(x.shape[1])}


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors of the fit list, their sums by dimension, components as rows, and their eigenvalues and shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def shift(self) -> np.ndarray:
        """The whole part of each dimension's mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the means have beyond their whole parts."""
        return [s % self.n for s in self.sums]

    def project(self, vectors: pa.Array) -> np.ndarray:
        """Rows of whole numbers, whitened; a component without variance gives 0."""
        z = as_matrix(vectors, self.shift).astype(np.float64) - np.array([r / self.n for r in self.rest])
        safe = np.where(self.values > 0, self.values, 1)
        return np.where(self.values > 0, z @ self.components.T / np.sqrt(safe), 0.0)

    def deviations(self, vectors: pa.Array) -> list[int]:
        """The sum over dimensions of (n * x - S)^2, exactly."""
        z = as_matrix(vectors, self.shift)
        most = 0 if not z.size else max(abs(int(z.max())), abs(int(z.min()))) + 1
        if z.shape[1] * (self.n * most) ** 2 >= 1 << 63:
            z = z.astype(object)
        y = self.n * z - np.array(self.rest, object if z.dtype == object else np.int64)
        return [int(v) for v in (y * y).sum(axis=1)]


def covariance(n: int, sums: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance (divisor n), rounded once at the end.

    ``squares`` are of x less the whole part of its mean. With y = n * x - S, the sum of (y_i + y_j)^2 is n^2 times that of
    the given sums, less n times the square of what the whole parts leave.
    """
    rest = [s % n for s in sums]
    d = len(sums)
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    out = np.zeros((d, d))
    for i in range(d):
        out[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = float(Fraction(both - own[i] - own[j], 2 * n * n))
    return out


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of different vectors ``x`` (arrays of longs of one length); None if it is empty."""
    n, shortest, longest = x.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return None
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} and of {longest} dimensions cannot be whitened together")
    totals = _summed(x, _totals)
    sums = [totals[i, 0] for i in range(longest)]
    shift = np.array([s // n for s in sums], np.int64)
    v = covariance(n, sums, _summed(x, _squares(shift)))
    values, vectors = np.linalg.eigh(v)
    trace = float(np.trace(v))
    values = np.where(values > longest * np.finfo(float).eps * max(trace, 0.0), values, 0.0)
    k = min(components, longest)
    top = values[::-1][:k]
    return Whitening(n, sums, vectors[:, ::-1].T[:k], top, top / trace if trace else np.zeros(k))


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, over components with variance."""
    k = len(model.values)

    def moments(centre: np.ndarray, squared: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, k) if squared else k)
            for batch in batches:
                w = model.project(batch["x"]) - centre
                total = total + (w.T @ w if squared else w.sum(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())],
                                             ["at", "value"])

        rows = x.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value")).collect()
        return np.array([v for _, v in sorted(map(tuple, rows))]) / model.n

    mean = moments(np.zeros(k), False)
    spread = moments(mean, True).reshape(k, k)
    some = model.values > 0
    off = np.abs(spread - np.eye(k))[np.ix_(some, some)]
    return float(off.max()) if off.size else 0.0


RESULT = ("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error: one row for each
    vector and each of the first ``components`` dimensions of the whitened space.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped. Equal vectors count once in the fit;
    every row is whitened. All vectors must have one length, else it is an error. A component without variance is 0 in
    every row. Null and repeated ids are rows of their own, further columns are not read, an empty table gives no rows.
    """
    schema = f"id {rows.schema[id_col].dataType.simpleString()}, {RESULT}"
    vector = F.col(f"`{vector_col}`")
    base = stored(rows.where(finite(vector)).select(F.col(f"`{id_col}`").alias("id"), whole_numbers(vector).alias("x")),
                  "whitening-rows")
    x = stored(base.select("x").distinct(), "whitening-fit")
    model = fit(x, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    k, error = len(model.values), identity_error(x, model)
    number, explained = np.arange(1, k + 1, dtype=np.int32), model.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                m = part.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(each), pa.array(np.tile(number, m)), pa.array(np.full(m * k, model.n, np.int64)),
                     _decimals(model.deviations(part["x"])).take(each), pa.array(model.project(part["x"]).ravel()),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["id", *(c.split()[0] for c in RESULT.split(", "))])

    return base.mapInArrow(run, schema).withColumnRenamed("id", id_col)
