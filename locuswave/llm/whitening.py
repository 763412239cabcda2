"""Whitening of embeddings on the leading components of their covariance, found by FEAST contour integration.

Method.  Entries become integers ``floor(scale * entry)``.  Equal vectors count once: a map-side combined distinct makes
the fit list.  Two passes over the staged list give its exact sums and, from centred rows, its covariance: every task
adds up one d x d matrix, and Spark adds the tasks' entries.  ``feast`` takes the leading eigenpairs of that one matrix
(d is the width of a vector, not a number of rows), and one more pass over all rows projects them.  A last pass over
the fit list measures how far the covariance of the whitened values is from the identity.

Defined cases.  Vectors that are NULL or hold NULL, NaN or infinite entries are dropped, as are empty ones and those
whose length is not the most frequent one (the greater of equally frequent ones).  Entries beyond a long are clipped to
it; sums that leave a long raise.  Repeated rows and NULL or repeated vec_id: rows of their own.  Eigenvalues that are
zero to rounding give no component, so a single distinct vector gives no rows.  Equal eigenvalues: any orthogonal
choice, the same for all rows.  Other columns are not read.  No rows: no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswave.llm.common import table
from locuswave.llm.feast import eigenpairs
from locuswave.session import stage

SCALE = 256
COMPONENTS = 4
LARGEST = 2 ** 63 - 1


def integer_vectors(rows: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable rows of one length."""
    entry = F.col(vector)
    usable = rows.filter(entry.isNotNull() & (F.size(entry) > 0) & F.forall(entry, lambda c: F.coalesce(
        F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))))
    made = usable.select(F.col(key).alias("vec_id"), F.transform(
        entry, lambda c: F.floor(c.cast("double") * scale)).cast("array<bigint>").alias("x"))
    return made


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _covariance_parts(batches: Iterator[pa.RecordBatch], mean: np.ndarray, project: np.ndarray | None = None):
    """Upper triangle of the sum of outer products of centred (and projected) rows, one row per entry."""
    total = None
    for batch in batches:
        if batch.num_rows:
            y = _matrix(batch.column(0)).astype(np.float64) - mean
            if project is not None:
                y = y @ project
            total = y.T @ y if total is None else total + y.T @ y
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])


def covariance(vectors: DataFrame, n: int, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the column ``x`` around ``mean``, divisor n."""
    width = len(mean) if project is None else project.shape[1]
    parts = vectors.select("x").mapInArrow(
        functools.partial(_covariance_parts, mean=mean, project=project), "i bigint, j bigint, s double")
    out = np.zeros((width, width))
    # d * (d + 1) / 2 rows, whatever the number of vectors.
    for i, j, s in parts.groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = out[j, i] = s / n
    return out


class Fit:
    """Statistics of the fit list: n, exact sums, leading eigenpairs, trace, and the measured identity error."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float) -> None:
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        self.mean = np.array([s / n for s in sums])
        self.project = vectors / np.sqrt(values)
        self.identity_error = 0.0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fit of the distinct vectors ``x``, all of one length; None without any."""
    distinct = stage(vectors.select("x").distinct(), "distinct-vectors")
    width = distinct.select(F.size("x").alias("d")).first()
    if width is None:
        return None
    sums = distinct.select(F.count(F.lit(1)), *[
        F.sum(F.get("x", F.lit(k)).cast("decimal(38,0)")) for k in range(width.d)]).first()
    n, sums = sums[0], [int(s) for s in sums[1:]]
    mean = np.array([s / n for s in sums])
    matrix = covariance(distinct, n, mean)
    # Below this an eigenvalue is rounding.
    floor = len(mean) * np.finfo(float).eps * float(np.trace(matrix)) * 4
    values, found = eigenpairs(matrix, components, floor) if np.any(matrix) else (np.zeros(0), np.zeros((len(mean), 0)))
    made = Fit(n, sums, values, found, float(np.trace(matrix)))
    if len(values):
        # Whitened values of the fit list have mean zero, as its rows are centred.
        measured = covariance(distinct, n, mean, made.project)
        made.identity_error = float(np.abs(measured - np.eye(len(values))).max())
    return made


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Sum over dimensions of (n * x - S) ** 2 for every row, exact."""
    biggest = max((abs(int(x.min())), abs(int(x.max())))) if x.size else 0
    most = n * biggest + max(map(abs, sums))
    if len(sums) * most * most <= LARGEST:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1)
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    if max(exact) > LARGEST:
        raise OverflowError("deviation beyond a long")
    return exact.astype(np.int64)


def _whiten(batches: Iterator[pa.RecordBatch], made: Fit) -> Iterator[pa.RecordBatch]:
    k = len(made.values)
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            x = _matrix(part.column(1))
            rows = len(x)
            whitened = (x.astype(np.float64) - made.mean) @ made.project
            repeated = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(repeated)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, made.n)), pa.array(_deviations(x, made.n, made.sums)[repeated]),
                pa.array(whitened.ravel()), pa.array(np.tile(made.values / made.trace, rows)),
                pa.array(np.full(rows * k, made.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, scale: int = SCALE, components: int = COMPONENTS, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component; the model is fitted on the distinct vectors of the same rows."""
    made = stage(integer_vectors(rows, scale, key, vector), "vectors")
    usual = made.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
    if usual is not None:
        made = made.filter(F.size("x") == usual.d)
    model = fit(made, components)
    if model is None or not len(model.values):
        return made.sparkSession.createDataFrame([], SCHEMA)
    return made.select(F.col("vec_id").cast("bigint"), "x").mapInArrow(functools.partial(_whiten, made=model), SCHEMA)


def op12_feast_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
