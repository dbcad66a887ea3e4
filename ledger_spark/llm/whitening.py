"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

SCALE, SHIFT = 1024.0, 100_000
#: Entries beyond this have no x that fits exact sums; they count as non-finite.
LARGEST = 2.0**38
_ROWS_A_STEP = 4_096


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: row count and sums of x, the eigenvalues, their unit vectors (columns) and the covariance's trace."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def usable_vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector takes part, with ``_v`` (array of double).

    Left out are vectors that are null or hold a null, NaN, infinite or too large entry (LARGEST), and
    those whose length differs from the commonest one among the rest (of lengths as common: the larger).
    """
    sound = table.withColumn("_v", F.col(column).cast("array<double>")).filter(
        F.col("_v").isNotNull() & (F.size("_v") > 0) & F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    )
    lengths = sound.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    return sound.filter(F.size("_v") == lengths["d"]) if lengths else sound.limit(0)


def _entries(column: pa.Array) -> Iterator[np.ndarray]:
    """Blocks (rows x dimensions) of x."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(column) == 0:
        return
    flat = column.flatten().to_numpy(zero_copy_only=False)
    for block in np.array_split(flat.reshape(len(column), -1), -(-len(column) // _ROWS_A_STEP)):
        yield np.floor(block * SCALE).astype(np.int64) + SHIFT


def _exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sum of x in each dimension, in whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            for x in _entries(batch.column(0)):
                part = [int(s) for s in x.sum(axis=0)]
                n, sums = n + len(x), part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
        if n:
            rows = [n, *sums]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int32()), pa.array(map(str, rows), pa.string())], ["i", "s"])

    parts = vectors.select("_v").mapInArrow(run, "i int, s string")
    found = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()  # a row a dimension
    totals = [int(r["s"]) for r in found]
    return (totals[0], totals[1:]) if totals else (0, [])


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit numbers where they fit, otherwise as Python's."""
    reach = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums))
    if reach < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of x, each entry centred before it is multiplied; a partition gives one row a dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _entries(batch.column(0)):
                centred = (_differences(x, n, sums) / n).astype(np.float64)
                part = centred.T @ centred
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "s"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[:1].assign(s=[np.sum(np.stack(rows["s"].tolist()), axis=0)])

    parts = vectors.select("_v").mapInArrow(run, "i int, s array<double>").withColumn("part", F.spark_partition_id() % 64)
    # two levels, so that no group holds the rows of all partitions
    some = parts.groupBy("i", "part").applyInPandas(add, "i int, s array<double>, part int")
    rows = some.groupBy("i").applyInPandas(add, "i int, s array<double>, part int").select("i", "s").collect()  # a row a dimension
    return np.stack([r["s"] for r in sorted(rows, key=lambda r: r["i"])]) / n


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``factor`` with factor @ factor.T = matrix (symmetric, no negative eigenvalue): a column a pivot, largest first.

    In the order of the pivots the factor is lower triangular; rows stay in the order of ``matrix``. It
    ends when what is left of the diagonal is rounding noise, so it has as many columns as the rank.
    """
    left = np.array(matrix, np.float64)
    size = len(left)
    noise = size * np.finfo(np.float64).eps * max(np.diagonal(left).max(initial=0.0), 0.0)
    columns = []
    for _ in range(size):
        pivot = int(np.argmax(np.diagonal(left)))
        if left[pivot, pivot] <= noise:
            break
        column = left[:, pivot] / np.sqrt(left[pivot, pivot])
        columns.append(column)
        left -= np.outer(column, column)
        left[pivot, :] = left[:, pivot] = 0.0
    return np.stack(columns, axis=1) if columns else np.zeros((size, 0))


def _rounds(count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``count`` columns once, in rounds of pairs without a common column."""
    players = list(range(count + count % 2))
    out = []
    for _ in range(len(players) - 1):
        pairs = [(a, b) for a, b in zip(players[: len(players) // 2], reversed(players), strict=False) if max(a, b) < count]
        out.append((np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)))
        players = [players[0], players[-1], *players[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, *, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of factor @ factor.T.

    Columns are rotated in pairs until all are orthogonal. The product never changes, so their squared
    norms are then its eigenvalues and the columns themselves, normalised, its eigenvectors. Rotations of
    a round touch different columns and are made at once.
    """
    work = np.array(factor, np.float64)
    tolerance = np.finfo(np.float64).eps * max(work.shape)
    for _ in range(sweeps):
        worst = 0.0
        for a, b in _rounds(work.shape[1]):
            if not len(a):
                continue
            p, q = work[:, a], work[:, b]
            pp, qq, pq = (p * p).sum(axis=0), (q * q).sum(axis=0), (p * q).sum(axis=0)
            size = np.sqrt(pp * qq)
            off = np.divide(np.abs(pq), size, out=np.zeros_like(pq), where=size > 0)
            worst = max(worst, float(off.max()))
            turn = off > tolerance / 8
            zeta = np.divide(qq - pp, 2 * pq, out=np.zeros_like(pq), where=turn)
            tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cosine = 1.0 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            work[:, a], work[:, b] = cosine * p - sine * q, sine * p + cosine * q
        if worst <= tolerance:
            break
    norms = np.sqrt((work * work).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    norms, work = norms[order], work[:, order]
    return norms**2, work / norms


def fit_whitening(vectors: DataFrame) -> Whitening | None:
    """Fit on the rows of ``usable_vectors``: two scans, of which numbers per dimension and pair of dimensions reach the driver.

    None where there are no vectors. Directions without variance have no component.
    """
    n, sums = _exact_sums(vectors)
    if n == 0:
        return None
    covariance = _covariance(vectors, n, sums)
    values, components = one_sided_jacobi(pivoted_cholesky(covariance))
    return Whitening(n, tuple(sums), values, components, float(np.trace(covariance)))


def whiten(vectors: DataFrame, model: Whitening, *, components: int | None = None, id_column: str = "vec_id") -> DataFrame:
    """(id, deviation, whitened): each row's sum of (n * x - S)^2 and its coordinates on the first components.

    ``whitened`` has one entry a component, at most the number of directions with variance. A deviation
    that no long can hold is null.
    """
    n, sums = model.n, list(model.sums)
    project = model.components[:, :components] / np.sqrt(model.eigenvalues[:components])
    dimensions = max(1, len(sums))
    kind = next(f for f in vectors.schema.fields if f.name == id_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviations, projected = [], []
            for x in _entries(batch.column(1)):
                d = _differences(x, n, sums)
                if int(np.abs(d).max()) ** 2 * dimensions >= 1 << 63:
                    d = d.astype(object)
                deviations += [s if s < 1 << 63 else None for s in map(int, (d * d).sum(axis=1))]
                projected.append(((d / n).astype(np.float64)) @ project)
            values = np.concatenate(projected) if projected else np.zeros((0, project.shape[1]))
            offsets = np.arange(len(values) + 1, dtype=np.int32) * project.shape[1]
            whitened = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations, pa.int64()), whitened], [id_column, "deviation", "whitened"])

    ddl = f"`{id_column}` {kind.dataType.simpleString()}, deviation bigint, whitened array<double>"
    return vectors.select(id_column, "_v").mapInArrow(run, ddl)


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity, centred before multiplying."""
    if components == 0:
        return 0.0
    w = [F.element_at("whitened", i + 1) for i in range(components)]
    means = whitened.agg(*[F.avg(c) for c in w]).first()
    centred = [c - F.lit(m) for c, m in zip(w, means, strict=True)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    entries = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, entries, strict=True))


def whitening_report(table: DataFrame, *, components: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Repeated rows are rows of their own; a null id stays null; extra columns are not read. Fewer
    components come out where fewer directions have variance: none for one vector, for equal vectors and
    for a table without vectors.
    """
    vectors = usable_vectors(table, vector_column).select(F.col(id_column).cast("bigint").alias("vec_id"), "_v")
    ddl = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit_whitening(vectors)
    count = min(components, len(model.eigenvalues)) if model else 0
    if count == 0:
        return table.sparkSession.createDataFrame([], ddl)
    projected = stage(whiten(vectors, model, components=count), "whitened")
    error = identity_error(projected, count)
    explained: Column = reduce(
        lambda rest, i: F.when(F.col("i") == i, F.lit(float(model.eigenvalues[i] / model.trace))).otherwise(rest), range(count), F.lit(None).cast("double")
    )
    rows = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "w"))
    return rows.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", F.col("w").alias("whitened"),
        explained.alias("explained"), F.lit(error).alias("identity_error"),
    )
