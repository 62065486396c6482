"""Embedding whitening by spectral divide-and-conquer on QDWH polar decompositions.

The fit list is every distinct vector once, in whole steps of 1/256.  Three passes over it run on Spark: exact sums, the centred
second moments, and the covariance of what whitening makes of it.  Only numbers that the dimension bounds reach the driver: the sums
and the covariance matrix (at most MAX_DIMENSION squared).

There the covariance is split: the polar factor of (V - shift) by dynamically weighted Halley iterations (QR steps, then Cholesky
steps) is its matrix sign, half of sign + identity projects on the subspace above the shift, and orthonormal bases of it and of its
complement give two smaller problems, until blocks are diagonal to double precision.  The components are broadcast, and each row is
whitened in the task that reads it.

Cases: vectors that are null or hold null or non-finite entries take no part, nor do empty ones and those of another length than the
commonest (of equals the longer); steps beyond a 64-bit number are held at its ends; repeated rows are whitened each, but count once
in the fit; null vec_ids stay.  A component without variance (fewer distinct vectors than components, or all in one plane) has null
whitened values, and identity_error is over the others (0 where there is none).  A deviation beyond a 64-bit number is null.  Columns
other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import Scratch

STEPS = 256
MAX_DIMENSION = 4096
EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------------------------------------
# The decomposition of one small symmetric matrix


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, which is its matrix sign, by dynamically weighted Halley iterations."""
    size = np.linalg.norm(a)  # no singular value is larger
    if size == 0:
        return np.eye(len(a))
    x, eye = a / size, np.eye(len(a))
    low = max(0.9 * np.linalg.norm(np.linalg.inv(x)) ** -1 if np.linalg.cond(x) < 1 / EPS else EPS, EPS)  # nor smaller than this
    for _ in range(60):
        l2 = low * low
        d = np.cbrt(4 * max(1 - l2, 0.0) / (l2 * l2))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - l2) / (l2 * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[: len(a)] @ q[len(a) :].T
        else:
            half = np.linalg.cholesky(eye + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        moved = np.linalg.norm(new - x)
        x, low = (new + new.T) / 2, min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if moved < 1e-14 * np.sqrt(len(a)) or (moved < EPS ** (1 / 3) and 1 - low < 10 * EPS):
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """An orthonormal basis whose first columns span what lies above the shift, and how many do."""
    n = len(a)
    up = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(float(np.trace(up))))
    if not 0 < rank < n:
        return np.eye(n), rank
    q = rng.standard_normal((n, n))
    for _ in range(3):  # a projector squared is itself: more rounds only clean rounding
        q, _ = np.linalg.qr(np.hstack([up @ q[:, :rank], q[:, rank:] - up @ q[:, rank:]]))
    return q, rank


def spectral(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns (largest entry positive) of a symmetric matrix."""
    v = (v + v.T) / 2
    rng, tiny = np.random.default_rng(12), EPS * max(np.linalg.norm(v), np.finfo(np.float64).tiny)
    values, columns, todo = [], [], [(v, np.eye(len(v)))]
    while todo:
        a, q = todo.pop()
        n = len(a)
        off = np.linalg.norm(a - np.diag(np.diag(a)))
        if n == 1 or off <= tiny:
            values += np.diag(a).tolist()
            columns.append(q)
            continue
        if n == 2:  # one rotation
            theta = 0.5 * np.arctan2(2 * a[0, 1], a[0, 0] - a[1, 1])
            basis, rank = np.array([[np.cos(theta), -np.sin(theta)], [np.sin(theta), np.cos(theta)]]), 1
        else:
            for shift in (float(np.median(np.diag(a))), float(np.trace(a)) / n):  # the mean lies between the extremes
                basis, rank = _split(a, shift, rng)
                if 0 < rank < n:
                    break
            else:
                # All eigenvalues agree with the shift to rounding: any basis is one of eigenvectors.
                values += np.diag(a).tolist()
                columns.append(q)
                continue
        b = basis.T @ a @ basis
        b = (b + b.T) / 2
        todo += [(b[:rank, :rank], q @ basis[:, :rank]), (b[rank:, rank:], q @ basis[:, rank:])]
    vectors = np.hstack(columns)
    vectors = _corrected(v, vectors)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    return values, vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(v))] < 0, -1.0, 1.0)


def _corrected(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """One first-order step: what is left between columns whose eigenvalues are apart."""
    t = q.T @ v @ q
    gap = np.diag(t)[None, :] - np.diag(t)[:, None]
    far = np.abs(gap) > 1e-6 * np.linalg.norm(v)
    turn = np.where(far, t / np.where(far, gap, 1.0), 0.0)
    q, r = np.linalg.qr(q + q @ turn)
    return q * np.sign(np.diag(r))


# ---------------------------------------------------------------------------------------------
# Passes over vectors


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A list column of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def steps_of(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the vector in whole steps, of the rows that take part (but for their length)."""
    c = lambda v: v.cast("double")
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(c(v)) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(fine).select("vec_id", F.transform("embedding", lambda v: F.floor(c(v) * STEPS)).alias("x"))


@dataclass(frozen=True)
class Whitening:
    """What rows are whitened with; the arrays have a row or column for each dimension."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # of all components
    vectors: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def scale(self, k: int) -> np.ndarray:
        """dimension x k: components over the root of their variance; NaN where there is none to double precision."""
        e = self.values[:k]
        real = e > max(self.values[0], 0.0) * len(self.values) * EPS * 4
        return np.where(real, self.vectors[:, :k] / np.sqrt(np.where(real, e, 1.0)), np.nan)

    @classmethod
    def fit(cls, fit_list: DataFrame) -> Whitening | None:
        """Of x, each vector once and all of one length; None of no rows.  fit_list should be staged, it is read twice."""
        dimension = fit_list.select(F.size("x").alias("d")).limit(1).collect()
        if not dimension:
            return None
        d = dimension[0]["d"]
        if d > MAX_DIMENSION:
            raise ValueError(f"vectors of more than {MAX_DIMENSION} dimensions: their covariance doesn't fit the driver")

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, [0] * d
            for b in batches:
                x = matrix(b.column(0), d)
                exact = np.abs(x.astype(np.float64)).max(initial=0.0) * len(x) < 2**62
                n += len(x)
                total = [t + int(s) for t, s in zip(total, (x if exact else x.astype(object)).sum(0), strict=True)]
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)), pa.array([n] * d, pa.int64())], ["i", "s", "n"])

        got = sorted(fit_list.mapInArrow(add, "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
        n, sums = got[0]["n"], tuple(int(r["s"]) for r in got)
        mean = np.array([s / n for s in sums])

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, any_row = np.zeros((d, d)), False
            for b in batches:
                y = matrix(b.column(0), d) - mean
                total += y.T @ y
                any_row = any_row or len(y) > 0
            if any_row:
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "row"])

        def strip(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"i": group["i"].iloc[:1], "row": [np.sum([np.frombuffer(r) for r in group["row"]], axis=0).tobytes()]})

        # A task adds up one row of the matrix, of one partial sum a partition.
        rows = sorted(fit_list.mapInArrow(moments, "i int, row binary").groupBy("i").applyInPandas(strip, "i int, row binary").collect())
        return cls(n, sums, *spectral(np.vstack([np.frombuffer(r["row"]) for r in rows]) / n))

    def projected(self, rows: DataFrame, k: int) -> DataFrame:
        """rows (vec_id, x) with deviation, and whitened: the values of the first k components."""
        sent = rows.sparkSession.sparkContext.broadcast((self.n, self.sums, self.mean, self.scale(k)))
        width = min(k, len(self.values))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums, mean, scale = sent.value
            small = n * 2.0**31 + max(map(abs, sums)) < 2**62
            whole = np.array(sums, np.int64 if small else object)
            for b in batches:
                x = matrix(b.column(1), len(sums))
                w = (x - mean) @ scale
                size = np.square(float(n) * (x - mean)).sum(1).max(initial=0.0)
                fits = small and size < 2**61 and np.abs(x.astype(np.float64)).max(initial=0.0) < 2**31
                far = n * (x if fits else x.astype(object)) - whole
                deviation = [int(v) if v < 2**63 else None for v in (far * far).sum(1)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(w.ravel(), pa.float64(), from_pandas=True))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviation, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

        return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, k: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and each of the first k components."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    rows = steps_of(vectors.select("vec_id", "embedding"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == lengths["d"])
    fit_list = scratch.staged(rows.select("x").distinct(), "fit_list")
    model = Whitening.fit(fit_list)
    width = min(k, lengths["d"])
    trial = model.projected(fit_list.withColumn("vec_id", F.lit(0).cast("long")), width).select("whitened")
    real = np.flatnonzero(~np.isnan(model.scale(width)[0])).tolist()
    pairs = [(i, j) for i in real for j in real if i <= j]
    error = 0.0
    if pairs:
        got = trial.agg(*[F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for (i, j), c in zip(pairs, got, strict=True))
    scratch.close()
    trace = float(model.values.sum())
    explained = F.array(*[F.lit(float(max(e, 0.0) / trace) if trace > 0 else 0.0) for e in model.values[:width]])
    out = model.projected(rows, width).select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return out.select("vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("_at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
