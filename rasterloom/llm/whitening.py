"""Whitening of vectors by a covariance from squared sums (polarisation)."""

from __future__ import annotations

from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm.tables import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows taken together; sums of this many products of two 26-bit numbers stay within 63 bits.
BLOCK = 512
HALF = 26
EXACT = Context(prec=60)


def quantised(vectors, column="embedding", scale=SCALE, shift=SHIFT):
    """The rows whose vector and entries are there and finite, with x = floor(scale * entry) + shift in place of the vector.

    Entries beyond 4e18 / scale count as that, so that x stays a long.
    """
    sane = f"`{column}` is not null and forall(`{column}`, c -> c is not null and not isnan(c) and abs(c) < double('inf'))"
    x = F.expr(f"transform(`{column}`, c -> floor(greatest(-4e18D, least(4e18D, {scale} * double(c)))) + {shift}L)")
    return vectors.filter(sane).withColumn("x", x).drop(*([column] if column != "x" else []))


def _matrix(column):
    """An Arrow list column as a matrix. All lists must be of one length."""
    size = np.diff(column.offsets.to_numpy())
    if len(size) and (size != size[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy().reshape(len(column), -1)


def _decimals(numbers):
    """Python integers as an Arrow column of decimals."""
    return pa.array([Decimal(int(n)) for n in numbers], pa.decimal128(38, 0))


def _sums(batches):
    """Per task: dimension, rows, sum of x."""
    n, total = 0, None
    for batch in batches:
        x = _matrix(batch.column("x"))
        if len(x):
            if total is not None and len(total) != x.shape[1]:
                raise ValueError("vectors differ in length")
            # High and low halves apart, so that no sum leaves 63 bits.
            part = (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
            total = part if total is None else total + part
            n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), _decimals(total)], ["i", "n", "total"])


def centred(x, n, sums):
    """n * x - S, exactly: as 64-bit integers where they hold it and its sum with another, else as Python integers."""
    far = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    wide = n * far + max(map(abs, sums), default=0) >= 1 << 62
    return x.astype(object) * n - np.array(sums, object) if wide else x * np.int64(n) - np.array(sums, np.int64)


def squares(z):
    """Sums down the rows of z squared, in three parts: z = h * 2 ** 26 + l gives h h, h l and l l."""
    if z.dtype != object and z.size and (len(z) > 2048 or max(int(z.max()), -int(z.min())) >= 1 << 52):
        z = z.astype(object)
    h, l = z >> HALF, z & ((1 << HALF) - 1)
    return [(p * q).sum(axis=0) for p, q in ((h, h), (h, l), (l, l))]


def _pair_sums(n, sums):
    """Per task: for each dimension (i = j) the sum of squared centred values, for each pair i < j that of their sums."""
    d = len(sums)
    first = np.append(0, np.cumsum(np.arange(d, 0, -1)))

    def run(batches):
        total = [np.zeros(first[-1], object) for _ in range(3)]
        seen = False
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                y = centred(_matrix(batch.column("x").slice(low, BLOCK)), n, sums)
                for i in range(d):
                    z = y[:, i:] + y[:, i:i + 1]
                    z[:, 0] = y[:, i]
                    for t, s in zip(total, squares(z)):
                        t[first[i]:first[i + 1]] += s.astype(object)
                seen = True
        if seen:
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(_decimals, total)], ["i", "j", "hh", "hl", "ll"])
    return run


def covariance(rows, n, d):
    """Covariances from the aggregated sums: cov(i, j) = (var(i + j) - var(i) - var(j)) / 2, in whole numbers until the last division."""
    square = np.zeros((d, d), object)
    for r in rows:
        square[r.i, r.j] = (int(r.hh) << 2 * HALF) + (int(r.hl) << HALF + 1) + int(r.ll)
    v = np.zeros((d, d))
    for i in range(d):
        v[i, i] = square[i, i] / n**3
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (square[i, j] - square[i, i] - square[j, j]) / (2 * n**3)
    return v


def axes(v, components):
    """Leading eigenvalues, falling, and unit eigenvectors of a covariance; those below its numerical rank are left out."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > max(e[0], 0) * len(e) * np.finfo(float).eps).sum())) if len(e) else 0
    return e[:k], u[:, :k]


def _projected(y, n, e, u):
    return (y.astype(float) / n) @ u / np.sqrt(e)


def _moments(n, sums, e, u):
    """Per task: sums of products of the whitened values of the fit list."""
    def run(batches):
        k = len(e)
        total, seen = np.zeros((k, k)), False
        for batch in batches:
            if batch.num_rows:
                w = _projected(centred(_matrix(batch.column("x")), n, sums), n, e, u)
                total, seen = total + w.T @ w, True
        if seen:
            i, j = np.indices((k, k)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], ["i", "j", "total"])
    return run


def _whitened(n, sums, e, u, keep):
    def run(batches):
        k = len(e)
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                y = centred(_matrix(part.column("x")), n, sums)
                hh, hl, ll = (x.astype(object) for x in squares(y.T))
                deviation = hh * (1 << 2 * HALF) + hl * (1 << HALF + 1) + ll
                row = pa.array(np.repeat(np.arange(len(y)), k))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(row) for c in keep), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                     pa.array([str(x) for x in deviation]).take(row), pa.array(_projected(y, n, e, u).ravel())],
                    [*keep, "component", "deviation", "whitened"])
    return run


def whiten(vectors, components=COMPONENTS, column="embedding", scale=SCALE, shift=SHIFT, keep=("vec_id",)):
    """Vectors on the principal axes of their distinct values, each axis scaled to unit variance.

    ``vectors``: a list column and the columns to ``keep``; others are ignored. Rows whose vector is
    null or holds a null or non-finite entry are dropped, those with an empty vector give no rows.
    Vectors of differing lengths are an error. Entries become whole numbers x (see ``quantised``). Repeated rows and null ids are whitened
    each for itself, but the fit list holds each distinct x vector once: a hot vector weighs no more
    than a rare one, and copies are combined before the shuffle.

    Covariance by polarisation: for each dimension the centred values n x - S, and for each pair of
    dimensions their sums, are squared and added up, all in whole numbers. Half of what the variance
    of a sum exceeds the two variances by is the covariance. A task holds one block of vectors and one
    number for each pair; the driver gets dimensions times dimensions numbers. Components beyond the
    covariance's numerical rank have no scale and give no rows, so a single distinct vector, and an
    empty table, give none.

    Returns the kept columns, component (from 1), n, deviation (sum over dimensions of (n x - S)
    squared, as a string of digits: it may outgrow a long), whitened, explained and identity_error
    (largest entry of the whitened fit list's covariance minus the identity).
    """
    spark = vectors.sparkSession
    types = {c: vectors.schema[c].dataType.simpleString() for c in keep}
    rows = quantised(vectors.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col(column).alias("e")), "e", scale, shift).filter("size(x) > 0")
    kept = [f"k{i}" for i in range(len(keep))]
    out = ", ".join([*(f"{k} {t}" for k, t in zip(kept, types.values())), "component int, deviation string, whitened double"])
    # Grouped by the bytes of the vector, which are combined in each task first.
    fit = stored(rows.select("x").distinct(), "vectors")
    sums = fit.mapInArrow(_sums, "i int, n bigint, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    n, total, d = (sums[0].n if sums else 0), [int(r.total) for r in sums], len(sums)
    if any(r.n != n for r in sums):
        raise ValueError("vectors differ in length")
    e, u, explained, error = np.zeros(0), np.zeros((d, 0)), [], 0.0
    if n:
        pairs = fit.mapInArrow(_pair_sums(n, total), "i int, j int, hh decimal(38,0), hl decimal(38,0), ll decimal(38,0)")
        v = covariance(pairs.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in ("hh", "hl", "ll"))).collect(), n, d)
        e, u = axes(v, components)
        explained = (e / np.trace(v)).tolist() if len(e) else []
    if len(e):
        found = fit.mapInArrow(_moments(n, total, e, u), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
        error = max(abs(r.total / n - (r.i == r.j)) for r in found)
    scales = spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(explained)], "component int, explained double")
    made = rows.mapInArrow(_whitened(n, total, e, u, kept), out).join(F.broadcast(scales), "component")  # at most ``components`` rows
    return made.select(
        *(F.col(k).alias(c) for k, c in zip(kept, keep)), "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(float(error)).alias("identity_error"))
