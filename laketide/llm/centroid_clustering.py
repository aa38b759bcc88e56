"""Centroid clustering by Walsh-Hadamard progressive search.

Vectors become integers, ``floor(64 * x)``. The Walsh-Hadamard transform of
vectors and centroids is exact in integers and keeps distances up to the
factor ``dim``: the squared differences of the coefficients add up to
``dim`` times the squared distance. Coefficients run from coarse to fine
(by their number of sign changes). After every stage the sum so far is a lower
bound, and a centroid whose bound is strictly over the whole distance of a
leading centroid is out; those left at the end have all coefficients added.

Every round is one Spark job over the table: a task keeps one sum and count per
centroid and component, whatever its rows, and Spark adds the tasks' sums, so a
centroid that holds most of the rows costs no more than another. The
driver gets ``clusters * dim`` sums a round.

Defined cases. Vectors that are null, of another length, or hold a null, NaN
or infinite component are left out; so are components beyond the range of a
float. Rows are vectors one by one: repeated rows count each. A
null ``vec_id`` sorts last among the starting centroids; rows that repeat an id
are ordered by their vectors. With fewer vectors than ``clusters`` each is a
centroid. Ties go to the smaller centroid number. A distance, or a sum
of them, that a long cannot hold is null. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import ready, written

SAFE = 1 << 20          # components up to here are transformed and squared in 64 bits
LIMB = 62               # sums travel as two decimals, split at this bit
FLOAT_MAX = float(np.finfo(np.float32).max)
LONG_MAX = (1 << 63) - 1


def coarse_to_fine(dim: int) -> np.ndarray:
    """Rows of the Hadamard matrix by their number of sign changes."""
    if dim < 1 or dim & (dim - 1):
        raise ValueError("the number of components must be a power of two")
    rows = np.arange(dim)
    signs = np.bitwise_count(rows[:, None] & rows[None, :]) & 1
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def transform(v: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows, coarse to fine."""
    n, dim = v.shape
    out, half = v, 1
    while half < dim:
        pairs = out.reshape(n, dim // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([a + b, a - b], axis=2).reshape(n, dim)
        half *= 2
    return out[:, coarse_to_fine(dim)]


def stages(dim: int) -> list[tuple[int, int]]:
    """Coefficient ranges, each as long as all before it."""
    edges = [0, 1, *[1 << i for i in range(1, dim.bit_length())]]
    return list(zip(edges[:-1], edges[1:]))


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and squared distance of each integer row,
    and how many coefficient differences were added."""
    n, dim = v.shape
    x, c = transform(v), transform(centroids)
    so_far = np.zeros((n, len(c)), x.dtype)
    alive = np.ones((n, len(c)), bool)
    bound, added = None, 0
    for a, b in stages(dim):
        row, col = np.nonzero(alive)
        so_far[row, col] += ((x[row, a:b] - c[col, a:b]) ** 2).sum(axis=1)
        added += len(row) * (b - a)
        if b == dim:
            break
        # The leader's whole distance bounds all others; a later leader may lower it.
        lead = np.where(alive, so_far, so_far.max(initial=0) + 1).argmin(axis=1)
        whole = ((x - c[lead]) ** 2).sum(axis=1)
        bound = whole if bound is None else np.minimum(bound, whole)
        alive &= so_far <= bound[:, None]
    so_far[~alive] = so_far.max(initial=0) + 1
    best = so_far.argmin(axis=1)
    return best, so_far[np.arange(n), best] // dim, added


def whole_numbers(col: pa.Array, dim: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of a list column whose lists are whole: 64-bit
    integers, or Python integers where one is too large to square."""
    x = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    y = np.floor(x * scale)
    if not len(y) or np.abs(y).max() < SAFE:
        return y.astype(np.int64)
    return np.array([[math.floor(e) for e in r] for r in y.tolist()], object).reshape(-1, dim)


def _same_kind(v: np.ndarray, c: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    big = v.dtype == object or max(abs(e) for r in c for e in r) >= SAFE
    kind = object if big else np.int64
    return v.astype(kind), np.array(c, kind)


def _sums(rows: DataFrame, centroids: list[list[int]], dim: int, scale: int) -> list[tuple[int, list[int]]]:
    """Count and componentwise sum of every centroid's vectors."""
    k = len(centroids)

    def add(batches):
        total = np.zeros((k, dim + 1), object)
        for b in batches:
            if not b.num_rows:
                continue
            v, c = _same_kind(whole_numbers(b.column(0), dim, scale), centroids)
            best, _, _ = nearest(v, c)
            for i in np.unique(best):
                own = v[best == i]
                total[i, :dim] += own.sum(axis=0)
                total[i, dim] += len(own)
        at = [(i, j) for i in range(k) if total[i, dim] for j in range(dim + 1)]
        sums = [int(total[i, j]) for i, j in at]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()),
             pa.array([Decimal(s >> LIMB) for s in sums], kind), pa.array([Decimal(s & ((1 << LIMB) - 1)) for s in sums], kind)],
            names=["cluster", "component", "high", "low"])

    whole = (rows.select("vector").mapInArrow(add, "cluster int, component int, high decimal(38,0), low decimal(38,0)")
             .groupBy("cluster", "component").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    out = [(0, [0] * dim) for _ in range(k)]
    value = {(r.cluster, r.component): (int(r.high) << LIMB) + int(r.low) for r in whole}  # k * (dim + 1) at most
    for i in range(k):
        if (i, dim) in value:
            out[i] = (value[i, dim], [value[i, j] for j in range(dim)])
    return out


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = 16, rounds: int = 3,
            dim: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """Per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Centroids start as the vectors whose SHA-256 of ``<seed>:<vec_id>`` is
    smallest; a round assigns all vectors and moves each centroid that has some
    to the floor of their mean.
    """
    spark = df.sparkSession
    ready(spark)
    coarse_to_fine(dim)
    v = F.col(vector)
    whole = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) <= FLOAT_MAX))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector")).where(whole)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "vector").limit(clusters).select("vector").toArrow()
    centroids = [[int(e) for e in r] for b in first.to_batches() for r in whole_numbers(b.column(0), dim, scale)]
    result = "vec_id long, cluster int, distance long"
    if not centroids:
        return spark.createDataFrame([], result + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = [[s // n for s in total] if n else old
                     for old, (n, total) in zip(centroids, _sums(rows, centroids, dim, scale))]

    def assign(batches):
        for b in batches:
            if b.num_rows:
                v, c = _same_kind(whole_numbers(b.column(1), dim, scale), centroids)
                best, distance, _ = nearest(v, c)
                far = [None if d > LONG_MAX else int(d) for d in distance] if distance.dtype == object else distance
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best.astype(np.int32)), pa.array(far, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    placed = written(rows.mapInArrow(assign, result), "clusters")
    sums = (placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                          F.count_if(F.col("distance").isNull()).alias("lost")).collect())  # a row a centroid
    of = {r.cluster: None if r.lost else int(r.s) for r in sums}
    total = None if None in of.values() else sum(of.values())
    fit = lambda s: None if s is None or s > LONG_MAX else s
    about = spark.createDataFrame(
        [(i, fit(s), fit(total), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()) for i, s in of.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # `about`: a row a centroid
