"""Approximate nearest neighbours by an inverted multi-index.

1. Rows with one vector become one class with their ``k + 1`` smallest ids: a
   search can never need more of them, because ties go to smaller ids.
2. Each half of the vectors is quantised on its own, with centroids fitted on a
   bounded sample; a class lies in the cell of its two centroids.
3. Cells, in order, are cut into shards of about ``shard_rows`` classes (a cell
   with more is split by hash). A shard travels as one packed row.
4. A query visits centroid pairs by rising summed distance (the inner product
   turned round) from a heap, until its cells hold ``budget`` classes. Blocks
   of queries go to the shards that hold visited cells.
5. A shard ranks the classes of a query's own visited cells by their original
   vectors; each shard's best meet in a window per query.

``budget`` is measured, not guessed: for a bounded sample of queries, true
neighbours from one pass over all classes tell after how many classes the heap
reaches each of them, and ``budget`` takes the share ``recall`` of them. On
clustered vectors it stays small; on vectors without any structure, where no
index helps, it grows to a fixed share of the table. All rows are
indexed; nothing is dropped from a cell.

Bounds: the fit takes ``sample_rows`` classes, the measurement ``measured``
queries, centroids a half grow with the root of the classes up to 1024, so the
driver holds at most 1024 ** 2 cell counts.

Defined cases. Vectors that are null, zero, or hold a null or non-finite
component take no part, nor do those of another length than the most frequent one
(ties: the longer). Rows equal in id and vector are one. A null id is no query; as
a candidate it sorts last among ties. A query never finds a row of its own
id; an id with several vectors asks with each of them. Scores are sums in double precision,
component by component. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from laketide.llm.common import NULL_ID, U64, mix, owners_of, ready, written

MAX_CENTROIDS = 1024
ITERATIONS = 8
NEAR = 1e-9  # scores nearer than this, relative to their size, are decided in exact order


def finite_vectors(col: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and components of the lists that are whole: not null, all finite, not all zero."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
    at = np.flatnonzero(size)
    flat = col.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    edges = np.concatenate([[0], np.cumsum(size[at])])
    if not len(at):
        return at, []
    good = np.logical_and.reduceat(np.isfinite(flat), edges[:-1]) & np.logical_or.reduceat(flat != 0, edges[:-1])
    return at[good], [flat[edges[i]:edges[i + 1]] for i in np.flatnonzero(good)]


def _matrix(raw: pa.Array | list[bytes], kind: str) -> np.ndarray:
    rows = raw if isinstance(raw, list) else raw.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def closest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids ** 2).sum(axis=1) - 2 * (x @ centroids.T)).argmin(axis=1)


def fit(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of one half: Lloyd's steps from the sample's first ``k`` distinct rows."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    _, first = np.unique(x, axis=0, return_index=True)
    c = x[np.sort(first)[:k]]
    for _ in range(ITERATIONS):
        own = closest(x, c)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def visit(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[int, float]]:
    """Cells by rising summed distance, that is by falling ``u[i] + v[j]``, from a heap."""
    a, b = np.argsort(-u, kind="stable").tolist(), np.argsort(-v, kind="stable").tolist()
    x, y, width = u[a].tolist(), v[b].tolist(), len(v)
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        s, i, j = heapq.heappop(heap)
        yield a[i] * width + b[j], -s
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


@dataclass
class Index:
    """What every task needs: both halves' centroids, the classes of each cell, where its shards are."""
    first: np.ndarray
    second: np.ndarray
    count: np.ndarray
    shard: np.ndarray   # first shard of a cell
    pieces: np.ndarray  # shards of a cell: more than one only if it alone is larger than a shard

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.first.shape[1]], x[:, self.first.shape[1]:]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return closest(a, self.first) * len(self.second) + closest(b, self.second)

    def nearness(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.halves(x)
        return a @ self.first.T, b @ self.second.T


def place_shards(count: np.ndarray, shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of cells of about ``shard_rows`` classes; a larger cell gets shards of its own."""
    pieces = np.maximum(1, -(-count // shard_rows))
    shard, now, held = np.zeros(len(count), np.int64), 0, 0
    for cell, (n, p) in enumerate(zip(count.tolist(), pieces.tolist())):
        if held and (p > 1 or held + n > shard_rows):
            now, held = now + 1, 0
        shard[cell] = now
        held += n
        if p > 1:
            now, held = now + p, 0
    return shard, pieces


def _classes(df: DataFrame, vec_id: str, vector: str, k: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """Distinct rows ``vec_id, vec`` and distinct vectors ``class, vec, ids``, both written."""
    def take(batches):
        for b in batches:
            at, found = finite_vectors(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array([x.astype(kind).tobytes() for x in found], pa.binary())], names=["vec_id", "vec"])

    rows = written(df.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(NULL_ID)).alias("vec_id"), F.col(vector).alias("vec"))
                   .mapInArrow(take, "vec_id long, vec binary").distinct(), "neighbour-rows")
    lengths = rows.groupBy(F.length("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.length("vec") == (lengths.size if lengths else 0))
    # A rank limit is applied in every task before the shuffle, so a vector of any number of rows sends few.
    few = rows.withColumn("place", F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return rows, written(classes.select(F.monotonically_increasing_id().alias("class"), "vec", "ids"), "neighbour-classes")


def _budget(spark, cells: DataFrame, index: Index, kind: str, k: int, recall: float, measured: int) -> int:
    """After how many classes the heap has reached the share ``recall`` of true neighbours."""
    picked = cells.orderBy(F.xxhash64("vec"), "class").limit(measured).select("class", "vec").toArrow()
    own, q = picked.column("class").to_numpy(), _matrix(picked.column("vec").to_pylist(), kind)

    def true(batches):
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int32))] * len(q)
        for b in batches:
            score = q @ _matrix(b.column(1), kind).T
            name, cell = b.column(0).to_numpy(), b.column(2).to_numpy()
            for i in range(len(q)):
                s, c, z = (np.concatenate(p) for p in zip(best[i], (score[i], name, cell)))
                s[c == own[i]] = -np.inf
                top = np.lexsort((c, -s))[:k]
                best[i] = s[top], c[top], z[top]
        n = [len(s) for s, _, _ in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(q)), n), pa.int32()), *(pa.array(np.concatenate(x)) for x in zip(*best))],
            names=["q", "score", "class", "cell"])

    def depth(batches):
        for b in batches:
            for i, cells_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                u, v = index.nearness(q[i:i + 1])
                want, met, out = set(cells_), 0, {}
                for cell, _ in visit(u[0], v[0]):
                    met += int(index.count[cell])
                    if cell in want:
                        out[cell] = met
                        if len(out) == len(want):
                            break
                yield pa.RecordBatch.from_arrays([pa.array([out[c] for c in cells_], pa.int64())], names=["depth"])

    # `measured` queries, `k` rows each a task; then `measured` rows in all.
    near = cells.select("class", "vec", "cell").mapInArrow(true, "q int, score double, class long, cell int").where(F.col("score") > F.lit(float("-inf")))
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "class"))
    lists = near.withColumn("place", rank).where(F.col("place") <= k).groupBy("q").agg(F.collect_list("cell").alias("cells"))
    depths = lists.repartition(max(1, spark.sparkContext.defaultParallelism), "q").mapInArrow(depth, "depth long")
    found = np.sort(depths.toArrow().column("depth").to_numpy())
    return int(found[min(len(found) - 1, int(np.ceil(recall * len(found))))]) if len(found) else 0


def search(df: DataFrame, query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.97,
           sample_rows: int = 20_000, measured: int = 256, shard_rows: int = 8192, block: int = 256) -> DataFrame:
    """The ``k`` rows of largest inner product for every row that ``query`` (over its id)
    holds for: ``query_id, rank, vec_id, score``, nearest first."""
    spark = df.sparkSession
    ready(spark)
    element = df.schema[vector].dataType
    kind = "<f4" if isinstance(element, ArrayType) and isinstance(element.elementType, FloatType) else "<f8"
    rows, classes = _classes(df, vec_id, vector, k, kind)

    n = classes.count()
    picked = classes.orderBy(F.xxhash64("vec"), "class").limit(sample_rows).select("vec").toArrow().column("vec").to_pylist()
    if not picked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = _matrix(picked, kind)
    centroids = int(min(MAX_CENTROIDS, max(4, 2 ** round(np.log2(max(1.0, np.sqrt(n / 8)))))))
    half = max(1, x.shape[1] // 2)
    index = Index(fit(x[:, :half], centroids), fit(x[:, half:], centroids), np.zeros(0), np.zeros(0), np.zeros(0))

    def locate(batches):
        for b in batches:
            if b.num_rows:
                cell = index.cells(_matrix(b.column(1), kind)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

    cells = written(classes.mapInArrow(locate, "class long, vec binary, ids array<long>, cell int"), "neighbour-cells")
    index.count = np.zeros(len(index.first) * len(index.second), np.int64)
    for r in cells.groupBy("cell").count().collect():  # at most MAX_CENTROIDS ** 2 rows
        index.count[r["cell"]] = r["count"]
    index.shard, index.pieces = place_shards(index.count, shard_rows)
    budget = max(_budget(spark, cells, index, kind, k, recall, measured), 2 * (k + 1))
    shared = spark.sparkContext.broadcast(index)

    # Queries with the class that answers them; a class is asked once, however many rows ask it.
    asked = written(rows.where((F.col("vec_id") != NULL_ID) & query).join(cells.select("vec", "class", "cell").hint("merge"), "vec")
                    .select("vec_id", "class", "cell", "vec"), "neighbour-asked")
    once = asked.groupBy("class").agg(F.min("cell").alias("cell"), F.min("vec").alias("vec"))

    def probe(batches):
        def sent(ids, vecs):
            at = shared.value
            u, v = at.nearness(_matrix(vecs, kind))
            limit, touched = np.empty(len(ids)), set()
            for i in range(len(ids)):
                met, last = 0, None
                for cell, s in visit(u[i], v[i]):
                    if last is not None and s < last:
                        break
                    met += int(at.count[cell])
                    if at.count[cell]:
                        touched.add(cell)
                    if met >= budget and last is None:
                        last = s - NEAR * (np.abs(u[i]).max() + np.abs(v[i]).max())
                limit[i] = -np.inf if last is None else last
            shards = sorted({s for c in touched for s in range(int(at.shard[c]), int(at.shard[c] + at.pieces[c]))})
            return pa.RecordBatch.from_pydict({
                "shard": pa.array(shards, pa.int64()), "asks": pa.array([np.array(ids, "<i8").tobytes()] * len(shards), pa.binary()),
                "limits": pa.array([limit.tobytes()] * len(shards), pa.binary()),
                "queries": pa.array([b"".join(vecs)] * len(shards), pa.binary())})

        ids, vecs = [], []
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                vecs.append(x)
                if len(ids) == block:
                    yield sent(ids, vecs)
                    ids, vecs = [], []
        if ids:
            yield sent(ids, vecs)

    probes = (once.repartitionByRange(owners_of(spark), "cell").sortWithinPartitions("cell", "class").select("class", "vec")
              .mapInArrow(probe, "shard long, asks binary, limits binary, queries binary"))

    def deal(batches):
        for b in batches:
            at, cell = shared.value, b.column(3).to_numpy()
            piece = mix(b.column(0).to_numpy().astype(U64)) % at.pieces[cell].astype(U64) if b.num_rows else cell
            yield pa.RecordBatch.from_arrays([pa.array(at.shard[cell] + piece.astype(np.int64)), *b.columns], names=["shard", *b.schema.names])

    def pack(key, part):
        part = part.sort_by("class")
        ids = part.column("ids").combine_chunks()
        join = lambda c: b"".join(part.column(c).to_pylist())
        raw = lambda a, t: np.asarray(a).astype(t).tobytes()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "cells": [raw(part.column("cell").to_numpy(), "<i4")],
                         "sizes": [raw(pc.list_value_length(ids).to_numpy(), "<i4")], "ids": [raw(pc.list_flatten(ids).to_numpy(), "<i8")],
                         "vecs": [join("vec")]})

    shards = (cells.mapInArrow(deal, "shard long, class long, vec binary, ids array<long>, cell int")
              .groupBy("shard").applyInArrow(pack, "shard long, cells binary, sizes binary, ids binary, vecs binary"))

    def rank(batches):
        for b in batches:
            for r in b.to_pylist():
                yield from _best(shared.value, r, kind, k)

    met = probes.join(shards.hint("merge"), "shard")
    best = met.mapInArrow(rank, "class long, found array<struct<score: double, vec_id: long>>")
    places = W.partitionBy("class").orderBy(F.desc("f.score"), "f.vec_id")
    top = (best.select("class", F.explode("found").alias("f")).withColumn("place", F.row_number().over(places))
           .where(F.col("place") <= k + 1)  # one more than asked for: the query's own id may be among them
           .groupBy("class").agg(F.sort_array(F.collect_list(F.struct("place", "f.vec_id", "f.score"))).alias("found")))
    top = written(top, "neighbour-found")
    shared.destroy()
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return (asked.select(F.col("vec_id").alias("query_id"), "class").join(top.hint("merge"), "class")
            .select("query_id", F.posexplode(others).alias("at", "f"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.nullif("f.vec_id", F.lit(NULL_ID)).alias("vec_id"), F.col("f.score").alias("score")))


def _best(index: Index, row: dict, kind: str, k: int) -> Iterator[pa.RecordBatch]:
    """For a block of queries and a shard: each query's ``k + 1`` best ids of the cells it visits."""
    asks, limit = np.frombuffer(row["asks"], "<i8"), np.frombuffer(row["limits"], "<f8")
    cell, size = np.frombuffer(row["cells"], "<i4"), np.frombuffer(row["sizes"], "<i4")
    ids = np.frombuffer(row["ids"], "<i8")
    q = np.frombuffer(row["queries"], kind).reshape(len(asks), -1).astype(np.float64)
    x = np.frombuffer(row["vecs"], kind).reshape(len(cell), -1).astype(np.float64)
    start = np.cumsum(size) - size
    u, v = index.nearness(q)
    width = len(index.second)
    score = q @ x.T
    score[(u[:, cell // width] + v[:, cell % width]) < limit[:, None]] = -np.inf
    if score.shape[1] > k + 1:
        edge = np.partition(score, -(k + 1), axis=1)[:, -(k + 1)]
        edge = edge - NEAR * np.abs(q).sum(axis=1) * np.abs(x).max()
    else:
        edge = np.full(len(q), -np.inf)
    i, j = np.nonzero((score >= edge[:, None]) & (score > -np.inf))
    exact = in_order(q[i], x[j])
    cut = np.searchsorted(i, np.arange(len(q) + 1))
    names, found = [], []
    for a in range(len(q)):
        lo, hi = cut[a], cut[a + 1]
        if lo == hi:
            continue
        every = np.concatenate([ids[start[c]:start[c] + size[c]] for c in j[lo:hi]])
        scores = np.repeat(exact[lo:hi], size[j[lo:hi]])
        top = np.lexsort((every, -scores))[:k + 1]
        names.append(int(asks[a]))
        found.append([{"score": float(scores[t]), "vec_id": int(every[t])} for t in top])
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(found, pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])))],
        names=["class", "found"])
