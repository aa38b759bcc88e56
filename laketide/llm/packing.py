"""Mixture-controlled packing of documents into sequences of tokens.

Every source is a queue of tokens (its documents in table order, each ended by
an end id). Windows of ``window_sequences`` sequences are filled by deficit
round-robin: in each window every queue is owed its share of the target
proportions; it serves whole tokens, and what it is still owed (a fraction of
a token) is carried to the next window. After window t a queue has served
``floor(t * share)`` tokens, so the state of the rounds is known at any t
without running the earlier ones. That makes the rounds parallel: a document
needs only its place in its queue (token totals of the partitions before it,
a sum over one row per partition and queue) to know its windows, sequences
and offsets. Deficits thus carry across partitions as well as windows.

Targets. By default a queue's share is its share of all tokens, so all
queues end together and every window has the corpus mixture. With ``targets``
(weights by source) queues run dry at different times; from then on the
remaining ones share the window by their weights. Every token is packed once.
All sequences are full but the last.

Every source named in ``targets`` has a queue of its own, and so have the ``max_queues``
sources with most text (bytes and end ids; their tokens are not known before they are packed).
All smaller ones share one more queue, in table order: the windows hold the share of all of
them, not of each. That bounds what is collected and broadcast: a row per queue. A target for
a source without documents is an error.

Defined cases. Null and empty texts are documents of one token, the end id. A
null source is a source of its own. Null and repeated ids and repeated rows are
packed row by row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laketide.llm import tokens
from laketide.llm.common import NULL_ID, ready, real_id, slices, written

END_ID = 1
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "source string, window_id long")


def token_table(docs: DataFrame, doc_id: str, text: str, source: str, max_queues: int,
                tokenizer: str | None, named: list[str | None]) -> tuple[DataFrame, list[str]]:
    """Token ids of every row, written once. ``part``, ``queue`` and ``ahead``
    (tokens of the queue before the row within its part) fix the order."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.col(text).cast("string").alias("text"), F.col(source).cast("string").alias("source"))
    size = F.sum(1 + F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")
    asked = F.exists(F.array(*[F.lit(n).cast("string") for n in named]), lambda n: n.eqNullSafe(F.col("source"))) if named else F.lit(False)
    sources = rows.groupBy("source").agg(size).withColumn("asked", asked)
    order = F.desc("bytes"), F.asc_nulls_first("source")
    largest = [r["source"] for r in sources.orderBy(F.desc("asked"), *order).limit(max(max_queues, len(named))).collect()]
    if largest and (missing := [n for n in named if n not in largest]):
        raise ValueError(f"targets of sources without documents: {missing}")
    lookup = docs.sparkSession.createDataFrame([(n, i) for i, n in enumerate(largest)], "q_source string, q int")
    rows = (rows.join(F.broadcast(lookup), F.col("source").eqNullSafe(F.col("q_source")), "left")
            .select("doc_id", "text", "source", F.coalesce("q", F.lit(len(largest))).alias("queue")))

    def encode(batches):
        vocabulary = tokens.loaded(tokenizer)
        size = vocabulary.kind.itemsize
        end = np.array([END_ID], vocabulary.kind).tobytes()
        ahead: dict[int, int] = {}
        for whole in batches:
            for b in slices(whole):
                ids = [vocabulary.encode(t or "") + end for t in b.column(1).to_pylist()]
                lengths = [len(x) // size for x in ids]
                before = []
                for q, n in zip(b.column(3).to_pylist(), lengths):
                    before.append(ahead.get(q, 0))
                    ahead[q] = before[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), b.column(3), pa.array(before, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array([size] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "source", "queue", "ahead", "n", "size", "ids"])

    return written(rows.mapInArrow(encode, "doc_id long, source string, queue int, ahead long, n long, size int, "
                                           "ids binary")
                   .select(F.spark_partition_id().alias("part"), "*"), "packing-tokens"), largest


class Rounds:
    """The deficit round-robin over queues of ``totals`` tokens with ``weights``, in closed form."""

    def __init__(self, totals: list[int], weights: list[Fraction], window: int):
        empties = [Fraction(n) / w for n, w in zip(totals, weights)]  # when each queue runs dry
        self.window, self.phases = window, []
        served, base, first = [0] * len(totals), 0, 0
        for end in sorted(set(empties)):
            upto = [n if e <= end else int(w * end) for n, w, e in zip(totals, weights, empties)]
            owed = [b - a for a, b in zip(served, upto)]
            if sum(owed):
                windows = -(-sum(owed) // window)
                self.phases.append((served, owed, windows, base, first))
                base, first, served = base + sum(owed), first + windows, upto
        self.served = lru_cache(256)(self._served)

    def _served(self, phase: int, t: int) -> list[int]:
        """Tokens of each queue before round ``t`` of a phase."""
        _, owed, windows, _, _ = self.phases[phase]
        return [n * t // windows for n in owed]

    def places(self, queue: int, at: int, n: int, size: int):
        """Yields (first token, tokens, window, global place) of the pieces of
        tokens ``at .. at + n`` of a queue, cut at windows and sequences."""
        end = at + n
        for phase, (start, owed, windows, base, first) in enumerate(self.phases):
            while start[queue] <= at < min(end, start[queue] + owed[queue]):
                x = at - start[queue]
                t = ((x + 1) * windows - 1) // owed[queue]
                before, after = self.served(phase, t), self.served(phase, t + 1)
                place = (base + sum(before) + sum(after[:queue]) - sum(before[:queue]) + x - before[queue])
                stop = min(end, start[queue] + after[queue])
                while at < stop:
                    k = min(stop - at, size - place % size)
                    yield at, k, first + t, place
                    at, place = at + k, place + k


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         size: int = 2048, window_sequences: int = 64, targets: dict[str, float] | None = None,
         max_queues: int = 256, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source, window_id``. ``tokenizer``: path of a
    byte-level BPE vocabulary file on every worker."""
    ready(docs.sparkSession)
    table, names = token_table(docs, doc_id, text, source, max_queues, tokenizer, list(targets or {}))
    parts = table.groupBy("part", "queue").agg(F.sum("n").alias("tokens"))
    order = W.partitionBy("queue").orderBy("part")
    before = written(parts.select("part", "queue", "tokens",
                                  (F.sum("tokens").over(order) - F.col("tokens")).alias("base")), "packing-offsets")
    totals = {r["queue"]: r["t"] for r in before.groupBy("queue").agg(F.sum("tokens").alias("t")).collect()}
    queues = len(names) + 1
    counts = [totals.get(q, 0) for q in range(queues)]
    every = sum(counts)
    asked = targets or {}
    weights = [Fraction(asked[n]).limit_denominator(10**6) if (n := names[q] if q < len(names) else None) in asked
               else Fraction(max(counts[q], 1), max(every, 1)) for q in range(queues)]
    if any(w <= 0 for w in weights):
        raise ValueError("target weights must be positive")
    rounds = (counts, weights, size * window_sequences)

    def place(batches):
        drr = Rounds(*rounds)
        for whole in batches:
            for b in slices(whole, "ids"):
                out = []
                for at, q, d, src, n, width, ids in zip(*(c.to_pylist() for c in b.columns)):
                    x = np.frombuffer(ids, f"<u{width}").astype("<u4")
                    for a, k, window, g in drr.places(q, at, n, size):
                        a -= at
                        out.append((d, a, k, zlib.crc32(x[a:a + k].tobytes()), n, g // size, g % size, src, window))
                cols = list(zip(*out)) or [[]] * 9
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if i == 7 else pa.int64()) for i, c in enumerate(cols)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                           "source", "window_id"])

    rows = (table.join(before.select("part", "queue", "base"), ["part", "queue"])
            .select((F.col("base") + F.col("ahead")).alias("at"), "queue", "doc_id", "source", "n", "size", "ids"))
    return rows.mapInArrow(place, PIECES).select(real_id(), *[c.split()[0] for c in PIECES.split(", ")[1:]])
