"""Repeated word sequences, found by fixed-block anchors.

A window of ``window`` words that stands at two places contains, at the first
of them, a whole block of ``window // 2`` words that begins at a multiple of
that length. So:

1. Index and probe. Every document's non-overlapping blocks are the index and
   each of its rolling block-length windows is a probe. Both go to owners
   (hash ranges) as packed 32-bit keys and positions, about 5.5 bytes a word.
   An owner sorts its keys and reports every block that occurs again elsewhere
   (packed, to one of as many buckets of documents).
   Keys may collide; that only adds blocks to look at. So do the ids used here:
   rows that repeat an id look at each other's blocks, and a null id is replaced
   by a hash of its text.
2. Extend. A window can be repeated only if all whole blocks inside it were
   reported: the other place's probes meet them. Rows with reported blocks
   are written with a row number, and the blocks extended to these windows. They go to owners again with 80 bits of hash beyond the
   owner's share, and each sequence's first place (smallest
   doc_id, then start) is the one that stays. Neighbouring repeated windows
   join into maximal repeated spans, which are removed.

An owner's load is a range of hashes, never one document or one passage; a
passage that a third of all documents share is one key, whose places are
sorted and passed once. Nothing compares pairs of places. Owners are as many
as ``spark.sql.shuffle.partitions``.

Defined cases. Null text has no words. Documents shorter than a window stay
whole. A null ``doc_id`` sorts last; such rows are documents of their own, one
before the other. Rows that repeat a ``doc_id`` are one document: equal places
are not earlier than each other, and each row loses the words of its own text
only. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import (NON_WHITE, NULL_ID, U64, documents, find_words, mix, owners_of, ready, real_id,
                                 rolling, slices, text_buffer, word_hashes, written)
from laketide.llm.exchange import PLACES, deal_places, gather_places, pack, shrink, text_column, unpack

RESULT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
          "spans array<struct<start:int,end:int>>")
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SECOND = U64(0x5851F42D4C957F2D)


def _positions(places: bytes | None) -> np.ndarray:
    return np.frombuffer(places or b"", "<u4").astype(np.int64)


class _Words:
    """Words of a batch's texts and the places where a window may begin."""

    def __init__(self, batch: pa.RecordBatch):
        self.off, self.data = text_buffer(text_column(batch.column(1)))
        self.starts, self.ends, self.first = find_words(self.off, self.data, NON_WHITE)
        self.ids = batch.column(0).to_numpy()

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def valid(self, k: int, of: int):
        """Word places where ``k`` words follow within a text of at least ``of`` words; their texts and positions."""
        n = np.diff(self.first)
        room = np.where(n >= max(k, of), n - k + 1, 0)
        doc = np.repeat(np.arange(len(n)), room)
        pos = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        return self.first[doc] + pos, doc, pos


def repeated_windows(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(plain, suspect): the final rows of documents without a repeated block, and
    the others with their removable window starts in ``cut`` (packed positions)."""
    spark = docs.sparkSession
    owners, block = owners_of(spark), window // 2
    # The id that blocks meet by: shared by rows of one id, and of null ids by equal texts.
    docs = docs.select(F.when(F.col("doc_id") == NULL_ID, F.xxhash64("text")).otherwise(F.col("doc_id")).alias("block_id"),
                       "text", "doc_id")

    def probe(batches):
        for whole in batches:
            for batch in slices(whole):
                w = _Words(batch)
                at, doc, pos = w.valid(block, window)
                if not len(at):
                    continue
                h = rolling(w.hashes(), block)[at]
                owner = ((h >> U64(32)) % U64(owners)).astype(np.int64)
                rows = pack(owner, owners, doc, pos, w.ids, [h.astype("<u4")])
                yield pa.RecordBatch.from_arrays([pa.array([o for o, _ in rows], pa.int32()),
                                                  pa.array([p for _, p in rows], pa.binary())],
                                                 names=["owner", "payload"])

    def hits(key, rows):
        doc, pos, (keys,), _ = unpack(rows.column("payload").to_pylist(), ["<u4"])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        group = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0) if len(keys) else keys
        size = np.bincount(group)
        blocks = np.bincount(group, weights=(pos[order] % block == 0))
        keep = order[((size > 1) & (blocks > 0))[group]]
        keep = keep[pos[keep] % block == 0]
        return deal_places(doc[keep], pos[keep], owners)

    anchors = (docs.select("block_id", "text").mapInArrow(probe, "owner int, payload binary").groupBy("owner")
               .applyInArrow(hits, PLACES).groupBy("bucket").applyInArrow(gather_places, "doc_id long, places binary")
               .select(F.col("doc_id").alias("block_id"), F.col("places").alias("anchors")))
    # Documents meet their anchors once: those with none are settled there, and
    # only the others' texts are kept for the next step.
    texts = docs.mapInArrow(shrink, "block_id long, text binary, doc_id long")
    met = written(texts.join(anchors.hint("merge"), "block_id", "left").select("doc_id", "text", "anchors")
                  .mapInArrow(_settle, f"{RESULT}, text binary, anchors binary")
                  .select("*", F.monotonically_increasing_id().alias("row_id")), "substring-anchors")
    suspects = met.where("anchors IS NOT NULL").select("row_id", "text", "anchors", "doc_id")

    def extend(batches):
        for whole in batches:
            for batch in slices(whole):
                w = _Words(batch)
                marked = np.zeros(len(w.starts) + 1, bool)
                n = np.diff(w.first)
                for d, parts in enumerate(batch.column(2).to_pylist()):
                    p = _positions(parts)
                    marked[w.first[d] + p[p < n[d]]] = True
                at, doc, pos = w.valid(window, window)
                if not len(at):
                    continue
                # Every whole block inside a repeated window is met by the other place's probes.
                lead = -pos % block
                near = marked[at + lead]
                more = lead + 2 * block <= window
                near[more] &= marked[at[more] + lead[more] + block]
                at, doc, pos = at[near], doc[near], pos[near]
                words = w.hashes()
                h = rolling(words, window)[at]
                second = rolling(mix(words + SECOND), window, 0xD1B54A32D192ED03)[at]
                owner = (second >> U64(32)) % U64(owners)
                rows = pack(owner.astype(np.int64), owners, doc, pos, w.ids,
                            [h.astype("<u8"), second.astype("<u2")], (batch.column(3).to_numpy(),))
                yield pa.RecordBatch.from_arrays([pa.array([o for o, _ in rows], pa.int32()),
                                                  pa.array([p for _, p in rows], pa.binary())],
                                                 names=["owner", "payload"])

    def later(key, rows):
        row, pos, (h, second), (doc,) = unpack(rows.column("payload").to_pylist(), ["<u8", "<u2"], 1)
        own = np.where(doc == NULL_ID, row, 0)     # rows without an id are documents of their own
        order = np.lexsort((pos, own, doc, second, h))
        row, doc, own, pos, h, second = (x[order] for x in (row, doc, own, pos, h, second))
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (second[1:] != second[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        cut = (doc != doc[head]) | (own != own[head]) | (pos != pos[head])
        return deal_places(row[cut], pos[cut], owners)

    cuts = (suspects.mapInArrow(extend, "owner int, payload binary").groupBy("owner")
            .applyInArrow(later, PLACES).groupBy("bucket").applyInArrow(gather_places, "doc_id long, places binary")
            .select(F.col("doc_id").alias("row_id"), F.col("places").alias("cut")))
    plain = met.where("anchors IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")
    return plain, suspects.select("row_id", "text", "doc_id").join(cuts, "row_id", "left")


def _settle(batches):
    """Final rows of documents without an anchor; the others pass with their text."""
    for whole in batches:
        for batch in slices(whole):
            w = _Words(batch)
            raw = w.data.tobytes()
            parts = batch.column(2).to_pylist()
            digests = [None if p is not None else hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest()
                       for p, a, b in zip(parts, w.off[:-1].tolist(), w.off[1:].tolist())]
            rows = batch.num_rows
            keep = pa.array([p is not None for p in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(w.first).astype(np.int64)), pa.array(np.zeros(rows, np.int64)),
                 pa.array(digests, pa.string()), pa.array([[]] * rows, SPANS),
                 pc.if_else(keep, batch.column(1), pa.scalar(None, batch.column(1).type)), batch.column(2)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "text", "anchors"])


def _finish(window: int):
    """Per document: words, removed words, the digest of the kept ones, the removed spans."""

    def finish(batches):
        for whole in batches:
            for batch in slices(whole):
                w = _Words(batch)
                n = np.diff(w.first)
                raw, starts, ends = w.data.tobytes(), w.starts, w.ends
                removed, digests, spans = [], [], []
                cuts = batch.column(2).to_pylist()
                for d in range(batch.num_rows):
                    a = w.first[d]
                    p = _positions(cuts[d])
                    p = np.unique(p[p + window <= n[d]])
                    depth = np.zeros(n[d] + 1, np.int64)
                    depth[p] += 1
                    np.subtract.at(depth, p + window, 1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                    removed.append(int(gone.sum()))
                    keep = np.flatnonzero(~gone) + a
                    kept = b" ".join([raw[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist())])
                    digests.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n.astype(np.int64)), pa.array(removed, pa.int64()),
                     pa.array(digests, pa.string()), pa.array(spans, SPANS)],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    return finish


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256`` and ``spans``, the
    maximal removed word ranges (end exclusive)."""
    if window < 2:
        raise ValueError("window must be 2 words or more")
    ready(docs.sparkSession)
    plain, suspect = repeated_windows(documents(docs, doc_id, text), window)
    return (suspect.select("doc_id", "text", "cut").mapInArrow(_finish(window), RESULT).unionByName(plain)
            .select(real_id(), "n_words", "n_removed", "kept_sha256", "spans"))
