"""Benchmark decontamination by suffix arrays over the training text.

The documents are cut into shards (parts of a scan). In each shard the words'
suffixes are sorted into a suffix array, and every suffix of every benchmark
item is looked up in it by binary search. A look-up gives the range of shard
positions where the item's words stand, so the longest verbatim matches and
their places follow from neighbouring look-ups. The array is sparse: a suffix
whose first words open no benchmark suffix can never be found and is left out.

The benchmark is taken in blocks of at most ``block_words`` words, each
broadcast by itself; between blocks the documents' state is written to the
shared folder. A document never leaves its task, so nothing is shuffled and a
passage that many documents share costs only its own occurrences.

Defined cases. Null or empty text has no words. An item without text or
words matches nothing. An item without an id counts like others (in ``n_hit`` and ``n_items``); all of
them are one, and a list of ids does not show it. Ties: every item whose window stands at a place
is listed there. Rows are judged one by one, repeated ids included. Empty
tables: no documents give no rows, no benchmark gives clean rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from laketide.llm.common import ALNUM, LOWER, U64, find_words, ready, slices, text_buffer, word_hashes, written

BITS = 20          # bits of a word's number: a block has fewer than 2**20 distinct words
GROUP = 3          # words packed into one 64-bit number
FOUND = ("items array<string>, runs array<struct<s:int,e:int>>, "
         "matches array<struct<item_id:string,item_start:int,doc_start:int,length:int>>")
MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()),
                   ("length", pa.int32())])
RUN = pa.struct([("s", pa.int32()), ("e", pa.int32())])


def _tokens(texts: list[str]):
    off, data = text_buffer(pa.array(texts, pa.string()))
    data = LOWER[data]
    starts, ends, first = find_words(off, data, ALNUM)
    return data, starts, ends, first


def _packed(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` word numbers from each position, as fixed byte strings whose
    order is the words' order."""
    groups = -(-width // GROUP)
    padded = np.concatenate([ids, np.zeros(groups * GROUP, np.int64)]).astype(U64)
    cols = np.zeros((len(at), groups), U64)
    for j in range(width):
        cols[:, j // GROUP] |= padded[at + j] << U64(BITS * (GROUP - 1 - j % GROUP))
    return cols


def _strings(cols: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(cols.astype(">u8")).view(f"S{8 * cols.shape[1]}").ravel()


class TestBlock:
    """A block of benchmark items, ready to be looked up (plain arrays, broadcast)."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int):
        data, starts, ends, first = _tokens([t for _, t in items])
        words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        self.vocabulary = sorted(set(words))
        if len(self.vocabulary) + 1 >= 1 << BITS:
            raise ValueError("block_words is too large")
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        flat = np.array([number[w] for w in words], np.int64)
        v_data = np.frombuffer(b"".join(self.vocabulary), np.uint8)
        v_ends = np.cumsum([len(w) for w in self.vocabulary], dtype=np.int64)
        v_hash = word_hashes(v_data, np.concatenate([[0], v_ends[:-1]]).astype(np.int64), v_ends) \
            if words else np.zeros(0, U64)
        order = np.argsort(v_hash)
        self.hashes, self.numbers = v_hash[order], order + 1
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(v_hash & U64((1 << 20) - 1)).astype(np.int64)] = True
        self.item_ids = [i for i, _ in items]
        length = np.diff(first)
        width = np.minimum(length, window)
        # Every window of every item: an item shorter than a window is one window.
        item = np.repeat(np.arange(len(items)), np.where(length > 0, length - width + 1, 0))
        begin = np.concatenate([np.arange(a, a + n - w + 1) for a, n, w in zip(first, length, width) if n] or
                               [np.zeros(0, np.int64)]).astype(np.int64)
        self.item, self.item_start, self.width = item, begin - first[item], width[item]
        self.window = window
        # Search keys: the window's words, then the smallest and the largest continuation.
        low = np.zeros((len(begin), -(-window // GROUP)), U64)
        high = np.zeros_like(low)
        ids = np.concatenate([flat, np.zeros(window, np.int64)])
        for j in range(window):
            shift = U64(BITS * (GROUP - 1 - j % GROUP))
            inside = j < self.width
            w = np.where(inside, ids[begin + j], 0).astype(U64)
            low[:, j // GROUP] |= w << shift
            high[:, j // GROUP] |= np.where(inside, w, U64((1 << BITS) - 1)) << shift
        self.low, self.high = _strings(low), _strings(high)
        self.depth = int(min(GROUP, self.width.min())) if len(begin) else 0
        heads = _packed(flat, begin, self.depth)[:, 0] if self.depth else np.zeros(0, U64)
        self.heads = np.unique(heads)

    def word_numbers(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary numbers by hash; 0 for other words."""
        out = np.zeros(len(h), np.int64)
        at = np.flatnonzero(self.sieve[(h & U64((1 << 20) - 1)).astype(np.int64)])
        near = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[near] == h[at]
        out[at[same]] = self.numbers[near[same]]
        return out

    def look_up(self, ids: np.ndarray):
        """Hits of all windows in a shard's padded word numbers: (window, position)."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.depth or not len(ids):
            return none
        known = np.concatenate([ids > 0, np.zeros(GROUP, bool)])
        opens = known[:len(ids)].copy()
        for j in range(1, self.depth):
            opens &= known[j:len(ids) + j]
        at = np.flatnonzero(opens)
        head = _packed(ids, at, self.depth)[:, 0]
        near = np.minimum(np.searchsorted(self.heads, head), len(self.heads) - 1)
        at = at[self.heads[near] == head]
        if not len(at):
            return none
        keys = _packed(ids, at, self.window)
        order = np.lexsort(tuple(keys[:, g] for g in range(keys.shape[1] - 1, -1, -1)))
        suffixes, keys = at[order], _strings(keys[order])
        lo = np.searchsorted(keys, self.low, side="left")
        hi = np.searchsorted(keys, self.high, side="right")
        n = hi - lo
        found = np.repeat(np.arange(len(lo)), n)
        ranks = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return found, suffixes[ranks]


def _runs(cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], cover.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _judge(batch: pa.RecordBatch, block: TestBlock) -> pa.RecordBatch:
    off, data = text_buffer(batch.column(1))
    data = LOWER[data]
    starts, ends, first = find_words(off, data, ALNUM)
    docs, n_words = batch.num_rows, np.diff(first)
    doc = np.repeat(np.arange(docs), n_words)
    place = np.arange(len(starts)) + doc           # one gap after each document
    size = len(starts) + docs
    ids = np.zeros(size, np.int64)
    ids[place] = block.word_numbers(word_hashes(data, starts, ends))
    word_at = np.full(size, -1)
    word_at[place] = np.arange(len(starts))
    while True:
        window, at = block.look_up(ids)
        depth = np.zeros(size + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + block.width[window], -1)
        cover = np.cumsum(depth)[:size] > 0
        # Verbatim: the words' bytes decide, not their hashes.
        wrong = [p for p in np.flatnonzero(cover)
                 if data[starts[word_at[p]]:ends[word_at[p]]].tobytes() != block.vocabulary[ids[p] - 1]]
        if not wrong:
            break
        ids[wrong] = 0
    doc_at = np.zeros(size, np.int64)
    doc_at[place] = doc
    begin = first[:-1] + np.arange(docs)           # padded place of each document's first word

    runs_before, items_before = batch.column(5).to_pylist(), batch.column(4).to_pylist()
    matches_before = batch.column(6).to_pylist()
    for d, rs in enumerate(runs_before):
        for r in rs or ():
            cover[begin[d] + r["s"]:begin[d] + r["e"]] = True
    items = [set(x or ()) for x in items_before]
    matches = [list(x or ()) for x in matches_before]
    # Neighbouring windows of one item on one diagonal are one longer match.
    hit_doc, item = doc_at[at], block.item[window]
    diagonal = at - block.item_start[window]
    order = np.lexsort((at, diagonal, item, hit_doc))
    hit_doc, item, diagonal, at, window = (x[order] for x in (hit_doc, item, diagonal, at, window))
    new = np.ones(len(at), bool)
    new[1:] = ((hit_doc[1:] != hit_doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])
               | (at[1:] != at[:-1] + 1))
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    for a, b in zip(heads, tails):
        d = hit_doc[a]
        items[d].add(block.item_ids[item[a]])
        matches[d].append({"item_id": block.item_ids[item[a]], "item_start": int(block.item_start[window[a]]),
                           "doc_start": int(at[a] - begin[d]),
                           "length": int(at[b] - at[a] + block.width[window[b]])})
    s, e = _runs(cover)
    run_doc = doc_at[s] if len(s) else np.zeros(0, np.int64)
    run_off = np.searchsorted(run_doc, np.arange(docs + 1)).astype(np.int32)
    runs = pa.ListArray.from_arrays(run_off, pa.StructArray.from_arrays(
        [pa.array(s - begin[run_doc], pa.int32()), pa.array(e - begin[run_doc], pa.int32())], fields=list(RUN)))
    hits = np.zeros(docs, np.int64)
    np.add.at(hits, run_doc, e - s)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(n_words.astype(np.int64)), pa.array(hits),
         pa.array([sorted(x, key=lambda i: (i is None, i)) for x in items], pa.list_(pa.string())), runs,
         pa.array(matches, pa.list_(MATCH))],
        names=["row", "text", "n_words", "n_hit", "items", "runs", "matches"])


def _blocks(bench: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark's items, streamed to the driver one bounded block at a time."""
    block, words = [], 0
    rows = bench.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")) \
        .where("t IS NOT NULL")
    for r in rows.toLocalIterator():
        n = len(r.t) // 2 + 1                      # no text has more words
        if block and words + n > block_words:
            yield block
            block, words = [], 0
        block.append((r.i, r.t))
        words += n
    yield block


def contamination(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, block_words: int = 500_000) -> DataFrame:
    """Every row of ``docs`` as it is (struct ``row``) with ``n_words, n_hit,
    items`` (ids with an occurring window), ``runs`` (covered word ranges) and
    ``matches`` (maximal verbatim matches of at least a window, with their
    places in item and document)."""
    spark = docs.sparkSession
    ready(spark)
    kinds = [k.split(" ", 1) for k in FOUND.split(", ")]
    state = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"),
                        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                        *[F.expr(f"CAST(array() AS {kind})").alias(name) for name, kind in kinds])
    schema = StructType([StructField("row", docs.schema), *state.drop("row").schema.fields])
    for i, items in enumerate(_blocks(bench, item_id, item_text, block_words)):
        if i:
            state = written(state, "decontaminate")
        block = spark.sparkContext.broadcast(TestBlock(items, window))

        def judge(batches, block=block):
            for b in batches:
                for part in slices(b):
                    yield _judge(part, block.value)

        state = state.mapInArrow(judge, schema)
    return state.drop("text")


def contaminated_report(docs: DataFrame, bench: DataFrame, **kw) -> DataFrame:
    """Per row: ``contamination`` with its items as a digest."""
    return contamination(docs.select("doc_id", "text"), bench, **kw).select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, bench: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no benchmark window."""
    return contamination(docs, bench, **kw).where("n_hit = 0").select("row.*")
