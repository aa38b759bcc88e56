"""Language identification by prediction by partial matching (PPM).

Per language, a tree of byte contexts up to ``order`` bytes holds how often
each next byte followed. A byte is coded at the longest context that exists:
with probability count / (n + d) where it was seen there (n occurrences, d
distinct next bytes), else an escape of d / (n + d) and the shorter context,
without the bytes already ruled out (method C with exclusion). Below the empty
context every byte is equally likely. Each context's probabilities add up to
one, so code lengths are exact. A text's language is the one whose frozen
tree codes the whole text in the fewest bits.

Learning uses a bounded sample: per language at most ``sample_rows`` rows, in
the order of a hash of the id, and of these whole texts up to ``sample_bytes``
in all. Spark counts the contexts; at most ``max_contexts`` contexts (the most
frequent, shorter ones first) make the tree, which bounds what is collected
and broadcast. The trees are then laid out as two arrays, child[context, byte]
and bits[context, byte, language], so that scoring is a few array look-ups a
byte over whole Arrow buffers. Scoring is a map: no shuffle.

Defined cases. A text that is null or has no letter is ``und`` with score 0.
With no labelled row every text is ``und``. Ties go to the language that sorts
first. Rows are judged one by one; only id, text and (for learning) language
are read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laketide.llm.common import LOWER, documents, ready, real_id, slices, text_buffer, written



def has_letter(text: str | None) -> bool:
    """A character of Unicode's category L: no digit, mark, fraction or letter-like number."""
    return text is not None and next(filter(str.isalpha, text), None) is not None


SALTS = 64


def sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label at most (``SALTS`` equal shares, by
    hashes of the id): ``doc_id, label, rank``. Bounded and repeatable. The
    shares are ranked apart, so a label that holds most rows is not one task."""
    salt = F.pmod(F.xxhash64("doc_id", F.lit("share")), F.lit(SALTS)).alias("salt")
    order = W.partitionBy("label", "salt").orderBy(F.xxhash64("doc_id"), "doc_id")
    return (rows.select("doc_id", F.col(label).alias("label"), salt).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= -(-per_label // SALTS))
            .select("doc_id", "label", (F.col("rank") * SALTS + F.col("salt")).alias("rank")))


def count_contexts(sampled: DataFrame, order: int, max_contexts: int, sample_bytes: int):
    """Counts of (context, next byte) by language: rows (label, gram, count) of the kept contexts."""

    def grams(batches):
        for b in batches:
            labels = np.array(b.column(0).to_pylist(), object)
            off, data = text_buffer(b.column(1))
            data = LOWER[data]
            for label in sorted(set(labels)):
                parts = [data[off[i]:off[i + 1]] for i in np.flatnonzero(labels == label)]
                joined = np.concatenate([np.concatenate([np.zeros(order, np.uint8), p]) for p in parts]).astype(np.uint64)
                # A gram of up to 7 bytes: the context, older bytes higher, then the byte.
                for k in range(order + 1):
                    code = np.zeros(len(joined) - order, np.uint64)
                    for j in range(k, -1, -1):
                        code = (code << np.uint64(8)) | joined[order - j:len(joined) - j]
                    code = code[joined[order:] != 0]
                    if k:
                        code = code[(code >> np.uint64(8)) & np.uint64(255) != 0]
                    values, counts = np.unique(code, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * len(values)), pa.array(np.full(len(values), k, np.int32)),
                         pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["label", "k", "gram", "n"])

    used = F.sum(F.octet_length("text")).over(W.partitionBy("label").orderBy("rank", "doc_id"))
    first = F.row_number().over(W.partitionBy("label").orderBy("rank", "doc_id"))
    bounded = (sampled.withColumn("used", used).withColumn("first", first)
               .where((F.col("used") <= sample_bytes) | (F.col("first") == 1)).select("label", "text"))
    counts = written(bounded.mapInArrow(grams, "label string, k int, gram long, n long")
                     .groupBy("label", "k", "gram").agg(F.sum("n").alias("n")), "language-counts")
    contexts = (counts.withColumn("context", F.shiftright("gram", 8)).groupBy("k", "context")
                .agg(F.sum("n").alias("seen")).orderBy("k", F.desc("seen"), "context"))
    # Short contexts first, then the most frequent of the longest that fit; and never a bare novelty.
    kept = (contexts.where((F.col("k") <= 1) | (F.col("seen") >= 3))
            .orderBy(F.when(F.col("k") <= 2, F.col("k")).otherwise(3), F.desc("seen"), "k", "context")
            .limit(max_contexts))
    rows = (counts.withColumn("context", F.shiftright("gram", 8))
            .join(F.broadcast(kept.select("k", "context")), ["k", "context"], "left_semi")
            .select("label", "k", "context", F.col("gram").bitwiseAND(255).alias("byte"), "n"))
    return rows.toPandas()


class ContextTrees:
    """All languages' trees over one numbering of contexts."""

    def __init__(self, counts, order: int):
        self.labels = sorted(counts["label"].unique())
        self.order = order
        seen = sorted(set(counts["byte"]))
        # Bytes that learning never saw share one column: each is coded below the
        # empty context at 1/256 and no context holds it.
        self.column = np.full(256, len(seen), np.int64)
        self.column[seen] = np.arange(len(seen))
        width, langs = len(seen) + 1, len(self.labels)
        number = {(0, 0): 0}
        for k, c in sorted(set(zip(counts["k"], counts["context"]))):
            if k and (k - 1, c & ((1 << 8 * (k - 1)) - 1)) in number:  # its shorter context exists
                number[k, c] = len(number)
        self.child = np.zeros((len(number), width), np.int32)
        parent = np.zeros(len(number), np.int64)
        depth = np.zeros(len(number), np.int64)
        for (k, c), i in number.items():
            if k:
                p = number[k - 1, c & ((1 << 8 * (k - 1)) - 1)]
                parent[i], depth[i] = p, k
                self.child[p, self.column[c >> 8 * (k - 1)]] = i
        tally = np.zeros((len(number), width, langs), np.float32)
        which = {x: i for i, x in enumerate(self.labels)}
        for label, k, c, byte, n in counts[["label", "k", "context", "byte", "n"]].itertuples(index=False):
            i = number.get((k, c))
            if i is not None:
                tally[i, self.column[byte], which[label]] = n
        prob = np.zeros_like(tally)
        size = np.append(np.ones(width - 1), 256 - (width - 1)).astype(np.float32)  # bytes in each column
        for i in np.argsort(depth, kind="stable"):
            t = tally[i]
            lower = np.full_like(t, 1 / 256) if i == 0 else prob[parent[i]]
            n, d = t.sum(axis=0), (t > 0).sum(axis=0)
            open_ = t == 0
            left = (lower * open_ * size[:, None]).sum(axis=0)  # what exclusion leaves of the shorter context
            escape = np.where(n > 0, d / np.maximum(n + d, 1), 1.0)
            prob[i] = np.where(open_, escape * lower / np.maximum(left, 1e-30),
                               t / np.maximum(n + d, 1) + np.where(left <= 0, escape * t / np.maximum(n, 1), 0))
        self.prob_size = size
        self.bits = -np.log2(np.maximum(prob, 1e-30)).astype(np.float32)

    def code_lengths(self, off: np.ndarray, data: np.ndarray, block: int = 1 << 18) -> np.ndarray:
        """Bits of every whole text under every language."""
        total = np.zeros((len(off) - 1, len(self.labels)))
        s = self.column[LOWER[data]]
        begin = np.zeros(len(data) + 1, np.int64)
        np.add.at(begin, off[1:-1], 1)
        doc = np.cumsum(begin[:-1])                # text of each byte, empty ones stepped over
        since = np.arange(len(data)) - off[doc] if len(data) else doc
        for a in range(0, len(data), block):
            at = np.arange(a, min(a + block, len(data)))
            node = np.zeros(len(at), np.int32)
            live = np.flatnonzero(since[at] >= 1)
            for k in range(1, self.order + 1):
                deeper = self.child[node[live], s[at[live] - k]]
                live, deeper = live[deeper > 0], deeper[deeper > 0]
                node[live] = deeper
                live = live[since[at[live]] >= k + 1]
                if not len(live):
                    break
            cost = self.bits[node, s[at]]
            heads = np.flatnonzero(np.diff(doc[at], prepend=-1))
            total[doc[at][heads]] += np.add.reduceat(cost.astype(np.float64), heads, axis=0)
        return total


def learn(docs: DataFrame, train: Column, lang: str = "lang", order: int = 4, sample_rows: int = 2000,
          sample_bytes: int = 2 << 20, max_contexts: int = 20_000) -> ContextTrees | None:
    """Trees from the rows of ``docs`` (doc_id, text, lang) where ``train`` holds and the language is known."""
    ready(docs.sparkSession)
    rows = docs.where(train & F.col(lang).isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    keys = sample(rows, lang, sample_rows)
    labels = keys.select("label").distinct().limit(1001).collect()
    if not labels:
        return None
    if len(labels) > 1000:
        raise ValueError("more than 1000 languages")
    # The sample's ids are at most sample_rows x languages rows of 16 bytes.
    sampled = rows.join(F.broadcast(keys), "doc_id")
    return ContextTrees(count_contexts(sampled, order, max_contexts, sample_bytes), order)


def identify(docs: DataFrame, trees: ContextTrees | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, lang_pred, score`` and ``bits_per_byte`` of the prediction.

    ``score``: the language's probability when all are equally likely before,
    with code lengths taken per 64 bytes for longer texts.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = documents(docs, doc_id, text)
    if trees is None:
        return rows.select(real_id(), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("bits_per_byte"))
    shared = spark.sparkContext.broadcast(trees)

    def judge(batches):
        t = shared.value
        labels = np.array(t.labels, object)
        for whole in batches:
            for b in slices(whole, limit=2 << 20):
                off, data = text_buffer(b.column(1))
                bits = t.code_lengths(off, data)
                size = np.maximum(np.diff(off), 1)
                best = bits.argmin(axis=1)
                each = bits * (np.minimum(size, 64) / size)[:, None]
                score = 1 / np.exp2(each.min(axis=1, keepdims=True) - each).sum(axis=1)
                words = np.array([has_letter(x) for x in b.column(1).to_pylist()], bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.where(words, labels[best], "und"), pa.string()),
                     pa.array(np.where(words, score, 0.0)),
                     pa.array(np.where(words, bits[np.arange(len(best)), best] / size, np.nan))],
                    names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    return (rows.mapInArrow(judge, "doc_id long, lang_pred string, score double, bits_per_byte double")
            .select(real_id(), "lang_pred", "score", F.nanvl("bits_per_byte", F.lit(None)).alias("bits_per_byte")))


def fold(doc_id: str, folds: int) -> Column:
    """The remainder of the CRC-32 of the id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def language_id(docs: DataFrame, held_out: int = 1, folds: int = 3, **learning) -> DataFrame:
    """Learn on all folds but ``held_out`` and predict every row (a null id is in no fold: never learned from)."""
    rows = docs.select("doc_id", "text", "lang")
    trees = learn(rows, fold("doc_id", folds) != held_out, **learning)
    return (identify(rows, trees)
            .select("doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
                    "lang_pred", "score", "bits_per_byte"))
