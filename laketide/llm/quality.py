"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (``passage`` bytes each, cut over the whole
text). Every passage is encoded: shares of byte kinds and of pairs of coarse
byte kinds, and word repetition. Features are scaled and go through a dense
tanh layer; gated attention (tanh branch times sigmoid branch) weights the
passages of a document, and the weighted passage representation is scored by
a logistic output. Only document labels are known; the attention weights are
learned from them.

Learning uses a bounded sample: at most ``sample_rows`` labelled rows a class,
in the order of a hash of the id, and of each at most ``sample_passages``
passages spread evenly over the text. The sample's features are written once;
every step of gradient descent is a Spark job of one stage over them that
returns one gradient per partition. Scoring is a map over whole texts: no shuffle.

Defined cases. Null and empty texts are one passage without bytes; they are
scored like any other. Rows without a label are never learned from. With no
labelled rows, or one class only, every score is 0.5. Repeated labels of an id
count once (the smallest). Labels, language, source and id are no inputs.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from laketide.llm.common import NON_WHITE, find_words, ready, slices, text_buffer, word_hashes, written
from laketide.llm.language import fold, sample

# Byte kinds: each printable ASCII sign by itself, letters by case, digits, white space, others.
KIND = np.zeros(256, np.int64)
_SIGNS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
for _i, _b in enumerate(_SIGNS):
    KIND[_b] = 6 + _i
KIND[0x61:0x7B], KIND[0x41:0x5B], KIND[0x30:0x3A] = 1, 2, 3
KIND[[0x20, 9, 0x0B, 0x0C, 0x0D]], KIND[0x0A], KIND[0x80:] = 4, 5, 1
KINDS = 6 + len(_SIGNS)
COARSE = np.minimum(KIND, 6)          # all signs together
PAIRS = 49
FEATURES = KINDS + PAIRS + 4


def encode(off: np.ndarray, data: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and the first passage of each text (n + 1)."""
    size = np.diff(off)
    per = np.maximum(-(-size // passage), 1)
    first = np.concatenate([[0], np.cumsum(per)])
    doc = np.repeat(np.arange(len(size)), size)
    which = first[doc] + (np.arange(len(data)) - off[doc]) // passage
    n = int(first[-1])
    x = np.zeros((n, FEATURES), np.float32)
    length = np.maximum(np.bincount(which, minlength=n), 1).astype(np.float32)[:, None]
    x[:, :KINDS] = np.bincount(which * KINDS + KIND[data], minlength=n * KINDS).reshape(n, KINDS) / length
    c = COARSE[data]
    if len(data) > 1:
        pair = np.where(which[1:] == which[:-1], c[:-1] * 7 + c[1:], 0)
        x[:, KINDS:KINDS + PAIRS] = np.bincount(which[1:] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS) / length
    starts, ends, _ = find_words(off, data, NON_WHITE)
    if len(starts):
        h, p = word_hashes(data, starts, ends), which[starts]
        words = np.maximum(np.bincount(p, minlength=n), 1)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (p[1:] == p[:-1])
        order = np.lexsort((h, p))
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (p[order][1:] != p[order][:-1])
        x[:, -4] = np.bincount(p, weights=same, minlength=n) / words
        x[:, -3] = np.bincount(p[order], weights=fresh, minlength=n) / words
        x[:, -2] = np.bincount(p, weights=ends - starts, minlength=n) / words / 16
    x[:, -1] = np.log1p(length[:, 0]) / 8
    return x, first


class Model:
    """Weights of the encoder, the gated attention and the output."""

    def __init__(self, hidden: int = 24, gate: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        shape = {"w": (FEATURES, hidden), "b": (hidden,), "v": (hidden, gate), "u": (hidden, gate),
                 "a": (gate,), "o": (hidden,), "c": (1,)}
        self.p = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k in "wvuao" else np.zeros(s)) for k, s in shape.items()}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, x: np.ndarray, first: np.ndarray):
        p, heads = self.p, first[:-1]
        z = np.clip((x - self.mean) * self.scale, -8, 8)
        h = np.tanh(z @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * s) @ p["a"]
        bag = np.repeat(np.arange(len(heads)), np.diff(first))
        e = np.exp(e - np.maximum.reduceat(e, heads)[bag])
        weight = e / np.add.reduceat(e, heads)[bag]
        doc = np.add.reduceat(weight[:, None] * h, heads, axis=0)
        score = 1 / (1 + np.exp(-(doc @ p["o"] + p["c"])))
        return z, h, t, s, weight, bag, doc, score

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Gradient of the weighted log loss, flat, with the loss in front."""
        p, heads = self.p, first[:-1]
        z, h, t, s, weight, bag, doc, score = self.forward(x, first)
        d = (score - y) * share
        d_doc = d[:, None] * p["o"]
        d_h = weight[:, None] * d_doc[bag]
        d_weight = (h * d_doc[bag]).sum(axis=1)
        d_e = weight * (d_weight - np.add.reduceat(weight * d_weight, heads)[bag])
        d_t, d_s = d_e[:, None] * p["a"] * s * (1 - t * t), d_e[:, None] * p["a"] * t * s * (1 - s)
        d_h += d_t @ p["v"].T + d_s @ p["u"].T
        d_z = d_h * (1 - h * h)
        g = {"w": z.T @ d_z, "b": d_z.sum(axis=0), "v": h.T @ d_t, "u": h.T @ d_s, "a": (t * s).T @ d_e,
             "o": doc.T @ d, "c": d.sum(keepdims=True)}
        score = np.clip(score, 1e-7, 1 - 1e-7)
        loss = -(share * (y * np.log(score) + (1 - y) * np.log(1 - score))).sum()
        return np.concatenate([[loss], *(g[k].ravel() for k in self.p)])

    def step(self, g: np.ndarray, state: dict, n: int, rate: float = 0.03, decay: float = 1e-4) -> None:
        """One step of Adam."""
        at = 1
        for k, w in self.p.items():
            d = g[at:at + w.size].reshape(w.shape) + decay * w
            at += w.size
            m, v = state.get(k, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
            state[k] = m, v
            self.p[k] = w - rate * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.99 ** n)) + 1e-8)


def _bags(rows, size: int = 512):
    """Passages, first passage of each document and label, of ``size`` rows (y, n, x) at a time."""
    rows = iter(rows)
    while part := list(islice(rows, size)):
        y, n, x = zip(*part)
        x = np.frombuffer(b"".join(x), "<f4").reshape(-1, FEATURES)
        yield x, np.concatenate([[0], np.cumsum(n)]), np.array(y, np.float64)


def learn(docs: DataFrame, marks: DataFrame, label: str, passage: int = 1024, sample_rows: int = 4000, sample_passages: int = 16,
          steps: int = 60, parts: int = 6) -> Model | None:
    """A model from ``docs`` (doc_id, text) and ``marks`` (doc_id, label of 0 or 1)."""
    spark = docs.sparkSession
    keys = sample(marks.join(docs.select("doc_id"), "doc_id", "left_semi"), label, sample_rows)

    def features(batches):
        for whole in batches:
            for b in slices(whole):
                off, data = text_buffer(b.column(1))
                x, first = encode(off, data, passage)
                picks = [np.unique(np.linspace(a, z - 1, min(sample_passages, z - a)).astype(np.int64))
                         for a, z in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(p) for p in picks], pa.int32()),
                     pa.array([x[p].astype("<f4").tobytes() for p in picks], pa.binary())], names=["y", "n", "x"])

    # The sample's ids are at most sample_rows x 2 rows.
    bags = (docs.select("doc_id", "text").join(F.broadcast(keys), "doc_id")
            .select(F.col("label").cast("int").alias("y"), "text", "doc_id")
            .repartition(parts, F.pmod(F.xxhash64("doc_id"), F.lit(parts))).select("y", "text"))
    bags = written(bags.mapInArrow(features, "y int, n int, x binary"), "quality-sample")
    # Planned once: a step is one stage and no query, and its weights (some 20 KB) travel with its task.
    rows = bags.select("y", "n", "x").rdd
    model, state = Model(), {}
    total = lambda f: sum(np.frombuffer(v) for v in rows.mapPartitions(f).collect())

    def moments(part):
        for x, _, y in _bags(part):
            x = x.astype(np.float64)
            yield np.concatenate([np.bincount(y.astype(int), minlength=2), [len(x)], x.sum(axis=0), (x * x).sum(axis=0)]).tobytes()

    m = total(moments)
    if np.isscalar(m) or not m[:2].all():
        return None
    sizes, m = m[:2], m[2:]
    model.mean = m[1:1 + FEATURES] / m[0]
    model.scale = 1 / np.sqrt(np.maximum(m[1 + FEATURES:] / m[0] - model.mean ** 2, 1e-6))
    # Both classes weigh the same.
    weight = np.array([0.5 / sizes[0], 0.5 / sizes[1]])

    def gradient(part):
        g = 0
        for x, first, y in _bags(part):
            g = g + model.gradient(x, first, y, weight[y.astype(int)])
        if not np.isscalar(g):
            yield g.tobytes()

    for n in range(1, steps + 1):
        model.step(total(gradient), state, n)  # the closure is pickled anew for each step
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text", passage: int = 1024) -> DataFrame:
    """Every row of ``docs`` as it is (struct ``row``) with ``score`` and
    ``top_passage`` (the passage with most attention) of its whole text."""
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)

    def judge(batches):
        for whole in batches:
            for b in slices(whole, limit=2 << 20):
                off, data = text_buffer(b.column(1))
                n = b.num_rows
                if shared.value is None:
                    s, top = np.full(n, 0.5), np.zeros(n, np.int64)
                else:
                    x, first = encode(off, data, passage)
                    _, _, _, _, weight, bag, _, s = shared.value.forward(x, first)
                    order = np.lexsort((-weight, bag))
                    top = order[first[:-1]] - first[:-1]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(top)],
                                                 names=["row", "score", "top_passage"])

    schema = StructType([StructField("row", docs.schema), StructField("score", DoubleType()),
                         StructField("top_passage", LongType())])
    return docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text")).mapInArrow(judge, schema)


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 0, folds: int = 5,
           **learning) -> DataFrame:
    """Learn on all folds but ``held_out`` and score every row (a null id is in no fold: never learned from)."""
    ready(docs.sparkSession)
    marks = (labels.where(F.col(label).isin(0, 1) & (fold("doc_id", folds) != held_out))
             .groupBy("doc_id").agg(F.min(label).alias("mark")))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return score(docs, learn(rows, marks, "mark", **learning))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, held_out: int = 0, folds: int = 5,
            **learning) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted, top_passage``."""
    own = docs.select("doc_id", "text")
    return (scored(own, labels, held_out=held_out, folds=folds, **learning)
            .select("row.doc_id", "score", "top_passage")
            .select("doc_id", F.coalesce(fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "top_passage"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **learning) -> DataFrame:
    """The rows of ``docs``, all their columns, that the classifier does not reject."""
    return scored(docs, labels, **learning).where(F.col("score") >= threshold).select("row.*")
