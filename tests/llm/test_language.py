import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from laketide.llm import language as L
from laketide.llm.common import text_buffer


class Slow:
    """PPM with escapes (method C) and exclusion, one byte at a time."""

    def __init__(self, counts, contexts, order):
        self.counts, self.contexts, self.order = counts, contexts, order

    def prob(self, context, byte):
        own = self.counts.get(context, {})
        lower = (lambda b: 1 / 256) if context == b"" else (lambda b: self.prob(context[1:], b))
        n, d = sum(own.values()), len(own)
        if not n:
            return lower(byte)
        if byte in own:
            return own[byte] / (n + d)
        return d / (n + d) * lower(byte) / (1 - sum(lower(b) for b in own))

    def bits(self, text):
        total = 0
        for i, b in enumerate(text):
            context = b""
            for k in range(1, self.order + 1):   # the longest context that any language knows
                if i < k or text[i - k:i] not in self.contexts:
                    break
                context = text[i - k:i]
            total -= math.log2(self.prob(context, b))
        return total


@pytest.fixture(scope="module")
def trees(spark):
    rows = [(i, lang, t * 6) for i, (lang, t) in enumerate([("en", "the cat sat on the mat and the hat "), ("de", "der hund und die katze "),
                                                            ("fr", "le chat est sur la table où "), ("en", "that is what this was ")])]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    return rows, L.learn(df, L.F.lit(True), order=3)


def test_code_lengths_match_a_plain_model(trees):
    rows, t = trees
    counts = {lang: defaultdict(Counter) for lang in t.labels}
    for _, lang, text in rows:
        b = text.lower().encode()
        for i in range(len(b)):
            for k in range(0, min(i, 3) + 1):
                counts[lang][b[i - k:i]][b[i]] += 1
    seen = Counter()
    for c in counts.values():
        for context, own in c.items():
            seen[context] += sum(own.values())
    contexts = {c for c, n in seen.items() if len(c) <= 1 or n >= 3}
    texts = ["the cat", "", "die Katze!", "où est x", "zzzz \x00 中", "t"]
    off, data = text_buffer(pa.array(texts))
    got = t.code_lengths(off, data, block=5)
    for j, lang in enumerate(t.labels):
        slow = Slow({c: own for c, own in counts[lang].items() if c in contexts}, contexts, 3)
        for i, text in enumerate(texts):
            assert got[i, j] == pytest.approx(slow.bits(text.lower().encode()), rel=1e-4, abs=1e-3)


def test_probabilities_add_up(trees):
    _, t = trees
    p = np.exp2(-t.bits.astype(np.float64))
    assert np.allclose((p * t.prob_size[None, :, None]).sum(axis=1), 1, atol=1e-4)


def test_held_out_accuracy_and_folds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in L.language_id(docs).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out and len(r.text) >= 40]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= g.score <= 1 for g in got.values())


def test_labels_do_not_reach_predictions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = L.fold("doc_id", 3)
    hidden = docs.withColumn("lang", L.F.when(fold != 1, L.F.col("lang"))).withColumn("source", L.F.lit("x"))
    pick = lambda d: sorted(tuple(r)[:4] for r in L.language_id(d).collect())
    assert pick(docs) == pick(hidden)


def test_nasty_rows(nasty, nasty_rows):
    got = L.language_id(nasty).collect()
    assert len(got) == len(nasty_rows)
    no_letter = [r[0] for r in nasty_rows if r[0] is not None and r[0] != 3 and not any(c.isalpha() for c in r[1] or "")]
    assert all((g.lang_pred, g.score) == ("und", 0.0) for g in got if g.doc_id in no_letter)
    assert all(g.held_out is False for g in got if g.doc_id is None)


def test_empty_and_unlabelled(nothing, mixed):
    assert L.language_id(nothing).count() == 0
    blind = mixed.withColumn("lang", L.F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.language_id(blind).collect()} == {"und"}


def test_numbers_marks_and_signs_are_no_letters():
    from laketide.llm.language import has_letter
    assert not any(has_letter(t) for t in (None, "", " 12 ²½Ⅷ_-! ٣ ́ €"))
    assert all(has_letter(t) for t in ("²a", "中", "12 ñ", "ª", "ǅ"))
