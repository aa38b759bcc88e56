import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from laketide.llm import packing as P
from laketide.llm import tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def check(pieces, rows, tokenizer, size):
    """Each id lies in one piece; sequences are gapless and full but the last."""
    ids = Counter()
    for i, t in rows:
        x = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        ids[i, len(x)] += 1
    by = defaultdict(list)
    for p in pieces:
        by[p.doc_id, p.doc_tokens].append(p)
    assert {k: n * k[1] for k, n in ids.items()} == {k: sum(p.length for p in v) for k, v in by.items()}
    seq = defaultdict(list)
    for p in pieces:
        seq[p.sequence_id].append((p.offset, p.length))
    full = []
    for s in sorted(seq):
        at = 0
        for o, n in sorted(seq[s]):
            assert o == at and n > 0
            at += n
        full.append(at)
    assert sorted(seq) == list(range(len(seq))) and all(x == size for x in full[:-1]) and full[-1] <= size


def test_pieces_rebuild_documents(mixed, tokenizer):
    pieces = P.pack(mixed, size=64, window_sequences=3).collect()
    rows = {r.doc_id: r.text for r in mixed.collect()}
    check(pieces, rows.items(), tokenizer, 64)
    by = defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
    for i, t in rows.items():
        x, at = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(by[i], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(x[at:at + p.length].tobytes())
            at += p.length
        assert at == len(x) == p.doc_tokens


def test_windows_hold_the_mixture(mixed):
    pieces = P.pack(mixed, size=64, window_sequences=8).collect()
    total, windows = Counter(), defaultdict(Counter)
    for p in pieces:
        total[p.source] += p.length
        windows[p.window_id][p.source] += p.length
    for w in windows.values():  # a deficit is less than a token a queue
        for s, n in total.items():
            assert abs(w[s] - n / len(windows)) < 1 + 1e-9


def test_targets_and_shared_queue(mixed, tokenizer):
    pieces = P.pack(mixed, size=32, window_sequences=4, targets={"hot": 0.5, "s0": 0.5}, max_queues=3).collect()
    check(pieces, [(r.doc_id, r.text) for r in mixed.collect()], tokenizer, 32)
    first = Counter()
    for p in pieces:
        if p.window_id == 0:
            first[p.source] += p.length
    assert abs(first["hot"] - first["s0"]) <= 1


def test_queues_go_to_sources_with_most_text_and_to_targets(spark, mixed):
    """A source of two long documents and a named one of one short document, among sources with more documents."""
    rows = [(i, "few words here", f"m{i % 40}") for i in range(400)] + [(1000 + i, "many words " * 900, "long") for i in range(2)]
    df = spark.createDataFrame([*rows, (2000, "just one text of some words", "rare")], "doc_id long, text string, source string")
    windows = defaultdict(Counter)
    for p in P.pack(df, size=64, window_sequences=4, max_queues=3).collect():
        windows[p.window_id][p.source] += p.length
    total = sum(w["long"] for w in windows.values())
    assert len(windows) > 5 and all(abs(w["long"] - total / len(windows)) < 1 + 1e-9 for w in windows.values())
    pieces = P.pack(df, size=8, window_sequences=1, max_queues=2, targets={"rare": 0.5, "m1": 0.5}).collect()
    first = Counter(p.source for p in pieces if p.window_id == 0 for _ in range(p.length))
    assert first["rare"] and abs(first["rare"] - first["m1"]) <= 1
    with pytest.raises(ValueError, match="nowhere"):
        P.pack(df, targets={"nowhere": 1.0})


def test_rounds_agree_with_a_plain_round_robin():
    totals, weights, window = [1000, 37, 0, 411], [Fraction(1, 2), Fraction(1, 10), Fraction(1), Fraction(2, 5)], 50
    r = P.Rounds(totals, weights, window)
    place = {}
    for q, n in enumerate(totals):
        at = 0
        while at < n:
            step = min(13, n - at)
            for a, k, w, g in r.places(q, at, step, 16):
                for j in range(k):
                    assert g + j not in place
                    place[g + j] = (w, q, a + j)
            at += step
    assert sorted(place) == list(range(sum(totals)))
    order = [place[g] for g in range(sum(totals))]
    assert order == sorted(order)  # windows in turn, queues in turn, tokens in turn


def test_nasty_rows(nasty, nasty_rows, tokenizer):
    check(P.pack(nasty, size=128, window_sequences=2).collect(), [r[:2] for r in nasty_rows], tokenizer, 128)


def test_empty(nothing):
    assert P.pack(nothing).count() == 0


def test_ids_are_the_tokenizers_own(spark, tokenizer, nasty_rows):
    own = tokens.TokenIds(str(public_tokenizers.path("byte_bpe_50k.json")), keep=50)  # a small table: it turns over
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    odd = ["don't  stop", " a", "a ", " x  y", "é 'S 's", "1 2\n 3\r\n4", "中文 字", "🙂 🙂", "it's we'll\tI'd", "\x85 a"]
    for t in [*texts, *odd, *(r[1] or "" for r in nasty_rows)]:
        assert np.frombuffer(own.encode(t), own.kind).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:80]
