import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from laketide.llm import exchange, substring_dedup as S


def expected(rows, words, window):
    seen = {}
    docs = [(i, words(t)) for i, t in rows]
    for i, w in docs:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            seen[k] = min(seen.get(k, (i, p)), (i, p))
    out = []
    for i, w in docs:
        gone = set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p:p + window])] < (i, p):
                gone.update(range(p, p + window))
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_matches_brute_force(mixed, brute):
    for window in (20, 7):
        got = sorted(tuple(r)[:4] for r in S.substring_dedup(mixed, window=window).collect())
        assert got == expected([(r.doc_id, r.text) for r in mixed.collect()], brute["ws"], window)


def test_spans_are_the_removed_words(mixed):
    for r in S.substring_dedup(mixed).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_nasty_rows(nasty, nasty_rows, brute):
    big = 1 << 62
    got = sorted(((big if r.doc_id is None else r.doc_id, *tuple(r)[1:4]) for r in S.substring_dedup(nasty).collect()))
    assert got == expected([(big if r[0] is None else r[0], r[1]) for r in nasty_rows], brute["ws"], 20)


def test_null_and_repeated_ids_are_rows_of_their_own(spark, brute):
    """Places of one row without an id (or of a repeated id) cut no other row, and are seen as repeated in it."""
    text = lambda name, n=40: " ".join(f"{name}{j}" for j in range(n))
    rows = [(1, text("a")), (2, text("b")), (2, text("c")), (2, text("a")), (9, text("e")), (9, text("e"))]
    none = [text("a"), text("d"), text("f") + " x", text("f") + " y", text("g"), text("g"), text("h", 15), text("h", 15)]
    df = spark.createDataFrame(rows + [(None, t) for t in none], "doc_id long, text string").repartition(3)
    got = S.substring_dedup(df).collect()
    assert sorted(tuple(r)[:4] for r in got if r.doc_id is not None) == expected(rows, brute["ws"], 20)
    # Without ids: a copy of document 1 goes, one of two repeated texts stays, the others are untouched.
    assert sorted((r.n_words, r.n_removed) for r in got if r.doc_id is None) == \
        [(15, 0), (15, 0), (40, 0), (40, 0), (40, 40), (40, 40), (41, 0), (41, 40)]


def test_empty(nothing):
    assert S.substring_dedup(nothing).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 70_000)), unique=True, max_size=60), st.integers(1, 7))
def test_payload_round_trip(entries, owners):
    entries = sorted(entries)
    doc, pos = (np.array([e[i] for e in entries], np.int64) for i in (0, 1))
    ids = np.array([5, 9, 2**63 - 1, 3, 0, 12], np.int64)
    key = (pos * 7919 + doc).astype("<u4")
    rows = exchange.pack(key % owners, owners, doc, pos, ids, [key], (ids * 2,))
    back = set()
    for o, payload in rows:
        d, p, (k,), (twice,) = exchange.unpack([payload], ["<u4"], 1)
        assert (k % owners == o).all() and (twice == d * 2).all()
        back |= set(zip(d.tolist(), p.tolist(), k.tolist()))
    assert back == set(zip(ids[doc].tolist(), pos.tolist(), key.tolist()))
