import hashlib
import random

import pytest

from laketide.llm import decontaminate as D


def expected(rows, items, words, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[p:p + k]), set()).add(str(i))
    sizes = {len(k) for k in wins}
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if x := wins.get(tuple(w[p:p + k])):
                    hit.update(range(p, p + k))
                    found |= x
        ids = ",".join(sorted(found - {"None"}))  # an item without an id counts, but has none to show
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def bench(spark, mixed, nasty_rows, brute):
    rng = random.Random(3)
    texts = [brute["alnum"](r.text) for r in mixed.collect()]
    items = [(i, " ".join(w[:rng.randrange(1, 60)])) for i, w in enumerate(rng.sample(texts, 40)) if w]
    items += [(900, None), (901, "..."), (902, "edit7"), (902, "w1 w2 w3"), (None, "w5"), (903, nasty_rows[7][1].upper())]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [500_000, 900])  # one block, and many
def test_matches_brute_force(mixed, bench, brute, block_words):
    items, df = bench
    got = sorted((tuple(r) for r in D.contaminated_report(mixed, df, block_words=block_words).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in mixed.collect()], items, brute["alnum"])


def test_matches_are_maximal_and_verbatim(spark, brute):
    doc = "zero one two three four five six seven eight nine ten eleven twelve thirteen end"
    item = "start one two three four five six seven eight nine ten eleven twelve other"
    docs, bench = (spark.createDataFrame([(1, t)], f"{c} long, text string") for c, t in (("doc_id", doc), ("item_id", item)))
    r = D.contamination(docs, bench).collect()[0]
    m = r.matches[0]
    assert (m.item_id, m.item_start, m.doc_start, m.length) == ("1", 1, 1, 12) and len(r.matches) == 1 and r.n_hit == 12


def test_nasty_rows_and_clean(nasty, nasty_rows, bench, brute):
    items, df = bench
    got = sorted((tuple(r) for r in D.contaminated_report(nasty, df).collect()), key=str)
    want = expected([r[:2] for r in nasty_rows], items, brute["alnum"])
    assert got == want
    kept = D.clean(nasty, df)
    assert kept.columns == nasty.columns and kept.count() == sum(not r[-1] for r in want)


def test_empty(spark, nothing, mixed, bench):
    assert D.contaminated_report(nothing, bench[1]).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated_report(mixed, none).where("contaminated").count() == 0
