import re
from itertools import permutations

import pytest

from laketide.llm import filter_audit as A


def fails(rows):
    """(part, letters a document fails, id), by the plain definitions."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
               "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        out.append((part or "", {k for k, v in bad.items() if v}, i))
    return out


def brute(rows, labels, names="ABCDE"):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    docs, out = fails(rows), []
    for part in {p for p, _, _ in docs}:
        own = [(f, i) for p, f, i in docs if p == part]
        steps = []
        for order in permutations(names):
            left = own
            for k, f in enumerate(order):
                gone, left = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                steps.append(["".join(order), k + 1, len(left), len(gone), sum(f in d[0] for d in own) - len(gone),
                              sum(d[0] == {f} for d in own), sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone), f])
        for s in steps:
            out.append((part, *s[:-1], sum(x[3] for x in steps if x[-1] == s[-1])))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(0, 400, 2)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_matches_brute_force(mixed, labels):
    rows = [(r.doc_id, r.text, r.lang) for r in mixed.collect()]
    assert got(A.filter_audit(mixed, labels)) == brute(rows, [tuple(r) for r in labels.collect()])


def test_nasty_rows(nasty, nasty_rows, labels):
    assert got(A.filter_audit(nasty, labels)) == brute([r[:3] for r in nasty_rows], [tuple(r) for r in labels.collect()])


def test_empty(nothing, nasty, labels):
    assert A.filter_audit(nothing, labels).count() == 0
    zero = A.filter_audit(nasty, labels.limit(0)).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()
    assert tuple(zero) == (0, 0)


def test_other_filters(mixed, labels):
    out = got(A.filter_audit(mixed, labels, {"S": lambda t: t == "", "L": lambda t: t.contains("edit")}, None))
    assert {r[1] for r in out} == {"SL", "LS"}
    with pytest.raises(ValueError):
        A.filter_audit(mixed, labels, {"E": lambda t: t == ""})


@pytest.mark.parametrize("n", range(1, 6))
def test_plain_changes_visit_all_orders_by_one_swap_each(n):
    now = list(range(n))
    seen = [tuple(now)]
    for p in A.plain_changes(n):
        now[p], now[p + 1] = now[p + 1], now[p]
        seen.append(tuple(now))
    assert sorted(seen) == sorted(permutations(range(n)))


def test_swapped_diagram_equals_one_built_in_that_order():
    counts = {m: (m * 7 % 5, m % 2, 0) for m in range(16) if m % 3}
    d = A.Diagram("ABCD", counts)
    for p in (0, 1, 2, 1, 0, 2):
        d.swap(p)
    order = "".join(d.order)
    moved = {sum(((m >> "ABCD".index(c)) & 1) << i for i, c in enumerate(order)): w for m, w in counts.items()}
    assert list(d.steps()) == list(A.Diagram(order, moved).steps())
    # Equal sub-diagrams are shared: no level has more nodes than different functions.
    assert all(len(set(level.values())) == len(level) for level in d.levels)
