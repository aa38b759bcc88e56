"""P5/P6: the least-loss choice of levels equals an enumeration of all of them."""

import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from laketide.operators import lattice as L

HEIGHTS = [2, 3, 1]


def fine(r, node):
    a, b, c, _ = r
    first = [a, None if a is None else a[0], "*"][node[0]]
    second = [b, None if b is None else b // 10, None if b is None else b // 50, "*"][node[1]]
    return first, second, [c, "*"][node[2]]


def levels():
    band = lambda w: F.floor(F.col("b") / w)
    return {"a": [F.col("a"), F.substring("a", 1, 1), F.lit("*")], "b": [F.col("b"), band(10), band(50), F.lit("*")], "c": [F.col("c"), F.lit("*")]}


def brute(rows, k, most, unit):
    for node in sorted(product(range(3), range(4), range(2)), key=lambda n: (L.loss(n, HEIGHTS), n)):
        seen = {(fine(r, node), r[3]) for r in rows if r[3] is not None} if unit else [(fine(r, node), i) for i, r in enumerate(rows)]
        sizes = Counter(g for g, _ in seen)
        if sum(n for n in sizes.values() if n < k) <= most:
            kept = [n for n in sizes.values() if n >= k]
            return node, len(kept), min(kept, default=0), sum(n for n in sizes.values() if n < k)
    return None


@pytest.fixture(scope="module")
def people():
    rng = random.Random(6)
    rows = [(rng.choice(["xa", "xb", "ya", None]), rng.choice([None, *range(0, 100, 7)]), rng.choice("mf"), rng.randrange(120)) for _ in range(400)]
    return rows + [("xa", 7, "m", 1)] * 200 + [("zz", 99, "f", None)]  # one group holds a third of the rows


@pytest.mark.parametrize("k,most,unit", [(2, 0, None), (5, 0, None), (5, 40, None), (30, 0, None), (5, 0, "u"), (20, 25, "u"), (1, 0, None)])
def test_equals_enumeration(spark, people, k, most, unit):
    df = spark.createDataFrame(people, "a string, b int, c string, u int")
    got = L.search_generalisation(df, levels(), k, unit, most, batch=4)
    node, groups, least, small = brute(people, k, most, unit)
    assert (tuple(got.levels.values()), got.groups, got.smallest, got.suppressed) == (node, groups, least, small)
    assert got.counted <= 24
    shown = L.at_levels(df, levels(), got)
    assert shown.select("a", "b", "c").distinct().count() >= groups


def test_pruning_none_and_defined_cases(spark, people):
    df = spark.createDataFrame(people, "a string, b int, c string, u int")
    assert L.search_generalisation(df, levels(), 10_000) is None
    assert L.search_generalisation(df, levels(), 300, batch=2).counted < 12  # of 24: failed nodes close finer ones, passed ones costlier
    assert L.search_generalisation(df.limit(0), levels(), 5).levels == {"a": 0, "b": 0, "c": 0}
    with pytest.raises(ValueError):
        L.search_generalisation(df, {"b": [F.floor(F.col("b") / 10), F.floor(F.col("b") / 15)]}, 2)
