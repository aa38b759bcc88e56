import hashlib
import math

import numpy as np
import pytest

from laketide.llm import centroid_clustering as C

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string, vector int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA).repartition(4)


def brute(rows, clusters=16, rounds=3):
    """Plain Python integers all the way; rows sorted for comparison."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and abs(x) <= C.FLOAT_MAX for x in v)]
    mark = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cents = [v for _, v in sorted(kept, key=mark)[:clusters]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((gap(v, c), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        cents = [[sum(col) // len(own[k]) for col in zip(*own[k])] if k in own else c for k, c in enumerate(cents)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    within = {}
    for _, k, d in last:
        within[k] = within.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    fit = lambda x: x if x <= C.LONG_MAX else None
    whole = all(d <= C.LONG_MAX for _, _, d in last)
    lost = {k for _, k, d in last if d > C.LONG_MAX}
    return sorted(((i, k, fit(d), None if k in lost else fit(within[k]), fit(sum(within.values())) if whole else None, sha[k])
                   for i, k, d in last), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def points(n, seed=0, scale=1.0, groups=9):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(groups, 64))[rng.integers(0, groups, n)] + 0.3 * rng.normal(size=(n, 64))
    x[::3] = x[0]  # a third of the rows is one vector
    return [(i, [float(e) for e in scale * v]) for i, v in enumerate(x)]


def test_matches_brute_force(spark):
    rows = points(700)
    assert got(C.cluster(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("scale", [1e5, 1e9, 1e30])  # beyond 64 bits: Python integers, then figures that no long holds
def test_large_components(spark, scale):
    rows = points(40, scale=scale)
    assert got(C.cluster(table(spark, rows))) == brute(rows)


def test_defined_cases(spark):
    v = points(30)
    rows = [*v, *v[:9], (None, v[3][1]), (None, v[5][1]), (None, None), (3, v[8][1]), (4, None), (5, []), (6, [0.5] * 63),
            (7, [0.5] * 65), (8, [0.5] * 63 + [None]), (9, [float("nan")] * 64), (10, [float("-inf")] * 64), (11, [0.0] * 64), (12, [-0.0] * 64)]
    assert got(C.cluster(table(spark, rows))) == brute(rows)
    few = rows[:3]
    assert got(C.cluster(table(spark, few))) == brute(few)


def test_empty(spark):
    for rows in ([], [(1, None)]):
        out = C.cluster(table(spark, rows))
        assert out.count() == 0
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_transform_keeps_distances_and_runs_coarse_to_fine():
    x = np.random.default_rng(2).integers(-90, 90, (5, 64))
    t = C.transform(x)
    assert (t[:, 0] == x.sum(axis=1)).all()  # the coarsest coefficient
    assert (((t[0] - t[1:]) ** 2).sum(axis=1) == 64 * ((x[0] - x[1:]) ** 2).sum(axis=1)).all()
    rows = C.transform(np.eye(64, dtype=np.int64)).T
    assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(64))
    with pytest.raises(ValueError):
        C.coarse_to_fine(48)


def test_search_is_exact_on_ties_and_saves_work():
    rng = np.random.default_rng(4)
    c = rng.integers(-64, 64, (16, 64))
    c[7] = c[2]
    v = np.concatenate([c[rng.integers(0, 16, 300)] + rng.integers(-9, 9, (300, 64)), c])
    best, gap, added = C.nearest(v, c)
    every = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (gap == every.min(axis=1)).all()
    assert added < v.shape[0] * c.size / 2  # most coefficient differences are never added
