import numpy as np
import pytest
from pyspark.sql import functions as F

from laketide.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, class long, cell string, found int, place int"
EVERY = "vec_id % 20 = 0"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA).repartition(4)


def true_lists(rows, every=20, k=20):
    """Exact answers of distinct (id, vector) rows, ties to smaller ids."""
    rows = [(i, tuple(np.float32(x) for x in v)) for i, v in rows]
    rows = list(dict.fromkeys(rows))
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i is None or i % every:
            continue
        s = N.in_order(np.broadcast_to(np.array(v, np.float64), x.shape), x)
        near = sorted((-s[j], rows[j][0] is None, rows[j][0] or 0) for j in range(len(rows)) if rows[j][0] != i)
        out[i] = [(None if none else j, -d) for d, none, j in near[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def vectors(n, dim, groups, seed=3, spread=0.1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    x = centre[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    return x.astype(np.float32)


@pytest.fixture(scope="module")
def clustered(spark):
    x = vectors(4000, 16, 60)
    x[::3] = x[0]  # a third of the rows is one vector
    return [(i, [float(e) for e in v]) for i, v in enumerate(x)]


def test_recall_and_exact_scores(spark, clustered):
    got, want = lists(N.search(table(spark, clustered), F.expr(EVERY))), true_lists(clustered)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / (20 * len(want)) >= 0.9
    score = {q: dict(v) for q, v in true_lists(clustered, k=len(clustered)).items()}
    for q, found in got.items():
        assert [(i, score[q][i]) for i, _ in found] == found       # the measure itself
        assert sorted(found, key=lambda f: (-f[1], f[0])) == found  # nearest first, ties by id


def test_everything_visited_is_brute_force(spark, clustered):
    few = clustered[:600]
    assert lists(N.search(table(spark, few), F.expr(EVERY), recall=1.0, measured=600, shard_rows=50, block=7)) == true_lists(few)


def test_defined_cases(spark):
    a, b, z = [1.0, 0.0, 2.0], [0.5, 0.5, 0.5], [0.0, 0.0, 0.0]
    rows = [(0, a), (0, a), (20, b), (1, b), (2, b), (None, b), (None, None), (3, None), (4, z), (5, [1.0, None, 2.0]),
            (6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0]), (8, [1.0, 2.0]), (9, []), (40, [-1.0, 0.0, 0.0]), (60, z), (0, b)]
    kept = [(i, v) for i, v in rows if v in (a, b, [-1.0, 0.0, 0.0])]
    found = N.search(table(spark, rows), F.expr(EVERY))
    got, want = lists(found.where("query_id != 0")), true_lists(kept)
    assert set(got) == {20, 40}
    assert got[20] == want[20] and got[40] == want[40]  # all candidates, if fewer than 20; ties by id, null last
    twice = [r.vec_id for r in found.where("query_id = 0").collect()]  # an id with two vectors asks with both
    assert sorted(twice, key=str) == sorted([20, 1, 2, None, 40] * 2, key=str)


def test_empty(spark):
    for rows in ([], [(0, None), (20, [])]):
        out = N.search(table(spark, rows), F.expr(EVERY))
        assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_heap_visits_all_cells_in_order():
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=7), rng.normal(size=5)
    u[3] = u[2]
    seen = list(N.visit(u, v))
    assert sorted(c for c, _ in seen) == list(range(35))
    assert [s for _, s in seen] == sorted((s for _, s in seen), reverse=True)
    assert all(s == u[c // 5] + v[c % 5] for c, s in seen)


def test_shards_hold_about_as_many_as_asked():
    count = np.array([3, 0, 5, 40, 2, 9, 1])
    shard, pieces = N.place_shards(count, 10)
    held = {}
    for n, s, p in zip(count, shard, pieces):
        for x in range(s, s + p):
            held[x] = held.get(x, 0) + n / p
    assert max(held.values()) <= 10 and pieces[3] == 4
    assert sorted(held) == list(range(len(held)))
