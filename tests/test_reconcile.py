"""R4 by rows: every changed, lost, added, doubled and thinned key, from differing ranges only."""

import random

import pytest

from laketide.operators import reconcile as R
from laketide.session import scratch_path
from conftest import rows

SCHEMA = "k long, n int, v string, m map<string,int>"


def brute(a, b, width=2):
    out = []
    by = [{}, {}]
    for side, data in zip(by, (a, b)):
        for r in data:
            side.setdefault(r[:width], []).append(str(r))
    for k in set(by[0]) | set(by[1]):
        x, y = sorted(by[0].get(k, [])), sorted(by[1].get(k, []))
        if x != y:
            status = "lost" if not y else "added" if not x else "doubled" if len(y) > len(x) else "thinned" if len(y) < len(x) else "changed"
            out.append((*k, status, len(x), len(y)))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(2)
    a = [(k, n, rng.choice(["x", None, "y"]), {"a": n}) for k in range(0, 6000, 3) for n in range(2)]
    a += [(None, 1, "n", None), (None, 2, "n", None), (-(1 << 62), 0, "low", None), ((1 << 62), 0, "high", None)]
    a += [(900, 0, "hot", None)] * 500
    b = list(a)
    b.remove((None, 2, "n", None))
    b.remove((900, 0, "hot", None))
    b[10] = (b[10][0], b[10][1], "changed", {"a": 0})
    b[11] = (*b[11][:3], None)
    b += [b[200], (31, 0, "added", None)]
    del b[3000:3003]
    rng.shuffle(b)
    return a, b


@pytest.mark.parametrize("how", [{}, {"fan_out": 4, "leaf_rows": 1}, {"leaf_rows": 1, "max_ranges": 2}])
def test_finds_what_brute_force_finds(spark, copies, how):
    a, b = copies
    out = R.reconcile_rows(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k", "n"], **how)
    assert rows(out) == brute(a, b)


def test_text_keys_nulls_and_column_order(spark):
    a = [(f"k{i}", i % 5, None) for i in range(300)] + [(None, 1, "x")]
    b = [r for r in a if r[0] != "k7"] + [("k9", 4, None)]
    b[0] = ("k0", None, "0")  # values that moved to another column
    left, right = spark.createDataFrame(a, "k string, n int, v string"), spark.createDataFrame(b, "k string, n int, v string").select("v", "n", "k")
    assert rows(R.reconcile_rows(left, right, ["k"], leaf_rows=5)) == brute(a, b, 1)
    with pytest.raises(ValueError):
        R.reconcile_rows(left, right.drop("v"), ["k"])


def test_equal_and_empty_copies(spark, copies):
    a = spark.createDataFrame(copies[0], SCHEMA)
    assert R.differing_ranges(a, a, ["k"]) == ([], False)
    assert R.reconcile_rows(a, a, ["k"]).count() == 0
    none = a.limit(0)
    assert R.reconcile_rows(none, none, ["k"]).count() == 0
    assert {r["status"] for r in R.reconcile_rows(a, none, ["k", "n"]).collect()} == {"lost"}
    assert {r["status"] for r in R.reconcile_rows(none, a, ["k", "n"]).collect()} == {"added"}


def test_reads_only_ranges_that_differ(spark):
    path = scratch_path(spark, "reconcile")
    spark.range(100_000).selectExpr("id AS k", "id % 7 AS v").repartitionByRange(8, "k").write.parquet(path)
    a = spark.read.parquet(path)
    b = a.selectExpr("k", "CASE WHEN k BETWEEN 41000 AND 41010 THEN -1 ELSE v END AS v")
    ranges, _ = R.differing_ranges(a, b, ["k"], leaf_rows=100)
    assert sum(hi - lo + 1 for lo, hi in ranges) < 100 and ranges[0][0] <= 41000 and ranges[-1][1] >= 41010
    out = R.reconcile_rows(a, b, ["k"], leaf_rows=100)
    assert sorted(r["k"] for r in out.collect()) == list(range(41000, 41011))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k," in plan  # the range reaches the Parquet scan


def test_many_ranges_are_joined_not_dropped():
    ranges = [(i * 10, i * 10 + i % 7) for i in range(50)]
    out = R._joined(ranges, 5)
    assert len(out) == 5 and all(any(lo >= a and hi <= b for a, b in out) for lo, hi in ranges)


def test_many_ranges_are_one_lookup_and_lose_no_place(spark):
    """Hundreds of comparisons a row cost more than the row: a filter's size does not grow with the ranges."""
    from pyspark.sql import functions as F

    from laketide.operators import reconcile as R
    ranges = [(i * 1000, i * 1000 + i % 300) for i in range(-100, 100)]
    df = spark.range(-101_000, 101_000)
    got = {r.id for r in df.where(R._inside(F.col("id"), ranges, False)).collect()}
    want = {p for lo, hi in ranges for p in range(lo, hi + 1)}
    assert want <= got and len(got) < 1.3 * len(want)
    plan = df.where(R._inside(F.col("id"), ranges, False))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(">=") <= 20
    far = [((1 << 63) - 10 * i - 5, (1 << 63) - 10 * i - 2) for i in range(1, 30)] + [(-(1 << 63), -(1 << 63) + 3)]
    ends = spark.createDataFrame([(p,) for lo, hi in far for p in (lo, hi)] + [(0,), (None,)], "id long")
    assert ends.where(R._inside(F.col("id"), far, False)).count() >= 2 * len(far)
    assert ends.where(R._inside(F.col("id"), far, True) & F.col("id").isNull()).count() == 1
