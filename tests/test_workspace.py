"""W1-W4: governed extracts, cohorts, profiles, frequent item sets."""

import re

import pytest
from pyspark.sql import functions as F

from laketide.functions import keyed
from laketide.operators import mining, workspace
from laketide.operators.privacy import pseudonymise
from conftest import SF_SMALL, rows


def _customers(spark):
    return spark.read.parquet(f"{SF_SMALL}/customer.parquet")


def _geo(spark):
    n = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    r = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")


def test_open_and_strict_policy_on_one_table(spark):
    key = keyed.key_table(spark, b"main key for tests")
    cust = _customers(spark)
    open_p = workspace.Policy("customer", ["c_custkey", "c_mktsegment", "c_acctbal"],
                              tokenise={"c_custkey": "customer"})
    strict_p = workspace.Policy(
        "customer", ["c_custkey", "c_nationkey", "c_mktsegment"], row_filter="c_acctbal > 0",
        tokenise={"c_custkey": "customer"},
        generalise={"c_nationkey": ("lookup", _geo(spark), "n_nationkey", "r_name")},
        quasi=["c_nationkey", "c_mktsegment"], k=3, unit="c_custkey")
    a = workspace.workspace_extract(spark, open_p, "open_ws", key, source=cust)
    b = workspace.workspace_extract(spark, strict_p, "strict_ws", key, source=cust)
    assert a.count() == cust.count() and a.columns == ["c_custkey", "c_mktsegment", "c_acctbal"]
    # strict: row filter, generalised, and every quasi group has at least k rows
    sizes = [r["count"] for r in b.groupBy("c_nationkey", "c_mktsegment").count().collect()]
    assert sizes and min(sizes) >= 3
    assert b.count() <= cust.where("c_acctbal > 0").count()
    # workspaces cannot join each other's tokens, nor the main lake's
    ta = {r["c_custkey"] for r in a.collect()}
    tb = {r["c_custkey"] for r in b.collect()}
    main = {r["c_custkey"] for r in pseudonymise(cust, ["c_custkey"], key, "customer").collect()}
    assert not (ta & tb) and not (ta & main) and not (tb & main)


def test_extract_published_to_workspace(spark):
    from laketide.session import scratch_path
    key = keyed.key_table(spark, b"main key for tests")
    cust = _customers(spark)
    p = workspace.Policy("customer", ["c_custkey", "c_mktsegment"], tokenise={"c_custkey": "customer"})
    lake = scratch_path(spark, "test-ws-lake")
    out = workspace.workspace_extract(spark, p, "ws_pub", key, source=cust, lake_root=lake)
    assert out.count() == cust.count()
    assert spark.table("ws_pub.customer").count() == cust.count()


def test_extract_leaks_no_identifiers(spark):
    key = keyed.key_table(spark, b"main key for tests")
    cust = _customers(spark)
    p = workspace.Policy("customer", ["c_custkey", "c_name", "c_mktsegment"],
                         tokenise={"c_custkey": "customer", "c_name": "customer_name"})
    out = workspace.workspace_extract(spark, p, "ws", key, source=cust).collect()
    names = {r["c_name"] for r in cust.collect()}
    ids = {str(r["c_custkey"]) for r in cust.collect()}
    for r in out:
        assert r["c_name"] not in names and r["c_custkey"] not in ids
        assert re.fullmatch("[0-9a-f]{64}", r["c_custkey"])


def test_sample_cohort_same_people_everywhere(spark):
    cust = _customers(spark)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    c = {r["c_custkey"] for r in workspace.sample_cohort(cust, "c_custkey", "s1", 30).collect()}
    o = {r["o_custkey"] for r in workspace.sample_cohort(orders, "o_custkey", "s1", 30).collect()}
    e = {r["user_id"] for r in workspace.sample_cohort(events, "user_id", "s1", 30).collect()}
    assert o <= c and e <= c and 0 < len(c) < cust.count()
    assert o == c & {r["o_custkey"] for r in orders.collect()}
    other = {r["c_custkey"] for r in workspace.sample_cohort(cust, "c_custkey", "s2", 30).collect()}
    assert other != c


def test_profile_exact_and_approx(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a"), (None, "c")], "x int, s string")
    got = {r["column_name"]: r for r in workspace.profile(df).collect()}
    x = got["x"]
    assert (x["n"], x["n_null"], x["n_distinct"], x["min"], x["max"], x["mean"]) == (4, 1, 4, 1.0, 4.0, 2.5)
    assert (x["p25"], x["p50"], x["p75"]) == (1.75, 2.5, 3.25)
    s = got["s"]
    assert (s["n"], s["n_null"], s["n_distinct"], s["min"]) == (4, 1, 3, None)
    assert x["quantile_method"] == "exact" and s["quantile_method"] is None
    approx = {r["column_name"]: r for r in workspace.profile(df, exact=False).collect()}
    assert approx["x"]["n_distinct"] == 4 and approx["x"]["p50"] in (2.0, 3.0)
    assert approx["x"]["quantile_method"] == "approx"
    # cutting long stretches of values gives the same numbers
    cut = {r["column_name"]: r for r in workspace.profile(df, final_values=1).collect()}
    assert (cut["x"]["p25"], cut["x"]["p50"], cut["x"]["p75"]) == (1.75, 2.5, 3.25)
    none = workspace.profile(df.limit(0)).collect()
    assert [tuple(r)[:4] for r in none] == [("x", 0, 0, 0), ("s", 0, 0, 0)]


def _quantiles(df, qs, final_values):
    freq = workspace.value_counts(df, ["x"])
    return workspace.exact_quantiles(freq, {0: df.where("x IS NOT NULL").count()}, qs, final_values)[0]


def test_exact_quantiles_match_percentile(spark):
    import random
    rnd = random.Random(3)
    # a hot value holding a third of the rows, long tail, duplicates, nulls
    vals = [7.0] * 400 + [rnd.choice([rnd.random() * 1000, float(rnd.randint(0, 50))]) for _ in range(800)]
    vals += [None] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    got = _quantiles(df, qs, 20)
    want = df.agg(F.percentile("x", qs)).first()[0]
    assert got == want


def test_mine_itemsets_baskets(spark):
    # five baskets, one with a repeated item; supports worked out by hand
    data = [(1, "bread"), (1, "milk"), (1, "milk"), (2, "bread"), (2, "butter"), (3, "milk"),
            (3, "bread"), (3, "butter"), (4, "beer"), (5, "bread"), (5, "milk")]
    df = spark.createDataFrame(data, "basket long, item string")
    itemsets, rules = mining.mine_itemsets(df, "basket", "item", support=0.4, confidence=0.6)
    got = {",".join(r["items"]): (r["freq"], r["support"]) for r in itemsets.collect()}
    assert got == {"bread": (4, 0.8), "milk": (3, 0.6), "butter": (2, 0.4),
                   "bread,milk": (3, 0.6), "bread,butter": (2, 0.4)}
    rl = {(",".join(r["antecedent"]), ",".join(r["consequent"])): r["confidence"] for r in rules.collect()}
    assert rl == {("milk", "bread"): 1.0, ("bread", "milk"): 0.75, ("butter", "bread"): 1.0}


def test_exact_quantiles_with_infinities(spark):
    vals = [float("-inf"), 1.0, 2.0, 2.0, 3.0, float("inf"), float("inf")] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.1, 0.5, 0.9]
    got = _quantiles(df, qs, 2)
    want = df.agg(F.percentile("x", qs)).first()[0]
    assert got == want


def test_policy_with_k_needs_a_unit(spark):
    p = workspace.Policy("customer", ["c_mktsegment"], quasi=["c_mktsegment"], k=3)
    with pytest.raises(ValueError):
        workspace.workspace_extract(spark, p, "ws", keyed.key_table(spark, b"k"), source=_customers(spark))


def test_small_cohorts_are_not_rounded_away(spark):
    ids = spark.range(1_000_000)
    n = workspace.sample_cohort(ids, "id", "s", 0.004).count()
    assert 15 <= n <= 75
    for pct in (1e-12, -1, 101):
        with pytest.raises(ValueError):
            workspace.sample_cohort(ids, "id", "s", pct)


def test_sample_cohort_bounds(spark):
    cust = _customers(spark)
    assert workspace.sample_cohort(cust, "c_custkey", "s", 0).count() == 0
    assert workspace.sample_cohort(cust, "c_custkey", "s", 100).count() == cust.count()


def test_profile_keeps_every_digit(spark):
    from decimal import Decimal as D
    big = 1 << 53
    rows_ = [(big + i, D("12345678901234567.25") + i, float(i), None) for i in (0, 1, 2)] + [(None, None, float("nan"), None)]
    df = spark.createDataFrame(rows_, "k long, m decimal(20,2), f double, none int")
    for cut in (workspace.FINAL_VALUES, 1):
        got = {r["column_name"]: r for r in workspace.profile(df, decimal_scale=2, final_values=cut).collect()}
        k, m = got["k"], got["m"]
        assert (k["n"], k["n_null"], k["n_distinct"], k["min"], k["max"], k["mean"]) == (3, 1, 3, big, big + 2, big + 1)
        assert (k["p25"], k["p50"], k["p75"]) == (big + D("0.5"), big + 1, big + D("1.5"))
        assert (m["min"], m["mean"], m["p75"]) == (D("12345678901234567.25"), D("12345678901234568.25"), D("12345678901234568.75"))
        assert got["f"]["max"] is None and got["f"]["p50"] == D("1.50")  # NaN has no decimal
        assert (got["none"]["n"], got["none"]["min"]) == (0, None)
    # Longs at both ends do not overflow the total; places that do not fit beside wide decimals fall back to doubles.
    ends = spark.createDataFrame([((1 << 63) - 1, D("9" * 37 + ".5"))] * 3 + [(-(1 << 63), D("1.5"))], "k long, w decimal(38,1)")
    got = {r["column_name"]: r for r in workspace.profile(ends).collect()}
    assert got["k"]["max"] == float((1 << 63) - 1) and got["w"]["n_distinct"] == 2 and abs(got["w"]["mean"] / 7.5e36 - 1) < 1e-12
    assert workspace.value_kinds(spark.createDataFrame([], "a decimal(38,0), b decimal(38,30), c long"), ["a", "b", "c"]) == \
        {"a": "d", "b": "x", "c": "d"}


def test_targets_of_one_stretch_share_its_reading(spark, monkeypatch):
    """All three quartiles begin with the whole column: it is read for one of them, not for each."""
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("double").alias("x"))
    freq = workspace.value_counts(df, ["x"])
    sides, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, *a, **k: sides.append(len(rows)) or create(self, rows, *a, **k))
    got = workspace.exact_quantiles(freq, {0: 5000}, (0.25, 0.5, 0.75), 500)
    assert got == {0: [1249.75, 2499.5, 3749.25]} and sides[0] == 1
