"""A1-A4: subtotals, trends, top-n, cross-organisation linking."""

import datetime as dt

from pyspark.sql import functions as F

from laketide.operators import report
from conftest import SF_SMALL, rows


def _sales(spark):
    return spark.createDataFrame(
        [("EU", "a", 2020, 1), ("EU", "b", 2020, 2), ("EU", "a", 2021, 3), ("US", "a", 2021, 4)],
        "region string, seg string, yr int, amt int")


def test_rollup_cube_sets(spark):
    df = _sales(spark)
    m = {"total": F.sum("amt")}
    r = {(x["region"], x["seg"], x["gid"]): x["total"]
         for x in report.management_report(df, ["region", "seg"], m, "rollup").collect()}
    assert r[(None, None, 3)] == 10 and r[("EU", None, 1)] == 6 and r[("EU", "a", 0)] == 4
    assert (None, "a", 2) not in r
    c = {(x["region"], x["seg"], x["gid"]): x["total"]
         for x in report.management_report(df, ["region", "seg"], m, "cube").collect()}
    assert c[(None, "a", 2)] == 8
    g = report.management_report(df, ["region", "seg"], m, [["region"], []]).collect()
    assert sorted((x["region"], x["total"]) for x in g if x["region"]) == [("EU", 6), ("US", 4)]
    assert len(g) == 3


def test_trend(spark):
    D = dt.datetime
    df = spark.createDataFrame(
        [("p", D(2024, 1, 5), 10), ("p", D(2024, 1, 20), 5), ("p", D(2024, 2, 1), 30),
         ("p", D(2024, 3, 1), 20), ("q", D(2024, 1, 1), 7)],
        "part string, ts timestamp_ntz, v int")
    got = rows(report.trend(df, ["part"], "ts", F.col("v"), width=2))
    assert got == [
        ("p", dt.date(2024, 1, 1), 15.0, 15.0, 15.0, None),
        ("p", dt.date(2024, 2, 1), 30.0, 45.0, 22.5, 15.0),
        ("p", dt.date(2024, 3, 1), 20.0, 65.0, 25.0, -10.0),
        ("q", dt.date(2024, 1, 1), 7.0, 7.0, 7.0, None),
    ]


def test_top_n_ties_total_order(spark):
    df = spark.createDataFrame([("g", 3, 10.0), ("g", 1, 10.0), ("g", 2, 9.0), ("g", 4, 10.0),
                                ("h", 5, 1.0)], "grp string, id int, m double")
    got = rows(report.top_n(df, ["grp"], "m", 2, ["id"]))
    assert got == [("g", 1, 10.0, 1), ("g", 3, 10.0, 2), ("h", 5, 1.0, 1)]
    plan = report.top_n(df, ["grp"], "m", 2, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cross_org_link(spark):
    left = spark.createDataFrame([("t1", 5), ("t1", 7), ("t2", 1), (None, 3)], "tok string, x int")
    right = spark.createDataFrame([("t1",), ("t3",), ("t3",)], "tok string")
    linked = report.cross_org_link(left, right, "tok", {"n_l": F.count(F.lit(1)), "s": F.sum("x")},
                                   {"n_r": F.count(F.lit(1))})
    got = {r["tok"]: (r["n_l"], r["s"], r["n_r"], r["side"]) for r in linked.collect()}
    assert got == {"t1": (2, 12, 1, "both"), "t2": (1, 1, None, "left_only"),
                   "t3": (None, None, 2, "right_only")}
    summ = {r["side"]: r["n_tokens"] for r in report.link_summary(linked, ["n_l"]).collect()}
    assert summ == {"both": 1, "left_only": 1, "right_only": 1}


def test_trend_without_partition_and_bad_mode(spark):
    D = dt.datetime
    df = spark.createDataFrame([(D(2024, 1, 5), 10), (D(2024, 2, 1), 30)], "ts timestamp_ntz, v int")
    got = rows(report.trend(df, [], "ts", F.col("v"), width=3))
    assert got == [(dt.date(2024, 1, 1), 10.0, 10.0, 10.0, None), (dt.date(2024, 2, 1), 30.0, 40.0, 20.0, 20.0)]
    try:
        report.management_report(_sales(spark), ["region"], {"t": F.sum("amt")}, "rolup")
    except ValueError:
        return
    raise AssertionError("bad mode accepted")


def test_trend_rejects_unknown_period(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), 10)], "ts timestamp_ntz, v int")
    try:
        report.trend(df, [], "ts", F.col("v"), period="fortnight")
    except ValueError:
        return
    raise AssertionError("unknown period accepted")


def test_trend_goes_by_the_calendar(spark):
    D = dt.datetime
    df = spark.createDataFrame([(D(2024, 1, 5), 10), (D(2024, 2, 1), 30), (D(2024, 9, 1), 6), (None, 1)], "ts timestamp_ntz, v int")
    got = {r[0]: tuple(r)[1:] for r in report.trend(df, [], "ts", F.col("v"), width=3).collect()}
    assert got[dt.date(2024, 9, 1)][2:] == (6.0, None) and got[dt.date(2024, 2, 1)][2:] == (20.0, 20.0)
    assert got[None][2:] == (None, None)
    for period, n in (("year", 1), ("quarter", 2), ("week", 3), ("day", 3)):
        assert report.trend(df.where("ts IS NOT NULL"), [], "ts", F.col("v"), period=period).count() == n


def test_subtotals_expand_groups_not_facts(spark):
    import __spark_entry__ as E
    for name in ("a1_management_report", "a1_report_cube", "a1_report_grouping_sets"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Expand"):]
        assert "Aggregate" in below[:below.index("Relation")], name
    plan = E.queries()["a3_top_parts_by_revenue"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [l_partkey" in plan[plan.index("Join"):]


def test_no_margin_gives_a_hidden_cell_back(spark):
    import random
    rng = random.Random(8)
    data = [(rng.choice("abc"), rng.choice(["x", "y", None]), rng.choice([1, 2, 2, 3, 3, 3])) for _ in range(260)] + [("d", "x", 1)] * 2
    dims = ["p", "q", "r"]
    cube = report.management_report(spark.createDataFrame(data, "p string, q string, r int"), dims,
                                    {"n": F.count(F.lit(1)), "total": F.sum("r")}, "cube")
    out = report.protect_subtotals(cube, dims, "n", 8, ["total"]).collect()
    whole = {(r["p"], r["q"], r["r"], r["gid"]): r["n"] for r in cube.collect()}
    assert len(out) == len(whole)
    hidden = {}
    for r in out:
        at = (r["p"], r["q"], r["r"], r["gid"])
        hidden[at] = r["hidden"]
        assert (r["n"], r["total"] is None) == ((None, True) if r["hidden"] else (whole[at], False))
        assert (r["hidden"] == "small") == (whole[at] < 8)
    assert "margin" in hidden.values() and None in hidden.values()
    for i in range(3):
        bit, lines = 4 >> i, {}
        for at, h in hidden.items():
            lines.setdefault((*[v for j, v in enumerate(at[:3]) if j != i], at[3] & ~bit), []).append(h)
        assert all(sum(h is not None for h in line) != 1 for line in lines.values())
    # Nothing to hide, and a report without totals: nothing more is hidden.
    assert not [r for r in report.protect_subtotals(cube, dims, "n", 1).collect() if r["hidden"]]
    fine = cube.where("gid = 0")
    assert {r["hidden"] for r in report.protect_subtotals(fine, dims, "n", 8).collect()} <= {None, "small"}
    assert report.protect_subtotals(cube.limit(0), dims, "n", 8).count() == 0
