"""R1-R5: dimensions, facts, history, quality report, JSON."""

import datetime as dt

from pyspark.sql import functions as F

from laketide.operators import model
from conftest import rows

T = dt.datetime


def test_build_dimension_unknown_member_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "c", "y"), (None, "z", "z")],
                               "k long, name string, grp string")
    dim = model.build_dimension(df, ["k"], ["name", "grp"], unknown={"name": "Unknown"})
    got = {r["k"]: r for r in dim.collect()}
    assert set(got) == {1, 2, None}
    assert got[1]["name"] == "b"  # greatest attribute tuple wins, deterministically
    assert got[None]["dim_key"] == model.UNKNOWN_KEY and got[None]["name"] == "Unknown"
    import hashlib
    assert got[2]["dim_key"] == hashlib.sha256(b"1:2").hexdigest()


def test_build_fact_orphans(spark):
    # matched, unmatched, null foreign key, duplicate key in the dimension
    dim_src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "k long, name string")
    dim = model.build_dimension(dim_src, ["k"], ["name"])
    facts = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 2)], "fact_id long, dim_id long")
    out = model.build_fact(facts, [model.DimRef(dim, ["dim_id"], ["k"], "dim_key")])
    got = {r["fact_id"]: r["dim_key"] for r in out.collect()}
    assert len(got) == 4 and out.count() == 4  # no fan-out from the duplicated key
    import hashlib
    assert got[10] == hashlib.sha256(b"1:1").hexdigest()
    assert got[13] == hashlib.sha256(b"1:2").hexdigest()
    assert got[11] == model.UNKNOWN_KEY and got[12] == model.UNKNOWN_KEY


def test_history_scd2_states(spark):
    # A, A, B, A; two rows at one time; one row only
    data = [(1, T(2024, 1, 1), "A"), (1, T(2024, 1, 2), "A"), (1, T(2024, 1, 3), "B"),
            (1, T(2024, 1, 4), "A"),
            (2, T(2024, 1, 1), "A"), (2, T(2024, 1, 1), "B"), (2, T(2024, 1, 5), "B"),
            (3, T(2024, 2, 1), "C")]
    df = spark.createDataFrame(data, "key long, ts timestamp_ntz, state string")
    got = rows(model.history_scd2(df, "key", "ts", ["state"]))
    assert got == [
        (1, "A", T(2024, 1, 1), T(2024, 1, 3), False),
        (1, "A", T(2024, 1, 4), None, True),
        (1, "B", T(2024, 1, 3), T(2024, 1, 4), False),
        (2, "A", T(2024, 1, 1), T(2024, 1, 1), False),
        (2, "B", T(2024, 1, 1), None, True),
        (3, "C", T(2024, 2, 1), None, True),
    ]


def test_quality_report_fixture(spark):
    facts = spark.createDataFrame([(1, 1), (2, 9), (3, None), (3, 1)], "fact_id long, dim_id long")
    dims = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b")], "id long, name string")
    R = model.Rule
    src = facts.where("dim_id IS NOT NULL")
    rep = model.quality_report({"facts": facts, "dims": dims, "src": src}, [
        R("facts", "rows"), R("facts", "nulls", ["dim_id"]),
        R("facts", "duplicate_keys", ["fact_id"]), R("dims", "duplicate_keys", ["id"]),
        R("facts", "orphans", ["dim_id"], "dims", ["id"]),
        R("facts", "reconcile", ref_table="src", measures=["fact_id"]),
    ])
    got = {(r["table_name"], r["check"], r["subject"]): r["value"] for r in rep.collect()}
    assert got[("facts", "rows", "*")] == 4
    assert got[("facts", "nulls", "dim_id")] == 1
    assert got[("facts", "duplicate_keys", "fact_id:keys")] == 1
    assert got[("facts", "duplicate_keys", "fact_id:extra_rows")] == 1
    assert got[("dims", "duplicate_keys", "id:keys")] == 1
    assert got[("facts", "orphans", "dim_id->dims.id")] == 1
    assert got[("facts", "null_foreign_keys", "dim_id->dims.id")] == 1
    assert got[("facts", "reconcile", "source:rows")] == 3
    assert got[("facts", "reconcile", "target:rows")] == 4
    assert got[("facts", "reconcile", "source:sum(fact_id)")] == 6
    assert got[("facts", "reconcile", "target:sum(fact_id)")] == 9
    assert got[("facts", "reconcile", "difference:sum(fact_id)")] == 3 and got[("facts", "reconcile", "difference:rows")] == 1


def test_flatten_json_props(spark):
    # valid, missing field, wrong type, broken JSON, null
    df = spark.createDataFrame(
        [(1, '{"k": 5, "s": "x"}'), (2, '{"s": "y"}'), (3, '{"k": "abc", "s": "z"}'),
         (4, '{"k": 5'), (5, None)], "id long, props string")
    out = model.flatten_json(df, "props", "k int, s string")
    assert out.columns == ["id", "k", "s"]
    got = {r["id"]: (r["k"], r["s"]) for r in out.collect()}
    assert got[1] == (5, "x") and got[2] == (None, "y")
    assert got[3][0] is None
    assert got[4] == (None, None) and got[5] == (None, None)


def test_history_scd2_slices_match_single_slice(spark):
    # One hot key over many months plus small keys: sliced result equals unsliced.
    import random
    rnd = random.Random(7)
    data = [(0, T(2020, 1, 1) + dt.timedelta(hours=7 * i), rnd.choice("AB")) for i in range(3000)]
    data += [(k, T(2020, 1 + (i % 12), 1 + i), rnd.choice("ABC")) for k in range(1, 40) for i in range(20)]
    df = spark.createDataFrame(data, "key long, ts timestamp_ntz, state string")
    sliced = rows(model.history_scd2(df, "key", "ts", ["state"], slice_unit="week"))
    whole = rows(model.history_scd2(df, "key", "ts", ["state"], slice_unit=None))
    assert sliced == whole
    # brute force on the hot key
    hot = sorted((t, s) for k, t, s in data if k == 0)
    runs = [(t, s) for i, (t, s) in enumerate(hot) if i == 0 or hot[i - 1][1] != s]
    got = [(r[2], r[1]) for r in sliced if r[0] == 0]
    assert sorted(got) == runs


def test_composite_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 2), ("a:b", "c", 3), ("", "1:x", 4)], "k string, l string, v int")
    dim = model.build_dimension(df, ["k", "l"], ["v"])
    assert len({r["dim_key"] for r in dim.collect()}) == 5


def test_history_of_null_keys_and_times(spark):
    data = [(None, T(2024, 1, d), "A") for d in (1, 2, 3)] + [(None, T(2024, 1, 4), "B"), (None, None, "A"), (1, None, "A"), (1, T(2024, 1, 1), "A")]
    df = spark.createDataFrame(data, "key long, ts timestamp_ntz, state string")
    got = rows(model.history_scd2(df, "key", "ts", ["state"], slice_unit="day"))
    assert got == rows(model.history_scd2(df, "key", "ts", ["state"], slice_unit=None))
    assert got == [(1, "A", None, None, True), (None, "A", None, T(2024, 1, 4), False), (None, "B", T(2024, 1, 4), None, True)]


def test_totals_keep_their_cents(spark):
    a = spark.createDataFrame([("9999999999999999.01",), ("9999999999999999.01",)], "v string").selectExpr("CAST(v AS decimal(30,2)) AS v")
    b = spark.createDataFrame([("9999999999999999.01",), ("9999999999999999.02",)], "v string").selectExpr("CAST(v AS decimal(30,2)) AS v")
    rep = model.quality_report({"a": a, "b": b}, [model.Rule("b", "reconcile", ref_table="a", measures=["v"])])
    got = {r["subject"]: str(r["value"]) for r in rep.collect()}
    assert got["difference:sum(v)"] == "0.01" and got["source:sum(v)"] == "19999999999999998.02"


def test_reconciliation_does_not_round_rows(spark):
    from decimal import Decimal as D
    schema = "x double, m decimal(10,4), n long"
    source = spark.createDataFrame([(0.004, D("0.0040"), 9_000_000_000_000_000_000)] * 1000, schema)
    target = spark.createDataFrame([(0.0, D("0.0000"), 9_000_000_000_000_000_000)] * 999 + [(0.0, D("0.0000"), 8_999_999_999_999_999_999)], schema)
    report = model.quality_report({"s": source, "t": target}, [model.Rule("t", "reconcile", ref_table="s", measures=["x", "m", "n"])])
    value = {r["subject"]: r["value"] for r in report.collect()}
    assert value["source:sum(x)"] == value["source:sum(m)"] == D("4.00")
    assert value["difference:sum(x)"] == value["difference:sum(m)"] == D("-4.00")
    assert value["difference:sum(n)"] == D("-1.00") and value["difference:rows"] == D("0.00")
    # A difference below a cent is still one.
    few = spark.createDataFrame([(0.004, D("0.0040"), 1)], schema)
    value = {r["subject"]: r["value"] for r in model.quality_report(
        {"s": few, "t": few.withColumn("x", F.lit(0.003))}, [model.Rule("t", "reconcile", ref_table="s", measures=["x", "m"])]).collect()}
    assert value["difference:sum(x)"] == D("-0.01") and value["difference:sum(m)"] == D("0.00")


def test_rows_without_a_time_are_reduced_before_they_meet(spark):
    data = [(1, None, "b")] * 500 + [(1, None, "a")] * 500 + [(1, None, None)] * 500
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, s string")
    out = model.history_scd2(df, "k", "ts", ["s"])
    assert sorted((r["s"] or "", r["is_current"]) for r in out.collect()) == [("", False), ("a", False), ("b", True)]
    assert "Aggregate" in out._jdf.queryExecution().optimizedPlan().toString()
