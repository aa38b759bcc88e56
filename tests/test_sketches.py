"""Stored sketches against exact figures: late loads, repeated loads, nulls, a hot period, errors that must be seen."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from laketide.operators import sketches as S
from laketide.session import scratch_path

SCHEMA = "d date, k long, v double, s string"
COLUMNS = ["k", "v", "s"]


def part():
    return {"month": F.trunc("d", "month")}


def year():
    return {"year": F.year("month")}


def data(spark):
    """Two years of months; one month holds a third of the rows, one value of ``s`` a third of all values."""
    i = F.col("id")
    month = F.when(i % 3 == 0, 5).otherwise(i % 24).cast("int")
    return spark.range(60_000).select(
        F.add_months(F.lit(date(2020, 1, 1)), month).alias("d"), (i * 7919 % 20_011).alias("k"),
        F.when(i % 10 != 0, F.when(i % 10 == 1, float("nan")).otherwise((i * 31 % 9_973).cast("double") / 7)).alias("v"),
        F.when(i % 6 < 2, "hot").when(i % 6 == 2, "").when(i % 6 == 3, None).otherwise(F.concat(F.lit("s"), i.cast("string"))).alias("s"))


def test_loads_merge_and_keep_the_bounds(spark):
    rows = data(spark)
    path = scratch_path(spark, "sketches") + "/t"
    for load, of in (("first", F.col("k") % 5 != 0), ("late", F.col("k") % 5 == 0), ("late", F.col("k") % 5 == 0)):
        stored = S.store_sketches(rows.where(of), part(), COLUMNS, path, load, year())
    assert stored.count() == 16 * len(COLUMNS) * 2
    figures = S.merged_figures(stored, year())
    got = S.audit_figures(rows, figures, {"year": F.year("d")}, COLUMNS).collect()
    assert len(got) == 6
    for r in got:
        assert r.counts_equal and r.distinct_within and r.ranks_within and r.heavy_within, r
        exact = rows.where(F.year("d") == r.year).agg(F.count(r.column_name).alias("n"), F.countDistinct(r.column_name).alias("c")).first()
        assert (r.n, r.n_distinct) == (exact.n, exact.c)
    heavy = {r.year: r.heavy for r in figures.where("column_name = 's'").collect()}
    assert all(set(h) == {"hot", ""} for h in heavy.values())


def test_small_groups_are_exact(spark):
    rows = spark.createDataFrame([(date(2021, 1, 1), 1, 0.0, ""), (date(2021, 1, 9), 1, -0.0, None), (date(2021, 2, 1), 2, None, "x"),
                                  (None, None, float("nan"), "y"), (date(2021, 1, 1), 1, 0.0, "")], SCHEMA)
    figures = {(r.year, r.column_name): r for r in S.merged_figures(S.sketch_partitions(rows, part(), COLUMNS), year()).collect()}
    k, v, s = (figures[2021, c] for c in COLUMNS)
    assert (k.n, k.n_null, k.n_distinct, k.quantiles, k.heavy) == (4, 0, 2, [1.0, 1.0, 1.0], {"1": 3, "2": 1})
    assert (v.n, v.n_null, v.n_distinct, v.min, v.max, v.heavy) == (3, 1, 1, 0.0, 0.0, {"0.0": 3})
    assert (s.n, s.n_null, s.n_distinct, s.quantiles, s.heavy) == (3, 1, 2, None, {"": 2, "x": 1})
    none = figures[None, "v"]  # rows without a month are a partition of their own
    assert (none.n, none.n_null, none.quantiles, none.heavy, none.min) == (1, 0, None, {"NaN": 1}, None)
    assert (figures[None, "k"].n, figures[None, "k"].n_distinct, figures[None, "k"].heavy) == (0, 0, {})


def test_audit_sees_wrong_figures(spark):
    rows = data(spark).where("d < '2021-01-01'")
    right = S.merged_figures(S.sketch_partitions(rows, part(), COLUMNS), year())
    by = {"year": F.year("d")}

    def flags(figures):
        return [(r.counts_equal, r.distinct_within, r.ranks_within, r.heavy_within)
                for r in S.audit_figures(rows, figures, by, ["k"]).collect()]

    right = right.where("column_name = 'k'")
    assert flags(right) == [(True,) * 4]
    assert flags(right.withColumn("n", F.col("n") + 1)) == [(False,) * 4]
    assert flags(right.withColumn("n_distinct", F.col("n_distinct") * 11 / 10)) == [(True, False, True, True)]
    assert flags(right.withColumn("quantiles", F.transform("quantiles", lambda q: q * 1.2))) == [(True, True, False, True)]
    assert flags(right.withColumn("heavy", F.create_map(F.lit("absent"), F.lit(1).cast("long")))) == [(True, True, True, False)]
    assert flags(right.withColumn("year", F.lit(1999))) == [(False,) * 4] * 2
    hot = S.merged_figures(S.sketch_partitions(rows, part(), ["s"]), year())
    missed = S.audit_figures(rows, hot.withColumn("heavy", F.map_filter("heavy", lambda i, _: i != "hot")), by, ["s"]).first()
    assert not missed.heavy_within and missed.distinct_within


def test_empty_table_and_parameters(spark):
    empty = spark.createDataFrame([], SCHEMA)
    sketches = S.sketch_partitions(empty, part(), COLUMNS)
    assert sketches.count() == 0 and S.merged_figures(sketches, year()).count() == 0
    assert S.audit_figures(empty, S.merged_figures(sketches, year()), {"year": F.year("d")}, COLUMNS).count() == 0
    with pytest.raises(ValueError):
        S.merged_figures(sketches, year(), share=0.001)


def test_values_are_not_dealt_to_tasks_by_group(spark):
    """All values of a group and column in one task would grow with the table: the figures are sent to the values."""
    rows = data(spark)
    figures = S.merged_figures(S.sketch_partitions(rows, part(), COLUMNS), year())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        audit = S.audit_figures(rows, figures, {"year": F.year("d")}, COLUMNS)
        plan = audit._jdf.queryExecution().executedPlan().toString()
        flags = {(r.counts_equal, r.distinct_within, r.ranks_within, r.heavy_within) for r in audit.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    assert flags == {(True,) * 4}
