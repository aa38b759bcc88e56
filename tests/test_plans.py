"""Plan properties of every registered query (scale rules made checkable)."""

import re

import pytest

import __spark_entry__ as E
from laketide.functions import keyed
from laketide.plans import catalog as C
from laketide.plans.oracle import MAIN_PADS, WORKSPACE_PADS

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df):
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + "\n" + qe.executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(E.queries()[name](spark, SF)) for name in C.QUERIES}


def test_no_cross_products_or_python_in_any_plan(plans):
    for name, text in plans.items():
        for bad in FORBIDDEN:
            assert bad not in text, (name, bad)


def test_no_key_material_in_any_plan(plans):
    needles = [C.TEST_KEY.hex(), *MAIN_PADS, *WORKSPACE_PADS]
    for name, text in plans.items():
        low = text.lower()
        for n in needles:
            assert n not in low, name


def test_partial_aggregation_before_shuffle(spark):
    from laketide.sources.storage import newest_per_key
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    dfs = {name: E.queries()[name](spark, SF)
           for name in ("r1_build_dimension", "a4_cross_org_link", "p6_suppress_small_cells",
                        "a1_management_report", "a2_trend")}
    dfs["s5 newest_per_key"] = newest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    for name, df in dfs.items():
        text = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"partial_(max|count|sum)", text), name


def test_scans_read_only_needed_columns(spark):
    df = E.queries()["a1_management_report"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    line = [s for s in schemas if "l_orderkey" in s][0]
    assert line == "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>"


def test_no_round_robin_and_no_broadcast_hint(spark, plans):
    """Bytes decide broadcasts (only one-row sides may be hinted); scans are not dealt anew."""
    for name, text in plans.items():
        assert "RoundRobinPartitioning" not in text, name
    for name in ("p5_generalise_customers", "r2_build_fact", "p3_reidentify"):
        analyzed = E.queries()[name](spark, SF)._jdf.queryExecution().analyzed().toString()
        assert "strategy=broadcast" not in analyzed, name


def test_cluster_settings_follow_the_input():
    from laketide.session import cluster_conf
    assert cluster_conf(100 * 10**12)["spark.sql.shuffle.partitions"] == "372530"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"


def test_declared_table_schemas_match_files(spark):
    from laketide.plans.tables import TABLES
    for name, schema in TABLES.items():
        inferred = spark.read.parquet(f"{SF}/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in schema], name


def test_history_windows_partition_by_key_and_slice(spark):
    import datetime as dt
    from laketide.operators.model import history_scd2
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, d), "A") for d in range(1, 20)],
                               "key long, ts timestamp_ntz, state string")
    text = history_scd2(df, "key", "ts", ["state"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(key#\d+L, __slice#\d+", text)
    # per-key windows only run over the one-row-per-slice summaries
    for m in re.finditer(r"Window \[.*?windowspecdefinition\(([^)]*)\)", text):
        assert "__slice" in m.group(1), m.group(1)
