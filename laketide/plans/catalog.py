"""Registered queries: each reads the lake's tables (the driver's Parquet
files) and runs one operator, or the flagship composition, over all of them.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the SQL of the same name in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from laketide.functions import keyed
from laketide.operators import history, lattice, linkage, mining, model, privacy, reconcile, report, sequences, sketches, workspace
from laketide.plans.tables import TABLES
from laketide.session import read_table, scratch_path
from laketide.sources import ingest, storage, versions
from laketide.streaming.land import late_rows, stream_land, stream_store

# Fixed, public test key of the registered queries and their SQL oracle.
# It protects nothing: real keys come from a protected one-row table.
TEST_KEY = b"public test key of the registered queries"
CUSTOMER_DOMAIN = "customer"
CUSTOMER_NAME_DOMAIN = "customer_name"
WORKSPACE = "research"
COHORT_SALT = "cohort-2024"
INCREMENT_MARK = "2024-01-15 00:00:00"
K_SMALL_CELLS = 10
SHIP_MARK = "1996-06-30 00:00:00"
LATE_DELAY = "2 days"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name, schema=TABLES[name])


_KEY_TABLES: dict[str, DataFrame] = {}


def _key(spark: SparkSession) -> DataFrame:
    """The test key table, one cached copy per Spark application."""
    app = spark.sparkContext.applicationId
    if app not in _KEY_TABLES:
        _KEY_TABLES[app] = keyed.key_table(spark, TEST_KEY)
    return _KEY_TABLES[app]


def _money(c: str, scale: str = "decimal(12,2)"):
    return F.col(c).cast(scale)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region name (25 rows, joined by the planner as it sees fit)."""
    return (_t(spark, sf_dir, "nation")
            .join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "r_name"))


# ------------------------------------------------------------- flagship (A1)
def a1_management_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by region, market segment and year with subtotals, computed
    without customer identities: customers and orders meet on tokens."""
    key = _key(spark)
    cust = privacy.pseudonymise(
        _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
        ["c_custkey"], key, CUSTOMER_DOMAIN)
    orders = privacy.pseudonymise(
        _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        ["o_custkey"], key, CUSTOMER_DOMAIN)
    # Lines are summed per order before any join (Spark does not push an
    # aggregate below a join by itself): partial sums shrink the fact side
    # before its one shuffle, and that shuffle's key is the orders join key.
    per_order = (_t(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.sum(_money("l_extendedprice")
                            * (F.lit(1) - _money("l_discount", "decimal(4,2)"))).alias("rev"),
                      F.count(F.lit(1)).alias("lines")))
    fact = (per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("r_name", "c_mktsegment", F.year("o_orderdate").alias("o_year"), "rev", "lines"))
    return report.management_report(
        fact, ["r_name", "c_mktsegment", "o_year"],
        {"revenue": F.sum("rev").cast("double"), "n_lines": F.sum("lines")},
        mode="rollup", grain={"rev": F.sum("rev"), "lines": F.sum("lines")})


def _line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year"), "l_quantity",
        (_money("l_extendedprice") * (F.lit(1) - _money("l_discount", "decimal(4,2)"))).alias("rev"))


def _line_report(spark: SparkSession, sf_dir: str, mode) -> DataFrame:
    """Line volume, revenue and count, summed at the finest grain first."""
    return report.management_report(
        _line_fact(spark, sf_dir), ["l_returnflag", "l_linestatus", "ship_year"],
        {"sum_qty": F.sum("qty"), "revenue": F.sum("rev").cast("double"), "n_lines": F.sum("lines")}, mode=mode,
        grain={"qty": F.sum("l_quantity"), "rev": F.sum("rev"), "lines": F.count(F.lit(1))})


def a1_report_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line volume and revenue by return flag, line status and ship year, all subtotals."""
    return _line_report(spark, sf_dir, "cube")


def a1_report_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measures for (flag, status), for ship year alone, and in total."""
    return _line_report(spark, sf_dir, [["l_returnflag", "l_linestatus"], ["ship_year"], []])


K_CUBE = 15


def a1_protected_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and their balances by region, segment and balance band with all subtotals, where cells
    of fewer than 15 customers are hidden and no margin gives one back."""
    cust = _t(spark, sf_dir, "customer").join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    cube = report.management_report(
        cust.select("r_name", "c_mktsegment", F.floor(F.col("c_acctbal") / 2500).alias("band"), _money("c_acctbal").alias("balance")),
        ["r_name", "c_mktsegment", "band"], {"customers": F.sum("n"), "balance": F.sum("balance").cast("double")}, mode="cube",
        grain={"n": F.count(F.lit(1)), "balance": F.sum("balance")})
    return report.protect_subtotals(cube, ["r_name", "c_mktsegment", "band"], "customers", K_CUBE, ["balance"])


# ------------------------------------------------------------------ P1-P6
def p1_pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonymise(
        _t(spark, sf_dir, "customer"),
        {"c_custkey": CUSTOMER_DOMAIN, "c_name": CUSTOMER_NAME_DOMAIN}, _key(spark))


def p2_token_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vault filled from event users, then extended by order customers.
    Tokens are random, so the result is the vault's counts."""
    path = scratch_path(spark, "vault")
    users = _t(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    first, vault = privacy.token_vault(users, None, path, _key(spark))
    buyers = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    new, vault = privacy.token_vault(buyers, vault, path, _key(spark))
    parts = [
        first.agg(F.count(F.lit(1)).alias("value")).withColumn("measure", F.lit("first_batch_ids")),
        new.agg(F.count(F.lit(1)).alias("value")).withColumn("measure", F.lit("second_batch_ids")),
        vault.agg(F.count_distinct("id").alias("value")).withColumn("measure", F.lit("vault_ids")),
        vault.agg(F.count_distinct("token").alias("value")).withColumn("measure", F.lit("vault_tokens")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("measure", "value")


def p3_reidentify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders held under tokens; identities come back only for customers of
    the BUILDING segment (the approved list)."""
    key = _key(spark)
    cust = _t(spark, sf_dir, "customer")
    vault = privacy.pseudonymise(
        cust.select(F.col("c_custkey").alias("token"), F.col("c_custkey").alias("id")),
        ["token"], key, CUSTOMER_DOMAIN)
    approved = privacy.pseudonymise(
        cust.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("token")),
        ["token"], key, CUSTOMER_DOMAIN)
    orders = privacy.pseudonymise(
        _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        ["o_custkey"], key, CUSTOMER_DOMAIN)
    return privacy.reidentify(orders, "o_custkey", vault, approved, id_col="c_custkey")


def p4_mask_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.mask_text(_t(spark, sf_dir, "documents").select("doc_id", "text"), "text")


def p4_mask_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.mask_text(_t(spark, sf_dir, "pages").select("page_id", "html"), "html")


def p5_generalise_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                 "c_mktsegment")
    return privacy.generalise(cust, {
        "c_nationkey": ("lookup", _geo(spark, sf_dir), "n_nationkey", "r_name"),
        "c_acctbal": ("band", 1000)})


def p5_generalise_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_orderdate").alias("o_orderyear"), "o_totalprice")
    return privacy.generalise(orders, {
        "o_orderdate": ("month",), "o_orderyear": ("year",), "o_totalprice": ("band", 10000)})


def p6_suppress_small_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return privacy.suppress_small_cells(cust, ["c_nationkey", "c_mktsegment"], K_SMALL_CELLS)


def p6_mask_small_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return privacy.suppress_small_cells(cust, ["c_nationkey", "c_mktsegment"], K_SMALL_CELLS,
                                        mode="mask")


def p6_k_anonymity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check half of P6: smallest cell and number of cells."""
    cust = _t(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment")
    return privacy.k_anonymity(cust, ["c_nationkey", "c_mktsegment"])


K_LATTICE = 15


def p6_least_generalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' table at the levels of nation, balance and segment that lose least while every group
    has at least 15 customers, found by a search over the lattice of levels."""
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    placed = cust.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    band = lambda w: (F.floor(F.col("c_acctbal") / w) * w).cast("long")
    every = F.lit("*")
    levels = {"c_nationkey": [F.col("c_nationkey"), F.col("r_name"), every],
              "c_acctbal": [band(500), band(1000), band(2000), band(4000), every],
              "c_mktsegment": [F.col("c_mktsegment"), every]}
    best = lattice.search_generalisation(placed, levels, K_LATTICE, unit="c_custkey")
    if best is None:
        return cust.limit(0).withColumn("loss", F.lit(None).cast("double"))
    shown = lattice.at_levels(placed, levels, best).select(*cust.columns)
    return shown.withColumn("loss", F.lit(round(best.loss, 12)))


# ------------------------------------------------------------------ R1-R5
def _part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.build_dimension(
        _t(spark, sf_dir, "part"), ["p_partkey"], ["p_name", "p_brand", "p_type"],
        unknown={"p_name": "Unknown", "p_brand": "Unknown", "p_type": "Unknown"},
        key_name="part_key")


def r1_build_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_dim(spark, sf_dir)


def r2_build_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line facts keyed to the part dimension and to the dimension of active
    suppliers (positive balance); lines of other suppliers get the unknown key."""
    supp_dim = model.build_dimension(
        _t(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0),
        ["s_suppkey"], ["s_name", "s_nationkey"], unknown={"s_name": "Unknown"},
        key_name="supp_key")
    facts = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return model.build_fact(facts, [
        model.DimRef(_part_dim(spark, sf_dir), ["l_partkey"], ["p_partkey"], "part_key"),
        model.DimRef(supp_dim, ["l_suppkey"], ["s_suppkey"], "supp_key")])


def r3_history_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-status history per customer; of several orders on one day the
    highest order key speaks for the day."""
    daily = (_t(spark, sf_dir, "orders")
             .groupBy("o_custkey", "o_orderdate")
             .agg(F.max(F.struct("o_orderkey", "o_orderstatus")).alias("s"))
             .select("o_custkey", "o_orderdate", F.col("s.o_orderstatus").alias("o_orderstatus")))
    return model.history_scd2(daily, "o_custkey", "o_orderdate", ["o_orderstatus"])


def r3_history_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's runs of the same event type, sliced by day."""
    events = _t(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    return model.history_scd2(events, "user_id", "ts", ["event_type"], slice_unit="day")


def r3_history_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the event type over all users' events of no known user: where the
    user id is a multiple of seven it is unknown, and those rows share one null key.
    That key is hot, so slices are minutes."""
    events = _t(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("ts"), "event_type")
    return model.history_scd2(events, "user_id", "ts", ["event_type"], slice_unit="minute")


def r3_history_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-status history per customer, stored and merged from three batches of orders that
    arrive in no order of time; one of them is loaded twice."""
    path = scratch_path(spark, "history") + "/order_status"
    orders = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    deal = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    for n in (0, 1, 2, 1):
        merged = history.merge_history(orders.where(deal == n), "o_custkey", "o_orderdate", ["o_orderstatus"], path, f"batch {n}",
                                       tie_break=["o_orderkey"], slice_unit="year", buckets=2)
    return merged


def r4_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    tables = {
        "lineitem": li,
        "orders": _t(spark, sf_dir, "orders"),
        "customer": _t(spark, sf_dir, "customer"),
        "events": _t(spark, sf_dir, "events"),
        "active_supplier": _t(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0),
        "lineitem_storage": storage.newest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]),
    }
    R = model.Rule
    rules = [
        R("lineitem", "rows"), R("orders", "rows"), R("customer", "rows"),
        R("orders", "nulls", ["o_custkey", "o_orderdate"]),
        R("lineitem", "nulls", ["l_orderkey", "l_partkey", "l_suppkey"]),
        R("lineitem", "duplicate_keys", ["l_orderkey", "l_linenumber"]),
        R("orders", "duplicate_keys", ["o_custkey", "o_orderdate"]),
        R("lineitem", "orphans", ["l_orderkey"], "orders", ["o_orderkey"]),
        R("orders", "orphans", ["o_custkey"], "customer", ["c_custkey"]),
        R("events", "orphans", ["user_id"], "customer", ["c_custkey"]),
        R("lineitem", "orphans", ["l_suppkey"], "active_supplier", ["s_suppkey"]),
        R("lineitem_storage", "reconcile", ref_table="lineitem",
          measures=["l_quantity", "l_extendedprice"]),
    ]
    return model.quality_report(tables, rules)


def r4_reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against a stored copy that lost, changed and doubled lines in some stretches of orders:
    the lines that differ, found through fingerprints of order-key ranges."""
    lines = _t(spark, sf_dir, "lineitem")
    band, at = F.floor(F.col("l_orderkey") / 250) % 23, F.col("l_orderkey") % 7
    path = scratch_path(spark, "copy") + "/lineitem"
    copy = (lines.where(~((band == 4) & (at == 1)))
            .withColumn("l_quantity", F.when((band == 9) & (at == 2), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))))
    copy = copy.unionByName(lines.where((band == 16) & (at == 3)))
    copy.repartitionByRange("l_orderkey").write.parquet(path)
    stored = spark.read.schema(lines.schema).parquet(path)
    return reconcile.reconcile_rows(lines, stored, ["l_orderkey", "l_linenumber"], leaf_rows=2000)


def r5_flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", "props")
    return model.flatten_json(events, "props", "k int")


# ------------------------------------------------------------------ A2-A4
def a2_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    return report.trend(orders, ["o_orderpriority"], "o_orderdate", _money("o_totalprice"),
                        width=3, period="month")


def a2_trend_events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event value per event type with a 7-day moving average."""
    return report.trend(_t(spark, sf_dir, "events"), ["event_type"], "ts", _money("value"),
                        width=7, period="day")


def a2_trend_large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with orders of over 400,000 per priority: a calendar with gaps."""
    large = _t(spark, sf_dir, "orders").where(F.col("o_totalprice") > 400_000)
    return report.trend(large, ["o_orderpriority"], "o_orderdate", _money("o_totalprice"), width=7, period="day")


def a3_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return report.top_n(cust, ["c_nationkey"], "c_acctbal", 3, ["c_custkey"])


def a3_top_parts_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five parts of each brand with the most revenue (ties: lower part key)."""
    # Lines are summed per part before the join: the part table meets one row a part.
    per_part = (_t(spark, sf_dir, "lineitem").groupBy("l_partkey")
                .agg(F.sum(_money("l_extendedprice") * (F.lit(1) - _money("l_discount", "decimal(4,2)"))).alias("rev")))
    rev = (per_part.join(_t(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
           .select("p_brand", "p_partkey", F.col("rev").cast("double").alias("revenue")))
    return report.top_n(rev, ["p_brand"], "revenue", 5, ["p_partkey"])


def a4_cross_org_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one organisation against events of another, linked only on
    customer tokens under a shared key."""
    key = _key(spark)
    left = privacy.pseudonymise(
        _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("token"), "o_totalprice"),
        ["token"], key, CUSTOMER_DOMAIN)
    right = privacy.pseudonymise(
        _t(spark, sf_dir, "events").select(F.col("user_id").alias("token")),
        ["token"], key, CUSTOMER_DOMAIN)
    linked = report.cross_org_link(
        left, right, "token",
        {"n_orders": F.count(F.lit(1)), "order_value": F.sum(_money("o_totalprice"))},
        {"n_events": F.count(F.lit(1))})
    return (report.link_summary(linked, ["n_orders", "order_value", "n_events"])
            .withColumn("order_value", F.col("order_value").cast("double")))


def a4_linkage_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against another organisation's copy with typing errors and keys of its own, linked on encodings of their
    fields: per segment the customers, and whether nine in ten are linked with their own copy and nine in ten
    links are right. Of four customers' copies one is as it was; one lacks a character of the name, one
    has two swapped, one has a digit of the balance mistyped."""
    customers = _t(spark, sf_dir, "customer").withColumn("balance", F.format_string("%.2f", "c_acctbal"))
    kind, at = F.col("c_custkey") % 4, (F.length("c_name") - F.col("c_custkey") % 7).cast("int")
    one = F.lit(1)
    head, first, second = F.substring("c_name", one, at - 2), F.substring("c_name", at - 1, one), F.substring("c_name", at, one)
    tail = F.substring("c_name", at + 1, F.length("c_name"))
    copies = customers.withColumns({
        "c_name": F.when(kind == 1, F.concat(head, first, tail)).when(kind == 2, F.concat(head, second, first, tail)).otherwise(F.col("c_name")),
        "balance": F.when(kind == 3, F.concat(F.lit("7"), F.substring("balance", F.lit(2), F.length("balance")))).otherwise(F.col("balance")),
        "c_custkey": F.col("c_custkey") + F.lit(10_000_000_000)})
    fields = {"c_name": 4, "balance": 8, "c_nationkey": 4, "c_mktsegment": 1}
    # A record costs far more to encode than to send: a table in one small file is dealt to all tasks first.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = [linkage.encode_records(t.select("c_custkey", *fields).repartition(tasks, "c_custkey"), fields, _key(spark)) for t in (customers, copies)]
    links = linkage.mutual_best(linkage.link_encodings(*coded, "c_custkey", "c_custkey", 0.8))
    right = F.col("right_id") - F.lit(10_000_000_000) == F.col("left_id")
    told = customers.select("c_custkey", "c_mktsegment").join(links, F.col("c_custkey") == F.col("left_id"), "left")
    n, linked, true = F.count(F.lit(1)), F.count("right_id"), F.count_if(right)
    return told.groupBy("c_mktsegment").agg(n.alias("n_customers"), (true >= 0.9 * n).alias("recall_reached"),
                                            (true >= 0.9 * linked).alias("precision_reached"))


# ------------------------------------------------------------------ W1-W4
def w1_policy(spark: SparkSession, sf_dir: str) -> workspace.Policy:
    return workspace.Policy(
        table="customer",
        columns=["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"],
        row_filter="c_acctbal > 0",
        tokenise={"c_custkey": CUSTOMER_DOMAIN},
        generalise={"c_nationkey": ("lookup", _geo(spark, sf_dir), "n_nationkey", "r_name"),
                    "c_acctbal": ("band", 2500)},
        quasi=["c_nationkey", "c_mktsegment", "c_acctbal"],
        k=K_SMALL_CELLS, unit="c_custkey")


_LAKES: dict[str, str] = {}


def _lake(spark: SparkSession) -> str:
    """The lake's root folder, one per Spark application (a workspace keeps its place)."""
    return _LAKES.setdefault(spark.sparkContext.applicationId, scratch_path(spark, "lake"))


def w1_workspace_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The research workspace's governed copy of the customer table, written
    to its storage zone and read back through its catalog."""
    return workspace.workspace_extract(spark, w1_policy(spark, sf_dir), WORKSPACE, _key(spark),
                                       source=_t(spark, sf_dir, "customer"),
                                       lake_root=_lake(spark))


def w1_orders_per_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract of orders whose cells hold at least k different customers."""
    policy = workspace.Policy(
        table="orders", columns=["o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"],
        tokenise={"o_custkey": CUSTOMER_DOMAIN},
        generalise={"o_orderdate": ("month",), "o_totalprice": ("band", 100_000)},
        quasi=["o_orderdate", "o_totalprice", "o_orderpriority"], k=K_SMALL_CELLS, unit="o_custkey")
    return workspace.workspace_extract(spark, policy, WORKSPACE, _key(spark), source=_t(spark, sf_dir, "orders"),
                                       lake_root=_lake(spark))


def w2_sample_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workspace.sample_cohort(_t(spark, sf_dir, "orders"), "o_custkey", COHORT_SALT, 10.0)


def w2_sample_cohort_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cohort in another table: events of the sampled customers."""
    return workspace.sample_cohort(_t(spark, sf_dir, "events"), "user_id", COHORT_SALT, 10.0)


def w3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workspace.profile(_t(spark, sf_dir, "lineitem"),
                             ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_quantity", "l_returnflag"])


def w3_profile_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of keys that a double cannot tell apart and of money, every digit kept."""
    lines = _t(spark, sf_dir, "lineitem").select(
        (F.lit(1 << 53) + F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2).alias("line_key"),
        _money("l_extendedprice").alias("price"), F.when(F.col("l_linenumber") < 3, F.col("l_linenumber")).alias("low_number"))
    return workspace.profile(lines, decimal_scale=4)


def w3_stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines sketched by ship month, in two loads that share all months, the second one sent twice; the
    sketches merged by year and held against the exact figures of the lines: the exact figures, and
    whether the merged ones keep their bounds."""
    lines = _t(spark, sf_dir, "lineitem").withColumn("low_number", F.when(F.col("l_linenumber") < 3, F.col("l_linenumber")))
    columns = ["l_partkey", "l_extendedprice", "l_returnflag", "l_discount", "low_number"]
    path = scratch_path(spark, "sketches") + "/lineitem"
    late = F.col("l_orderkey") % 5 == 0
    for load_id, rows in (("first", lines.where(~late)), ("late", lines.where(late)), ("late", lines.where(late))):
        stored = sketches.store_sketches(rows, {"ship_month": F.trunc("l_shipdate", "month")}, columns, path, load_id,
                                         {"ship_year": F.year("ship_month")})
    figures = sketches.merged_figures(stored, {"ship_year": F.year("ship_month")})
    return sketches.audit_figures(lines, figures, {"ship_year": F.year("l_shipdate")}, columns)


def _brand_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
            .join(_t(spark, sf_dir, "part").select("p_partkey", "p_brand"),
                  F.col("l_partkey") == F.col("p_partkey"))
            .select("l_orderkey", "p_brand"))


def _mined(spark: SparkSession, sf_dir: str):
    return mining.mine_itemsets(_brand_baskets(spark, sf_dir), "l_orderkey", "p_brand",
                                support=0.01, confidence=0.1)


def w4_mine_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    itemsets, _ = _mined(spark, sf_dir)
    return itemsets.select(F.array_join("items", ",").alias("items"), "size", "freq", "support")


def w4_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rules = _mined(spark, sf_dir)
    return rules.select(F.array_join("antecedent", ",").alias("antecedent"),
                        F.array_join("consequent", ",").alias("consequent"),
                        "confidence", "support")


# ------------------------------------------------------------------ S2-S7
CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType(), False),
    StructField("c_name", StringType(), True),
    StructField("c_nationkey", IntegerType(), True),
    StructField("c_acctbal", DoubleType(), True),
    StructField("c_mktsegment", StringType(), True),
])


def w4_sequential_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of up to three event types that half of all users' weeks hold."""
    found = sequences.sequential_patterns(_t(spark, sf_dir, "events"), "user_id", "event_type", "ts", ["event_id"], 0.5, 3, "week")
    return found.select(F.array_join("pattern", ">").alias("pattern"), "length", "sessions", "support")


def s2_land_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table exported as CSV by a source system, landed back
    under its declared schema; good rows go to staging."""
    root = scratch_path(spark, "landing")
    _t(spark, sf_dir, "customer").write.option("header", True).csv(f"{root}/incoming")
    good, _ = ingest.land_files(spark, f"{root}/incoming", "csv", CUSTOMER_SCHEMA,
                                staging_path=f"{root}/staging",
                                quarantine_path=f"{root}/quarantine",
                                options={"header": "true"})
    return good


def s3_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.with_mark(_t(spark, sf_dir, "events"), "ts",
                            F.lit(INCREMENT_MARK).cast("timestamp_ntz"))


def s4_stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive twice (a source replays its whole export); the stream
    lands each event once."""
    root = scratch_path(spark, "stream")
    events = _t(spark, sf_dir, "events")
    events.write.parquet(f"{root}/src/export=1")
    events.write.parquet(f"{root}/src/export=2")
    q = stream_land(spark, f"{root}/src/*", events.schema, "ts", "event_id", "40 days",
                    f"{root}/dst", f"{root}/checkpoint")
    q.awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/dst")


def s5_promote_to_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "storage") + "/lineitem"
    return storage.promote_to_storage(
        _t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
        {"ship_year": F.year("l_shipdate")}, path)


def s5_second_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of order lines into one stored table, fed by increments (S3): the first holds
    lines shipped up to a mark; the second all later ones and a correction of every seventh
    order's lines, shipped 400 days later, so their keys move to another year. The
    sequence arrives as text and is conformed before the newest line is chosen."""
    path = scratch_path(spark, "storage") + "/lineitem"
    lines = _t(spark, sf_dir, "lineitem").withColumn("seq", F.lit("9"))
    mark = F.lit(SHIP_MARK).cast("timestamp_ntz")
    first = lines.where(F.col("l_shipdate") <= mark)
    second = ingest.with_mark(lines, "l_shipdate", mark).drop("new_mark")
    moved = (lines.where(F.col("l_orderkey") % 7 == 0).withColumn("seq", F.lit("10"))
             .withColumn("l_shipdate", F.col("l_shipdate") + F.expr("INTERVAL 400 DAYS")))
    stored = None
    for batch in (first, second.unionByName(moved)):
        stored = storage.promote_to_storage(batch, ["l_orderkey", "l_linenumber"], ["seq", "l_shipdate"],
                                            {"ship_year": F.year("l_shipdate")}, path, conform={"seq": "int"},
                                            quarantine_path=path + "-quarantine")
    return stored


def s5_versioned_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of order lines as atomic versions, the second one sent twice: the rows of
    both versions, and those that quarantine holds. The first load holds lines shipped up to a mark;
    the second all later ones, and every seventh order's lines again, shipped 400 days later. Lines of every
    101st order also come with a sequence that is no number."""
    path = scratch_path(spark, "versions") + "/lineitem"
    lines = _t(spark, sf_dir, "lineitem").withColumn("seq", F.lit("9"))
    early = F.col("l_shipdate") <= F.lit(SHIP_MARK).cast("timestamp_ntz")
    bad = lines.where(F.col("l_orderkey") % 101 == 0).withColumn("seq", F.lit("nine"))
    moved = (lines.where(F.col("l_orderkey") % 7 == 0).withColumn("seq", F.lit("10"))
             .withColumn("l_shipdate", F.col("l_shipdate") + F.expr("INTERVAL 400 DAYS")))
    loads = {"first": lines.where(early).unionByName(bad.where(early)),
             "second": lines.where(~early).unionByName(bad.where(~early)).unionByName(moved)}
    for load_id in ("first", "second", "second"):
        versions.promote_version(loads[load_id], ["l_orderkey", "l_linenumber"], ["seq", "l_shipdate"], path, load_id,
                                 {"ship_year": F.year("l_shipdate")}, conform={"seq": "int"})
    held = [versions.read(spark, path, n).withColumn("state", F.lit(f"version {n}")) for n in (0, 1)]
    quarantine = (versions.side(spark, path, "quarantine").drop("load")
                  .withColumns({"seq": F.lit(None).cast("int"), "ship_year": F.lit(None).cast("int"), "state": F.lit("quarantine")}))
    return held[0].unionByName(held[1]).unionByName(quarantine)


def s3_stored_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken in three increments through marks that are stored with the loads: the source grows between
    them, the second is run twice, and rows with the mark's own time arrive after it."""
    path = scratch_path(spark, "versions") + "/events"
    events = _t(spark, sf_dir, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    mark = F.lit(INCREMENT_MARK).cast("timestamp_ntz")
    # By days, so that many rows tie with each mark; every third of the last day's comes late.
    grown = events.withColumn("ts", day)
    seen = [grown.where(day < mark), grown.where((day < mark) | ((day == mark) & (F.col("event_id") % 3 != 0))), grown]
    for n in (0, 1, 1, 2):
        stored = versions.load_increment(seen[n], "events", "ts", ["event_id"], path, f"increment {n}", partition_by=["event_type"])
    return stored


def s4_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in three exports, every tenth only in the last: what the stream landed, and
    what came behind its watermark, side by side."""
    root = scratch_path(spark, "stream")
    events = _t(spark, sf_dir, "events")
    early, tenth = F.col("ts") < F.lit(INCREMENT_MARK).cast("timestamp_ntz"), F.col("event_id") % 10 == 0
    for n, part in enumerate((early & ~tenth, ~early & ~tenth, tenth)):
        events.where(part).write.parquet(f"{root}/src/export={n}")
        stream_store(spark, f"{root}/src/*", events.schema, "ts", ["event_id"], LATE_DELAY, f"{root}/table", f"{root}/checkpoint",
                     partition_by=["event_type"]).awaitTermination()
    landed = versions.read(spark, f"{root}/table").withColumn("late", F.lit(False))
    return landed.unionByName(late_rows(spark, f"{root}/table", "ts", ["event_id"]).withColumn("late", F.lit(True)))


def _customer_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes a source system sends for the customer table: renames of
    customers in debt, deletes of household customers of nation 0, a second
    change (delete) for renamed customers of nation 1, deletes of absent keys
    and new customers."""
    c = _t(spark, sf_dir, "customer")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    upd = (c.where(F.col("c_acctbal") < 0)
           .withColumn("c_name", F.concat("c_name", F.lit(" (revised)")))
           .select(*cols, F.lit("U").alias("op"), F.lit(1).alias("seq")))
    dele = (c.where((F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_nationkey") == 0))
            .select(*cols, F.lit("D").alias("op"), F.lit(1).alias("seq")))
    second = (c.where((F.col("c_acctbal") < 0) & (F.col("c_nationkey") == 1))
              .select(*cols, F.lit("D").alias("op"), F.lit(2).alias("seq")))
    absent = (c.where(F.col("c_nationkey") == 2)
              .withColumn("c_custkey", -F.col("c_custkey"))
              .select(*cols, F.lit("D").alias("op"), F.lit(1).alias("seq")))
    new = (c.where(F.col("c_nationkey") == 3)
           .withColumn("c_custkey", F.col("c_custkey") + F.lit(10_000_000_000))
           .select(*cols, F.lit("I").alias("op"), F.lit(1).alias("seq")))
    return upd.unionByName(dele).unionByName(second).unionByName(absent).unionByName(new)


def s6_upsert_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.upsert_storage(_t(spark, sf_dir, "customer"), _customer_delta(spark, sf_dir),
                                  ["c_custkey"], op_col="op", seq_col="seq")


def s6_stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored customer table takes the same changes twice, some without an operation and
    some without a key; the second time changes nothing."""
    path = scratch_path(spark, "storage") + "/customer"
    customer = _t(spark, sf_dir, "customer")
    customer.write.parquet(path)
    stored = spark.read.schema(customer.schema).parquet(path)
    delta = _customer_delta(spark, sf_dir).withColumns({
        "op": F.when(F.col("c_nationkey") != 4, F.col("op")),
        "c_custkey": F.when(F.col("c_custkey") < 10_000_000_000, F.col("c_custkey"))})
    for _ in range(2):
        stored = storage.upsert_storage(stored, delta, ["c_custkey"], op_col="op", seq_col="seq", path=path)
    return stored


def s6_versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table, stored by nation, takes the changes of four nations twice: its rows, and
    whether their nation's partition was written by the change."""
    path = scratch_path(spark, "versions") + "/customer"
    versions.promote_version(_t(spark, sf_dir, "customer"), ["c_custkey"], [], path, "first", ["c_nationkey"])
    delta = _customer_delta(spark, sf_dir).where(F.col("c_nationkey") < 4)
    for _ in range(2):
        stored = versions.upsert_version(delta, ["c_custkey"], path, "changes", "op", "seq", ["c_nationkey"])
    now = versions.version(spark, path)
    written = versions.manifest(spark, now).select(F.col("c_nationkey").alias("n"), F.col("folder").startswith(f"load={now.load}").alias("rewritten"))
    return stored.join(written, stored["c_nationkey"].eqNullSafe(written["n"])).drop("n")


def s7_publish_workspace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.publish_workspace_table(_t(spark, sf_dir, "supplier"), WORKSPACE, "supplier",
                                           partition_by=["s_nationkey"], lake_root=_lake(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "a1_management_report": a1_management_report,
    "a1_report_cube": a1_report_cube,
    "a1_protected_cube": a1_protected_cube,
    "a1_report_grouping_sets": a1_report_grouping_sets,
    "p1_pseudonymise": p1_pseudonymise,
    "p2_token_vault": p2_token_vault,
    "p3_reidentify": p3_reidentify,
    "p4_mask_documents": p4_mask_documents,
    "p4_mask_pages": p4_mask_pages,
    "p5_generalise_customers": p5_generalise_customers,
    "p5_generalise_orders": p5_generalise_orders,
    "p6_suppress_small_cells": p6_suppress_small_cells,
    "p6_mask_small_cells": p6_mask_small_cells,
    "p6_k_anonymity": p6_k_anonymity,
    "p6_least_generalisation": p6_least_generalisation,
    "r1_build_dimension": r1_build_dimension,
    "r2_build_fact": r2_build_fact,
    "r3_history_scd2": r3_history_scd2,
    "r3_history_events": r3_history_events,
    "r3_history_null_keys": r3_history_null_keys,
    "r3_history_batches": r3_history_batches,
    "r4_quality_report": r4_quality_report,
    "r4_reconcile_rows": r4_reconcile_rows,
    "r5_flatten_json": r5_flatten_json,
    "a2_trend": a2_trend,
    "a2_trend_events_daily": a2_trend_events_daily,
    "a2_trend_large_orders": a2_trend_large_orders,
    "a3_top_n": a3_top_n,
    "a3_top_parts_by_revenue": a3_top_parts_by_revenue,
    "a4_cross_org_link": a4_cross_org_link,
    "a4_linkage_without_key": a4_linkage_without_key,
    "w1_workspace_extract": w1_workspace_extract,
    "w1_orders_per_person": w1_orders_per_person,
    "w2_sample_cohort": w2_sample_cohort,
    "w2_sample_cohort_events": w2_sample_cohort_events,
    "w3_profile": w3_profile,
    "w3_profile_exact": w3_profile_exact,
    "w3_stored_sketches": w3_stored_sketches,
    "w4_mine_itemsets": w4_mine_itemsets,
    "w4_association_rules": w4_association_rules,
    "w4_sequential_patterns": w4_sequential_patterns,
    "s2_land_files": s2_land_files,
    "s3_ingest_incremental": s3_ingest_incremental,
    "s3_stored_marks": s3_stored_marks,
    "s4_stream_land": s4_stream_land,
    "s4_stream_late": s4_stream_late,
    "s5_promote_to_storage": s5_promote_to_storage,
    "s5_second_batch": s5_second_batch,
    "s5_versioned_loads": s5_versioned_loads,
    "s6_stored_upsert": s6_stored_upsert,
    "s6_upsert_storage": s6_upsert_storage,
    "s6_versioned_upsert": s6_versioned_upsert,
    "s7_publish_workspace_table": s7_publish_workspace_table,
}
