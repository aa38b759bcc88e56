"""Stored sketches (W3): a profile of any period from sketches, without reading its rows again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from laketide.sources import versions

# Sizes of the sketches, and the errors they are held to. A sketch of distinct values of this size has a
# standard error of 0.0082 after merges: the bound is four of them. A sketch of quantiles of this size
# keeps ranks within 0.0035 in 99 of 100 cases: the bound is about three times that.
DISTINCT_LG_K = 14
DISTINCT_ERROR = 0.033
QUANTILE_K = 800
RANK_ERROR = 0.01
TRACKED = 1024
# A sketch of frequent items gives counts too high by at most this many times rows / TRACKED, never too low.
COUNT_FACTOR = 3.5


def _text(df: DataFrame, name: str) -> Column:
    """A value as text; the two zeros of floating numbers are one value."""
    c = F.col(name)
    return ((c + F.lit(0.0)) if isinstance(df.schema[name].dataType, (FloatType, DoubleType)) else c).cast("string")


def _number(df: DataFrame, name: str) -> Column:
    numeric = isinstance(df.schema[name].dataType, NumericType)
    value = F.col(name).cast("double") if numeric else F.lit(None).cast("double")
    return F.when(~F.isnan(value), value)


def sketch_partitions(df: DataFrame, part: Mapping[str, Column], columns: Sequence[str]) -> DataFrame:
    """One row per partition (the values of ``part``) and column: rows, values, least and greatest
    number, and three sketches of fixed size: distinct values, quantiles (numbers) and frequent items.

    One pass over the rows; tasks send partial sketches, never rows, so a partition that holds a
    third of all rows costs its owner as little as any other. No rows for an empty table.
    """
    profiles = []
    for name in columns:
        text, number = _text(df, name), _number(df, name)
        profiles.append(F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count(F.col(name)).alias("n"),
            F.min(number).alias("min"), F.max(number).alias("max"),
            # Marked, because the sketch passes over empty texts.
            F.hll_sketch_agg(F.concat(F.lit("="), text), DISTINCT_LG_K).alias("distinct_sketch"),
            F.kll_sketch_agg_double(number, QUANTILE_K).alias("quantile_sketch"),
            F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias("item_sketch")))
    return (df.groupBy(*[c.alias(n) for n, c in part.items()]).agg(F.array(*profiles).alias("__p"))
            .select(*part, F.inline("__p")))


def store_sketches(df: DataFrame, part: Mapping[str, Column], columns: Sequence[str], path: str, load_id: str,
                   folder: Mapping[str, Column] | None = None) -> DataFrame:
    """Sketches of a load's rows, kept beside those of earlier loads as an atomic version.

    Rows that come late for a partition add sketches of their own; nothing stored is read
    but the sketches in the folders the load touches. ``folder`` (expressions over the partition
    columns) puts several partitions into one folder. A ``load_id`` that was committed
    before changes nothing. Returns the stored sketches.
    """
    rows = sketch_partitions(df, part, columns).withColumn("batch", F.lit(load_id))
    return versions.promote_version(rows, [*part, "column_name", "batch"], [], path, load_id, folder or list(part))


def merged_figures(sketches: DataFrame, by: Mapping[str, Column], share: float = 0.05,
                   quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Figures of any grouping of stored partitions, from their sketches alone.

    Per group of ``by`` (expressions over the partition columns) and column: ``n`` and ``n_null``
    (exact), ``min`` and ``max`` (exact, as doubles), ``n_distinct`` (within ``DISTINCT_ERROR``
    of the exact number), ``quantiles`` (their ranks within ``RANK_ERROR``; null without numbers;
    numbers as doubles, NaN is none) and ``heavy``: a map of items to counts that holds every
    item with at least ``share`` of the values. Counts are too high by at most ``count_error``,
    never too low, so a listed item can be short of the share by that much. Nulls are no item.
    """
    least = 2 * COUNT_FACTOR / TRACKED
    if not least <= share <= 1:
        raise ValueError(f"share is at least {least:.4f} (what the sketch can tell) and at most 1")
    merged = sketches.groupBy(*[c.alias(n) for n, c in by.items()], "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch").alias("d"), F.kll_merge_agg_double("quantile_sketch", QUANTILE_K).alias("q"),
        F.call_function("approx_top_k_combine", F.col("item_sketch")).alias("i"))
    numbers = F.coalesce(F.kll_sketch_get_n_double("q"), F.lit(0))
    items = F.filter(F.call_function("approx_top_k_estimate", F.col("i"), F.lit(TRACKED)),
                     lambda x: x["item"].isNotNull() & (x["count"] >= share * F.col("n")))
    return merged.select(
        *by, "column_name", "n", (F.col("n_rows") - F.col("n")).alias("n_null"), "min", "max",
        F.hll_sketch_estimate("d").alias("n_distinct"),
        F.when(numbers > 0, F.kll_sketch_get_quantile_double("q", F.array(*[F.lit(float(p)) for p in quantiles]))).alias("quantiles"),
        F.map_from_entries(items).alias("heavy"), F.ceil(F.col("n_rows") * (COUNT_FACTOR / TRACKED)).alias("count_error"))


def audit_figures(df: DataFrame, figures: DataFrame, by: Mapping[str, Column], columns: Sequence[str], share: float = 0.05,
                  quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Figures of ``merged_figures`` held against the rows themselves.

    Values are counted exactly (partial counts before the shuffle) and met by the figures, which are a
    row per group and column. Returns the exact ``n``, ``n_null``, ``n_distinct`` and ``n_heavy`` (items
    with at least ``share`` of the values) with ``counts_equal``, ``distinct_within``, ``ranks_within``
    and ``heavy_within``: whether the figures keep their bounds. A group or column that only
    one of the two has is a row of falses.
    """
    values = [F.struct(F.lit(c).alias("column_name"), _text(df, c).alias("item"), _number(df, c).alias("number")) for c in columns]
    counts = (df.select(*[c.alias(n) for n, c in by.items()], F.inline(F.array(*values)))
              .groupBy(*by, "column_name", "item", "number").agg(F.count(F.lit(1)).alias("k")))
    named = figures.select(*[F.col(c).alias(f"f_{c}") for c in figures.columns])
    match = F.col("column_name").eqNullSafe(F.col("f_column_name"))
    for name in by:
        match = match & F.col(name).eqNullSafe(F.col(f"f_{name}"))
    # Sums per group before the join; shares need them.
    size = counts.groupBy(*by, "column_name").agg(
        F.sum(F.when(F.col("item").isNotNull(), F.col("k")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("item").isNull(), F.col("k")).otherwise(0)).alias("n_null"),
        F.sum(F.when(F.col("number").isNotNull(), F.col("k")).otherwise(0)).alias("numbers"))
    told = size.join(named, match, "full_outer").select(
        *[F.coalesce(F.col(c), F.col(f"f_{c}")).alias(f"g_{c}") for c in (*by, "column_name")],
        "n", "n_null", "numbers", *[f"f_{c}" for c in figures.columns if c not in by and c != "column_name"])
    again = F.lit(True)
    for name in (*by, "column_name"):
        again = again & F.col(name).eqNullSafe(F.col(f"g_{name}"))
    estimate = F.try_element_at("f_heavy", F.col("item"))
    heavy = F.col("k") >= share * F.col("n")
    excess = estimate - F.col("k")
    # The figures go to the values (a row per group and column), not the values to a few tasks by group: sums leave each task.
    sums = counts.join(F.broadcast(told), again).groupBy(*[f"g_{c}" for c in (*by, "column_name")]).agg(
        F.count("item").alias("n_distinct"), F.count_if(F.col("item").isNotNull() & heavy).alias("n_heavy"),
        F.count_if(F.col("item").isNotNull() & heavy & estimate.isNull()).alias("missed"), F.count(estimate).alias("met"),
        F.min(excess).alias("least"), F.max(excess).alias("most"),
        *[F.sum(F.when(F.col("number") < F.col("f_quantiles")[i], F.col("k")).otherwise(0)).alias(f"below{i}") for i in range(len(quantiles))],
        *[F.sum(F.when(F.col("number") <= F.col("f_quantiles")[i], F.col("k")).otherwise(0)).alias(f"upto{i}") for i in range(len(quantiles))])
    tally = [c for c in sums.columns if c not in ("least", "most") and not c.startswith("g_")]
    sums = sums.withColumnsRenamed({f"g_{c}": f"s_{c}" for c in (*by, "column_name")})
    same = F.lit(True)
    for name in (*by, "column_name"):
        same = same & F.col(f"g_{name}").eqNullSafe(F.col(f"s_{name}"))
    measured = (told.join(sums, same, "left").withColumn("listed", F.size(F.map_keys("f_heavy")))
                .withColumns({c: F.coalesce(c, F.lit(0)) for c in tally}))
    ranks = F.lit(True)
    for i, p in enumerate(quantiles):
        ranks = ranks & (F.col(f"below{i}") <= (p + RANK_ERROR) * F.col("numbers")) & (F.col(f"upto{i}") >= (p - RANK_ERROR) * F.col("numbers"))
    sized = F.coalesce((F.col("n") == F.col("f_n")) & (F.col("n_null") == F.col("f_n_null")), F.lit(False))
    near = F.abs(F.col("f_n_distinct") - F.col("n_distinct")) <= F.ceil(DISTINCT_ERROR * F.col("n_distinct"))
    counted = ((F.col("missed") == 0) & (F.col("listed") == F.col("met"))
               & (F.col("met").eqNullSafe(0) | ((F.col("least") >= 0) & (F.col("most") <= F.col("f_count_error")))))
    return measured.select(
        *[F.col(f"g_{c}").alias(c) for c in (*by, "column_name")], "n", "n_null", "n_distinct", "n_heavy",
        sized.alias("counts_equal"), (sized & F.coalesce(near, F.lit(False))).alias("distinct_within"),
        (sized & F.coalesce(F.when(F.col("numbers") == 0, F.col("f_quantiles").isNull()).otherwise(ranks), F.lit(False))).alias("ranks_within"),
        (sized & F.coalesce(counted, F.lit(False))).alias("heavy_within"))
