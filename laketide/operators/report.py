"""Reporting and cross-organisation analysis (A1-A4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from laketide.sources.storage import _staged


# --------------------------------------------------------------------- A1
def management_report(fact: DataFrame, dims: Sequence[str], measures: Mapping[str, Column],
                      mode: str | Sequence[Sequence[str]] = "rollup",
                      gid_col: str = "gid", grain: Mapping[str, Column] | None = None) -> DataFrame:
    """Measures with subtotals over ``dims``.

    ``mode`` is ``rollup``, ``cube`` or an explicit list of grouping sets.
    ``gid_col`` is Spark's ``grouping_id()`` (bit set = dimension rolled up).
    With ``grain`` (name -> aggregate) the fact is first summed once at its
    finest grain, and ``measures`` aggregate those few rows: the Expand that
    makes the subtotals then multiplies groups, not facts. Without it the
    Expand sits on the fact rows (needed for measures that do not add up).
    """
    aggs = [m.alias(n) for n, m in measures.items()] + [F.grouping_id().alias(gid_col)]
    dims = list(dims)
    if grain is not None:
        fact = fact.groupBy(*dims).agg(*[m.alias(n) for n, m in grain.items()])
    if mode == "rollup":
        grouped = fact.rollup(*dims)
    elif mode == "cube":
        grouped = fact.cube(*dims)
    elif isinstance(mode, str):
        raise ValueError(f"mode must be 'rollup', 'cube' or a list of grouping sets, not {mode!r}")
    else:
        sets = [[F.col(c) for c in s] for s in mode]
        grouped = fact.groupingSets(sets, *dims)
    return grouped.agg(*aggs)


def protect_subtotals(report: DataFrame, dims: Sequence[str], count_col: str, k: int, measures: Sequence[str] = (),
                      gid_col: str = "gid") -> DataFrame:
    """A report with subtotals in which no hidden cell follows from the others by subtraction (A1 with P6).

    Cells of fewer than ``k`` (but some) persons are hidden as ``small``. Every margin is then looked
    at: the cells along one dimension, all other dimensions fixed, and their total. Where exactly one of
    them is hidden, its figure is the total less the rest; so the smallest shown one (ties: a cell before
    the total, then the smaller value) is hidden as well, as ``margin``. That can leave single
    hidden cells on other margins, so it is done until there are none. Margins without their total in the report
    (of a rollup or of chosen grouping sets) give nothing away.

    Adds ``hidden`` (null, ``small`` or ``margin``); ``count_col`` and ``measures`` of hidden
    cells are null. A null count or one of nobody is not small. All steps work on cells, after aggregation.
    """
    dims = list(dims)
    n, gid = F.col(count_col), F.col(gid_col)
    cells = _staged(report.withColumn("hidden", F.when((n > 0) & (n < k), "small")), "cells")
    while True:
        picks = []
        for i, d in enumerate(dims):
            bit = 1 << (len(dims) - 1 - i)
            others, total = [c for c in dims if c != d], gid.bitwiseAND(bit) > 0
            shown = F.when(F.col("hidden").isNull(), F.struct(n.alias("n"), total.alias("t"), F.col(d).alias("d"), gid.alias("g")))
            lines = (cells.groupBy(*others, gid.bitwiseAND(~bit).alias("__line"))
                     .agg(F.count("hidden").alias("__hidden"), F.max(total).alias("__total"), F.min(shown).alias("__pick"))
                     .where("__hidden = 1 AND __total AND __pick IS NOT NULL"))
            picks.append(lines.select(*[(F.col("__pick.d") if c == d else F.col(c)).alias(f"__{c}") for c in dims],
                                      F.col("__pick.g").alias("__gid")))
        more = _staged(reduce(DataFrame.unionByName, picks).distinct().withColumn("__more", F.lit(True)), "cells-more")
        if more.isEmpty():
            break
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in dims], gid == F.col("__gid"))
        cells = _staged(cells.join(more, same, "left").withColumn("hidden", F.coalesce("hidden", F.when(F.col("__more"), "margin")))
                        .select(*cells.columns), "cells")
    return cells.withColumns({c: F.when(F.col("hidden").isNull(), F.col(c)) for c in (count_col, *measures)})


# --------------------------------------------------------------------- A2
# Periods ``date_trunc`` understands that still name a calendar date.
PERIODS = ("year", "quarter", "month", "week", "day")


def _period_number(period: str, c: Column) -> Column:
    """Consecutive numbers of calendar periods."""
    if period == "week":
        return F.floor(F.datediff(c, F.lit("1970-01-05").cast("date")) / 7)
    if period == "day":
        return F.datediff(c, F.lit("1970-01-01").cast("date"))
    per_year = {"year": 1, "quarter": 4, "month": 12}[period]
    return F.year(c) * per_year + {"year": F.lit(0), "quarter": F.quarter(c), "month": F.month(c)}[period]


def trend(df: DataFrame, part: Sequence[str], period_col: str, measure: Column,
          width: int = 3, period: str = "month") -> DataFrame:
    """Per partition and period: value, running total, moving average over
    the last ``width`` calendar periods, and change on the calendar period before.

    Periods are counted by the calendar, not by rows: a period without rows
    is no row, but it is not stepped over either. The moving average is the
    mean over those of the last ``width`` periods that have rows; the change
    is null when the period before has none. Rows without a time form a
    period of their own, with neither.

    Rows are first summed per (part, period) with map-side partial sums; the
    windows then run over one row per period, never over raw rows.
    Sums stay in the measure's type (use decimals for exact money); the
    running total and change are returned as double, the moving average as
    moving sum / moving count.
    """
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    part = list(part)
    per = (df.groupBy(*part, F.date_trunc(period, F.col(period_col)).cast("date").alias("period"))
           .agg(F.sum(measure).alias("__v"))
           .withColumn("__n", _period_number(period, F.col("period")).cast("long")))
    w = Window.partitionBy(*part).orderBy("__n")
    moving, before = w.rangeBetween(-(width - 1), Window.currentRow), w.rangeBetween(-1, -1)
    known = F.col("__n").isNotNull()
    return per.select(
        *part, "period",
        F.col("__v").cast("double").alias("value"),
        F.sum("__v").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .cast("double").alias("running_total"),
        F.when(known, F.sum("__v").over(moving).cast("double") / F.count("__v").over(moving)).alias("moving_avg"),
        F.when(known, F.col("__v") - F.max("__v").over(before)).cast("double").alias("change"))


# --------------------------------------------------------------------- A3
def top_n(df: DataFrame, group: Sequence[str], measure: str, n: int,
          tie: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """Best ``n`` rows per group by ``measure`` descending, ties broken by
    ``tie`` ascending (a total order, so exactly ``min(n, size)`` rows per group).

    ``row_number() <= n`` lets Spark insert a window group limit before the
    shuffle, so each map task forwards at most n rows per group.
    """
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc(), *[F.col(t).asc() for t in tie])
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n))


# --------------------------------------------------------------------- A4
def cross_org_link(left: DataFrame, right: DataFrame, token: str,
                   left_aggs: Mapping[str, Column], right_aggs: Mapping[str, Column]) -> DataFrame:
    """Link two organisations' data on shared tokens, never on identities.

    Each side is aggregated by token first (partial aggregation shrinks hot
    tokens before any shuffle), then the two per-token tables are joined
    full-outer. Output: token, the per-side measures, ``in_left``,
    ``in_right`` and ``side`` (``both``, ``left_only``, ``right_only``).
    """
    lft = left.groupBy(token).agg(
        *[v.alias(k) for k, v in left_aggs.items()]).withColumn("in_left", F.lit(True))
    rgt = right.groupBy(token).agg(
        *[v.alias(k) for k, v in right_aggs.items()]).withColumn("in_right", F.lit(True))
    # Null tokens (unlinkable rows) are dropped after the join: a filter
    # before the aggregation would be pushed below a computed token and
    # evaluate it twice; here each side's null group is a single row.
    linked = lft.join(rgt, token, "full_outer").where(F.col(token).isNotNull())
    in_l = F.coalesce(F.col("in_left"), F.lit(False))
    in_r = F.coalesce(F.col("in_right"), F.lit(False))
    side = (F.when(in_l & in_r, "both").when(in_l, "left_only").otherwise("right_only"))
    return linked.withColumns({"in_left": in_l, "in_right": in_r, "side": side})


def link_summary(linked: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Overlap and one-sided counts: tokens and summed measures per side."""
    return linked.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        *[F.sum(m).alias(m) for m in measures])
