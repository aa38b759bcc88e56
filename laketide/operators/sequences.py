"""Sequential patterns (W4): which items follow each other in many sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laketide.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: the next length starts from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sequential_patterns(df: DataFrame, user: str, item: str, time: str, ties: list[str], support: float,
                        max_length: int = 3, session_unit: str = "day") -> DataFrame:
    """Ordered patterns of items that occur in at least ``support`` of all sessions.

    A session is one user's rows in one calendar unit, so the rows of a hot user
    are as many sessions as there are units and never one task. Rows are ordered
    by ``time`` and ``ties`` (unique together within a user). A session holds a
    pattern if its items occur in this order, others in between allowed; it counts
    once however often it does. Rows without user, item or time take no part.

    PrefixSpan as joins: of each session only the place where a pattern's leftmost
    occurrence ends is kept (its projection), and each item's places are one sorted
    array. A pattern grows by an item if that item has a place behind the
    projection; patterns below the support are dropped with their projections,
    because nothing that begins with them can reach it. The patterns of a length
    are counted with partial aggregation, written, and never come to the driver.

    Returns ``pattern`` (array), ``length``, ``sessions`` and ``support``; no rows
    for an empty table.
    """
    if not 0 < support <= 1:
        raise ValueError("support is over 0 and at most 1")
    if max_length < 1:
        raise ValueError("max_length is at least 1")
    rows = (df.where(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(time).isNotNull())
            .select(F.col(user).alias("u"), F.date_trunc(session_unit, time).alias("s"), F.col(item).alias("item"),
                    F.struct(time, *ties).alias("at")))
    placed = rows.withColumn("place", F.row_number().over(W.partitionBy("u", "s").orderBy("at")))
    places = _stored(placed.groupBy("u", "s", "item").agg(F.array_sort(F.collect_list("place")).alias("places")), "sequence-places")
    total = places.select("u", "s").distinct().count()

    def frequent(projected: DataFrame) -> DataFrame:
        counts = projected.groupBy("pattern").agg(F.count(F.lit(1)).alias("sessions"))
        share = F.col("sessions") / F.lit(total)
        return counts.where(share >= support).select("pattern", F.size("pattern").alias("length"), "sessions", share.alias("support"))

    projected = _stored(places.select("u", "s", F.array("item").alias("pattern"), F.col("places")[0].alias("end")), "sequence-1")
    kept = _stored(frequent(projected), "sequence-patterns-1")
    found, singles = kept, kept.select(F.col("pattern")[0].alias("item"))
    useful = places.join(singles, "item", "left_semi")
    for length in range(2, max_length + 1):
        projected = projected.join(kept.select("pattern"), "pattern", "left_semi")
        grown = (projected.join(useful, ["u", "s"])
                 .select("u", "s", F.concat("pattern", F.array("item")).alias("pattern"), _behind("places", "end").alias("end"))
                 .where("end IS NOT NULL"))
        projected = _stored(grown, f"sequence-{length}")
        kept = _stored(frequent(projected), f"sequence-patterns-{length}")
        found = found.unionByName(kept)
    return found


def _behind(places: str, end: str) -> Column:
    """The first of the sorted places behind ``end``; null if there is none."""
    return F.array_min(F.filter(places, lambda p: p > F.col(end)))
