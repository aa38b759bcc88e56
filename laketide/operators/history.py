"""R3 over batches: a stored type-2 history that late rows cut and join.

The store is a versioned table (``sources.versions``) of observations: key, time, tie-break
columns and state, each once, and ``starts``, which says whether the state differs from the
observation before it in the same time slice. It is partitioned by slice and by a hash bucket
of the key. A batch, in any order and however late, rewrites only the partitions of its own
(slice, bucket) pairs: there its rows are put between the stored ones and ``starts`` is set
anew, which cuts a version where a different state came to light inside it and joins two
versions where the difference between them went away.

The history is the history of the ``starts`` rows alone: inside a slice the other rows change
nothing, and what a slice takes over from the one before is settled when it is read, by one
pass over the few rows that start something. It equals the history of all rows in one batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from laketide.operators.model import SLICE_UNITS, history_scd2
from laketide.sources import versions

SLICE, BUCKET = "h_slice", "h_bucket"


def merge_history(batch: DataFrame, key: Sequence[str] | str, ts: str, state_cols: Sequence[str], path: str, load_id: str,
                  tie_break: Sequence[str] = (), slice_unit: str = "month", buckets: int = 16) -> DataFrame:
    """Put a batch of observations into the history stored at ``path``; returns the history.

    Rows that are stored already change nothing, nor does a ``load_id`` that was committed before.
    Null keys, times and states are values like others (rows without a time are a slice of
    their own, the first). ``slice_unit`` and ``buckets`` bound what a late row rewrites, and
    spread a hot key: choose them so that a key's slice fits a task, and keep them for the table's life.
    """
    if slice_unit not in SLICE_UNITS or slice_unit is None:
        raise ValueError(f"slice_unit must be a unit of {SLICE_UNITS}, not {slice_unit!r}")
    spark = batch.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    order = [ts, *tie_break, *[c for c in state_cols if c not in tie_break]]
    cols = list(dict.fromkeys([*keys, *order]))
    base = versions.version(spark, path)
    if base is None or load_id not in base.loads:
        rows = batch.select(*cols, F.date_trunc(slice_unit, F.col(ts)).cast("timestamp_ntz").cast("string").alias(SLICE),
                            F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET))
        marks = {"history": f"{keys} by {order}, {slice_unit}, {buckets}"}
        if base is not None and base.marks.get("history") != marks["history"]:
            raise ValueError(f"{path} is a history of {base.marks.get('history')}")
        in_slice = Window.partitionBy(*keys, SLICE, BUCKET).orderBy(*[F.col(c) for c in order])
        state = F.struct(*state_cols)

        def combine(new: DataFrame, near: DataFrame | None) -> DataFrame:
            every = new if near is None else new.unionByName(near.drop("starts")).distinct()
            before = F.lag(state).over(in_slice)
            return every.withColumn("starts", before.isNull() | ~state.eqNullSafe(before))

        versions.merge(spark, path, load_id, rows.distinct(), [SLICE, BUCKET], keys, combine, base, marks=marks, moves=False)
    return stored_history(spark, path, keys, ts, state_cols, tie_break, slice_unit)


def stored_history(spark: SparkSession, path: str, key: Sequence[str] | str, ts: str, state_cols: Sequence[str],
                   tie_break: Sequence[str] = (), slice_unit: str = "month", number: int | None = None) -> DataFrame:
    """The history at the newest version of the store, or at version ``number``: ``history_scd2``'s columns."""
    starts = versions.read(spark, path, number).where("starts")
    return history_scd2(starts, key, ts, state_cols, tie_break, slice_unit)
