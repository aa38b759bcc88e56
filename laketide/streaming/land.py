"""S4: incremental landing of arriving event files, exactly once per key; late rows kept aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from laketide.sources import versions
from laketide.sources.storage import _matched, newest_per_key


def stream_land(spark: SparkSession, src: str, schema: StructType, ts_col: str, key: str,
                delay: str, dst: str, checkpoint: str, fmt: str = "parquet",
                available_now: bool = True,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Land new files from ``src`` into ``dst``, each ``key`` once.

    ``dropDuplicatesWithinWatermark`` keeps the first row per key; its state
    lives for ``delay`` past the watermark (event time in ``ts_col``). A
    repeat arriving within the delay is dropped; a repeat later than that,
    or a row older than the watermark, is outside the guarantee: the row
    older than the watermark is dropped as late, the late repeat is landed
    again. The checkpoint makes restarts resume where they stopped, and the
    file sink commits each micro-batch once.

    Watermarks need ``timestamp``; a ``timestamp_ntz`` column is read as
    such, converted for the watermark (wall-clock kept, under the session
    time zone) and converted back before writing.

    ``max_files_per_trigger`` bounds each micro-batch, so catching up on a
    large backlog (``availableNow`` honours it) runs as several bounded
    batches instead of one.
    """
    ntz = isinstance(schema[ts_col].dataType, TimestampNTZType)
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(src)
    if ntz:
        stream = stream.withColumn(ts_col, F.col(ts_col).cast(TimestampType()))
    landed = stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])
    if ntz:
        landed = landed.withColumn(ts_col, F.col(ts_col).cast(TimestampNTZType()))
    writer = (landed.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", dst))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()



def stream_store(spark: SparkSession, src: str, schema: StructType, ts_col: str, key: Sequence[str], delay: str, path: str,
                 checkpoint: str, partition_by: Sequence[str] | Mapping[str, Column] = (), fmt: str = "parquet",
                 available_now: bool = True, max_files_per_trigger: int | None = None, name: str = "stream") -> StreamingQuery:
    """Land new files from ``src`` in the versioned table at ``path``; rows behind the watermark are
    set aside as ``late`` instead of lost (``late_rows``).

    Each micro-batch is one atomic version whose load id is ``name`` and the batch's id, so a batch
    that Spark runs again after a break (its data were committed, its checkpoint was not) changes
    nothing. The watermark is the greatest ``ts_col`` of all earlier batches less
    ``delay``; it is stored with the version, so it moves exactly when the rows do. Rows on time are merged by
    key over the whole table (the newest ``ts_col`` stays); rows without a time are on time.
    Landed and late keys together are the source's keys.

    ``checkpoint`` and ``path`` belong together: a new checkpoint needs a new ``name``.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    kind, mark = schema[ts_col].dataType.simpleString(), f"{name}:watermark"

    def store(batch: DataFrame, batch_id: int) -> None:
        session, load_id = batch.sparkSession, f"{name}:{batch_id}"
        base = versions.version(session, path)
        if base and load_id in base.loads:
            return
        ts, now = F.col(ts_col), base.marks.get(mark) if base else None
        behind = F.lit(False) if now is None else F.coalesce(ts < F.lit(now).cast(kind), F.lit(False))
        far = batch.agg((F.max(ts) - F.expr(f"INTERVAL {delay}")).cast(kind).cast("string").alias("m")).first().m
        after = max((x for x in (now, far) if x is not None), default=None)  # as text: one format, so one order
        versions.promote_version(batch.where(~behind), list(key), [ts_col], path, load_id, partition_by,
                                 sides={"late": batch.where(behind)}, marks={} if after is None else {mark: after})

    writer = reader.load(src).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_rows(spark: SparkSession, path: str, ts_col: str, key: Sequence[str]) -> DataFrame | None:
    """Rows that ``stream_store`` set aside, one per key (the newest), less those whose key is
    in the table all the same; None if no batch was ever stored."""
    late = versions.side(spark, path, "late")
    if late is None:
        return None
    return _matched(newest_per_key(late.drop("load"), list(key), [ts_col]), versions.read(spark, path), list(key), "left_anti")
