"""Transfer into the lake (S1-S3): database tables, landed files, increments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from laketide.session import scratch_path

CORRUPT_COL = "_corrupt_record"


# --------------------------------------------------------------------- S1
def range_bounds(spark: SparkSession, jdbc_options: Mapping[str, str], table: str,
                 key_col: str) -> tuple[Any, Any]:
    """Min and max of the split column, computed by the database itself."""
    opts = dict(jdbc_options)
    opts["query"] = f"SELECT MIN({key_col}) AS lo, MAX({key_col}) AS hi FROM {table}"
    opts.pop("dbtable", None)
    row = spark.read.format("jdbc").options(**opts).load().first()
    return row["lo"], row["hi"]


def ingest_table(spark: SparkSession, jdbc_options: Mapping[str, str], table: str,
                 key_col: str, parts: int, staging_path: str | None = None,
                 bounds: tuple[Any, Any] | None = None, fetchsize: int = 10_000) -> DataFrame:
    """Bulk copy of one database table, read as ``parts`` parallel key ranges.

    Spark issues one ``WHERE key_col >= a AND key_col < b`` query per
    partition (rows outside the bounds go to the first and last range, so
    nothing is lost when bounds are stale). A table without keys has no bounds
    and is read as one partition. ``fetchsize`` rows travel at a time. With ``staging_path`` the copy is
    written to staging as Parquet and read back from there.
    """
    lo, hi = bounds if bounds is not None else range_bounds(spark, jdbc_options, table, key_col)
    opts = dict(jdbc_options)
    opts.setdefault("fetchsize", str(fetchsize))
    opts["dbtable"] = table
    if lo is not None and hi is not None:
        opts.update({"partitionColumn": key_col, "lowerBound": str(lo), "upperBound": str(hi),
                     "numPartitions": str(parts)})
    df = spark.read.format("jdbc").options(**opts).load()
    if staging_path is None:
        return df
    df.write.mode("overwrite").parquet(staging_path)
    return spark.read.parquet(staging_path)


# --------------------------------------------------------------------- S2
def land_files(spark: SparkSession, path: str, fmt: str, schema: StructType,
               staging_path: str | None = None, quarantine_path: str | None = None,
               options: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Read files under a declared schema; split good rows from bad ones.

    Bad rows are those the reader could not convert (kept with their raw line
    in ``_corrupt_record``) and those missing a field the schema declares
    non-nullable. Never infers a schema. With paths given, good rows are
    written to staging and bad rows to quarantine, and both are read back.
    Works for ``csv``, ``json`` (lines), ``parquet``, ``orc`` and ``text``.
    Typed files (Parquet, ORC) are conformed with ``try_cast``: a value that
    does not convert makes the row bad (raw row kept as JSON) instead of
    failing the job under ANSI mode.
    """
    opts = dict(options or {})
    required = [f.name for f in schema.fields if not f.nullable]
    if fmt in ("csv", "json"):
        read_schema = StructType([StructField(f.name, f.dataType, True) for f in schema.fields]
                                 + [StructField(CORRUPT_COL, StringType(), True)])
        opts.setdefault("mode", "PERMISSIVE")
        opts["columnNameOfCorruptRecord"] = CORRUPT_COL
        raw = spark.read.format(fmt).schema(read_schema).options(**opts).load(path)
        corrupt = F.col(CORRUPT_COL).isNotNull()
    elif fmt == "text":
        raw = spark.read.format("text").options(**opts).load(path).select(
            F.col("value").alias(schema.fields[0].name), F.lit(None).cast("string").alias(CORRUPT_COL))
        corrupt = F.lit(False)
    else:
        src = spark.read.format(fmt).options(**opts).load(path)
        names = [f.name for f in schema.fields]
        lost = F.lit(False)
        for f in schema.fields:
            lost = lost | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        raw = src.select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
            F.when(lost, F.to_json(F.struct(*names))).alias(CORRUPT_COL))
        corrupt = F.col(CORRUPT_COL).isNotNull()
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    reason = (F.when(corrupt, F.lit("unparsable"))
              .when(missing, F.lit("missing_required")).otherwise(F.lit(None)))
    tagged = raw.withColumn("_reason", reason)
    cols = [f.name for f in schema.fields]
    is_bad = F.col("_reason").isNotNull()
    if staging_path is not None or quarantine_path is not None:
        # The source is parsed once; both outcomes are then read from that.
        once = scratch_path(spark, "landed")
        tagged.withColumn("__bad", F.col("_reason").isNotNull()).write.partitionBy("__bad").parquet(once)
        tagged = spark.read.schema(StructType([*tagged.schema.fields, StructField("__bad", BooleanType())])).parquet(once)
        is_bad = F.col("__bad")
    good = tagged.where(~is_bad).select(*cols)
    bad = tagged.where(is_bad).select(
        F.coalesce(F.col(CORRUPT_COL), F.to_json(F.struct(*cols))).alias("raw"), "_reason")
    if staging_path is not None:
        good.write.mode("overwrite").parquet(staging_path)
        good = spark.read.schema(StructType(
            [StructField(f.name, f.dataType, True) for f in schema.fields])).parquet(staging_path)
    if quarantine_path is not None:
        bad.write.mode("overwrite").parquet(quarantine_path)
        bad = spark.read.parquet(quarantine_path)
    return good, bad


# --------------------------------------------------------------------- S3
def past_mark(df: DataFrame, mark_col: str, last_mark: Any, key: Sequence[str], taken: DataFrame | None) -> DataFrame:
    """Rows that may be new: past the mark, at the mark but not taken, or without one. A taken
    key that comes again with a later mark is a change, and new."""
    if last_mark is None:
        return df
    mark = F.col(mark_col)
    if taken is None:
        return df.where((mark > F.lit(last_mark)) | mark.isNull())
    rows = df.where((mark >= F.lit(last_mark)) | mark.isNull())
    side = taken.select(*[F.col(k).alias(f"__t_{k}") for k in key]).distinct()
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(side[f"__t_{k}"]) for k in key])
    return rows.join(side, same & F.coalesce(mark <= F.lit(last_mark), F.lit(True)), "left_anti")


def ingest_incremental(df: DataFrame, mark_col: str, last_mark: Any = None, key: Sequence[str] = (),
                       taken: DataFrame | None = None) -> tuple[DataFrame, Any]:
    """Rows past the last high-water mark, and the new mark.

    The new mark is one aggregate over the increment, and the increment ends
    there: rows written between that job and the copy wait for the next one.
    Rows can arrive later with the mark's own value. To take them, pass
    ``taken`` (the ``key`` of the rows taken at ``last_mark``, see
    ``taken_at``); then the filter is ``>=`` less those keys. Rows without a
    mark come with every increment; ``promote_to_storage`` keeps one per key.
    The filter is pushed to the source (Parquet row groups / a JDBC WHERE).
    """
    new = past_mark(df, mark_col, last_mark, key, taken)
    row = new.agg(F.max(mark_col).alias("m")).first()
    mark = row["m"] if row is not None and row["m"] is not None else last_mark
    if mark is not None:
        new = new.where((F.col(mark_col) <= F.lit(mark)) | F.col(mark_col).isNull())
    return new, mark


def taken_at(increment: DataFrame, mark_col: str, mark: Any, key: Sequence[str]) -> DataFrame:
    """Keys of the increment's rows at its own mark, and without one: to be stored with the mark."""
    return increment.where((F.col(mark_col) == F.lit(mark)) | F.col(mark_col).isNull()).select(*key).distinct()


def with_mark(df: DataFrame, mark_col: str, last_mark: Any = None, mark_name: str = "new_mark",
              key: Sequence[str] = (), taken: DataFrame | None = None) -> DataFrame:
    """The increment with the new mark as a column, without a driver round trip.

    The mark is a scalar subquery (one aggregate row), not a join; one query
    reads the source once for it and once for the rows, under one snapshot.
    """
    new = past_mark(df, mark_col, last_mark, key, taken)
    mark = new.agg(F.max(mark_col)).scalar()
    return new.withColumn(mark_name, mark)
