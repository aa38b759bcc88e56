"""Storage zones (S5-S7): promote staging to storage, upserts, workspace catalog."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from laketide.session import scratch_path

# Fixed values of the lake layout: workspaces live under "clusters"; every
# workspace has a "storage" zone; only the main lake, "maindatalake", ingests
# and therefore also has a "staging" zone.
WORKSPACES_FOLDER = "clusters"
MAIN_WORKSPACE = "maindatalake"
ZONES = ("storage", "staging")
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def check_name(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a valid workspace or table name: {name!r}")
    return name


def zone_path(lake_root: str, workspace: str, zone: str) -> str:
    check_name(workspace)
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    if zone == "staging" and workspace != MAIN_WORKSPACE:
        raise ValueError("only the main lake has a staging zone")
    return f"{lake_root.rstrip('/')}/{WORKSPACES_FOLDER}/{workspace}/{zone}"


def _orderable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be compared (a map as its sorted entries)."""
    c = F.col(name)
    return F.array_sort(F.map_entries(c)) if isinstance(df.schema[name].dataType, MapType) else c


def newest_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``order_by``, ties broken by all other
    columns (greatest first), so the choice never depends on row order.

    A ``max_by`` aggregation: map tasks keep one row per key before the
    shuffle, so duplicated or hot keys shrink early. Null keys are keys.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key and c not in order_by]
    order = F.struct(*[_orderable(df, c).alias(f"__o{i}") for i, c in enumerate([*order_by, *rest])])
    row = F.struct(*[F.col(c) for c in df.columns if c not in key])
    if not rest and not order_by:
        return df.select(*key).distinct()
    return df.groupBy(*key).agg(F.max_by(row, order).alias("__r")).select(
        *[F.col(c) if c in key else F.col(f"__r.{c}").alias(c) for c in df.columns])


def _matched(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on equal or both-null columns."""
    side = right.select(*[F.col(c).alias(f"__m_{c}") for c in cols]).distinct()
    return left.join(side, reduce(lambda a, b: a & b, [left[c].eqNullSafe(side[f"__m_{c}"]) for c in cols]), how)


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: a table is never read while it is overwritten."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The stored table, or None before the first load."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _replace(new: DataFrame, old: DataFrame | None, touched: DataFrame | None, parts: list[str], path: str) -> None:
    """Overwrite the partitions of ``new``, and empty those of ``touched`` that it no longer has."""
    gone = []
    if parts and touched is not None:
        empty = _matched(touched, new, parts, "left_anti")
        folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
        gone = (_matched(old.select(*old.columns, folder.alias("__folder")), empty, parts, "left_semi")
                .select("__folder").distinct().collect())  # partitions, not rows
    writer = new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    nothing = new.drop(*parts).limit(0)
    for r in gone:
        nothing.write.mode("overwrite").parquet(r["__folder"])


# --------------------------------------------------------------------- S5
def promote_to_storage(df: DataFrame, key: Sequence[str], order_by: Sequence[str],
                       partition_by: Sequence[str] | Mapping[str, object] = (),
                       path: str | None = None,
                       conform: Mapping[str, str] | None = None,
                       quarantine_path: str | None = None) -> DataFrame:
    """Staging to storage: conformed types, newest row per key over all loads, partitioned write.

    ``conform`` casts columns with ``try_cast`` first, so the newest row is
    chosen by the conformed values; rows with a value that does not convert
    go to ``quarantine_path`` when it is given (else the value becomes null).
    ``partition_by`` is a list of columns, or a mapping name -> Column to
    derive partition columns (e.g. ship year).

    A batch is merged into what is stored: the stored rows of the batch's
    keys, wherever they are, and the other rows of all partitions those or
    the batch's rows are in, are reduced with it to the newest row per key,
    staged in the shared folder, and replace exactly those partitions. A key
    that moves leaves its old partition. Other partitions are not rewritten.
    Returns the stored table read back.
    """
    out = df
    if conform:
        cast = {c: F.col(c).try_cast(t) for c, t in conform.items()}
        if quarantine_path is not None:
            lost = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & v.isNull() for c, v in cast.items()])
            out.where(lost).write.mode("append").parquet(quarantine_path)
            out = out.where(~lost)
        out = out.withColumns(cast)
    if isinstance(partition_by, Mapping):
        out = out.withColumns(dict(partition_by))
    parts = list(partition_by)
    out = newest_per_key(out, key, order_by)
    if path is None:
        return out
    spark = df.sparkSession
    out = out.select(*[c for c in out.columns if c not in parts], *parts)  # as it reads back
    batch = _staged(out, "promote-batch")
    old = _stored(spark, path, out.schema)
    if old is None:
        _replace(batch, None, None, parts, path)
        return spark.read.schema(out.schema).parquet(path)
    touched = None
    near = old
    if parts:
        touched = _staged(_matched(old, batch, key, "left_semi").select(*parts)
                          .unionByName(batch.select(*parts)).distinct(), "promote-partitions")
        near = _matched(old, touched, parts, "left_semi")
    merged = _staged(newest_per_key(batch.unionByName(near), key, order_by), "promote-merged")
    _replace(merged, old, touched, parts, path)
    return spark.read.schema(out.schema).parquet(path)


# --------------------------------------------------------------------- S6
def upsert_storage(base: DataFrame, delta: DataFrame, key: Sequence[str],
                   op_col: str | None = None, seq_col: str | None = None, path: str | None = None,
                   partition_by: Sequence[str] | None = None) -> DataFrame:
    """Apply a batch of changes to a stored table (Parquet has no MERGE).

    The delta is first cut to the last change per key (by ``seq_col``, ties
    by the row itself; without ``seq_col`` the greatest row wins, so a key
    never ends up twice). Then: base rows whose key is in the delta are
    dropped (left anti join), delta rows that are not deletes (``op_col`` =
    'D') are appended; a null ``op_col`` is not a delete. Keys match
    null-safely, so a null key is replaced like others. Deleting an absent
    key is a no-op; applying the same delta twice equals applying it once.

    With ``path`` the result is staged in the shared folder and then stored
    there (``base`` may be that same table), and read back. A table stored by
    partitions (``partition_by``; by default as it lies at ``path``) stays so, and
    only partitions that hold a changed key, before or after, are rewritten.
    ``versions.upsert_version`` does the same as one atomic version.
    """
    key = list(key)
    last = newest_per_key(delta, key, [seq_col] if seq_col is not None else [])
    stay = ~F.col(op_col).eqNullSafe(F.lit("D")) if op_col is not None else F.lit(True)
    if path is None:
        return _matched(base, last, key, "left_anti").unionByName(last.where(stay).select(*base.columns))
    spark = base.sparkSession
    parts = _stored_parts(base, path) if partition_by is None else list(partition_by)
    schema = base.select(*[c for c in base.columns if c not in parts], *parts).schema
    old = _stored(spark, path, schema)
    last = _staged(last, "upsert-changes")
    added = last.where(stay).select(*schema.fieldNames())
    touched, near = None, base.select(*schema.fieldNames())
    if parts and old is not None:
        touched = _staged(_matched(near, last, key, "left_semi").select(*parts).unionByName(added.select(*parts)).distinct(),
                          "upsert-partitions")
        near = _matched(near, touched, parts, "left_semi")
    merged = _staged(_matched(near, last, key, "left_anti").unionByName(added), "upsert")
    _replace(merged, old, touched, parts, path)
    return spark.read.schema(schema).parquet(path)


def _stored_parts(base: DataFrame, path: str) -> list[str]:
    """The columns of ``base`` that the table stored at ``path`` is partitioned by."""
    stored = _stored(base.sparkSession, path, base.schema)
    first = stored.select("_metadata.file_path").limit(1).collect() if stored is not None else []
    folders = first[0][0].split("/")[:-1] if first else []
    names = []
    while folders and "=" in folders[-1]:
        names.insert(0, folders.pop().split("=", 1)[0])
    return [n for n in names if n in base.columns]


# --------------------------------------------------------------------- S7
def _bare(uri: str) -> str:
    """A location without an empty authority or a final slash, local paths without their scheme."""
    return re.sub(r"^file:/+", "/", uri).rstrip("/")


def publish_workspace_table(df: DataFrame, workspace: str, table: str,
                            partition_by: Sequence[str] = (),
                            lake_root: str | None = None,
                            bucket_by: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """Register a stored table in the workspace's own catalog database.

    The database is created on first use, located in the workspace's
    storage zone when ``lake_root`` is given; a database that exists in
    another place is an error, not a silent write to that place. The table is
    written with ``saveAsTable`` (overwrite) and read back through the catalog.

    ``bucket_by=(n, cols)`` stores the table hashed into ``n`` buckets on
    ``cols`` (sorted within buckets): later joins and aggregations on those
    columns against tables bucketed the same way read co-located buckets
    without a shuffle.
    """
    spark: SparkSession = df.sparkSession
    check_name(workspace)
    check_name(table)
    if lake_root is not None:
        loc = zone_path(lake_root, workspace, "storage")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{workspace}` LOCATION '{loc}'")
        place = spark.catalog.getDatabase(workspace).locationUri
        if _bare(place) != _bare(loc):
            raise ValueError(f"workspace {workspace!r} is stored at {place}, not at {loc}")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{workspace}`")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    writer.saveAsTable(f"`{workspace}`.`{table}`")
    return spark.table(f"`{workspace}`.`{table}`")
