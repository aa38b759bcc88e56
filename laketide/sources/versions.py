"""Stored tables whose loads are atomic: immutable load folders, a manifest a version, one commit last.

A table's folder holds

- ``data/load=<load>/<partitions>/``: what one load wrote, never changed afterwards. Every attempt
  of a load has a name of its own, so what a broken attempt left is never read;
- ``manifest/<load>/``: one row for each live folder of the version: its partition, its
  rows and the range of its first key column;
- ``side/<name>/load=<load>/``: rows a load set aside (quarantine, late rows, keys tied with a mark);
- ``versions/<number>.json``: the commit. It is written under another name and renamed last, without
  replacing: the highest number is the table, two loads cannot both commit the same one, and a
  reader sees a whole version or the one before.

Readers open the folders of their version's manifest and nothing else; Spark prunes the partitions. A
load reads and rewrites only the partitions its rows, or the old rows of its keys, are in. The driver
holds commits and folder names, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from laketide.sources.ingest import past_mark
from laketide.sources.storage import _matched, _staged, newest_per_key

COMMIT = "version long, load string, load_id string, schema string, parts array<string>, sides array<string>, marks map<string,string>"


class CommitConflict(RuntimeError):
    """Another load committed the version this one was built to be."""


@dataclass(frozen=True)
class Version:
    """A committed version: its number, the load that made it, and what came before."""
    path: str
    number: int
    load: str
    schema: StructType
    parts: list[str]
    marks: dict[str, str] = field(default_factory=dict)
    loads: dict[str, str] = field(default_factory=dict)   # load id -> load, up to this version
    sides: dict[str, list[str]] = field(default_factory=dict)   # name -> loads that set rows aside


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version of a table, or version ``number``; None before the first commit."""
    try:
        rows = spark.read.schema(COMMIT).json(f"{path}/versions").collect()  # one a load
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    rows = sorted((r for r in rows if number is None or r.version <= number), key=lambda r: r.version)
    if number is not None and (not rows or rows[-1].version != number):
        raise ValueError(f"{path} has no version {number}")
    if not rows:
        return None
    sides: dict[str, list[str]] = {}
    for r in rows:
        for name in r.sides:
            sides.setdefault(name, []).append(r.load)
    last = rows[-1]
    return Version(path, last.version, last.load, StructType.fromJson(json.loads(last.schema)), list(last.parts),
                   dict(last.marks), {r.load_id: r.load for r in rows}, sides)


def _publish(spark: SparkSession, path: str, number: int, commit: dict) -> None:
    """The commit file, whole and once: written aside, then renamed to its number unless that exists."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(f"{path}/versions/{number:012d}.json")
    aside = hadoop.Path(f"{path}/versions/_{uuid.uuid4().hex}")
    out = target.getFileSystem(conf).create(aside, False)
    out.write(bytearray(json.dumps(commit).encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(rename, 1)
    never[0] = rename.NONE
    files = hadoop.FileContext.getFileContext(target.toUri(), conf)
    try:
        files.rename(files.makeQualified(aside), files.makeQualified(target), never)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise CommitConflict(f"{path} got version {number} from another load") from e
        raise


def _ordered(schema: StructType, parts: Sequence[str]) -> StructType:
    """Columns as they read back: partitions last."""
    return StructType([*(f for f in schema.fields if f.name not in parts), *(schema[p] for p in parts)])


def manifest(spark: SparkSession, v: Version) -> DataFrame:
    """One row for each live folder of a version."""
    return spark.read.parquet(f"{v.path}/manifest/{v.load}")


def _open(spark: SparkSession, v: Version, folders: Sequence[str]) -> DataFrame:
    schema = _ordered(v.schema, v.parts)
    if not folders:
        return spark.createDataFrame([], schema)
    with_load = StructType([*schema.fields, StructField("load", StringType())])
    return (spark.read.schema(with_load).option("basePath", f"{v.path}/data")
            .parquet(*[f"{v.path}/data/{f}" for f in sorted(folders)]).drop("load"))


def _folders(rows: DataFrame) -> list[str]:
    return [r.folder for r in rows.select("folder").collect()]  # folders, not rows


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table at its newest version, or at version ``number``."""
    v = version(spark, path, number)
    if v is None:
        raise ValueError(f"{path} has no version yet")
    return _open(spark, v, _folders(manifest(spark, v)))


def side(spark: SparkSession, path: str, name: str, number: int | None = None) -> DataFrame | None:
    """Rows that committed loads set aside under ``name``, with their ``load``; None if none did."""
    v = version(spark, path, number)
    loads = v.sides.get(name, []) if v else []
    if not loads:
        return None
    return spark.read.option("basePath", f"{path}/side/{name}").parquet(*[f"{path}/side/{name}/load={x}" for x in loads])


def _summary(spark: SparkSession, path: str, load: str, schema: StructType, parts: Sequence[str], key: str | None) -> DataFrame:
    """The folders a load wrote, with rows and key range: reads the key column and file names only."""
    with_load = StructType([*_ordered(schema, parts).fields, StructField("load", StringType())])
    rows = spark.read.schema(with_load).option("basePath", f"{path}/data").parquet(f"{path}/data/load={load}")
    # File names are URIs: decoded once, they are paths again.
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    k = F.col(key) if key else F.lit(None).cast("long")
    named = rows.select(*parts, F.regexp_extract(plain, r"/data/(load=[^/]*(?:/.*)?)/[^/]*$", 1).alias("folder"), k.alias("__k"))
    return named.groupBy("folder", *parts).agg(F.count(F.lit(1)).alias("n_rows"), F.min("__k").alias("key_lo"),
                                               F.max("__k").alias("key_hi"), F.count_if(F.col("__k").isNull()).alias("key_nulls"))


def commit(spark: SparkSession, path: str, load_id: str, new: DataFrame, parts: Sequence[str] = (), key: Sequence[str] = (),
           base: Version | None = None, touched: DataFrame | None = None, sides: Mapping[str, DataFrame] | None = None,
           marks: Mapping[str, str] | None = None) -> Version:
    """Version ``base + 1``: the folders of ``base`` but for the partitions ``touched`` (None: but for all),
    and ``new``. Everything is written before the commit file, which is what makes it a version."""
    load = uuid.uuid4().hex
    parts = list(parts)
    schema = _ordered(new.schema, parts)
    schema = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    if base is not None and schema.simpleString() != _ordered(base.schema, base.parts).simpleString():
        raise ValueError(f"{path} holds {base.schema.simpleString()}, not {schema.simpleString()}")
    rows = new.select(*schema.fieldNames())
    if parts:  # few files a partition: small ones share a task, a large one is split over several (AQE)
        rows.hint("rebalance", *parts).write.partitionBy(*parts).parquet(f"{path}/data/load={load}")
    else:
        rows.write.parquet(f"{path}/data/load={load}")
    live = _summary(spark, path, load, schema, parts, key[0] if key else None)
    if base is not None and parts and touched is not None:
        live = live.unionByName(_matched(manifest(spark, base), touched, parts, "left_anti"))
    live.coalesce(1).write.parquet(f"{path}/manifest/{load}")
    for name, rows in (sides or {}).items():
        rows.write.parquet(f"{path}/side/{name}/load={load}")
    number = base.number + 1 if base else 0
    now = {**(base.marks if base else {}), **(marks or {})}
    _publish(spark, path, number, {"version": number, "load": load, "load_id": load_id, "schema": schema.json(), "parts": parts,
                                   "sides": list(sides or {}), "marks": now})
    return version(spark, path, number)


def near_rows(spark: SparkSession, base: Version, batch: DataFrame, key: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """The partitions a batch touches (its own and those of its keys' stored rows; None: no
    partitions) and the stored rows in them. Only folders whose key range meets the batch's are
    searched for its keys, and only the touched folders are then read."""
    live = manifest(spark, base)
    if not base.parts:
        return None, _open(spark, base, _folders(live))
    touched = batch.select(*base.parts)
    if key:
        span = batch.agg(F.min(key[0]).alias("b_lo"), F.max(key[0]).alias("b_hi"), F.max(F.col(key[0]).isNull()).alias("b_null"))
        meets = ((F.col("key_lo") <= F.col("b_hi")) & (F.col("key_hi") >= F.col("b_lo"))) | (F.col("b_null") & (F.col("key_nulls") > 0))
        maybe = _open(spark, base, _folders(live.join(F.broadcast(span), meets)))  # one row
        touched = touched.unionByName(_matched(maybe.select(*dict.fromkeys([*key, *base.parts])), batch, key, "left_semi").select(*base.parts))
    touched = _staged(touched.distinct(), "touched-partitions")
    return touched, _open(spark, base, _folders(_matched(live, touched, base.parts, "left_semi")))


def merge(spark: SparkSession, path: str, load_id: str, batch: DataFrame, parts: Sequence[str], key: Sequence[str],
           combine: Callable[[DataFrame, DataFrame | None], DataFrame], base: Version | None,
           sides: Mapping[str, DataFrame] | None = None, marks: Mapping[str, str] | None = None, moves: bool = True) -> DataFrame:
    """A batch combined with the stored rows near it, as the next version. ``moves``: a key's old rows can be in other partitions."""
    if base is not None and list(parts) != base.parts:
        raise ValueError(f"{path} is partitioned by {base.parts}, not by {list(parts)}")
    batch = _staged(batch, "load-batch")
    touched, near = near_rows(spark, base, batch, key if moves else ()) if base else (None, None)
    done = commit(spark, path, load_id, combine(batch, near), parts, key, base, touched, sides, marks)
    return _open(spark, done, _folders(manifest(spark, done)))


def _with_parts(df: DataFrame, partition_by: Sequence[str] | Mapping[str, Column]) -> tuple[DataFrame, list[str]]:
    if isinstance(partition_by, Mapping):
        df = df.withColumns(dict(partition_by))
    return df, list(partition_by)


# --------------------------------------------------------------------- S5
def promote_version(df: DataFrame, key: Sequence[str], order_by: Sequence[str], path: str, load_id: str,
                    partition_by: Sequence[str] | Mapping[str, Column] = (), conform: Mapping[str, str] | None = None,
                    sides: Mapping[str, DataFrame] | None = None, marks: Mapping[str, str] | None = None) -> DataFrame:
    """``promote_to_storage`` as one atomic version: newest row per key over all loads.

    A ``load_id`` that was committed before changes nothing, neither rows nor quarantine. Rows with
    a value that ``conform`` cannot cast are set aside as ``quarantine`` in the same version. A load
    that breaks before its commit leaves the table as it was and can be run again. A key
    that moves leaves its old partition. Null keys are keys. An empty batch is an
    (empty) version. Returns the table read back.
    """
    spark = df.sparkSession
    base = version(spark, path)
    if base and load_id in base.loads:
        return read(spark, path)
    sides = dict(sides or {})
    if conform:
        cast = {c: F.col(c).try_cast(t) for c, t in conform.items()}
        lost = F.lit(False)
        for c, v in cast.items():
            lost = lost | (F.col(c).isNotNull() & v.isNull())
        sides["quarantine"] = df.where(lost)
        df = df.where(~lost).withColumns(cast)
    df, parts = _with_parts(df, partition_by)

    def combine(batch: DataFrame, near: DataFrame | None) -> DataFrame:
        return newest_per_key(batch.unionByName(near), key, order_by) if near is not None else batch

    return merge(spark, path, load_id, newest_per_key(df, key, order_by), parts, key, combine, base, sides, marks)


# --------------------------------------------------------------------- S6
def upsert_version(delta: DataFrame, key: Sequence[str], path: str, load_id: str, op_col: str | None = None,
                   seq_col: str | None = None, partition_by: Sequence[str] | Mapping[str, Column] = ()) -> DataFrame:
    """``upsert_storage`` as one atomic version of a stored table: only the partitions that hold a changed
    key, before or after, are rewritten, and they stay partitions. Deletes are rows whose ``op_col`` is
    'D'. The rules for repeats, null keys, absent keys and null operations are ``upsert_storage``'s; a
    ``load_id`` that was committed before changes nothing."""
    spark = delta.sparkSession
    base = version(spark, path)
    if base and load_id in base.loads:
        return read(spark, path)
    gone = F.col(op_col).eqNullSafe(F.lit("D")) if op_col else F.lit(False)
    last = newest_per_key(delta, key, [seq_col] if seq_col else []).withColumn("__gone", gone)
    last, parts = _with_parts(last, partition_by)
    extra = [c for c in (op_col, seq_col) if c and (base is None or c not in base.schema.fieldNames())]
    last = last.drop(*extra)

    def combine(batch: DataFrame, near: DataFrame | None) -> DataFrame:
        added = batch.where("NOT __gone").drop("__gone")
        return added if near is None else _matched(near, batch, key, "left_anti").unionByName(added)

    return merge(spark, path, load_id, last, parts, key, combine, base)


# --------------------------------------------------------------------- S3
def load_increment(source: DataFrame, name: str, mark_col: str, key: Sequence[str], path: str, load_id: str,
                   order_by: Sequence[str] | None = None, partition_by: Sequence[str] | Mapping[str, Column] = (),
                   conform: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of ``source`` past its stored high-water mark, promoted into the table at ``path``.

    The new mark, and the keys of the rows taken at it, are stored in the load's own version: either
    rows, mark and keys are there, or none is. A break at any point is mended by running the load
    again; a load that was committed is not run twice; rows that arrive later with the mark's own
    value are taken by the next load. Marks are kept per ``name``, so several sources can feed one table.
    Rows without a mark come with every increment and stay one per key.
    """
    spark = source.sparkSession
    base = version(spark, path)
    if base and load_id in base.loads:
        return read(spark, path)
    kind = source.schema[mark_col].dataType.simpleString()
    kept, load = (base.marks.get(f"{name}:{x}") if base else None for x in ("mark", "load_id"))
    # Tied keys are those of the load that set the mark.
    taken = spark.read.parquet(f"{path}/side/taken/load={base.loads[load]}") if load is not None else None
    rows = _staged(past_mark(source, mark_col, None if kept is None else F.lit(kept).cast(kind), key, taken), "increment")
    mark = rows.agg(F.max(mark_col).cast("string").alias("m")).first().m
    if mark is None:  # nothing at or past the stored mark
        return promote_version(rows, key, order_by or [mark_col], path, load_id, partition_by, conform)
    ties = rows.where(F.col(mark_col) == F.lit(mark).cast(kind)).select(*key)
    if mark == kept:  # the mark stands: its new rows join those taken before
        ties = ties.unionByName(taken)
    return promote_version(rows, key, order_by or [mark_col], path, load_id, partition_by, conform, {"taken": ties.distinct()},
                           {f"{name}:mark": mark, f"{name}:load_id": load_id})
