"""Refinement into data models (R1-R5): dimensions, facts, history, quality, JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StructType
from pyspark.sql.window import Window

# Fixed surrogate key of the "unknown" member of every dimension.
UNKNOWN_KEY = "0" * 64


def surrogate_key(cols: Sequence[str]) -> Column:
    """Stable hashed key: sha256 hex of the natural key parts, each with its
    length in front, so that no two keys run together to the same text."""
    parts = [F.col(c).cast("string") for c in cols]
    return F.sha2(F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]), 256)


# --------------------------------------------------------------------- R1
def build_dimension(df: DataFrame, natural_key: Sequence[str], attrs: Sequence[str],
                    unknown: Mapping[str, object] | None = None,
                    key_name: str = "dim_key") -> DataFrame:
    """Conformed dimension: one row per natural key, a hashed surrogate key,
    and an "unknown" member (null natural key, ``UNKNOWN_KEY``).

    Duplicated natural keys keep their greatest attribute tuple (a
    deterministic choice), computed by an aggregation with map-side partial
    results so duplicated or hot keys shrink before the shuffle.
    """
    natural_key = list(natural_key)
    attrs = list(attrs)
    picked = (df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in natural_key]))
              .groupBy(*natural_key)
              .agg(F.max(F.struct(*attrs)).alias("__a"))
              .select(surrogate_key(natural_key).alias(key_name), *natural_key,
                      *[F.col(f"__a.{a}").alias(a) for a in attrs]))
    unknown = unknown or {}
    types = dict(df.select(*natural_key, *attrs).dtypes)
    member = df.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).alias(key_name),
        *[F.lit(None).cast(types[c]).alias(c) for c in natural_key],
        *[F.lit(unknown.get(a)).cast(types[a]).alias(a) for a in attrs])
    return picked.unionByName(member)


# --------------------------------------------------------------------- R2
@dataclass
class DimRef:
    """How a fact table points at one dimension."""
    dim: DataFrame
    fact_cols: Sequence[str]
    dim_cols: Sequence[str]
    key_name: str = "dim_key"


def build_fact(facts: DataFrame, dims: Sequence[DimRef],
               drop_natural: bool = True) -> DataFrame:
    """Attach dimension keys to fact rows; unmatched rows point to the unknown member.

    Each dimension must be unique on its natural key (``build_dimension``
    guarantees it); fact rows are never multiplied then.

    Each dimension joins by a left equi join on the natural key, projected to
    (natural key, surrogate key) so only two columns travel. File statistics
    and AQE decide by bytes which side, if any, is broadcast.
    """
    out = facts
    for ref in dims:
        side = ref.dim.where(F.col(ref.key_name) != F.lit(UNKNOWN_KEY)).select(
            *[F.col(d).alias(f"__d_{d}") for d in ref.dim_cols], F.col(ref.key_name))
        cond = reduce(lambda a, b: a & b,
                      [out[f] == side[f"__d_{d}"] for f, d in zip(ref.fact_cols, ref.dim_cols)])
        out = (out.join(side, cond, "left")
               .withColumn(ref.key_name, F.coalesce(F.col(ref.key_name), F.lit(UNKNOWN_KEY)))
               .drop(*[f"__d_{d}" for d in ref.dim_cols]))
        if drop_natural:
            out = out.drop(*ref.fact_cols)
    return out


# --------------------------------------------------------------------- R3
SLICE_UNITS = (None, "year", "quarter", "month", "week", "day", "hour", "minute", "second")


def _left_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on equal or both-null keys."""
    side = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(side[f"__r_{k}"]) for k in keys])
    return left.join(side, cond, "left").drop(*[f"__r_{k}" for k in keys])


def history_scd2(df: DataFrame, key: Sequence[str] | str, ts: str,
                 state_cols: Sequence[str], tie_break: Sequence[str] = (),
                 slice_unit: str | None = "month") -> DataFrame:
    """Type-2 history: one row per run of equal state per key.

    Output: key, state columns, ``valid_from`` (first time of the run),
    ``valid_to`` (start of the next run, null for the current one) and
    ``is_current``. Rows at the same time are ordered by ``tie_break`` and
    then by the state itself, so the result is deterministic.

    A key's history is cut into time slices (``slice_unit``, from year down to
    second; None for one slice per key). Windows run per (key, slice), so
    a key holding a third of all rows still spreads over as many tasks as it
    has slices: choose the unit so that the busiest key's slice fits a task. Slice boundaries are stitched with two small per-slice
    tables: the last state of the slice before (to decide whether a slice's
    first row starts a run) and the first run start of the slice after (to
    close a slice's last run). Both hold one row per (key, slice) and are
    joined back on (key, slice), which keeps the hot key spread. Null keys and
    null times are a key and a slice like others: all stitching is null-safe. Rows
    of a key without a time are all equal in time and differ only in ``tie_break`` and state:
    they are reduced to their distinct values before they meet in that one slice.
    """
    if slice_unit not in SLICE_UNITS:
        raise ValueError(f"slice_unit must be one of {SLICE_UNITS}, not {slice_unit!r}")
    keys = [key] if isinstance(key, str) else list(key)
    order = [ts, *tie_break, *[c for c in state_cols if c not in tie_break]]
    cols = list(dict.fromkeys([*keys, *order]))
    rows = df.select(*cols)
    if df.schema[ts].nullable:  # one slice a key, however many rows: equal ones say nothing twice
        rows = rows.where(F.col(ts).isNotNull()).unionByName(rows.where(F.col(ts).isNull()).distinct())
    if slice_unit is None:
        base = rows.withColumn("__slice", F.lit(0))
    else:
        base = rows.withColumn("__slice", F.date_trunc(slice_unit, F.col(ts)))
    grp = [*keys, "__slice"]
    w = Window.partitionBy(*grp).orderBy(*[F.col(c) for c in order])
    per_key = Window.partitionBy(*keys).orderBy("__slice")
    state = F.struct(*state_cols)

    # Last state of each slice, handed to the next slice of the same key.
    carry = (base.groupBy(*grp)
             .agg(F.max(F.struct(*[F.col(c) for c in order], state.alias("__s"))).alias("__last"))
             .select(*grp, F.lag(F.col("__last.__s")).over(per_key).alias("__carry")))
    flagged = _left_null_safe(base.withColumn("__prev", F.lag(state).over(w)), carry, grp)
    # Only a slice's first row has a null lag; it compares with the carried state.
    prev = F.coalesce(F.col("__prev"), F.col("__carry"))
    starts = flagged.where(prev.isNull() | ~state.eqNullSafe(prev)).select(*cols, "__slice")

    # First run start of the next slice that has one, to close the last run of a slice.
    following = (starts.groupBy(*grp).agg(F.min(F.struct(ts)).alias("__first"))
                 .select(*grp, F.lead("__first").over(per_key).alias("__next_slice")))
    # The last run of a key is known by having no later run, not by a null time.
    closed = _left_null_safe(starts.withColumn("__next", F.lead(F.struct(ts)).over(w)), following, grp)
    after = F.coalesce(F.col("__next"), F.col("__next_slice"))
    return closed.select(*keys, *state_cols, F.col(ts).alias("valid_from"), after.getField(ts).alias("valid_to"),
                         after.isNull().alias("is_current"))


# --------------------------------------------------------------------- R4
@dataclass
class Rule:
    """One quality check.

    check: ``rows``, ``nulls`` (columns), ``duplicate_keys`` (columns),
    ``orphans`` (columns -> ref_table.ref_columns), ``reconcile`` (this table
    against ref_table: row counts and sums of ``measures``).
    """
    table: str
    check: str
    columns: Sequence[str] = field(default_factory=list)
    ref_table: str | None = None
    ref_columns: Sequence[str] = field(default_factory=list)
    measures: Sequence[str] = field(default_factory=list)


# Counts and totals to the cent, at any size a table can have.
EXACT = "decimal(38,2)"
UNROUNDED = "decimal(38,12)"


def _exact(df: DataFrame, measure: str) -> Column:
    """A measure whose sum does not depend on the order of rows, with all its digits: integers and
    decimals as they are, floating numbers to twelve places (rows are never rounded to the cent)."""
    kind = df.schema[measure].dataType
    if isinstance(kind, DecimalType):
        return F.col(measure)
    return F.col(measure).cast(UNROUNDED if isinstance(kind, (DoubleType, FloatType)) else "decimal(38,0)")


def _long(pairs: Sequence[tuple[tuple[str, str, str], Column]], df: DataFrame) -> DataFrame:
    """One aggregation pass over ``df``; one output row per labelled value."""
    agg = df.agg(*[v.cast(UNROUNDED).alias(f"v{i}") for i, (_, v) in enumerate(pairs)])
    stack = ", ".join(f"'{t}', '{c}', '{s}', v{i}" for i, ((t, c, s), _) in enumerate(pairs))
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) as (table_name, check, subject, value)")


def quality_report(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Long table ``table_name, check, subject, value`` with one row per measurement.

    Sums are taken in the measure's own type (floating numbers to twelve places)
    and only the total is rounded to the cent. Every reconciliation also has
    ``difference:`` rows (target less source), taken before that and rounded away
    from zero, so that no difference disappears.

    Row counts, null counts and reconciliation totals of one table are
    gathered into a single aggregation, so each table is scanned once for
    them. Duplicate keys are a grouped count (partial counts before the
    shuffle), orphans a left anti join against the parent keys.
    Every branch reduces to a few rows before the union.
    """
    scalar: dict[str, list[tuple[tuple[str, str, str], Column]]] = {}
    parts: list[DataFrame] = []

    def add(on: str, label: tuple[str, str, str], value: Column) -> None:
        scalar.setdefault(on, []).append((label, value))

    for r in rules:
        t = tables[r.table]
        if r.check == "rows":
            add(r.table, (r.table, "rows", "*"), F.count(F.lit(1)))
        elif r.check == "nulls":
            for c in r.columns:
                add(r.table, (r.table, "nulls", c), F.count_if(F.col(c).isNull()))
        elif r.check == "reconcile":
            for side, on in (("source", r.ref_table), ("target", r.table)):
                add(on, (r.table, "reconcile", f"{side}:rows"), F.count(F.lit(1)))
                for m in r.measures:
                    add(on, (r.table, "reconcile", f"{side}:sum({m})"),
                        F.sum(_exact(tables[on], m)))
        elif r.check == "duplicate_keys":
            dup = (t.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > 1))
            subject = ",".join(r.columns)
            parts.append(_long(
                [((r.table, "duplicate_keys", subject + ":keys"), F.count(F.lit(1))),
                 ((r.table, "duplicate_keys", subject + ":extra_rows"),
                  F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))], dup))
        elif r.check == "orphans":
            ref = tables[r.ref_table].select(
                *[F.col(c).alias(f"__r_{c}") for c in r.ref_columns])
            child = t.select(*r.columns)
            not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in r.columns])
            cond = reduce(lambda a, b: a & b,
                          [child[c] == ref[f"__r_{rc}"] for c, rc in zip(r.columns, r.ref_columns)])
            orphans = child.where(not_null).join(ref, cond, "left_anti")
            subject = ",".join(r.columns) + "->" + r.ref_table + "." + ",".join(r.ref_columns)
            parts.append(_long([((r.table, "orphans", subject), F.count(F.lit(1)))], orphans))
            add(r.table, (r.table, "null_foreign_keys", subject), F.count_if(~not_null))
        else:
            raise ValueError(f"unknown check {r.check!r}")
    for on, pairs in scalar.items():
        parts.append(_long(pairs, tables[on]))
    out = reduce(DataFrame.unionByName, parts)
    report = out.withColumn("value", F.col("value").cast(EXACT))
    if not any(r.check == "reconcile" for r in rules):
        return report
    side = F.substring_index("subject", ":", 1)
    signed = F.sum(F.when(side == "target", F.col("value")).otherwise(-F.col("value")))
    of = F.expr("substring(subject, instr(subject, ':'))")
    whole = F.when(signed < 0, F.floor(signed * 100)).otherwise(F.ceil(signed * 100))
    gaps = (out.where(F.col("check") == "reconcile").groupBy("table_name", "check", F.concat(F.lit("difference"), of).alias("subject"))
            .agg((whole / 100).cast(EXACT).alias("value")))
    return report.unionByName(gaps)


# --------------------------------------------------------------------- R5
def flatten_json(df: DataFrame, col: str, schema: StructType | str,
                 prefix: str = "", keep_source: bool = False) -> DataFrame:
    """Lift fields of a JSON string column into typed top-level columns.

    Broken JSON, missing fields and values of the wrong type give nulls
    (PERMISSIVE parsing) instead of failing the job.
    """
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("__j")
    keep = [c for c in df.columns if keep_source or c != col]
    out = df.select(*keep, parsed)
    fields = out.schema["__j"].dataType.fieldNames()
    return out.select(*keep, *[F.col(f"__j.{f}").alias(prefix + f) for f in fields])
