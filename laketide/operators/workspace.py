"""Side lake and analysis (W1-W3): governed extracts, cohorts, profiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Context, Decimal
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType
from pyspark.sql.window import Window

from laketide.functions import generalise as gen
from laketide.functions import keyed
from laketide.operators.privacy import generalise, mask_text, pseudonymise, suppress_small_cells
from laketide.session import scratch_path
from laketide.sources.storage import publish_workspace_table


# --------------------------------------------------------------------- W1
@dataclass
class Policy:
    """What one workspace may take from one main-lake table.

    ``columns``: columns kept (after tokenising and generalising);
    ``row_filter``: SQL predicate on the source rows; ``tokenise``: column ->
    domain, re-tokenised under the workspace's own key; ``generalise``: rules
    of ``privacy.generalise``; ``quasi``, ``k`` and ``unit``: small-cell
    suppression over the generalised quasi-identifiers, counting different
    values of ``unit`` (the person's identifier in the source; required with
    ``k`` over 1, because rows are not persons); ``mask``: free-text columns whose
    direct identifiers are blanked (``privacy.mask_text`` with the default
    rules; the hit counts are not carried into the extract).
    """
    table: str
    columns: Sequence[str]
    row_filter: str | None = None
    tokenise: Mapping[str, str] = field(default_factory=dict)
    mask: Sequence[str] = field(default_factory=list)
    generalise: Mapping[str, tuple] = field(default_factory=dict)
    quasi: Sequence[str] = field(default_factory=list)
    k: int = 1
    unit: str | None = None


def workspace_key(key_df: DataFrame, workspace: str) -> DataFrame:
    """The workspace's own key, derived from the main key: two side lakes'
    tokens cannot be joined with each other or with the main lake."""
    return keyed.derive_key_table(key_df, "workspace:" + workspace)


def workspace_extract(spark: SparkSession, policy: Policy, workspace: str,
                      key_df: DataFrame, source: DataFrame | None = None,
                      lake_root: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Main lake to side lake as one declarative plan:
    row filter -> re-tokenise -> mask texts -> generalise -> small-cell suppression -> columns.

    ``source`` defaults to ``spark.table(policy.table)``. The filter and the
    column list reach the scan (pushdown and pruning); tokenising and
    generalising are narrow projections; suppression is one grouped count
    plus an anti join. With ``lake_root`` the extract is written to the
    workspace's storage zone, registered in its catalog database, and the
    registered table is returned.
    """
    suppress = bool(policy.quasi) and policy.k > 1
    if suppress and policy.unit is None:
        raise ValueError("a policy with k over 1 must name the unit that k counts")
    df = source if source is not None else spark.table(policy.table)
    needed = list(dict.fromkeys([*policy.columns, *policy.quasi, *([policy.unit] if suppress else [])]))
    if policy.row_filter:
        df = df.where(F.expr(policy.row_filter))
    df = df.select(*needed)
    if policy.tokenise:
        df = pseudonymise(df, dict(policy.tokenise), workspace_key(key_df, workspace))
    for c in policy.mask:
        df = mask_text(df, c).select(*needed)
    if policy.generalise:
        df = generalise(df, policy.generalise)
    if suppress:
        df = suppress_small_cells(df, policy.quasi, policy.k, unit=policy.unit)
    df = df.select(*policy.columns)
    if lake_root is None:
        return df
    return publish_workspace_table(df, workspace, policy.table, partition_by, lake_root)


# --------------------------------------------------------------------- W2
BUCKETS = 1 << 32


def sample_cohort(df: DataFrame, id_col: str, salt: str, pct: float) -> DataFrame:
    """Repeatable sample of ``pct`` percent of identifiers.

    The bucket is a function of (salt, id) only, so the same people are
    picked in every table that carries the id; a narrow filter, no shuffle.
    Buckets are the full 32 bits of the hash: ``pct`` is met to a part in four
    billion, and a smaller one is refused rather than rounded to nobody.
    """
    cutoff = int(round(pct * BUCKETS / 100.0))
    if not 0 <= pct <= 100 or (pct > 0 and cutoff == 0):
        raise ValueError(f"pct must be 0, or between {100 / BUCKETS} and 100, not {pct}")
    return df.where(gen.hash_bucket(F.col(id_col), salt, BUCKETS) < F.lit(cutoff))


# --------------------------------------------------------------------- W3
PROFILE_QUANTILES = (0.25, 0.5, 0.75)
FINAL_VALUES = 100_000   # distinct values that are ranked in one task
EDGES = 64               # parts that a longer stretch of values is cut into at a time


def exact_scale(df: DataFrame, cols: Sequence[str]) -> int:
    """Places after the point that the exact columns need together."""
    return max((f.dataType.scale for f in df.schema.fields if f.name in cols and isinstance(f.dataType, DecimalType)), default=0)


def value_kinds(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """How each column's values are held: ``x`` (exact), ``d`` (double) or ``s`` (text). A decimal that
    does not fit beside the others' places after the point is held as a double."""
    scale, out = exact_scale(df, cols), {}
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, DecimalType):
            out[c] = "x" if kind.precision - kind.scale + scale <= 38 else "d"
        elif isinstance(kind, IntegralType):
            out[c] = "x" if 19 + scale <= 38 else "d"
        else:
            out[c] = "d" if isinstance(kind, NumericType) else "s"
    return out


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``i, d, x, s, c``: every column's different values (integers and decimals as
    decimals in ``x``, with all their digits; floating numbers in ``d``; others as text in
    ``s``) and their counts, written once.

    Partial counts shrink repeated and hot values before the shuffle.
    """
    kinds = value_kinds(df, cols)
    types = {"d": "double", "x": f"decimal(38,{exact_scale(df, cols)})", "s": "string"}
    cells = [F.struct(F.lit(i).alias("i"), *[(F.col(c) if n == kinds[c] else F.lit(None)).cast(t).alias(n) for n, t in types.items()])
             for i, c in enumerate(cols)]
    long = df.select(F.explode(F.array(*cells)).alias("v")).select("v.*")
    freq = long.groupBy("i", "d", "x", "s").agg(F.count(F.lit(1)).alias("c"))
    path = scratch_path(df.sparkSession, "profile")
    freq.write.parquet(path)
    return df.sparkSession.read.schema(freq.schema).parquet(path)


def exact_quantiles(freq: DataFrame, totals: Mapping[int, int], qs: Sequence[float], final_values: int = FINAL_VALUES,
                    value: str = "d") -> dict[int, list]:
    """Exact interpolated percentiles of many columns at once: column number -> values.

    ``freq`` has ``i, c`` and the column ``value`` (see ``value_counts``), ``totals`` the number of
    values of each column. Equal to Spark's ``percentile`` (position
    ``q * (n - 1)``, linear between the two nearest ranks), but that values keep their
    type: doubles, or decimals with all their digits.

    Every (column, q) looks for two neighbouring ranks in a stretch of values.
    A stretch of more than ``final_values`` different values is cut at ``EDGES``
    sketched quantiles of its values, the parts are counted, and the parts with
    the two ranks are the next stretch: about ``EDGES`` times shorter. The
    steps are the same at every size, only their number grows (with the
    logarithm of the distinct count). All columns share each step, targets of one
    stretch read it once, and a value finds its part by halving the edges; a step
    sends the driver a few numbers per (column, q), and only a stretch of at
    most ``final_values`` values is ever sorted in one task.
    """
    spark = freq.sparkSession
    targets = {(i, j): (math.floor(q * (n - 1)), math.ceil(q * (n - 1)), q * (n - 1))
               for i, n in totals.items() if n for j, q in enumerate(qs)}
    freq = freq.select("i", "c", F.col(value).alias("d"))
    kind = freq.schema["d"].dataType
    if isinstance(kind, DecimalType):
        end = Decimal(10 ** 38 - 1).scaleb(-kind.scale, Context(prec=60))
        ends, number = (end.copy_negate(), end), Fraction
    else:  # NaN sorts above infinity: the first stretch is unbounded above
        ends, number = (float("-inf"), float("nan")), float
    stretch = {t: (*ends, 0) for t in targets}  # low, high, values below

    def inside(open_: dict) -> DataFrame:
        rows = [(i, j, lo, hi) for (i, j), (lo, hi, _) in open_.items()]
        side = spark.createDataFrame(rows, f"ti int, j int, lo {kind.simpleString()}, hi {kind.simpleString()}")
        # A row for each (column, q): few and bounded.
        return freq.where(F.col("d").isNotNull()).join(
            F.broadcast(side), (F.col("i") == F.col("ti")) & (F.col("d") >= F.col("lo")) & (F.col("d") <= F.col("hi")))

    done: dict[tuple[int, int], tuple[float, float, int]] = {}
    probs = [k / EDGES for k in range(1, EDGES)]
    while stretch:
        first_of: dict[tuple, tuple[int, int]] = {}
        told_by = {t: first_of.setdefault((t[0], _same(s[0]), _same(s[1])), t) for t, s in stretch.items()}  # one target a stretch
        looks = inside({t: stretch[t] for t in first_of.values()}).groupBy("i", "j").agg(
            F.count(F.lit(1)).alias("values"), F.percentile_approx("d", probs, 10_000).alias("edges")).collect()
        edges = {(r["i"], r["j"]): sorted({e for e in r["edges"] if e is not None}, key=_order) for r in looks}
        few = {(r["i"], r["j"]) for r in looks if r["values"] <= final_values}
        small = {t for t in stretch if told_by[t] in few}
        done.update({t: stretch[t] for t in small})
        stretch = {t: s for t, s in stretch.items() if t not in small}
        if not stretch:
            break
        open_ = {t: stretch[t] for t in {told_by[t] for t in stretch}}
        cut = spark.createDataFrame([(*t, edges[t]) for t in open_], f"ci int, cj int, edges array<{kind.simpleString()}>")
        placed = (inside(open_).join(F.broadcast(cut), (F.col("i") == F.col("ci")) & (F.col("j") == F.col("cj")))
                  .withColumn("part", F.lit(0)))
        for step in (1 << k for k in reversed(range(EDGES.bit_length()))):  # the number of edges below the value
            placed = placed.withColumn("part", F.col("part") + F.when(F.get("edges", F.col("part") + (step - 1)) < F.col("d"), step).otherwise(0))
        counts = (placed.groupBy("i", "j", "part").agg(F.sum("c").alias("c"), F.min("d").alias("lo"), F.max("d").alias("hi"))
                  .collect())
        for t in list(stretch):
            below, first, last = stretch[t][2], None, None
            for r in sorted((r for r in counts if (r["i"], r["j"]) == told_by[t]), key=lambda r: r["part"]):
                if first is None and targets[t][0] < below + r["c"]:
                    first = (r["lo"], below)
                if last is None and targets[t][1] < below + r["c"]:
                    last = r["hi"]
                below += r["c"]
            new = (first[0], last, first[1])
            if [_same(v) for v in new[:2]] == [_same(v) for v in stretch[t][:2]]:
                done[t] = stretch.pop(t)  # edges no longer part it: nearly one value
            else:
                stretch[t] = new
    if not done:
        return {}
    upto = F.sum("c").over(Window.partitionBy("i", "j").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    side = spark.createDataFrame([(*t, below, *targets[t][:2]) for t, (_, _, below) in done.items()],
                                 "ki int, kj int, below long, r0 long, r1 long")
    ranked = (inside(done).withColumn("upto", upto)
              .join(F.broadcast(side), (F.col("i") == F.col("ki")) & (F.col("j") == F.col("kj")))
              .withColumn("hi_rank", F.col("below") + F.col("upto")).withColumn("lo_rank", F.col("hi_rank") - F.col("c")))
    at = lambda r: F.max(F.when((F.col("lo_rank") <= F.col(r)) & (F.col(r) < F.col("hi_rank")), F.col("d")))
    out: dict[int, list[float]] = {i: [None] * len(qs) for i in totals}
    for r in ranked.groupBy("i", "j").agg(at("r0").alias("v0"), at("r1").alias("v1")).collect():
        lo, hi, p = targets[r["i"], r["j"]]
        v0, v1 = r["v0"], r["v1"]
        out[r["i"]][r["j"]] = v0 if lo == hi or v0 == v1 else number(hi - p) * number(v0) + number(p - lo) * number(v1)
    return out


def _order(v: float) -> tuple[bool, float]:
    return (math.isnan(v), v)


def _same(v: float) -> float | None:
    """A value that equals itself: NaN does not."""
    return None if math.isnan(v) else v


def _figure(v: object, decimal_scale: int | None) -> object:
    """A figure as a double, or as a decimal of so many places (None: it has none there)."""
    if v is None or decimal_scale is None:
        return None if v is None else float(v)
    if isinstance(v, float):
        v = Fraction(v) if math.isfinite(v) else None
    return None if v is None else Decimal(round(Fraction(v) * 10 ** decimal_scale)).scaleb(-decimal_scale, Context(prec=60))


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
            accuracy: int = 10_000, final_values: int = FINAL_VALUES, decimal_scale: int | None = None) -> DataFrame:
    """Per column: count, nulls, distinct, min, max, mean, quartiles.

    Integers and decimals are counted and ranked with all their digits. ``min`` to
    ``p75`` are doubles, or decimals of ``decimal_scale`` places (half to even) where keys beyond a
    double's 53 bits are to be shown as they are.

    ``exact=True``: one pass counts every column's different values
    (``value_counts``, written once); all figures come from that table, the
    quartiles by ``exact_quantiles``: one way at every size
    (``quantile_method`` = ``exact``). ``exact=False``: HyperLogLog++ and
    Greenwald-Khanna sketches in one pass (``approx``). Non-numeric columns
    get counts only.
    """
    cols = list(cols or df.columns)
    spark = df.sparkSession
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    if exact:
        freq = value_counts(df, cols)
        kinds = value_kinds(df, cols)
        value = F.col("d").isNotNull() | F.col("x").isNotNull() | F.col("s").isNotNull()
        n = F.sum(F.when(value, F.col("c")).otherwise(0))
        # A total beyond 38 digits is taken again in doubles.
        times = F.try_multiply("x", F.col("c").cast("decimal(19,0)"))
        whole = F.when(F.count_if(F.col("x").isNotNull() & times.isNull()) == 0, F.try_sum(times))
        total = freq.groupBy("i").agg(
            n.alias("n"), (F.sum("c") - n).alias("n_null"), F.count_if(value).alias("n_distinct"),
            *[f(k).alias(f"{name}_{k}") for k in ("d", "x") for name, f in (("min", F.min), ("max", F.max))],
            F.sum(F.col("d") * F.col("c")).alias("sum_d"), whole.alias("sum_x"),
            F.sum(F.col("x").cast("double") * F.col("c")).alias("rough_x"))
        seen = {r["i"]: r for r in total.collect()}  # one row a column
        q = {}
        for kind in ("d", "x"):
            q |= exact_quantiles(freq, {i: seen[i]["n"] for i, c in enumerate(cols) if kinds[c] == kind and i in seen},
                                 PROFILE_QUANTILES, final_values, kind)
        rows = []
        for i, c in enumerate(cols):
            r = seen[i].asDict() if i in seen else dict.fromkeys(("n", "n_null", "n_distinct"), 0)
            k, figures = kinds[c], [None] * 6
            if k != "s" and r["n"]:
                exact_sum = r["sum_d"] if k == "d" else r["sum_x"]
                mean = (Fraction(exact_sum) / r["n"] if k == "x" and exact_sum is not None
                        else (r["sum_d"] if k == "d" else r["rough_x"]) / r["n"])
                figures = [r[f"min_{k}"], r[f"max_{k}"], mean, *q[i]]
            rows.append((c, r["n"], r["n_null"], r["n_distinct"], *(_figure(v, decimal_scale) for v in figures),
                         "exact" if c in numeric else None))
        shown = "double" if decimal_scale is None else f"decimal(38,{decimal_scale})"
        return spark.createDataFrame(rows, "column_name string, n long, n_null long, n_distinct long, "
                                     + "".join(f"{f} {shown}, " for f in ("min", "max", "mean", "p25", "p50", "p75"))
                                     + "quantile_method string")
    aggs = []
    for i, c in enumerate(cols):
        x, none = F.col(c), F.lit(None).cast("double")
        xd = x.cast("double") if c in numeric else None
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x.isNull()).alias(f"z{i}"), F.approx_count_distinct(x).alias(f"d{i}")]
        aggs += ([F.min(xd).alias(f"lo{i}"), F.max(xd).alias(f"hi{i}"), F.avg(xd).alias(f"m{i}"),
                  F.percentile_approx(xd, list(PROFILE_QUANTILES), accuracy).alias(f"q{i}"), F.lit("approx").alias(f"qm{i}")]
                 if c in numeric else
                 [none.alias(f"lo{i}"), none.alias(f"hi{i}"), none.alias(f"m{i}"), F.lit(None).cast("array<double>").alias(f"q{i}"),
                  F.lit(None).cast("string").alias(f"qm{i}")])
    rows = ", ".join(f"'{c}', n{i}, z{i}, d{i}, lo{i}, hi{i}, m{i}, q{i}[0], q{i}[1], q{i}[2], qm{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr(f"stack({len(cols)}, {rows}) as (column_name, n, n_null, n_distinct, "
                                    "min, max, mean, p25, p50, p75, quantile_method)")
