"""R4 by rows: which rows two copies of a table do not share, found through fingerprints of key ranges.

A fingerprint of any set of rows is (count, sum of row hashes, xor of other row hashes): it does
not depend on order, and fingerprints of parts add up. The sum is held as the sums of a hash's three pieces of
at most 22 bits, which fit whole numbers for any table. The ranges of a key are compared level
by level: a range whose fingerprints are equal is done, one that differs is cut into
``fan_out`` parts, until its parts hold few rows. Then, and only for those, keys are compared.
A level's filter is on the key itself, so where the copies are stored by their keys Spark
skips files and row groups outside the ranges that differ.

The driver holds at most ``max_ranges`` ranges. Where more differ, they are joined with their
neighbours: more rows are compared, none is missed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, MapType

Range = tuple[int, int]  # first and last place


def row_hashes(df: DataFrame, cols: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's values. Which values are null is hashed as well, because Spark's
    hash passes over them; maps are hashed as sorted entries."""
    values = [F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in cols]
    every = [*values, *[F.col(c).isNull() for c in cols]]
    return F.xxhash64(*every), F.xxhash64(F.lit("second"), *every)


def _fingerprint(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    a, b = row_hashes(df, cols)
    pieces = (a.bitwiseAND(0x3FFFFF), F.shiftright(a, 22).bitwiseAND(0x3FFFFF), F.shiftright(a, 44))
    return [F.count(F.lit(1)).alias("__n"), *[F.sum(p).alias(f"__s{i}") for i, p in enumerate(pieces)], F.bit_xor(b).alias("__x")]


PARTS = ("__s0", "__s1", "__s2", "__x")


def place(df: DataFrame, key: Sequence[str]) -> Column:
    """Where a key lies: a whole-numbered first key column itself, other keys by their hash. Rows
    without a first key have no place."""
    if isinstance(df.schema[key[0]].dataType, IntegralType):
        return F.col(key[0]).cast("long")
    return F.when(F.col(key[0]).isNotNull(), F.xxhash64(*key))


FEW = 8        # ranges that a filter names one by one
CELLS = 3000   # about as many cells stand for more of them


def _step(where: Column, first: int, last: int, width: int) -> Column:
    """How many whole steps of ``width`` a place lies behind ``first`` (rounded to zero before it)."""
    if last - first < 1 << 62:
        return F.call_function("div", F.try_subtract(where, F.lit(first).cast("long")), F.lit(width).cast("long"))
    return F.floor((where.cast("decimal(20,0)") - F.lit(first).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("long")


def _inside(where: Column, ranges: Sequence[Range], no_place: bool) -> Column:
    """Every place in one of the ranges. Many comparisons a row would cost more than the row: beyond a few ranges, a
    few wide ones reach the scan and one lookup among equal cells of the key follows, which lets no more pass than a
    cell at each end of a range."""
    parts = [where.between(lo, hi) for lo, hi in _joined(list(ranges), FEW)]
    told = reduce(lambda a, b: a | b, parts, F.lit(False))
    if len(ranges) > FEW:
        width = max(1, -(-sum(hi - lo + 1 for lo, hi in ranges) // CELLS))
        cell = lambda p: p // width if p >= 0 else -(-p // width)  # noqa: E731  # rounded to zero, as div does: no overflow
        cells = {c for lo, hi in ranges for c in range(cell(lo), cell(hi) + 1)}
        told = told & F.call_function("div", where, F.lit(width).cast("long")).isin(sorted(cells))
    return told | where.isNull() if no_place else told


def _joined(ranges: list[Range], most: int) -> list[Range]:
    """Touching ranges as one; then those with the smallest gaps, until at most ``most`` are left."""
    out: list[Range] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    if len(out) > most:
        gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1], reverse=True)[:most - 1]
        cuts = [0, *sorted(gaps), len(out)]
        out = [(out[a][0], out[b - 1][1]) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def differing_ranges(source: DataFrame, target: DataFrame, key: Sequence[str], fan_out: int = 64, leaf_rows: int = 10_000,
                     max_ranges: int = 200) -> tuple[list[Range], bool]:
    """Ranges of places in which the copies differ, and whether rows without a place do."""
    cols = sorted(source.columns)
    sides = {"a": source, "b": target}

    def compare(part: dict[str, Column], inside: dict[str, Column]) -> list:
        """One aggregation over both copies; rows of parts that differ: few, and bounded."""
        tables = [df.where(inside[n]).groupBy(part[n].alias("part")).agg(*_fingerprint(df, cols)).withColumn("side", F.lit(n))
                  for n, df in sides.items()]
        both = tables[0].unionByName(tables[1])
        ends = [f(c).alias(f"{name}{c}") for c in PARTS for name, f in (("least", F.min), ("most", F.max))]
        return (both.groupBy("part").agg(F.max("__n").alias("n"), F.count(F.lit(1)).alias("sides"), F.min("__n").alias("n0"), *ends)
                .where("sides < 2 OR n0 <> n OR " + " OR ".join(f"least{c} <> most{c}" for c in PARTS)).select("part", "n").collect())

    at = {n: place(df, key) for n, df in sides.items()}
    ends = [df.agg(F.min(at[n]).alias("lo"), F.max(at[n]).alias("hi")).first() for n, df in sides.items()]
    lows, highs = [e.lo for e in ends if e.lo is not None], [e.hi for e in ends if e.hi is not None]
    open_, leaves, no_place, first = ([(min(lows), max(highs))] if lows else []), [], False, True
    while open_ or first:
        # All open ranges are cut alike: by the width that cuts the longest into `fan_out`.
        width = max([1, *[-(-(hi - lo + 1) // fan_out) for lo, hi in open_]])
        base = min((lo for lo, _ in open_), default=0)
        cut = lambda c: _step(c, base, max(highs, default=0), width)  # noqa: B023, E731
        # The first level reads all rows: those without a place are one part (null) of it.
        found = compare({n: cut(at[n]) for n in sides}, {n: F.lit(True) if first else _inside(at[n], open_, False) for n in sides})
        no_place = no_place or any(r.part is None for r in found)
        parts = [(max(lo, base + r.part * width), min(hi, base + (r.part + 1) * width - 1), r.n) for r in found if r.part is not None
                 for lo, hi in open_ if lo <= base + (r.part + 1) * width - 1 and hi >= base + r.part * width]
        leaves += [(lo, hi) for lo, hi, n in parts if n <= leaf_rows or width == 1]
        open_ = [(lo, hi) for lo, hi, n in parts if n > leaf_rows and width > 1]
        first = False
        if len(open_) > max_ranges:
            leaves, open_ = leaves + open_, []
    return _joined(leaves, max_ranges), no_place


def reconcile_rows(source: DataFrame, target: DataFrame, key: Sequence[str], fan_out: int = 64, leaf_rows: int = 10_000,
                   max_ranges: int = 200) -> DataFrame:
    """Keys whose rows differ between two copies: the key, ``status``, ``n_source``, ``n_target``.

    ``status``: ``lost`` and ``added`` (only one copy has the key), ``doubled`` and ``thinned`` (target has
    more or fewer rows of it), ``changed`` (as many rows, other values). Both copies have the same
    columns, in any order. Null keys are keys; repeated rows count. Equal copies give no row, as do two empty ones.
    """
    if sorted(source.columns) != sorted(target.columns):
        raise ValueError("the copies have different columns")
    key, cols = list(key), sorted(source.columns)
    ranges, no_place = differing_ranges(source, target, key, fan_out, leaf_rows, max_ranges)
    per_key = [df.where(_inside(place(df, key), ranges, no_place)).groupBy(*key).agg(*_fingerprint(df, cols)) for df in (source, target)]
    a = per_key[0].select(*key, F.col("__n").alias("n_source"), F.struct(*PARTS).alias("was"))
    b = per_key[1].select(*[F.col(k).alias(f"t_{k}") for k in key], F.col("__n").alias("n_target"), F.struct(*PARTS).alias("now"))
    met = a.join(b, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in key]), "full_outer")
    both = {k: F.when(F.col("n_source").isNotNull(), F.col(k)).otherwise(F.col(f"t_{k}")).alias(k) for k in key}
    status = (F.when(F.col("n_target").isNull(), "lost").when(F.col("n_source").isNull(), "added")
              .when(F.col("n_target") > F.col("n_source"), "doubled").when(F.col("n_target") < F.col("n_source"), "thinned")
              .when(~F.col("was").eqNullSafe(F.col("now")), "changed"))
    return (met.withColumn("status", status).where(F.col("status").isNotNull())
            .select(*both.values(), "status", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_source", "n_target")]))
