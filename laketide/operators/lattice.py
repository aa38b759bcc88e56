"""P5/P6: the search for the generalisation that loses least and still hides everyone.

Every quasi-identifier has levels, from its own values up to one value for all. A choice of one
level each is a node of a lattice. Rows are counted once, at the finest grain; a node's groups
are sums of that table. Merging groups never makes one smaller, so whatever a node achieves all
coarser ones achieve, and what a node fails all finer ones fail. Each job counts ``batch`` nodes
spread over the losses still open: one that passes closes all that lose as much or more, one that fails
closes all finer ones, until none is open below the best.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.session import scratch_path

Node = tuple[int, ...]


@dataclass(frozen=True)
class Choice:
    """The levels chosen, what they cost, and what is left: groups, the smallest kept one, persons in too small ones."""
    levels: dict[str, int]
    loss: float
    groups: int
    smallest: int
    suppressed: int
    counted: int  # nodes whose groups were counted


def _finest(df: DataFrame, levels: Mapping[str, Sequence[Column]], unit: str | None) -> DataFrame:
    """One row for each combination of all levels' values (and person), with its rows; written once."""
    values = [c.cast("string").alias(f"q{i}_{j}") for i, of in enumerate(levels.values()) for j, c in enumerate(of)]
    who = [F.col(unit).alias("unit")] if unit else []
    rows = df.select(*values, *who)
    counts = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(df.sparkSession, "lattice")
    counts.write.parquet(path)
    return df.sparkSession.read.schema(counts.schema).parquet(path)


def _check_levels(finest: DataFrame, levels: Mapping[str, Sequence[Column]]) -> None:
    for i, (name, of) in enumerate(levels.items()):
        pairs = [(F.struct(f"q{i}_{j}"), F.struct(f"q{i}_{j}", f"q{i}_{j + 1}")) for j in range(len(of) - 1)]
        if not pairs:
            continue
        different = finest.select(*[f"q{i}_{j}" for j in range(len(of))]).distinct()
        r = different.agg(*[F.count_distinct(c) for p in pairs for c in p]).first()
        for j in range(len(pairs)):
            if r[2 * j] != r[2 * j + 1]:
                raise ValueError(f"{name}: a value of level {j} lies in several values of level {j + 1}")


def loss(node: Node, heights: Sequence[int]) -> Fraction:
    """Mean share of each quasi-identifier's levels that are given up."""
    return sum((Fraction(a, h) if h else Fraction(0) for a, h in zip(node, heights)), Fraction(0)) / len(node)


def _count(finest: DataFrame, nodes: Sequence[Node], k: int, unit: str | None) -> dict[Node, tuple[int, int, int]]:
    """Groups, smallest group of at least ``k``, and persons (rows) in smaller ones, of several nodes in one job."""
    cells = [F.struct(F.lit(at).alias("node"), *[F.col(f"q{i}_{j}").alias(f"v{i}") for i, j in enumerate(node)])
             for at, node in enumerate(nodes)]
    rest = ["unit"] if unit else []
    rows = finest.select(F.explode(F.array(*cells)).alias("c"), *rest, "n").select("c.*", *rest, "n")
    group = ["node", *[f"v{i}" for i in range(len(nodes[0]))]]
    if unit:  # a person counts once a group, and rows of nobody count for no one
        rows = rows.where(F.col("unit").isNotNull()).groupBy(*group, "unit").agg(F.lit(1).alias("n"))
    sizes = rows.groupBy(*group).agg(F.sum("n").alias("n"))
    whole = F.col("n") >= k
    out = sizes.groupBy("node").agg(F.count_if(whole).alias("groups"), F.min(F.when(whole, F.col("n"))).alias("least"),
                                    F.sum(F.when(whole, 0).otherwise(F.col("n"))).alias("small")).collect()
    found = {nodes[r.node]: (r.groups, r.least or 0, r.small) for r in out}
    return {n: found.get(n, (0, 0, 0)) for n in nodes}


def search_generalisation(df: DataFrame, levels: Mapping[str, Sequence[Column]], k: int, unit: str | None = None,
                          max_suppressed: int = 0, batch: int = 8) -> Choice | None:
    """The choice of levels with the least loss whose groups of fewer than ``k`` rows (persons, with
    ``unit``) hold at most ``max_suppressed`` of them; None if even the coarsest has more.

    ``levels``: for each quasi-identifier its values from fine to coarse; a value must lie in one value of the next
    level (checked). Ties in loss go to the choice that is finer in the quasi-identifiers named first.
    Nulls are values. An empty table takes the finest choice.
    """
    if k < 1 or not levels or any(not of for of in levels.values()):
        raise ValueError("k is at least 1, and every quasi-identifier has a level")
    finest = _finest(df, levels, unit)
    _check_levels(finest, levels)
    heights = [len(of) - 1 for of in levels.values()]
    order = lambda n: (loss(n, heights), n)
    todo = sorted(product(*[range(h + 1) for h in heights]), key=order)
    best, found = None, {}
    while todo:
        some = todo if len(todo) <= batch else [todo[len(todo) * (i + 1) // (batch + 1)] for i in range(batch)]
        found |= _count(finest, some, k, unit)
        failed = [n for n in some if found[n][2] > max_suppressed]
        best = min([n for n in some if n not in failed] + ([best] if best else []), key=order, default=None)
        # What is finer than a failed node fails as well; what costs more than the best is not asked for.
        todo = [n for n in todo if n not in found and (best is None or order(n) < order(best))
                and not any(all(a <= b for a, b in zip(n, f)) for f in failed)]
    return Choice(dict(zip(levels, best)), float(loss(best, heights)), *found[best], len(found)) if best else None


def at_levels(df: DataFrame, levels: Mapping[str, Sequence[Column]], choice: Choice) -> DataFrame:
    """The rows with each quasi-identifier at its chosen level (as text)."""
    return df.withColumns({c: of[choice.levels[c]].cast("string") for c, of in levels.items()})
