"""Filter interaction audit by count-weighted decision diagrams.

Every document gets a mask of the filters it fails. Per part, the masks and
their document counts become a diagram: a level a filter, a low edge for
passing it and a high edge for failing it, equal sub-diagrams shared, and at
every node the counts of all documents below. For filters applied in the
diagram's order, the path of low edges gives what is kept after each step, and
the high edges leaving it what each step removes. Another order needs
no other pass over the data: two neighbouring levels are swapped, and plain
changes visit all orders by one swap each.

Spark computes the masks and counts; a diagram is built from at most
``2 ** filters`` rows, in one task a part. The filter for copies asks for the smallest
id of each text: a partial aggregate by digest, met by (digest, id), so that
neither a text nor a null id held by a third of all rows gathers in a task.

Defined cases. Null text counts as empty, a null part as the empty string.
Rows are documents one by one, repeated rows too. A row without ``doc_id`` has
no smaller id, is none to others, and has no label. Rows that repeat the
smallest id of their text are no copies. A document is good (toxic) when any
label row of its id says so. Texts with one SHA-256 digest are identical. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import written

Weight = tuple[int, ...]

WORDS = r"[\x20\x09-\x0D]+"


def few_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, WORDS), "")) < 100


def repeated_words(text: Column) -> Column:
    words = F.array_remove(F.split(text, WORDS), "")
    return 100 * F.size(F.array_distinct(words)) < 80 * F.size(words)


def capitals(text: Column) -> Column:
    return 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text)


def symbols(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


# Failure conditions by letter; E is the filter for copies.
FILTERS: dict[str, Callable[[Column], Column]] = {"A": few_words, "B": repeated_words, "C": capitals, "D": symbols}
COPIES = "E"


class Diagram:
    """A count-weighted decision diagram over masks of ``names``, level by level.

    ``levels[i]`` maps a node to its (low, high) nodes on level ``i + 1``; nodes of
    the last level are the weights themselves. ``weight`` is the sum below a node.
    """

    def __init__(self, names: str, counts: Mapping[int, Weight], width: int = 3):
        self.order = list(names)
        n = len(names)
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in range(n)]
        self.weight: dict[int, Weight] = {}
        self._known: dict[object, int] = {}
        none = (0,) * width
        row = [self._leaf(counts.get(sum(b << i for i, b in enumerate(bits)), none)) for bits in product((0, 1), repeat=n)]
        for i in reversed(range(n)):
            row = [self._node(i, low, high) for low, high in zip(row[::2], row[1::2])]
        self.root = row[0]

    def _leaf(self, w: Weight) -> int:
        if w not in self._known:
            self._known[w] = len(self.weight)
            self.weight[self._known[w]] = w
        return self._known[w]

    def _node(self, level: int, low: int, high: int) -> int:
        key = (self.order[level], level, low, high)
        if key not in self._known:
            self._known[key] = len(self.weight)
            self.weight[self._known[key]] = tuple(a + b for a, b in zip(self.weight[low], self.weight[high]))
        self.levels[level][self._known[key]] = (low, high)
        return self._known[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next. Nodes of the upper level keep
        their name, so nothing above them changes; those of the lower are made anew."""
        below = self.levels[level + 1]
        self.levels[level + 1] = {}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        for node, (low, high) in self.levels[level].items():
            (ll, lh), (hl, hh) = below[low], below[high]
            self.levels[level][node] = (self._node(level + 1, ll, hl), self._node(level + 1, lh, hh))

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Along the path that passes all: filter, weight kept, weight removed."""
        node = self.root
        for level, name in enumerate(self.order):
            low, high = self.levels[level][node]
            yield name, self.weight[low], self.weight[high]
            node = low


def plain_changes(n: int) -> Iterator[int]:
    """Places to swap with their right neighbour, one at a time, so that all orders of ``n`` come once."""
    if n < 2:
        return
    ups = list(range(n - 1))
    down, inner = True, plain_changes(n - 1)
    while True:
        yield from (reversed(ups) if down else ups)
        step = next(inner, None)
        if step is None:
            return
        # The largest element is at one end: swaps of the others shift by one when it is in front.
        yield step + 1 if down else step
        down = not down


def audit_orders(names: str, counts: Mapping[int, Weight]) -> list[tuple]:
    """``filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` for all orders of the filters."""
    diagram = Diagram(names, counts)
    seen = [("".join(diagram.order), list(diagram.steps()))]
    for place in plain_changes(len(names)):
        diagram.swap(place)
        seen.append(("".join(diagram.order), list(diagram.steps())))
    # A filter removes all its failures when it comes first, and only its own when it comes last.
    fails = {path[0][0]: path[0][2][0] for _, path in seen}
    alone = {path[-1][0]: path[-1][2][0] for _, path in seen}
    shapley = dict.fromkeys(names, 0)
    for _, path in seen:
        for name, _, gone in path:
            shapley[name] += gone[0]
    return [(order, i + 1, kept[0], gone[0], fails[name] - gone[0], alone[name], gone[1], gone[2], shapley[name])
            for order, path in seen for i, (name, kept, gone) in enumerate(path)]


ROWS = ("filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
        "toxic_lost long, shapley long")


def failure_counts(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable[[Column], Column]] = FILTERS,
                   copies: str | None = COPIES, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail (bit i: the i-th
    filter; the filter for copies is the last)."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    fails = [F.when(f(whole), F.lit(1 << i)).otherwise(0) for i, f in enumerate(filters.values())]
    slim = written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                               reduce(lambda a, b: a + b, fails, F.lit(0)).alias("mask"), F.sha2(whole, 256).alias("sha")),
                   "audit-masks")
    rows = slim.groupBy("doc_id", "sha", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    if copies is not None:
        first = (slim.where(F.col("doc_id").isNotNull()).groupBy("sha").agg(F.min("doc_id").alias("doc_id"))
                 .select("doc_id", "sha", F.lit(True).alias("first")))
        kept = F.coalesce("first", F.col("doc_id").isNull())
        rows = (rows.join(first.hint("merge"), ["doc_id", "sha"], "left")
                .withColumn("mask", F.col("mask") + F.when(kept, 0).otherwise(1 << len(filters))))
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
             .withColumn("spread", F.lit("")))
    # Rows without an id meet no label; the digest keeps them from gathering on one null key.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.col("sha")).otherwise("")).join(
        marks.hint("merge"), ["doc_id", "spread"], "left")
    of = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable[[Column], Column]] = FILTERS,
                 copies: str | None = COPIES, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``filters``: failure conditions over the text by one-letter names, at most 7 with
    ``copies``, the letter of the filter that fails later copies of a text (None: without).
    """
    names = "".join(filters) + (copies or "")
    if len(set(names)) != len(filters) + (copies is not None) or not 0 < len(names) <= 7:
        raise ValueError("one to seven filters, each named by one letter of its own")

    def audit(key, rows):
        counts = {m: w for m, *w in zip(*(rows.column(c).to_pylist() for c in ("mask", "n", "good", "toxic")))}
        out = audit_orders(names, {m: tuple(w) for m, w in counts.items()})
        cols = list(zip(*out))
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
        fields = [f.split()[0] for f in ROWS.split(", ")]
        return pa.table({"part": pa.array([key[0].as_py()] * len(out), pa.string()),
                         **{f: pa.array(c, k) for f, c, k in zip(fields, cols, kinds)}})

    counted = failure_counts(docs, labels, filters, copies, doc_id, text, part)
    return counted.groupBy("part").applyInArrow(audit, "part string, " + ROWS)
