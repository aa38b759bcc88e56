"""N-gram Jaccard join by set-relation skipping.

A document's set holds the hashes of its distinct word n-grams. Rows are
numbered in a written table. Rows with equal sets are one class; the row of its
smallest id speaks for it, and its number is the class's key from the lists to
the components. The links between classes are found exactly, by prefix lists:

1. Frequency levels. Partitions send owners their sets' 32-bit keys,
   Golomb-Rice coded; owners count them and answer with one bitmap per level
   (how often a key occurs at least). Bitmaps have a fixed size. They order
   all grams, rare ones first; a wrong bit only moves a gram in the order.
2. Index lists. Two linked sets share a gram among the first
   ``n - ceil(t n) + 1`` of each. Those of them that occur again are sent to
   their owners with position and set size. Lists of one class are dropped.
3. Skipping in lists. Within a list entries are in blocks by set size; blocks
   out of reach, positions that leave too little and prefixes that differ in
   too much (by a 256-bit picture of each) are skipped. First every set is
   only compared with the one earlier set that it shares most grams with (its
   hub).
4. Skipping by relations. Once linked, sets are one component; a list only
   yields pairs between different components, and per pair the number of
   shared prefix grams bounds the overlap. A pair is also settled without
   comparing when the sets' known overlaps with a common hub bound it: the
   answer of a highly similar set, changed by its few differing grams.
5. What is left is compared exactly, a few pairs of each pair of components
   first, because one link makes all others between them needless.

Between 3 and 4 components meet in rounds: in each of its lists a set is only
paired with one set of the largest component and one of the next component in
an order that changes with the round, at most two rows an entry. The pair met
most often is compared. Families of copies near the threshold become one
component this way before step 4 looks at all pairs that are left.

From the rounds on only lists of several components are read, and every owner
has the parity prints of its sets: a bit tells whether an odd number of the
whole set's grams falls on it. Bits in which two prints differ are never more
than the grams in which the sets differ, so a pair with more of them than a link
allows is skipped where it is met. What is left over is nearly always linked,
and pairs that nearly always link do not outlive the rounds in numbers.

Comparisons are two merge joins with the texts: the rows of a hub with many
members are cut into several tasks. Components come from Spark joins over the links (see
``components``). All joins are merge joins at every size: nothing grows on the
driver, and no small table takes the way over it.

Defined cases. Null and empty texts, and texts without words, have an empty
set and no links. Fewer than n words make one gram of their own. A null
``doc_id`` sorts last. Null and repeated ids are judged row by row, each by its
own text. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laketide.llm.common import (LOWER, NON_WHITE, NULL_ID, U64, documents, find_words, mix, owners_of, ready, real_id,
                                 rolling, shuffles_go, slices, text_buffer, word_hashes, written)
from laketide.llm.components import components, points
from laketide.llm.exact_dedup import rice_decode, rice_encode
from laketide.llm.exchange import pack, shrink, text_column, unpack

PRINT_BITS = 256, 1 << 14  # least and most bits of a print; between them two or more a gram
LEVELS = ((2, 5), (32, 8), (1024, 8))  # (occurrences, key bits left out of the bitmap): 16 + 2 + 2 MB
KEY_SPACE = 1 << 32
ROUND_LINKS = 32  # a further round follows one that linked at least one of so many sets
ANSWER = U64(0x2545F4914F6CDD1D)


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of each text: text number and hash, sorted by both."""
    off, data = text_buffer(text_column(texts))
    starts, ends, first = find_words(off, LOWER[data], NON_WHITE)
    words = word_hashes(LOWER[data], starts, ends)
    size = np.diff(first)
    h, doc = np.zeros(0, U64), np.zeros(0, np.int64)
    for k in np.unique(np.minimum(size, n)):
        if not k:
            continue
        # Texts of fewer than n words are one gram of their own length.
        room = np.where(np.minimum(size, n) == k, size - k + 1, 0)
        d = np.repeat(np.arange(len(size)), room)
        at = first[d] + np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        h = np.concatenate([h, mix(rolling(words, int(k))[at] + U64(k))])
        doc = np.concatenate([doc, d])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def describe(docs: DataFrame, n: int) -> DataFrame:
    """``row_id, doc_id, n_shingles`` and a 128-bit digest of the set (d1, d2) of
    rows (row_id, doc_id, text)."""

    def digest(batches):
        for whole in batches:
            for b in slices(whole):
                doc, h = gram_sets(b.column(2), n)
                size = np.bincount(doc, minlength=b.num_rows)
                sums = []
                for salt in (U64(0), ANSWER):
                    total = np.concatenate([[U64(0)], np.cumsum(mix(h + salt), dtype=U64)])
                    cut = np.concatenate([[0], np.cumsum(size)])
                    sums.append(mix(total[cut[1:]] - total[cut[:-1]] + size.astype(U64)).view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size.astype(np.int64)), *map(pa.array, sums)],
                                                 names=["row_id", "doc_id", "n_shingles", "d1", "d2"])

    return docs.mapInArrow(digest, "row_id long, doc_id long, n_shingles long, d1 long, d2 long")


def frequency_levels(docs: DataFrame, n: int) -> list[np.ndarray]:
    """Fixed-size bitmaps by key, one per level, packed eight bits a byte."""
    owners = owners_of(docs.sparkSession)
    span = -(-KEY_SPACE // owners // 65536) * 65536

    def send(batches):
        for whole in batches:
            for b in slices(whole):
                _, h = gram_sets(b.column(1), n)
                keys, counts = np.unique(h >> U64(32), return_counts=True)
                cuts = np.searchsorted(keys, np.arange(owners + 1, dtype=np.int64).astype(U64) * U64(span))
                rows = []
                for o in np.flatnonzero(np.diff(cuts)):
                    a, z = cuts[o], cuts[o + 1]
                    k, code = rice_encode(keys[a:z] - U64(int(o) * span), span)
                    rows.append((int(o), int(z - a), k, code, np.minimum(counts[a:z], 255).astype(np.uint8).tobytes()))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["owner", "n", "k", "code", "counts"])

    def answer(key, rows):
        o = key[0].as_py()
        keys = np.concatenate([rice_decode(c.as_py(), m.as_py(), k.as_py()) for c, m, k in
                               zip(rows.column("code"), rows.column("n"), rows.column("k"))])
        counts = np.concatenate([np.frombuffer(c.as_py(), np.uint8) for c in rows.column("counts")])
        keys, where = np.unique(keys, return_inverse=True)
        total = np.bincount(where, weights=counts)
        maps = []
        for least, shift in LEVELS:
            bits = np.zeros(span >> shift, np.uint8)
            bits[(keys[total >= least] >> U64(shift)).astype(np.int64)] = 1
            maps.append(np.packbits(bits).tobytes())
        return pa.table({"owner": pa.array([o] * len(maps), pa.int32()), "level": pa.array(range(len(maps)), pa.int32()),
                         "bits": pa.array(maps, pa.binary())})

    got = (docs.mapInArrow(send, "owner int, n int, k int, code binary, counts binary").groupBy("owner")
           .applyInArrow(answer, "owner int, level int, bits binary"))
    levels = [np.zeros(owners * span >> (shift + 3), np.uint8) for _, shift in LEVELS]
    with shuffles_go(docs.sparkSession):
        got = got.toArrow()  # fixed size: the bitmaps together, in one job whatever the number of owners
    for owner, level, bits in zip(got.column("owner").to_pylist(), got.column("level").to_pylist(), got.column("bits")):
        at, bits = owner * span >> (LEVELS[level][1] + 3), np.frombuffer(bits.as_buffer(), np.uint8)
        levels[level][at:at + len(bits)] = bits
    return levels


def _level(levels: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    key, out = (h >> U64(32)).astype(np.int64), np.zeros(len(h), np.int64)
    for bits, (_, shift) in zip(levels, LEVELS):
        at = key >> shift
        out += (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
    return out


def prefix_lists(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Entries of all lists with two classes or more: ``owner, gram, doc_id, size,
    pos``, and of each set the number ``sent`` of its prefix grams that occur
    again and a 256-bit picture of them (``s0..s3``)."""
    spark = docs.sparkSession
    owners = owners_of(spark)
    shared = spark.sparkContext.broadcast(frequency_levels(docs, n))  # fixed size

    def send(batches):
        for whole in batches:
            for b in slices(whole):
                doc, h = gram_sets(b.column(1), n)
                if not len(h):
                    continue
                level = _level(shared.value, h)
                size = np.bincount(doc, minlength=b.num_rows)
                cut = np.concatenate([[0], np.cumsum(size)])
                order = np.lexsort((h, level, doc))
                pos = np.arange(len(h)) - cut[doc]
                prefix = size - -(-percent * size // 100) + 1
                keep = (pos < prefix[doc]) & (level[order] > 0)
                d, p, g = doc[keep], pos[keep], h[order][keep]
                sent = np.bincount(d, minlength=b.num_rows)
                picture = np.zeros((4, b.num_rows), U64)
                bit = (g >> U64(8)) & U64(255)
                np.bitwise_or.at(picture, ((bit >> U64(6)).astype(np.int64), d), U64(1) << (bit & U64(63)))
                owner = ((g >> U64(20)) % U64(owners)).astype(np.int64)
                rows = pack(owner, owners, d, p, b.column(0).to_numpy(), [g.astype("<u8")],
                            (size + (sent << 32), *picture.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([o for o, _ in rows], pa.int32()),
                                                  pa.array([x for _, x in rows], pa.binary())], names=["owner", "payload"])

    def fold(key, rows):
        doc, pos, (gram,), (size, *picture) = unpack(rows.column("payload").to_pylist(), ["<u8"], 5)
        _, where, count = np.unique(gram, return_inverse=True, return_counts=True)
        many = np.flatnonzero(count[where] > 1)
        cols = {"owner": np.full(len(many), key[0].as_py(), np.int32), "gram": gram[many].view(np.int64), "doc_id": doc[many],
                "size": (size[many] & 0xFFFFFFFF).astype(np.int32), "pos": pos[many].astype(np.int32),
                "sent": (size[many] >> 32).astype(np.int32), **{f"s{i}": x[many] for i, x in enumerate(picture)}}
        return pa.table({c: pa.array(v) for c, v in cols.items()})

    lists = written(docs.mapInArrow(send, "owner int, payload binary").groupBy("owner")
                    .applyInArrow(fold, "owner int, gram long, doc_id long, size int, pos int, sent int, "
                                         "s0 long, s1 long, s2 long, s3 long"), "jaccard-lists")
    shared.destroy()  # the lists are stored
    return lists


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of two linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


class _Lists:
    """An owner's entries, sorted by list and the columns given."""

    def __init__(self, rows: pa.Table, *by: str):
        col = {c: rows.column(c).to_numpy() for c in rows.column_names if c != "owner"}
        order = np.lexsort(tuple(col[c] for c in (*reversed(by), "gram")))
        for c, v in col.items():
            setattr(self, c, v[order].astype(np.int64))
        self.picture = np.stack([getattr(self, f"s{i}").view(np.uint64) for i in range(4)])
        self.head = np.flatnonzero(np.concatenate([[True], self.gram[1:] != self.gram[:-1]]))
        self.tail = np.append(self.head[1:], len(self.gram))

    def reachable(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Sizes near enough, enough grams left behind the shared one, and prefixes
        alike enough: a bit that only one picture has is a gram they do not share,
        and what the prefixes share and all behind them must reach the least overlap."""
        a, b, p, q = self.size[i], self.size[j], self.pos[i], self.pos[j]
        need = _needed(a, b, percent)
        left = 1 + np.minimum(a - p - 1, b - q - 1) + np.minimum(p, q)
        x, y = self.picture[:, i], self.picture[:, j]
        shared = np.minimum(self.sent[i] - np.bitwise_count(x & ~y).sum(axis=0, dtype=np.int64),
                            self.sent[j] - np.bitwise_count(y & ~x).sum(axis=0, dtype=np.int64))
        behind = np.maximum(-(-percent * a // 100), -(-percent * b // 100)) - 1
        return (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (left >= need) & (shared + behind >= need)


def _pairs_table(owner, a, b, size_a, size_b) -> pa.Table:
    """Pairs with the number of lists that gave them."""
    order = np.lexsort((b, a))
    a, b, size_a, size_b = a[order], b[order], size_a[order], size_b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(a)))
    return pa.table({"a": pa.array(a[heads], pa.int64()), "b": pa.array(b[heads], pa.int64()),
                     "size_a": pa.array(size_a[heads].astype(np.int32)), "size_b": pa.array(size_b[heads].astype(np.int32)),
                     "shared": pa.array(count.astype(np.int32))})


def prints(texts: DataFrame, n: int) -> DataFrame:
    """``doc_id, print`` of rows (doc_id, text): the parity of the number of grams on each bit. A print
    has a power of two of bits, and folds to a shorter one as if made with fewer."""

    def parity(batches):
        for whole in batches:
            for b in slices(whole):
                doc, h = gram_sets(b.column(1), n)
                cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
                out = []
                for a, z in zip(cut[:-1], cut[1:]):
                    bits = min(max(1 << int(2 * (z - a)).bit_length(), PRINT_BITS[0]), PRINT_BITS[1])
                    odd = np.bincount((h[a:z] & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
                    out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "print"])

    return texts.mapInArrow(parity, "doc_id long, print binary")


class _Prints:
    """An owner's prints, those of one length in one array."""

    def __init__(self, rows: pa.Table):
        order = rows.column("doc_id").to_numpy().argsort()
        raw = rows.column("print").take(pa.array(order)).to_pylist()
        self.doc, self.words = rows.column("doc_id").to_numpy()[order], np.array([len(r) >> 3 for r in raw], np.int64)
        self.row, self.by = np.zeros(len(raw), np.int64), {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.row[at] = np.arange(len(at))
            self.by[w] = np.frombuffer(b"".join(raw[i] for i in at), "<u8").reshape(len(at), w)

    def _folded(self, k: np.ndarray, w: int) -> np.ndarray:
        out = np.empty((len(k), w), U64)
        for v in np.unique(self.words[k]).tolist():
            at = np.flatnonzero(self.words[k] == v)
            out[at] = np.bitwise_xor.reduce(self.by[v][self.row[k[at]]].reshape(len(at), v // w, w), axis=1)
        return out

    def alike(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
        """Pairs whose prints differ in no more bits than the sets of a link in grams."""
        i, j = np.searchsorted(self.doc, a), np.searchsorted(self.doc, b)
        most, ok = size_a + size_b - 2 * _needed(size_a, size_b, percent), np.ones(len(a), bool)
        short = np.minimum(self.words[i], self.words[j])
        for w in np.unique(short).tolist():
            at, step = np.flatnonzero(short == w), max(1, (1 << 18) // w)
            for k in (at[x:x + step] for x in range(0, len(at), step)):
                ok[k] = np.bitwise_count(self._folded(i[k], w) ^ self._folded(j[k], w)).sum(axis=1, dtype=np.int64) <= most[k]
        return ok


PAIRS = "a long, b long, size_a int, size_b int, shared int"


def hub_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """For every class the earlier class it shares most prefix grams with."""

    def near(key, rows):
        e = _Lists(rows, "doc_id")
        doc, size = e.doc_id, e.size
        hub = np.repeat(e.head, e.tail - e.head)
        at = np.arange(len(doc))
        # The list's smallest id, and the entry just before.
        i = np.concatenate([at, at])
        j = np.concatenate([hub, np.maximum(at - 1, hub)])
        ok = (doc[i] != doc[j]) & e.reachable(i, j, percent)
        ok[len(at):] &= j[len(at):] != hub
        i, j = i[ok], j[ok]
        return _pairs_table(None, doc[i], doc[j], size[i], size[j])

    pairs = (lists.groupBy("owner").applyInArrow(near, PAIRS).groupBy("a", "b", "size_a", "size_b")
             .agg(F.sum("shared").cast("int").alias("shared")))
    best = F.max_by(F.struct("b", "size_a", "size_b", "shared"), F.struct("shared", -F.col("b"), "size_b", "size_a"))
    return pairs.groupBy("a").agg(best.alias("x")).select("a", "x.*")


def open_lists(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """The lists that hold sets of several components: no other list gives a pair any more."""

    def several(key, rows):
        gram, c = rows.column("gram").to_numpy(), rows.column("component_id").to_numpy()
        order = np.lexsort((c, gram))
        gram, c = gram[order], c[order]
        head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        tail = np.append(head[1:], len(gram))
        mixed = c[head] != c[tail - 1]
        return rows.drop_columns(["component_id"]).take(pa.array(order[np.repeat(mixed, tail - head)]))

    return _placed(lists, comp).select(*lists.columns, "component_id").groupBy("owner").applyInArrow(several, lists.schema)


def _with_prints(lists: DataFrame, comp: DataFrame, shown: DataFrame):
    """Each owner's list entries with their components, and its prints (owner, doc_id, print)."""
    return _placed(lists, comp).groupBy("owner").cogroup(shown.groupBy("owner"))


def near_pairs(lists: DataFrame, comp: DataFrame, shown: DataFrame, percent: int, turn: int) -> DataFrame:
    """For every class the set of another component it meets most often, when each list
    pairs an entry with one set of the list's largest component and one of the next
    component; ``turn`` changes these sets and the order of components."""

    def near(key, rows, pictures):
        if not rows.num_rows:
            return _pairs_table(None, *[np.zeros(0, np.int64)] * 4)
        salt = U64(turn) * ANSWER
        rows = rows.append_column("turn", pa.array((mix(rows.column("component_id").to_numpy().view(U64) + salt) >> U64(1)).view(np.int64)))
        rows = rows.append_column("place", pa.array((mix(rows.column("doc_id").to_numpy().view(U64) + salt) >> U64(1)).view(np.int64)))
        e = _Lists(rows, "turn", "component_id", "place", "doc_id")
        n = len(e.gram)
        list_of = np.repeat(np.arange(len(e.head)), e.tail - e.head)
        new = np.ones(n, bool)
        new[1:] = (list_of[1:] != list_of[:-1]) | (e.component_id[1:] != e.component_id[:-1])
        run_head = np.flatnonzero(new)  # the members of one component in one list, and the set that stands for them
        run_of, run_size, run_list = np.cumsum(new) - 1, np.diff(np.append(run_head, n)), list_of[run_head]
        first_run = run_of[e.head]
        last_run = np.append(first_run[1:], len(run_head)) - 1
        after = np.arange(len(run_head)) + 1
        after = np.where(after > last_run[run_list], first_run[run_list], after)
        by_size = np.lexsort((run_size, run_list))
        main = by_size[last_run]  # the runs of a list are together in both orders
        at = np.arange(n)
        i = np.concatenate([at, at])
        j = run_head[np.concatenate([after[run_of], main[list_of]])]
        double = np.zeros(2 * n, bool)
        double[n:] = j[n:] == j[:n]
        ok = (e.component_id[i] != e.component_id[j]) & ~double
        i, j = i[ok], j[ok]
        ok = e.reachable(i, j, percent)
        i, j = i[ok], j[ok]
        ok = _Prints(pictures).alike(e.doc_id[i], e.doc_id[j], e.size[i], e.size[j], percent)
        i, j = i[ok], j[ok]
        return _pairs_table(None, e.doc_id[i], e.doc_id[j], e.size[i], e.size[j])

    pairs = (_with_prints(lists, comp, shown).applyInArrow(near, PAIRS).groupBy("a", "b", "size_a", "size_b")
             .agg(F.sum("shared").alias("shared")))
    return pairs.groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))


def _placed(lists: DataFrame, comp: DataFrame) -> DataFrame:
    return lists.join(comp.hint("merge"), "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def _enough(percent: int) -> Column:
    """Shared prefix grams plus all that can lie behind the prefixes reach the least overlap."""
    behind = F.greatest(F.ceil(F.col("size_a") * percent / 100), F.ceil(F.col("size_b") * percent / 100)) - 1
    return F.col("shared") + behind >= F.ceil((F.col("size_a") + F.col("size_b")) * percent / (100 + percent))


def cross_pairs(lists: DataFrame, comp: DataFrame, shown: DataFrame, percent: int) -> DataFrame:
    """Pairs of list members of different components that may still be linked."""

    def cross(key, rows, pictures):
        if not rows.num_rows:
            return _pairs_table(None, *[np.zeros(0, np.int64)] * 4)
        e, seen = _Lists(rows, "size", "doc_id"), _Prints(pictures)
        doc, size, c = e.doc_id, e.size, e.component_id
        mixed = np.minimum.reduceat(c, e.head) != np.maximum.reduceat(c, e.head)
        out_i, out_j = [], []
        for a, z in zip(e.head[mixed].tolist(), e.tail[mixed].tolist()):
            # All pairs with a member outside the largest component, sizes in reach only.
            own, s = c[a:z], size[a:z]
            names, counts = np.unique(own, return_counts=True)
            main = names[counts.argmax()]
            for i in np.flatnonzero(own != main):
                lo = np.searchsorted(s, -(-percent * s[i] // 100))
                hi = np.searchsorted(s, 100 * s[i] // percent, side="right")
                j = np.arange(lo, hi)
                j = j[(own[j] != own[i]) & ((own[j] == main) | (j > i))] + a
                ii = np.full(len(j), i + a)
                ok = e.reachable(ii, j, percent)
                ii, j = ii[ok], j[ok]
                ok = seen.alike(doc[ii], doc[j], size[ii], size[j], percent)
                out_i.append(ii[ok])
                out_j.append(j[ok])
        i = np.concatenate(out_i) if out_i else np.zeros(0, np.int64)
        j = np.concatenate(out_j) if out_j else np.zeros(0, np.int64)
        swap = doc[i] < doc[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return _pairs_table(None, doc[i], doc[j], size[i], size[j])

    return (_with_prints(lists, comp, shown).applyInArrow(cross, PAIRS).groupBy("a", "b", "size_a", "size_b")
            .agg(F.sum("shared").cast("int").alias("shared")).where(_enough(percent)))


def compare(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """``a, b, size_a, size_b, overlap`` of pairs (a, b); ``b`` is the hub. Two merge joins bring the
    texts, one stage each; Spark cuts the rows of a hub with many members into several tasks."""
    text_a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def overlap(batches):
        for whole in batches:
            for part in slices(whole, "text_a"):
                a, b = (part.column(c).to_numpy() for c in "ab")
                new = np.concatenate([[True], b[1:] != b[:-1]])  # a hub's rows follow each other
                doc, h = gram_sets(part.column("text_a"), n)
                hub, g = gram_sets(part.column("text_b").filter(pa.array(new)), n)
                cut, hub_cut = np.searchsorted(doc, np.arange(len(a) + 1)), np.searchsorted(hub, np.arange(new.sum() + 1))
                at = np.cumsum(new) - 1
                size, hub_size = np.diff(cut), np.diff(hub_cut)[at]
                either = [len(np.unique(np.concatenate([h[cut[i]:cut[i + 1]], g[hub_cut[k]:hub_cut[k + 1]]])))
                          for i, k in enumerate(at.tolist())]
                cols = (a, b, size, hub_size, size + hub_size - np.array(either, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["a", "b", "size_a", "size_b", "overlap"])

    return (pairs.select("a", "b").join(text_a.hint("merge"), "a").join(text_b.hint("merge"), "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(overlap, "a long, b long, size_a long, size_b long, overlap long"))


def _linked(percent: int) -> Column:
    return 100 * F.col("overlap") >= percent * (F.col("size_a") + F.col("size_b") - F.col("overlap"))


def _star_links(comp: DataFrame) -> DataFrame:
    """A link of each point to its component: it takes the place of all links that made the component."""
    return comp.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))


def class_links(docs: DataFrame, n: int, percent: int, first_pairs: int = 4) -> DataFrame:
    """Links (a, b) that connect exactly the classes that are connected. ``docs``
    is one row a class: its key as ``doc_id``, and its text as ``shrink`` makes it."""
    lists = prefix_lists(docs, n, percent)
    members = lists.select("doc_id").distinct()
    texts = written(docs.join(members.hint("merge"), "doc_id", "left_semi"), "jaccard-texts")
    known = written(compare(hub_pairs(lists, percent), texts, n), "jaccard-hubs")
    comp = points(known.where(_linked(percent)).select("a", "b"))
    lists = written(open_lists(lists, comp), "jaccard-open")
    shown = written(lists.select("owner", "doc_id").distinct().join(prints(texts, n).hint("merge"), "doc_id"), "jaccard-prints")
    seen, sets, turn = known.select("a", "b"), texts.count(), 0
    found = tried = sets
    while ROUND_LINKS * found > sets and 8 * found > tried:  # a round costs less than all pairs as long as it links enough
        turn += 1
        chosen = near_pairs(lists, comp, shown, percent, turn).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        met = written(compare(chosen.distinct().join(seen.hint("merge"), ["a", "b"], "left_anti"), texts, n), "jaccard-met")
        new = met.where(_linked(percent)).select("a", "b")
        tried, found = met.agg(F.count(F.lit(1)), F.coalesce(F.sum(_linked(percent).cast("long")), F.lit(0))).first()
        seen = seen.unionByName(met.select("a", "b"))
        if found:
            comp = points(new.unionByName(_star_links(comp)))

    # Answers of a common hub bound the pair: |x & y| <= |h & y| + |x - h|.
    left = cross_pairs(lists, comp, shown, percent).alias("p")
    hub = known.select(F.col("a").alias("k"), F.col("b").alias("hub"), F.col("overlap").alias("o"))
    hx, hy = hub.alias("hx"), hub.alias("hy")
    bound = F.least(F.col("hy.o") + F.col("p.size_a") - F.col("hx.o"), F.col("hx.o") + F.col("p.size_b") - F.col("hy.o"))
    need = F.ceil((F.col("p.size_a") + F.col("p.size_b")) * percent / (100 + percent))
    pairs = (left.join(hx.hint("merge"), F.col("p.a") == F.col("hx.k"), "left").join(hy.hint("merge"), F.col("p.b") == F.col("hy.k"), "left")
             .where(~F.coalesce((F.col("hx.hub") == F.col("hy.hub")) & (bound < need), F.lit(False)))
             .select("p.*"))
    pairs = written(pairs.join(seen.hint("merge"), ["a", "b"], "left_anti"), "jaccard-pairs")
    for few in (first_pairs, None) if pairs.count() > sets else (None,):
        placed = pairs
        for side in ("a", "b"):
            of = comp.select(F.col("doc_id").alias(side), F.col("component_id").alias(f"c{side}"))
            placed = (placed.join(of.hint("merge"), side, "left")
                      .withColumn(f"c{side}", F.coalesce(f"c{side}", side)))
        open_ = placed.where("ca != cb")
        if few:
            between = W.partitionBy(F.least("ca", "cb"), F.greatest("ca", "cb")).orderBy(F.desc("shared"), "a", "b")
            chosen = open_.withColumn("rank", F.row_number().over(between)).where(F.col("rank") <= few)
        else:
            chosen = open_
        more = written(compare(chosen.select("a", "b"), texts, n), "jaccard-compared")
        found = more.where(_linked(percent)).select("a", "b")
        links = written(found.unionByName(_star_links(comp)), "jaccard-links")
        if few:
            pairs = pairs.join(more.select("a", "b"), ["a", "b"], "left_anti")
            comp = points(links)
    return links


def named_sets(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """``row_id, doc_id, n_shingles, component_id, class_id`` (``NULL_ID`` for null) and
    ``first``, the row that speaks for the component, of written rows (row_id, doc_id, text)."""
    if not 0 < percent <= 100:
        raise ValueError("percent is over 0 and at most 100")
    sets = written(describe(rows, n), "jaccard-sets")
    classes = written(sets.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min(F.struct("doc_id", "row_id")).alias("x"))
                      .select(F.col("n_shingles").alias("n"), F.col("d1").alias("e1"), F.col("d2").alias("e2"),
                              F.col("x.doc_id").alias("class_id"), F.col("x.row_id").alias("key")), "jaccard-classes")
    speakers = written(rows.select(F.col("row_id").alias("doc_id"), "text").mapInArrow(shrink, "doc_id long, text binary")
                       .join(classes.select(F.col("key").alias("doc_id")).hint("merge"), "doc_id", "left_semi"), "jaccard-speakers")
    comp = written(components(class_links(speakers, n, percent)).select(F.col("doc_id").alias("key"), F.col("component_id").alias("c"))
                   .join(classes.select("key", "class_id").hint("merge"), "key"), "jaccard-components")
    least = comp.groupBy("c").agg(F.min(F.struct("class_id", "key")).alias("x"))
    named = (classes.join(comp.join(least.hint("merge"), "c").select("key", "x").hint("merge"), "key", "left")
             .select("n", "e1", "e2", "class_id", F.coalesce("x.class_id", "class_id").alias("component_id"),
                     F.coalesce("x.key", "key").alias("first")))
    same = (F.col("n_shingles") == F.col("n")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
    return sets.join(named.hint("merge"), same, "left").select(
        "row_id", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("first", "row_id").alias("first"))


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, class_id`` (smallest id with an equal set)."""
    ready(docs.sparkSession)
    rows = written(documents(docs, doc_id, text).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text"),
                   "jaccard-rows")
    return named_sets(rows, n, percent).select(real_id(), "n_shingles", real_id("component_id"), real_id("class_id"))


def representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs``, all its columns, of each component: the smallest id's."""
    ready(docs.sparkSession)
    whole = written(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("row_id")), "jaccard-rows")
    rows = whole.select("row_id", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                        F.col("row.text").cast("string").alias("text"))
    stay = named_sets(rows, n, percent).where("row_id = first").select(F.col("row_id").alias("k_id"))
    return whole.join(stay.hint("merge"), F.col("row_id") == F.col("k_id"), "left_semi").select("row.*")
