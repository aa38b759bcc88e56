"""Linkage without a shared key (A4): records meet on keyed Bloom encodings of their fields, never on the fields."""

from __future__ import annotations

import math
import random
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from laketide.functions import keyed
from laketide.session import scratch_path

WORDS = 16  # an encoding is 16 words of 64 bits
BITS = WORDS * 64
MAX_HASHES = 8  # an HMAC of 256 bits holds eight positions of 32 bits
BAND_BITS = 62  # a band's looks are one positive bigint
RUNS = (1, 4, 16)  # places that a look may go through
FOLD = 4  # words of the folded encoding that goes into the blocks
SAMPLE = 2000  # encodings whose distances tell how many meet by chance
PAIR_COST = 0.05  # of comparing two rows of a block; making, sending and sorting a row is 1
ROUND_BANDS = 8  # bands whose rows are on disk together, more if they are few
ROUND_ROWS = 16_000_000
ROUND_PAIRS = 64_000_000  # pairs that meet their whole encodings together
TASK_ROWS = 2_000_000


def encode_records(df: DataFrame, fields: Mapping[str, int], key_df: DataFrame, key_col: str = "key") -> DataFrame:
    """The fields of each record replaced by one encoding, ``code`` (16 bigints).

    A field is lower-cased and trimmed and cut into pairs of neighbouring characters, its ends marked. Each pair
    sets as many of 1024 bits as ``fields`` gives its field (1 to 8: the field's weight), at places
    taken from the HMAC of field and pair under the key of ``key_df``: without the key neither
    a field nor a pair of characters can be looked up. Similar fields set mostly the same bits. Null and empty
    fields set none. A narrow projection; the key reaches it as a scalar subquery, as in ``pseudonymise``.
    Spark computes the HMACs; NumPy sets their bits, a batch of records at a time.
    """
    if not fields or not all(1 <= k <= MAX_HASHES for k in fields.values()):
        raise ValueError(f"fields need weights from 1 to {MAX_HASHES}")
    rows = df.withColumn("__pads", keyed.pads_of(key_df, key_col))
    kept = [c for c in df.columns if c not in fields]
    rows = rows.select(*kept, F.unhex(F.concat(*[_macs(name, hashes) for name, hashes in fields.items()])).alias("__macs"))

    def coded(batches):
        for b in batches:
            macs = b.column(b.num_columns - 1).cast(pa.large_binary())
            off = np.frombuffer(macs.buffers()[1], np.int64)[macs.offset:macs.offset + b.num_rows + 1]
            raw = macs.buffers()[2]
            places = (np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)).view(">u4") % BITS
            bits = np.zeros((b.num_rows, BITS), np.uint8)
            bits[np.repeat(np.arange(b.num_rows), np.diff(off) // 4), places] = 1
            words = np.packbits(bits, axis=1, bitorder="little").view("<i8")
            codes = pa.ListArray.from_arrays(np.arange(0, words.size + 1, WORDS, dtype=np.int32), pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], codes], names=[*kept, "code"])

    return rows.mapInArrow(coded, StructType([*df.select(*kept).schema, StructField("code", ArrayType(LongType()))]))


def _macs(name: str, hashes: int) -> Column:
    """The places a field sets, 8 hexadecimal digits each (the place modulo 1024), repeats included."""
    text = F.coalesce(F.lower(F.trim(F.col(name).cast("string"))), F.lit(""))
    ended = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    pairs = F.when(F.length(text) > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(ended, i, F.lit(2)))))
    macs = F.transform(pairs, lambda pair: F.substring(keyed.token(pair, f"bloom:{name}", F.col("__pads")), 1, 8 * hashes))
    return F.coalesce(F.array_join(macs, ""), F.lit(""))


def _bits(code: str) -> Column:
    return sum((F.bit_count(F.col(code)[w]).cast("int") for w in range(1, WORDS)), F.bit_count(F.col(code)[0]).cast("int"))


def dice(a: str, b: str) -> Column:
    """Twice the common bits of two encodings by the sum of their bits; null if both are empty."""
    def ones(words: Column) -> Column:
        # Loops over the words: written out, they make a method too long for the JVM's compiler.
        return F.aggregate(words, F.lit(0), lambda n, word: n + F.bit_count(word).cast("int"))

    total = ones(F.col(a)) + ones(F.col(b))
    return F.when(total > 0, 2.0 * ones(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))) / total)


@contextmanager
def _settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings of the jobs started in here; the caller's own jobs keep theirs."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back. The shuffle files behind it go with the job."""
    path = scratch_path(df.sparkSession, "linkage")
    with _settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _tasks(spark: SparkSession, rows: int) -> dict[str, str]:
    """Shuffle partitions for so many rows: no task's share grows with the tables."""
    return {"spark.sql.shuffle.partitions": str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)))}


def _classes(df: DataFrame, id_col: str) -> DataFrame:
    """One row per different encoding that is not empty: its smallest id, its records. Written: it is read several times."""
    rows = df.groupBy("code").agg(F.min(id_col).alias("id"), F.count(F.lit(1)).alias("n")).withColumn("size", _bits("code"))
    # The filter stands behind the write: before it, Spark would push it into the encoding and compute that once a word.
    # The classes are read once a round of bands: they are dealt to all tasks here, not in each.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _stored(rows.repartition(tasks, "id")).where("size > 0")


def _bits_of(words: np.ndarray) -> np.ndarray:
    """A row of 1024 bits for each encoding."""
    return np.unpackbits(words.reshape(-1, WORDS).astype("<i8").view(np.uint8), axis=1, bitorder="little")


def _set_bits(both: DataFrame) -> np.ndarray:
    """In how many encodings each place is set."""

    def counted(batches):
        total = np.zeros(BITS, np.int64)
        for b in batches:
            total += _bits_of(b.column(0).flatten().to_numpy(zero_copy_only=False)).sum(axis=0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS, dtype=np.int32)), pa.array(total)], names=["place", "n"])

    rows = both.select("code").mapInArrow(counted, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
    of = {r.place: r.n for r in rows}
    return np.array([of.get(p, 0) for p in range(BITS)], np.int64)


def _sampled(both: DataFrame, n: int) -> np.ndarray:
    """The bits of about ``SAMPLE`` encodings, taken by their hash: 256 KB for the driver whatever the tables hold."""
    rows = both.where(F.pmod(F.xxhash64("code"), F.lit(max(1, n // SAMPLE))) == 0).select("code").limit(2 * SAMPLE).collect()
    return _bits_of(np.array([r.code for r in rows], np.int64)).astype(np.float32)


def _bands(lft: DataFrame, rgt: DataFrame, n_left: int, n_right: int, threshold: float, found: float, seed: int,
           max_bands: int) -> tuple[list[list[int]], int]:
    """The places each band looks at, and how many of them make a look; see ``banded``.

    Bits that are the same in all records tell nothing apart; of the others all serve: a pair at the threshold differs in
    as many bits however many serve, so the more do, the rarer does a look hit one of these. Two encodings agree on a look of
    one place if they do not differ there. On a look of more they agree more seldom the less they have in common, as
    most pairs do. There are as many bands as let pairs at the threshold meet with probability ``found``, on average over the
    records of a sample, if all their differing bits are among those that serve. How long a look is and how many make a
    band follows the cost: a row per class and band and the pairs that meet by chance, as many as in the
    sample (bits that go together let far more meet than their shares tell).
    """
    both = lft.select("code").unionByName(rgt.select("code"))
    counts, n = _set_bits(both), n_left + n_right
    telling = [p for p in range(BITS) if 0 < counts[p] < n]
    if not telling:  # no encoding or one
        return [[]], 1
    sample = _sampled(both, n)
    differing = 2 * sample.sum(axis=1) * (1 - threshold)
    bits = sample[:, telling]
    ones = bits.sum(axis=1)
    common = bits @ bits.T
    either = ones[:, None] + ones[None, :] - common
    other = common < either  # of equal encodings each side has one

    def agreed(common: np.ndarray, either: np.ndarray, run: int) -> np.ndarray:
        none = np.clip(1 - either / len(telling), 0, 1) ** run
        return common / np.maximum(either, 1) * (1 - none) + none

    def needed(agree: np.ndarray) -> int:
        """Bands that find pairs at the threshold, one more than there may be if these do not do."""
        return 1 + bisect_left(range(1, max_bands + 1), True, key=lambda number: bool(np.mean((1 - agree) ** number) <= 1 - found))

    cheapest = None
    for run in (r for r in RUNS if r <= len(telling)):
        per_look = agreed(np.maximum(0, ones - differing / 2), ones + differing / 2, run)
        pairs, edges = np.histogram(agreed(common, either, run)[other], bins=2048, range=(0, 1))
        pairs, middles = pairs / max(1, sample.shape[0] ** 2), (edges[1:] + edges[:-1]) / 2
        for looks in range(1, int(BAND_BITS / math.log2(run + 1)) + 1):
            number = needed(per_look ** looks)
            if number > max_bands:  # wider blocks rather than lost links
                break
            cost = number * (n_left + n_right + PAIR_COST * n_left * n_right * float(pairs @ middles ** looks))
            if cheapest is None or cost < cheapest[0]:
                cheapest = cost, run, looks, number
    if cheapest is None:  # pairs at the threshold have hardly a bit in common
        return [[]], 1
    _, run, looks, number = cheapest
    dealt = random.Random(seed)
    return [[p for _ in range(looks) for p in dealt.sample(telling, run)] for _ in range(number)], run


def banded(side: DataFrame, bands: list[list[int]], run: int = 1) -> DataFrame:
    """``id, size``, the ``keys`` of a class in each band and its ``folded`` encoding (``f0``, ...): the words of
    the encoding under exclusive or. Folded encodings differ in no more bits than whole ones do.

    A band is a list of places, each ``run`` of them one look: which of them is the first that is set, or that none is.
    A look of one place is its bit."""

    def look(batches):
        for b in batches:
            words = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, WORDS)
            bits = _bits_of(words).T.copy()
            keys = np.zeros((len(bands), b.num_rows), np.int64)
            for i, band in enumerate(bands):
                for start in range(0, len(band), run):
                    first = np.zeros(b.num_rows, np.uint8)  # a place counts the more the earlier it comes
                    for late, p in enumerate(reversed(band[start:start + run]), 1):
                        np.maximum(first, bits[p] * np.uint8(late), out=first)
                    keys[i] = keys[i] * (run + 1) + first
            folded = np.bitwise_xor.reduce(words.reshape(b.num_rows, WORDS // FOLD, FOLD), axis=1)
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, len(bands), dtype=np.int32), keys.T.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists, *[pa.array(folded[:, w]) for w in range(FOLD)]],
                                             names=["id", "size", "keys", *[f"f{w}" for w in range(FOLD)]])

    return side.select("id", F.col("size").cast("int"), "code").mapInArrow(
        look, f"id {side.schema['id'].dataType.simpleString()}, size int, keys array<bigint>, " + ", ".join(f"f{w} bigint" for w in range(FOLD)))


def link_encodings(left: DataFrame, right: DataFrame, left_id: str, right_id: str, threshold: float,
                   found: float = 0.98, seed: int = 1, max_bands: int = 256) -> DataFrame:
    """Pairs of records of two organisations whose encodings have a Dice score of at least ``threshold``.

    Neither side's fields nor the key are needed, only ids and ``code``. Equal encodings are one class, so copies of
    one record never meet each other in a block: a link names the smallest id of both classes and how many records
    they hold (``n_left``, ``n_right``); the others have the same ``code``. Classes that agree on all looks of
    any of several bands are compared, exactly, where they meet; only links leave the join, and a link
    found in several bands is one row. Empty encodings link with nothing. Links are missed with a probability of at most about
    1 - ``found`` at the threshold, less above. At most ``max_bands`` bands serve; beyond, blocks widen and no link is given up.

    The blocks are met by a sorted shuffle join, never by a broadcast: they hold a row per class and band. They are met in
    rounds of a few bands, each of which leaves its pairs in the shared folder and frees its shuffle files, so that the disk holds a fixed
    number of rows a class. Only ids, sizes and ``folded`` encodings go into the blocks; pairs that these let pass meet their
    whole encodings once, whatever the number of their bands, a bounded number of pairs at a time.

    The driver gets 1024 counts and a sample of encodings of fixed size. The links are written to the shared folder and
    read back. Returns ``left_id``, ``right_id``, ``n_left``, ``n_right``, ``dice``.
    """
    if not 0 < threshold <= 1 or not 0 < found < 1:
        raise ValueError("threshold is over 0 and at most 1, found between 0 and 1")
    spark = left.sparkSession
    lft, rgt = _classes(left, left_id), _classes(right, right_id)
    n_left, n_right = lft.count(), rgt.count()
    bands, run = _bands(lft, rgt, n_left, n_right, threshold, found, seed, max_bands)

    def met(side: DataFrame, mark: str, bands: list[list[int]]) -> DataFrame:
        keys = banded(side, bands, run).select("*", F.posexplode("keys").alias("band", "key"))
        # One number a block: its sort needs no second look.
        return keys.select(F.xxhash64("band", "key").alias("block"), F.col("id").alias(f"{mark}_id"), F.col("size").alias(f"{mark}_size"),
                           *[F.col(f"f{w}").alias(f"{mark}_f{w}") for w in range(FOLD)])

    apart = sum((F.bit_count(F.col(f"left_f{w}").bitwiseXOR(F.col(f"right_f{w}"))) for w in range(1, FOLD)),
                F.bit_count(F.col("left_f0").bitwiseXOR(F.col("right_f0"))))
    near = apart <= (1 - threshold) * (F.col("left_size") + F.col("right_size")) + 1e-6
    at_once = max(ROUND_BANDS, ROUND_ROWS // max(1, n_left + n_right))
    rounds = []
    for i in range(0, len(bands), at_once):
        some = bands[i:i + at_once]
        with _settings(spark, _tasks(spark, len(some) * (n_left + n_right))):
            rounds.append(_stored(met(lft, "left", some).join(met(rgt, "right", some).hint("merge"), "block").where(near)
                                  .select("left_id", "right_id").distinct()))
    pairs = reduce(DataFrame.unionByName, rounds)
    n_pairs = pairs.count()
    parts = max(1, -(-n_pairs // ROUND_PAIRS))
    links = []
    for part in range(parts):
        def mine(df: DataFrame) -> DataFrame:
            return df.where(F.pmod(F.xxhash64("left_id"), F.lit(parts)) == part) if parts > 1 else df

        scored = mine(pairs).distinct()
        for side, mark in ((lft, "left"), (rgt, "right")):
            whole = side.select(F.col("id").alias(f"{mark}_id"), F.col("n").alias(f"n_{mark}"), F.col("code").alias(f"{mark}_code"))
            scored = scored.join((mine(whole) if mark == "left" else whole).hint("merge"), f"{mark}_id")
        scored = scored.withColumn("dice", dice("left_code", "right_code"))
        with _settings(spark, _tasks(spark, n_pairs // parts + n_left + n_right)):
            links.append(_stored(scored.where(F.col("dice") >= threshold).select("left_id", "right_id", "n_left", "n_right", "dice")))
    return reduce(DataFrame.unionByName, links)


def mutual_best(links: DataFrame) -> DataFrame:
    """Links in which each side is the other's best (ties to the smaller id): at most one a class."""
    def best(of: str, other: str) -> DataFrame:
        return links.groupBy(of).agg(F.min_by(other, F.struct(-F.col("dice"), F.col(other))).alias(other))
    return links.join(best("left_id", "right_id"), ["left_id", "right_id"], "left_semi").join(
        best("right_id", "left_id"), ["left_id", "right_id"], "left_semi")
