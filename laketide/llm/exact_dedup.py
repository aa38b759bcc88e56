"""Exact duplicates by a Golomb-coded fingerprint exchange.

1. Every row's normalised text gets a SHA-256; (partition, id, digest) is
   written once, so the partition number is fixed from there on.
2. Each partition sends its sorted 64-bit fingerprints to their owners (hash
   ranges) as Golomb-Rice codes: about log2(range / count) + 1.5 bits a row.
3. An owner decodes what it got, counts each fingerprint and answers every
   sender with a bitmap: set where the fingerprint occurs more than once.
4. The partitions turn the bitmaps into suspects. Only suspects' texts are
   shuffled, and grouped by their bytes: partial aggregation folds copies
   before the shuffle, so a group of any size arrives as one row a task.

Defined cases. Null text counts as empty. A null ``doc_id`` sorts last as a
keeper. Rows that repeat a ``doc_id`` are counted one by one in
``group_size``; of rows that repeat the keeping id one stays. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import NULL_ID, U64, documents, owners_of, ready, real_id, written

SPACES = r"[\x20\x09-\x0D]+"


def rice_encode(values: np.ndarray, space: int) -> tuple[int, bytes]:
    """Golomb-Rice code of sorted values below ``space``: the parameter, then
    the gaps' quotients in unary and their remainders in ``k`` bits each."""
    n = len(values)
    if n == 0:
        return 0, b""
    k = max(0, (space // n).bit_length() - 1)
    gaps = np.diff(values, prepend=U64(0))
    stops = np.cumsum((gaps >> U64(k)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    bits = ((gaps[:, None] >> np.arange(k, dtype=U64)) & U64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes() + np.packbits(bits).tobytes()


def rice_decode(code: bytes, n: int, k: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, U64)
    tail = (n * k + 7) // 8
    raw = np.frombuffer(code, np.uint8)
    stops = np.flatnonzero(np.unpackbits(raw[:len(raw) - tail]))[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    bits = np.unpackbits(raw[len(raw) - tail:], count=n * k).reshape(n, k)
    rest = (bits.astype(U64) << np.arange(k, dtype=U64)).sum(axis=1, dtype=U64)
    return np.cumsum((quotients.astype(U64) << U64(k)) + rest)


def _fingerprint(digest: str, bits: int):
    """The digest's leading ``bits`` (60 at most) as a non-negative number."""
    return F.shiftrightunsigned(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 60 - bits)


def suspects(prints: DataFrame, bits: int) -> DataFrame:
    """Rows of ``prints`` (part, row, doc_id, text_sha256, fp) whose fingerprint occurs more than once."""
    owners = owners_of(prints.sparkSession)
    span = -(-(1 << bits) // owners)

    def send(key, rows):
        part = key[0].as_py()
        fp = np.sort(rows.column("fp").to_numpy().astype(U64))
        cuts = np.searchsorted(fp, (np.arange(owners + 1, dtype=U64) * U64(span)))
        out = []
        for o in np.flatnonzero(np.diff(cuts)):
            own = fp[cuts[o]:cuts[o + 1]] - U64(int(o) * span)
            k, code = rice_encode(own, span)
            out.append((int(o), part, len(own), k, code))
        return pa.Table.from_pylist([dict(zip(("owner", "part", "n", "k", "code"), r)) for r in out],
                                    schema=SENT)

    def answer(key, rows):
        lists = [rice_decode(c.as_py(), n.as_py(), k.as_py()) for c, n, k in
                 zip(rows.column("code"), rows.column("n"), rows.column("k"))]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        maps = [np.packbits(np.isin(x, twice)).tobytes() for x in lists]
        return pa.table({"owner": rows.column("owner"), "part": rows.column("part"), "n": rows.column("n"),
                         "bitmap": pa.array(maps, pa.binary())})

    def receive(key, rows, answers):
        fp = rows.column("fp").to_numpy()
        order = np.argsort(fp, kind="stable")
        got = sorted(zip(answers.column("owner").to_pylist(), answers.column("n").to_pylist(),
                         answers.column("bitmap").to_pylist()))
        bits_ = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, n, b in got]
        flag = np.zeros(len(fp), bool)
        flag[order] = np.concatenate(bits_).astype(bool)  # owners in order hold the sorted list
        return rows.filter(pa.array(flag)).select(["doc_id", "text_sha256", "row"])

    sent = prints.select("part", "fp").groupBy("part").applyInArrow(
        send, "owner int, part int, n int, k int, code binary")
    answers = sent.groupBy("owner").applyInArrow(answer, "owner int, part int, n int, bitmap binary")
    return (prints.groupBy("part").cogroup(answers.groupBy("part"))
            .applyInArrow(receive, "doc_id long, text_sha256 string, row long"))


SENT = pa.schema([("owner", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("k", pa.int32()),
                  ("code", pa.binary())])


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 60) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``bits``: length of the exchanged fingerprint (fewer bits only mean more
    suspects; equality is always decided by bytes).
    """
    ready(docs.sparkSession)
    raw = documents(docs, doc_id, text)
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " ").alias("norm")
    norm = raw.select("doc_id", normal)
    prints = written(
        norm.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("norm", 256).alias("text_sha256"))
            .withColumn("fp", _fingerprint("text_sha256", bits)), "exact-prints")
    sus = written(suspects(prints, bits), "exact-suspects")

    # Bytes decide: group suspects by the text itself. The join is the same at every size: texts meet
    # their ids by a shuffle, never by a broadcast of ids that grow with the data.
    ids = sus.select("doc_id").distinct()
    texts = raw.join(ids.hint("merge"), "doc_id", "left_semi").select("doc_id", normal)
    groups = written(
        texts.withColumn("text_sha256", F.sha2("norm", 256))
             .groupBy("text_sha256", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
             .select("text_sha256", "keep_id", "n"), "exact-groups")
    # A digest that covered two different texts would show as two groups here:
    # a run that meets one stops instead of merging them.
    one = groups.groupBy("text_sha256").agg(
        F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts")
    ).where("group_size > 1").select(
        "text_sha256", "group_size",
        F.when(F.col("texts") == 1, F.col("keep_id"))
         .otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")).alias("keep_id"))
    # One row stays, also where several repeat the keeping id.
    stays = sus.groupBy("text_sha256").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    one = one.join(stays, "text_sha256").select("text_sha256", "group_size", "keep_id", F.col("first.row").alias("first_row"))
    return (prints.select("row", "doc_id", "text_sha256").join(one, "text_sha256", "left")
            .select(real_id(), F.nullif(F.coalesce("keep_id", "doc_id"), F.lit((1 << 63) - 1)).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (F.coalesce("first_row", "row") == F.col("row")).alias("kept"), "text_sha256"))


def first_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, without later copies: of equal
    texts the row with the smallest id stays, and one of rows that repeat it."""
    found = exact_dedup(docs, doc_id, text)
    keepers = (found.where("doc_id <=> keep_id").groupBy(F.coalesce("doc_id", F.lit(NULL_ID)).alias("k_id"), F.col("text_sha256").alias("k_sha"))
               .agg(F.count(F.lit(1)).alias("n")))
    digest = F.sha2(F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), SPACES, " "), 256)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"),
                       digest.alias("sha"))
    # The same join at every size; the rows cross it once, for both branches.
    met = rows.join(keepers.hint("merge"), (F.col("id") == F.col("k_id")) & (F.col("sha") == F.col("k_sha")))
    once = met.where("n = 1").select("row.*")
    return once.unionByName(met.where("n > 1").dropDuplicates(["id", "sha"]).select("row.*"))
