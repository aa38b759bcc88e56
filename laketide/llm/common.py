"""Shared helpers: words of an Arrow text column as NumPy arrays, rolling
word hashes, binary payload rows, and the shared folder for written tables.

Words are found and hashed over the column's whole byte buffer at once, so no
Python loop touches a word. Temporary arrays are sized by a block of bytes,
not by the longest text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.session import scratch_path

U64 = np.uint64
BLOCK_BYTES = 1 << 19
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NULL_ID = (1 << 63) - 1  # stands for a null document id inside an operator; sorts last


def byte_class(pattern_bytes: bytes) -> np.ndarray:
    """Lookup table: True for the bytes given."""
    lut = np.zeros(256, bool)
    lut[np.frombuffer(pattern_bytes, np.uint8)] = True
    return lut


WHITE = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
NON_WHITE = ~WHITE
# Word bytes once A-Z is lower-cased: digits, a-z and every byte of a non-ASCII character.
ALNUM = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """SplitMix64's finishing step (public domain), elementwise."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.base, self.n = U64(0x9E3779B97F4A7C15), 0
        self.inverse = U64(pow(int(self.base), -1, 1 << 64))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, BLOCK_BYTES + 4096)
            ones = np.ones(self.n, U64)
            up, down = ones * self.base, ones * self.inverse
            up[0] = down[0] = U64(1)
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1, from 0) and UTF-8 bytes of a string column; null is empty."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return off - off[0], data


def find_words(off: np.ndarray, data: np.ndarray, is_word: np.ndarray):
    """Start and end byte of each word, and the first word of each text (n + 1)."""
    w = is_word[data]
    before, after = np.empty_like(w), np.empty_like(w)
    if len(w):
        before[0], before[1:] = False, w[:-1]
        after[-1], after[:-1] = False, w[1:]
        full = off[1:] > off[:-1]
        before[off[:-1][full]] = False
        after[off[1:][full] - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, block by block."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, base + BLOCK_BYTES)))
        seg = data[base:ends[j - 1]]
        up, down = _POWERS.get(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, U64)
        np.cumsum(_BYTE[seg] * up[:len(seg)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U64))
        i = j
    return out


def rolling(h: np.ndarray, k: int, factor: int = 0xA24BAED4963EE407) -> np.ndarray:
    """Hash of every ``k`` consecutive values (``len(h) - k + 1`` of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    v = h[:n].copy()
    for j in range(1, k):
        v = v * U64(factor) + h[j:j + n]
    return mix(v)


def owners_of(spark: SparkSession) -> int:
    """Owner tasks of a payload exchange: as many as the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ready(spark: SparkSession) -> None:
    """Session settings of the operators: small Arrow batches (a batch of long
    texts must fit a Python worker), and workers on this machine find the
    package where the driver found it (a cluster gets it by ``--py-files``)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds more than about ``limit`` bytes of text
    (a single longer text makes a part of its own)."""
    off, _ = text_buffer(batch.column(batch.schema.get_field_index(text)))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job started in here go as soon as it ends, not when the driver happens to
    collect its garbage. For jobs whose plan runs once: the caller's own jobs keep the setting they had."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back: lineage is
    cut, a lost executor does not lose it, and the shuffles behind it go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, ids never null."""
    return df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                     F.col(text).cast("string").alias("text"))


def real_id(col: str = "doc_id"):
    """Back from ``NULL_ID`` to null."""
    return F.nullif(F.col(col), F.lit(NULL_ID)).alias(col)
