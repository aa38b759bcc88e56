"""Keyed tokens: HMAC-SHA-256 (RFC 2104) written as Spark column expressions.

The key never enters a query plan as a literal: it lives in a one-row table,
the inner and outer pads are derived from it by Spark expressions and reach
the token expression as a scalar subquery. Plans, the event log and the UI
show the subquery, not key bytes.

    token = hex(sha256(opad || sha256(ipad || message)))

with ``message`` the UTF-8 bytes of ``"token:" + length of domain + ":" +
domain + ":" + cast(value as string)``. The domain keeps equal numbers of
different kinds apart (customer 7 and supplier 7 get different tokens), and
its length keeps domain and value apart whatever they hold. Keys are derived
from messages that begin with ``"derive:"``, so no token can equal a key. A
null value stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of RFC 2104 for SHA-256.
BLOCK_BYTES = 64
IPAD_BYTE = 0x36
OPAD_BYTE = 0x5C
# Fixed beginnings of the two kinds of messages.
TOKEN_PREFIX = "token:"
DERIVE_PREFIX = "derive:"


def key_table(spark: SparkSession, key: bytes) -> DataFrame:
    """One-row table ``key binary, pads struct<ipad, opad>``. In production,
    read the key from a protected path and pass it through ``with_pads``.

    Cached with its pads: the pads subquery then reads executor memory
    instead of re-deriving them (or running a job fed from the Python
    process) in every query; a lost copy is rebuilt from lineage. The key
    stays out of every plan either way.
    """
    return with_pads(spark.createDataFrame([(bytearray(key),)], "key binary"))


def with_pads(key_df: DataFrame, key_col: str = "key") -> DataFrame:
    """The key table with its pads derived once and cached."""
    block = _block_key(F.col(key_col))
    return key_df.select(
        F.col(key_col).alias("key"),
        F.struct(_xor_block(block, IPAD_BYTE).alias("ipad"),
                 _xor_block(block, OPAD_BYTE).alias("opad")).alias("pads")).cache()


def _block_key(key: Column) -> Column:
    # Keys longer than one block are hashed first; then zero-padded to a block.
    short = F.when(F.octet_length(key) > BLOCK_BYTES, F.unhex(F.sha2(key, 256))).otherwise(key)
    return F.rpad(short, BLOCK_BYTES, F.lit(b"\x00"))


def _xor_block(block: Column, byte: int) -> Column:
    # Spark has no XOR on binary: XOR the block four bytes at a time as bigint.
    mask = int.from_bytes(bytes([byte]) * 4, "big")
    words = []
    for i in range(BLOCK_BYTES // 4):
        word = F.conv(F.hex(F.substring(block, 4 * i + 1, 4)), 16, 10).cast("bigint")
        words.append(F.lpad(F.hex(word.bitwiseXOR(F.lit(mask))), 8, "0"))
    return F.unhex(F.concat(*words))


def pad_table(key_df: DataFrame, key_col: str = "key") -> DataFrame:
    """One-row table ``pads struct<ipad binary, opad binary>`` from a key table
    (taken as is when the table already carries its pads)."""
    if "pads" in key_df.columns:
        return key_df.select("pads")
    block = _block_key(F.col(key_col))
    return key_df.select(
        F.struct(_xor_block(block, IPAD_BYTE).alias("ipad"),
                 _xor_block(block, OPAD_BYTE).alias("opad")).alias("pads"))


def pads_of(key_df: DataFrame, key_col: str = "key") -> Column:
    """Scalar-subquery column holding the pads of the key in ``key_df``."""
    return pad_table(key_df, key_col).scalar()


def hmac_hex(message: Column, pads: Column) -> Column:
    """HMAC-SHA-256 of a binary message as 64 lower-case hex characters."""
    inner = F.unhex(F.sha2(F.concat(pads.getField("ipad"), message), 256))
    return F.sha2(F.concat(pads.getField("opad"), inner), 256)


def message(value: Column, domain: str) -> Column:
    return F.encode(F.concat(F.lit(f"{TOKEN_PREFIX}{len(domain)}:{domain}:"), value.cast("string")), "UTF-8")


def token(value: Column, domain: str, pads: Column) -> Column:
    return hmac_hex(message(value, domain), pads)


def derive_key_table(key_df: DataFrame, label: str, key_col: str = "key") -> DataFrame:
    """One-row table with a key derived from ``key_df`` for ``label``.

    ``derived = HMAC(key, "derive:" + label)`` (32 bytes). Used to give each
    side lake its own key, so two workspaces' tokens cannot be joined.
    """
    pads = pad_table(key_df, key_col).select("pads")
    msg = F.encode(F.lit(DERIVE_PREFIX + label), "UTF-8")
    return pads.select(F.unhex(hmac_hex(msg, F.col("pads"))).alias("key"))
