"""Column expressions that coarsen quasi-identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_band(c: Column, width: int) -> Column:
    """Lower bound of the band of ``width`` the value falls in, as bigint."""
    return (F.floor(c / F.lit(width)) * F.lit(width)).cast("bigint")


def hash_bucket(value: Column, salt: str, buckets: int) -> Column:
    """Repeatable bucket in ``[0, buckets)`` from the md5 of salt and value."""
    digest = F.md5(F.concat(F.lit(salt + "|"), value.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
