"""Pseudonymisation and disclosure control (P1-P6)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laketide.functions import generalise as gen
from laketide.functions import keyed
from laketide.functions.text_rules import DEFAULT_RULES, TextRule
from laketide.session import scratch_path


# --------------------------------------------------------------------- P1
def pseudonymise(df: DataFrame, cols: Sequence[str] | Mapping[str, str],
                 key_df: DataFrame, domain: str | None = None,
                 key_col: str = "key") -> DataFrame:
    """Replace identifier columns by HMAC-SHA-256 tokens under the key in ``key_df``.

    ``cols`` is a list of columns sharing ``domain``, or a mapping column ->
    domain. The same value in the same domain gives the same token in every
    table under one key, so joins on tokens equal joins on identifiers.
    A narrow projection: no shuffle, no join; the pads arrive as one scalar
    subquery evaluated once per query.
    """
    if isinstance(cols, Mapping):
        domains = dict(cols)
    else:
        if domain is None:
            raise ValueError("domain is required when cols is a list")
        domains = {c: domain for c in cols}
    pads = keyed.pads_of(key_df, key_col)
    replaced = {c: keyed.token(F.col(c), d, pads) for c, d in domains.items()}
    return df.withColumns(replaced)


# --------------------------------------------------------------------- P2
def token_vault(ids: DataFrame, vault: DataFrame | None, vault_path: str, key_df: DataFrame,
                id_col: str = "id", key_col: str = "key") -> tuple[DataFrame, DataFrame]:
    """Give tokens to identifiers not yet in the vault.

    ``vault`` has columns ``id string, token string, batch string`` (or is
    None for an empty vault). A new identifier's token is the HMAC of the
    batch's own random name and the identifier under the vault's key (a
    one-row table, as in ``pseudonymise``): without the key it cannot be
    rebuilt from a plan or an event log, and a retried task gives the same
    token. New rows are written, one folder a batch, before anything reads
    them. Returns (new rows, whole vault) read back; the new rows' read is
    cut to their batch's folder.
    """
    spark = ids.sparkSession
    batch = uuid.uuid4().hex
    wanted = (ids.select(F.col(id_col).cast("string").alias("id"))
              .where(F.col("id").isNotNull()).distinct())
    if vault is not None:
        wanted = wanted.join(vault.select("id"), "id", "left_anti")
    token = keyed.token(F.col("id"), f"vault:{batch}", keyed.pads_of(key_df, key_col))
    new = wanted.select("id", token.alias("token"), F.lit(batch).alias("batch"))
    new.write.mode("append").partitionBy("batch").parquet(vault_path)
    stored = spark.read.schema("id string, token string, batch string").parquet(vault_path)
    return stored.where(F.col("batch") == batch), stored


# --------------------------------------------------------------------- P3
def reidentify(df: DataFrame, token_col: str, vault: DataFrame, approved: DataFrame,
               id_col: str = "id") -> DataFrame:
    """Tokens back to identifiers, only for tokens on the approved list.

    Rows whose token is not approved are not returned. ``vault`` maps
    ``token -> id`` (columns ``token``, ``id``); ``approved`` has ``token``.
    The vault's approved part is written to the shared folder first; the facts
    then meet it in one join. That join stands between two plain shuffles, so
    a token that holds a third of the rows is split by AQE (two joins on one
    shuffle would not be).
    """
    spark = df.sparkSession
    ok = (approved.select(F.col("token").alias(token_col))
          .where(F.col(token_col).isNotNull()).distinct())
    lookup = ok.join(vault.select(F.col("token").alias(token_col), F.col("id").alias(id_col)), token_col, "left")
    path = scratch_path(spark, "approved")
    lookup.write.parquet(path)
    return df.join(spark.read.schema(lookup.schema).parquet(path), token_col)


# --------------------------------------------------------------------- P4
def _occurrences(text: Column, literal: str) -> Column:
    """Non-overlapping occurrences of an ASCII literal (plain replace, no
    regex; byte lengths are O(1) on Spark strings)."""
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(literal), F.lit(""))))
            / F.lit(len(literal.encode("utf-8")))).cast("int")


def mask_text(df: DataFrame, text_col: str, rules: Iterable[TextRule] = DEFAULT_RULES,
              out_col: str | None = None) -> DataFrame:
    """Blank out direct identifiers in a text column and count hits per kind.

    Rules apply in order; each counts its hits on the text left by the rules
    before it. Adds ``n_<kind>`` columns; the text column is replaced (or
    written to ``out_col``). Whole texts, JVM-side regex, no shuffle.

    One regex pass per rule: the hit count is the growth in occurrences of
    the rule's mask literal, which is exact because a mask such as
    ``[CARD]`` cannot overlap itself. A rule's guard substring skips the
    regex on texts that cannot match.
    """
    text = F.col(text_col)
    counts: dict[str, Column] = {}
    steps: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        before = _occurrences(text, rule.mask)
        replaced = F.regexp_replace(text, rule.engine_pattern, rule.mask)
        if rule.guard is not None:
            absent = F.instr(text, rule.guard) == 0
            replaced = F.when(absent, text).otherwise(replaced)
        step = f"__mask{i}"
        steps[step] = replaced
        hits = _occurrences(F.col(step), rule.mask) - before
        if rule.guard is not None:
            hits = F.when(absent, F.lit(0)).otherwise(hits)
        counts[f"n_{rule.kind}"] = hits
        text = F.col(step)
    out = df
    for step, expr in steps.items():
        out = out.withColumn(step, expr)
    return (out.withColumns({out_col or text_col: text, **counts})
            .drop(*steps))


# --------------------------------------------------------------------- P5
def generalise(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """Coarsen quasi-identifiers. Rules per column:

    ``("year",)``, ``("month",)``, ``("band", width)``, and
    ``("lookup", lookup_df, key_col, value_col)`` which replaces the column by
    the looked-up value (e.g. nation to region).
    """
    out = df
    simple: dict[str, Column] = {}
    for c, rule in rules.items():
        kind = rule[0]
        if kind == "year":
            simple[c] = F.year(F.col(c))
        elif kind == "month":
            simple[c] = F.trunc(F.col(c), "MM")  # first day of the month, a date
        elif kind == "band":
            simple[c] = gen.to_band(F.col(c), rule[1])
        elif kind == "lookup":
            _, lookup, key_col, value_col = rule
            tmp = f"__gen_{c}"
            # One value per key (the greatest), so a duplicated key cannot
            # multiply rows. AQE broadcasts it by its measured bytes.
            side = lookup.groupBy(F.col(key_col).alias(tmp)).agg(F.max(value_col).alias(f"{tmp}_v"))
            out = (out.join(side, out[c] == side[tmp], "left")
                   .withColumn(c, F.col(f"{tmp}_v")).drop(tmp, f"{tmp}_v"))
        else:
            raise ValueError(f"unknown generalisation {kind!r} for {c}")
    return out.withColumns(simple) if simple else out


# --------------------------------------------------------------------- P6
def group_sizes(df: DataFrame, quasi: Sequence[str], unit: str | None = None) -> DataFrame:
    """Size of every quasi-identifier group (null is a group of its own):
    rows, or different values of ``unit`` (a person's identifier)."""
    size = F.count(F.lit(1)) if unit is None else F.count_distinct(F.col(unit))
    return df.groupBy(*quasi).agg(size.alias("group_size"))


def k_anonymity(df: DataFrame, quasi: Sequence[str], unit: str | None = None) -> DataFrame:
    """One row: smallest group size (the k the data meets) and group count."""
    return group_sizes(df, quasi, unit).agg(F.min("group_size").alias("k"),
                                            F.count(F.lit(1)).alias("n_groups"))


def suppress_small_cells(df: DataFrame, quasi: Sequence[str], k: int,
                         mode: str = "drop", unit: str | None = None) -> DataFrame:
    """Remove (``drop``) or blank (``mask``) rows whose quasi group is below k.

    ``unit`` counts persons instead of rows: one person with many rows does
    not make a group safe. Masked rows form a group of their own (with rows
    that were blank before); when that group is below k, its masked rows are
    dropped, so the output meets k in both modes.

    Group sizes come from an aggregation with map-side partial counts, so a
    hot group never lands whole in one task; the small groups are then joined
    back null-safely (left anti / left outer). AQE broadcasts that side when
    it is small at runtime, else splits skewed partitions of the large side.
    """
    small = group_sizes(df, quasi, unit).where(F.col("group_size") < k).select(
        *[F.col(q).alias(f"__q_{q}") for q in quasi])
    cond = None
    for q in quasi:
        c = df[q].eqNullSafe(small[f"__q_{q}"])
        cond = c if cond is None else cond & c
    if mode == "drop":
        return df.join(small, cond, "left_anti")
    if mode == "mask":
        flagged = df.join(small.withColumn("__small", F.lit(True)), cond, "left").drop(*[f"__q_{q}" for q in quasi])
        masked = {q: F.when(F.col("__small"), F.lit(None)).otherwise(F.col(q)) for q in quasi}
        flagged = flagged.withColumns(masked)
        blank = F.lit(True)
        for q in quasi:
            blank = blank & F.col(q).isNull()
        together = F.count(F.lit(1)) if unit is None else F.count_distinct(F.col(unit))
        size = flagged.where(blank).agg(together).scalar()
        return flagged.where(F.col("__small").isNull() | (size >= k)).drop("__small")
    raise ValueError(f"unknown mode {mode!r}")
