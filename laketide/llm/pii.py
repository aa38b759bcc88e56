"""Personal data by rules and by bootstrapped contextual extraction.

Base spans come from four fixed patterns. They seed the bootstrap:

* Instances: every base span, and every other identifier-shaped token (digits
  or an ``@``, outside base spans) or run of digit groups joined by separators,
  with the kind its shape could be.
* Lexical patterns: the one and the two words before an instance's first
  character, whatever they are.
* A graph joins patterns to instance values. In each round a pattern's
  confidence is the share of its instances that are believed to be of its
  kind (smoothed). It is trusted with enough different seeds, enough
  confidence, and at least half of what the shape alone leaves open: words
  that stand before anything teach nothing. A value's belief
  is the chance that one of its trusted patterns is right. Rounds are Spark
  joins and aggregations over (pattern, value) counts, written in between.
* Unseen identifiers are tokens and runs whose value ends up believed and that
  stand in a trusted pattern; of overlapping ones the first and longest counts.

The patterns are made of possessive quantifiers and start only where a match
can start, so they need neither recursion nor a second look at a character,
and find what the plain patterns find. Positions come from splitting a text at
the matches: the pieces' and matches' lengths add up. Main path: DataFrame
functions only.

Defined cases. Null text is empty. Rows that repeat an id are told apart by
their text; equal rows get equal answers. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laketide.llm.common import documents, real_id, written

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "[A-Za-z0-9._%+-]"
# The contract's patterns, each starting at a run's first character or where the last match ended.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Any token with a digit or an at sign.
    "token": r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S++",
    # Digit groups, brackets and one blank, dot or hyphen between them; letters behind them spoil the shape.
    "run": r"(?<![A-Za-z0-9@])\(?\+?\(?[0-9]++(?:\)?[\x20.-]?\(?[0-9]++)*+(?:[A-Za-z@]\S*+)?+",
}
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "token": "[0-9@]", "run": "[0-9]"}
CONTEXT = 80  # code points before an instance whose last words are its pattern
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digits' Luhn sum is a multiple of ten."""
    def add(acc, d):
        twice = (F.length(digits) - d) % 2 == 1
        v = F.substring(digits, d, 1).cast("int") * F.when(twice, 2).otherwise(1)
        return acc + v - F.when(v > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")
    if kind == "card":
        return F.when(n.between(14, 19), luhn(_digits(match))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, i, gap, size, value, left, tail): the i-th match, the code
    points before it since the last one, the end of them, and the end of both."""
    rx = PATTERNS[kind]
    pieces = F.split(text, rx, -1)
    end = lambda c: F.substring(c, -CONTEXT, CONTEXT)
    pairs = F.arrays_zip(pieces.alias("p"), F.regexp_extract_all(text, F.lit(rx), F.lit(0)).alias("m"))
    rows = F.transform(pairs, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("size"),
        x["m"].alias("value"), end(x["p"]).alias("left"), end(F.concat(x["p"], x["m"])).alias("tail")))
    found = F.filter(rows, lambda x: x["value"].isNotNull())  # the last piece has no match
    return F.when(text.rlike(GUARDS[kind]), found).otherwise(F.filter(rows, lambda x: F.lit(False)))


def instances(rows: DataFrame) -> DataFrame:
    """All base spans and all identifier-shaped tokens and runs outside them, with
    offsets (code points, end exclusive): doc_id, text_key, kind, base, start, end, value, left."""
    text = F.col("text")
    key = ["doc_id", "text_key"]
    found = (rows.where(text.rlike("[0-9@]")).dropDuplicates(key)
             .select(*key, F.explode(F.concat(*[_matches(text, k) for k in PATTERNS])).alias("x")).select(*key, "x.*"))
    before = W.partitionBy(*key, "kind").orderBy("i")
    spans = found.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)) \
                 .withColumn("start", F.col("end") - F.col("size"))
    # The text before a match, across earlier matches: each has two code points or more with its gap.
    earlier = F.array_join(F.collect_list("tail").over(before.rowsBetween(-CONTEXT // 2, -1)), "")
    spans = spans.withColumn("left", F.when(F.col("gap") < CONTEXT, F.concat(earlier, "left")).otherwise(F.col("left"))).drop("tail")
    ok = F.lit(False)
    for k in KINDS:
        ok = ok | ((F.col("kind") == k) & _valid(k, F.col("value")))
    base = F.col("kind").isin(KINDS)
    spans = spans.where(~base | ok).withColumn("base", base)
    # A token that touches a base span is part of it.
    place = W.partitionBy(*key).orderBy("start")
    back = F.max(F.when(F.col("base"), F.col("end"))).over(place)
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(place.rangeBetween(W.currentRow, W.unboundedFollowing))
    spans = (spans.withColumn("back", back).withColumn("ahead", ahead)
             .where(F.col("base") | ((F.coalesce("back", F.lit(-1)) <= F.col("start"))
                                     & (F.coalesce("ahead", F.col("end")) >= F.col("end")))))
    # The kind a token or run could be, by its shape.
    bare = F.regexp_replace("value", r"^[^A-Za-z0-9+(@]+|[^A-Za-z0-9)]+$", "")
    bare = F.when(F.contains(bare, F.lit(")")), bare).otherwise(F.regexp_replace(bare, r"^\(+", ""))
    n = F.length(_digits(bare))
    shape = (F.when(bare.rlike("^[^@]+@[^@]+$"), "email")
             .when(bare.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
             .when(bare.rlike(r"^[0-9 -]+$") & n.between(13, 19), "card")
             .when(bare.rlike(r"^[+(0-9][0-9().\x20-]+$") & n.between(7, 15), "phone"))
    skipped = F.instr("value", bare) - 1
    token = spans.withColumns({"bare": bare, "shape": shape, "skipped": skipped})
    left = F.concat("left", F.when(F.col("base"), "").otherwise(F.substring("value", F.lit(1), F.col("skipped"))))
    left = F.trim(F.regexp_replace(F.lower(F.substring(left, -CONTEXT, CONTEXT)), r"[0-9]+", "0"))
    return token.where("base OR shape IS NOT NULL").select(
        *key, F.when(F.col("base"), F.col("kind")).otherwise(F.col("shape")).alias("kind"), "base",
        F.when(F.col("base"), F.col("start")).otherwise(F.col("start") + F.col("skipped")).alias("start"),
        F.when(F.col("base"), F.col("end")).otherwise(F.col("start") + F.col("skipped") + F.length("bare")).alias("end"),
        F.when(F.col("base"), F.col("value")).otherwise(F.col("bare")).alias("value"), left.alias("left")) \
        .dropDuplicates([*key, "kind", "start", "end"])  # a token may be a run


def _patterns(found: DataFrame) -> DataFrame:
    """Each instance once per pattern: the last word, and the last two words, on its left."""
    words = F.filter(F.split("left", r"\s+"), lambda x: x != "")
    n = F.size("w")
    return (found.withColumn("w", words).where("size(w) > 0")
            .withColumn("pattern", F.explode(F.array_distinct(F.array(
                F.element_at("w", -1), F.concat_ws(" ", F.slice("w", F.greatest(n - 1, F.lit(1)), 2)))))).drop("w", "left"))


def bootstrap(found: DataFrame, rounds: int = 3, min_seeds: int = 5, trust: float = 0.85):
    """(patterns, values): trusted (kind, pattern) and believed (kind, value) after the last round."""
    edges = written(_patterns(found).groupBy("kind", "pattern", "value")
                    .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("base").cast("int")).alias("seed")), "pii-edges")
    beliefs = edges.groupBy("kind", "value").agg(F.max("seed").cast("double").alias("belief"))
    # What a kind's shape says by itself: a pattern must say clearly more (one row per kind).
    shape = F.broadcast(edges.groupBy("kind").agg(((1 + F.sum(F.col("seed") * F.col("n")) / F.sum("n")) / 2).alias("floor")))
    trusted = None
    for _ in range(rounds):
        scored = (edges.join(beliefs, ["kind", "value"]).groupBy("kind", "pattern")
                  .agg((F.sum(F.col("belief") * F.col("n")) / (F.sum("n") + 1)).alias("confidence"),
                       F.sum("seed").alias("seeds")))
        trusted = written(scored.join(shape, "kind").where((F.col("seeds") >= min_seeds) & (F.col("confidence") >= trust)
                                                           & (F.col("confidence") >= F.col("floor"))).drop("floor"), "pii-patterns")
        miss = F.sum(F.log(F.greatest(1 - F.coalesce("confidence", F.lit(0.0)), F.lit(1e-9))))
        beliefs = written(edges.join(trusted.drop("seeds"), ["kind", "pattern"], "left").groupBy("kind", "value")
                          .agg(F.greatest(F.max("seed").cast("double"), 1 - F.exp(miss)).alias("belief")), "pii-values")
    return trusted, beliefs.where(F.col("belief") >= trust)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = 3, min_seeds: int = 5,
             trust: float = 0.85) -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone`` (base spans),
    ``base_sha256``, ``spans`` (base and discovered) and ``n_found`` (discovered)."""
    rows = documents(docs, doc_id, text).withColumn("text_key", F.xxhash64("text"))
    key = ["doc_id", "text_key"]
    found = written(instances(rows), "pii-instances")
    trusted, believed = bootstrap(found, rounds, min_seeds, trust)
    tokens = _patterns(found.where("NOT base"))
    unseen = (tokens.join(trusted.select("kind", "pattern"), ["kind", "pattern"], "left_semi")
              .join(believed.select("kind", "value"), ["kind", "value"], "left_semi")
              .select(*key, "kind", "base", "start", "end").distinct())
    sooner = W.partitionBy(*key).orderBy("start", F.desc("end"), "kind").rowsBetween(W.unboundedPreceding, -1)
    unseen = (unseen.withColumn("reach", F.coalesce(F.max("end").over(sooner), F.lit(0)))
              .where(F.col("reach") <= F.col("start")).drop("reach"))
    spans = found.where("base").select(*key, "kind", "base", "start", "end").unionByName(unseen)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct("start", rank.alias("o"), "end", "kind")
    listed = lambda c: F.concat_ws(",", F.transform(F.array_sort(c), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}")
    per = (spans.groupBy(*key)
           .agg(*[count(k) for k in KINDS], F.collect_list(F.when(F.col("base"), item)).alias("own"),
                F.collect_list(item).alias("every"), F.count(F.when(~F.col("base"), 1)).alias("n_found"))
           .select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), *[f"n_{k}" for k in KINDS], "n_found",
                   listed(F.col("own")).alias("own"), listed(F.col("every")).alias("spans")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (rows.select(*key).join(per, (F.col("doc_id") == F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left")
            .select(real_id(), *[zero(f"n_{k}") for k in KINDS],
                    F.sha2(F.coalesce("own", F.lit("")), 256).alias("base_sha256"),
                    F.coalesce("spans", F.lit("")).alias("spans"), zero("n_found")))
