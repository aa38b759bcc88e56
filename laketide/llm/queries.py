"""The registered queries of this subpackage, and their SQL where SQL is able."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketide.llm import (centroid_clustering, decontaminate, exact_dedup, filter_audit, jaccard_join, language, license_scan,
                          neighbours, packing, pii, quality, substring_dedup, url_filter)
from laketide.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned on two thirds of them."""
    return language.language_id(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without the 20-word windows that stood earlier."""
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of 2048 in the corpus mixture."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents: five-word shingles, similarity of 0.8 or more."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).drop("class_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


# The URL policy, (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]
# Hosts whose pages make up the list of unwanted URLs.
LISTED_HOSTS = r"(^|\.)(spam-farm|cheap-pills|casino-win|free-bets|ads-track)\."


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of all pages; the list is every page URL of an unwanted host."""
    pages = table(spark, sf_dir, "pages")
    host, _ = url_filter.split_url(F.col("url"))
    return url_filter.judge_urls(pages, pages.where(host.rlike(LISTED_HOSTS)), URL_RULES)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in all documents."""
    return decontaminate.contaminated_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned on four fifths of the labels."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in all documents."""
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, per language and in every order of the filters."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for every twentieth id."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of 16 centroids over all vectors of 64 components."""
    return centroid_clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_packing": op4_packing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_license_scan": op10_license_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLE: dict[str, str] = {}

ORACLE["op3_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
cut AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM win)
  WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT q) AS q FROM (SELECT doc_id, unnest(range(p, p + 20)) AS q FROM cut) GROUP BY 1),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d)
  ANTI JOIN (SELECT doc_id, unnest(q) AS i FROM gone) USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(gone.q), 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE["op6_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, row_number() OVER (PARTITION BY t.norm ORDER BY t.doc_id) = 1 AS kept,
  sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

ORACLE["op7_url_filter"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1),
    '^[^?#]*') AS path FROM u),
c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') END AS canon
  FROM h),
rules(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT page_id, arg_max(rh || rp, length(rh) + length(rp)) AS rule, arg_max(verdict, length(rh) + length(rp)) AS said
  FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
listed AS (
  SELECT DISTINCT canon FROM c
  WHERE regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|casino-win|free-bets|ads-track)\.') AND canon IS NOT NULL)
SELECT page_id, host, path, rule, CASE WHEN said IS NOT NULL THEN said WHEN listed.canon IS NOT NULL THEN 'block'
  ELSE 'allow' END AS verdict
FROM c LEFT JOIN fit USING (page_id) LEFT JOIN listed USING (canon)
"""

ORACLE["op8_decontaminate"] = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 10) AS k FROM iw WHERE len(w) > 0),
win AS (
  SELECT item_id, least(len(w), 10) AS k, array_to_string(w[j:j + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS j FROM iw WHERE len(w) > 0)),
dwin AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, sizes WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, k, p FROM dwin SEMI JOIN win USING (k, s)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY 1),
it AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM dwin JOIN win USING (k, s) GROUP BY 1)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(n.n_hit, 0) AS n_hit,
  coalesce(len(it.items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(it.items, ','), '')) AS items_sha256,
  coalesce(n.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


ORACLE["op11_filter_audit"] = r"""
WITH RECURSIVE first AS (SELECT coalesce(text, '') AS t, min(doc_id) AS first_id FROM documents GROUP BY 1),
w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
m AS (
  SELECT part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM w JOIN first USING (t) LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
p AS (
  SELECT '' AS o, 0 AS used UNION ALL
  SELECT o || substr('ABCDE', i + 1, 1), used + (1 << i)::INT FROM p, range(5) r(i) WHERE used & (1 << i)::INT = 0),
s AS (
  SELECT o AS filter_order, k::INT AS step, 1 << (ascii(substr(o, k::INT, 1)) - 65) AS f,
    coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(substr(o, j::INT, 1)) - 65))), 0)::INT AS before
  FROM p, range(1, 6) r(k) WHERE length(o) = 5),
x AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (mask & (before | f) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & f <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & f <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & f <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & f <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM x
"""


def _clusters_sql(rounds: int = 3) -> str:
    """DuckDB SQL of the clustering: each round's centroids and assignment as a step of its own."""
    steps = [r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS cluster, x
  FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h LIMIT 16))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, x, cluster, distance FROM (
    SELECT vec_id, v.x, cluster, list_sum(list_transform(list_zip(v.x, c{r}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT
      AS distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS place FROM v, c{r}) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM (
      SELECT cluster, i, sum(e)::HUGEINT AS s, count(*) AS n FROM (
        SELECT cluster, unnest(x) AS e, unnest(range(64)) AS i FROM a{r}) GROUP BY ALL) GROUP BY cluster) m USING (cluster))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


ORACLE["op13_centroid_clustering"] = _clusters_sql()


def with_shared_folder(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Names the shared folder (``spark.checkpoint.dir``) before a query runs."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared_dir(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run
