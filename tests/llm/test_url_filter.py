import re

import pytest

from laketide.llm import url_filter as U
from laketide.llm.queries import URL_RULES

URLS = [None, "", "no scheme/x", "http://", "https://EXAMPLE.com", "http://example.com/en/1?x#y", "http://www.example.com/en/1",
        "ftp://a.b.net/es/2/", "http://net/fr/", "http://notnet/fr/", "http://x.net?/es/", "http://x.org/a://b", "://h/p",
        "http://www.listed.org/a/b/", "http://m.listed.org/a/b?q", "http://listed.org/a/b#f", "http://listed.org/a", "http://ÄB.org/ü",
        "http://a.example.com/en/", "HTTP://X.COM/en/ x", "http://x.org" + "/y" * 20_000]


def expected(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group().translate({c: c + 32 for c in range(65, 91)})
        path = re.match(r"[^?#]*", rest[len(host):]).group()
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    canon = re.sub(r"^(www|m)\.", "", host) + re.sub("/+$", "", path) if host else None
    return host, path, None, "block" if canon in listed else "allow"


@pytest.mark.parametrize("log2_blocks", [16, 0])  # with a single block the filter passes nearly everything
def test_matches_brute_force(spark, log2_blocks):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(3, URLS[13], "y")], "page_id long, url string, host string")
    listed = ["http://listed.org/a/b", "HTTPS://www.listed.org/a/b/?z", None, "junk", ""] + [f"http://l{i}.org/{i}" for i in range(300)]
    df = spark.createDataFrame([(u,) for u in listed], "url string")
    got = sorted((tuple(r) for r in U.judge_urls(pages, df, URL_RULES, log2_blocks=log2_blocks).collect()), key=str)
    want = [(i, *expected(u, {"listed.org/a/b"})) for i, u in [*enumerate(URLS), (3, URLS[13])]]
    assert got == sorted(want, key=str)


def test_filter_misses_nothing_and_is_sharp(spark):
    pages = spark.range(20_000).selectExpr("id AS page_id", "concat('http://p', id, '.org/', id) AS url")
    listed = pages.where("page_id % 10 = 0")
    loose = U.judge_urls(pages, listed, [], log2_blocks=12, exact=False).where("verdict = 'block'")
    assert loose.where("page_id % 10 = 0").count() == 2000
    assert loose.count() < 2000 * 1.2
    assert U.judge_urls(pages, listed, [], log2_blocks=12).where("verdict = 'block'").count() == 2000


def test_no_python_and_bounded_broadcast(spark):
    pages = spark.range(100).selectExpr("id AS page_id", "concat('http://p', id, '.org/') AS url")
    plan = U.judge_urls(pages, pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert U.judge_urls(none, some, URL_RULES).count() == 0
    assert [tuple(r) for r in U.judge_urls(some, none, URL_RULES).collect()] == [(1, "a.org", "/", None, "allow")]
