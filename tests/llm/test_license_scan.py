import random
import re

from laketide.llm import license_scan as S


def expected(i, text, words):
    w = words(text)
    found = []
    for label, phrase in S.PHRASES:
        p = phrase.split()
        found += [(j, label) for j in range(len(w) - len(p) + 1) if w[j:j + len(p)] == p]
    at = [j for j, _ in found]
    return i, len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def texts():
    rng = random.Random(2)
    bits = ["under the MIT license", "Apache License, Version 2.0", "CC BY-NC 4.0", "under the", "mit license", "cc by", "by nc", "é", "x y z",
            "under the mit under the mit license", "cc by nc by nc", "license version 2"]
    return [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(150)]


def test_base_places_match_brute_force(spark, brute):
    rows = [*texts(), (500, "cc-by-nc " * 3000)]
    got = sorted(tuple(r)[:6] for r in S.license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == sorted(expected(*r, brute["alnum"]) for r in rows)


def test_notices_with_changes_are_found(spark):
    notice = S.NOTICES[0][1].split()
    worn = notice[:12] + ["hereby", "really"] + notice[12:20] + notice[21:]
    half = notice[:12]
    rows = [(1, "Intro words. " + " ".join(notice).upper() + " end."), (2, "a b " + " ".join(worn)), (3, " ".join(half)),
            (4, " ".join(notice[i] for i in random.Random(1).sample(range(len(notice)), len(notice)))), (5, "under the mit license")]
    got = {r.doc_id: r for r in S.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0 and got[1].base_labels == "" and got[1].spans[0].start == 2
    assert got[2].labels == "mit" and 0.7 <= got[2].score < 1 and len(got[2].spans) == 1
    assert got[3].labels == got[4].labels == "" and got[3].score == got[4].score == 0
    assert got[5].labels == got[5].base_labels == "mit" and got[5].score == 1.0


def test_labels_hold_base_labels(spark):
    for r in S.license_scan(spark.createDataFrame(texts(), "doc_id long, text string")).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_nasty_rows(nasty, nasty_rows, brute):
    got = sorted((tuple(r)[:6] for r in S.license_scan(nasty).collect()), key=str)
    assert got == sorted((expected(*r[:2], brute["alnum"]) for r in nasty_rows), key=str)


def test_repeated_rows_vote_once(spark, brute):
    rows = [(1, "under the MIT license"), (2, "under the mit"), (None, "cc by nc and cc by")] * 2 + [(None, "cc by")] * 3
    got = sorted((tuple(r)[:6] for r in S.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted((expected(*r, brute["alnum"]) for r in rows), key=str)


def test_no_python_and_empty(mixed, nothing):
    plan = S.license_scan(mixed)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert S.license_scan(nothing).count() == 0
