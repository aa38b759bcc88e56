"""Linkage on keyed Bloom encodings: encodings against plain Python, links against all pairs, copies, nulls, empty tables."""

from __future__ import annotations

import hashlib
import hmac
import random

import pytest
from pyspark.sql import functions as F

from laketide.functions import keyed
from laketide.operators import linkage as L

KEY = b"test key of the linkage"
FIELDS = {"name": 4, "town": 2}
SCHEMA = "id long, name string, town string"
FIRST = "anna bert carla dieter emma frank greta hans ida jonas karla louis mia noah olga paul".split()
LAST = "schneider fischer weber meyer wagner becker hoffmann schulz koch richter klein wolf schroeder neumann".split()
TOWNS = "hamburg bremen kassel leipzig dresden muenchen stuttgart koeln".split()


def plain_bits(row):
    bits = set()
    for field, hashes in FIELDS.items():
        text = (row[field] or "").strip().lower()
        ended = "\x02" + text + "\x03" if text else ""
        domain = f"bloom:{field}"
        for pair in {ended[i:i + 2] for i in range(len(ended) - 1)}:
            mac = hmac.new(KEY, f"token:{len(domain)}:{domain}:{pair}".encode(), hashlib.sha256).hexdigest()
            bits |= {int(mac[8 * j:8 * j + 8], 16) % L.BITS for j in range(hashes)}
    return bits


def of_code(code):
    return {w * 64 + b for w, word in enumerate(code) for b in range(64) if (word >> b) & 1}


def people(n, seed):
    r = random.Random(seed)
    return [(i, f"{r.choice(FIRST)} {r.choice(FIRST)[:3]} {r.choice(LAST)}-{r.choice(LAST)}", r.choice(TOWNS)) for i in range(n)]


def typed(rows, seed):
    r, out = random.Random(seed), []
    for i, name, town in rows:
        at = r.randrange(len(name) - 1)
        kind = i % 4
        name = (name, name[:at] + name[at + 1:], name[:at] + name[at + 1] + name[at] + name[at + 2:], name[:at] + "x" + name[at + 1:])[kind]
        out.append((i + 10_000, name, None if i % 25 == 0 else town))
    return out


def test_encodings_match_plain_python(spark):
    rows = [(1, "Anna Weber", "Kassel"), (2, " anna WEBER ", "kassel"), (3, None, ""), (4, "a", None), (5, "Jürgen Öz 字", "x" * 500)]
    got = {r.id: of_code(r.code) for r in L.encode_records(spark.createDataFrame(rows, SCHEMA), FIELDS, keyed.key_table(spark, KEY)).collect()}
    assert got == {i: plain_bits({"name": n, "town": t}) for i, n, t in rows}
    assert got[1] == got[2] and got[3] == set()


def test_links_reach_the_recall_against_all_pairs(spark):
    key = keyed.key_table(spark, KEY)
    left = people(400, 1)
    right = typed(left, 2) + [(i + 50_000, n, t) for i, n, t in people(300, 3)]
    code = {s: L.encode_records(spark.createDataFrame(r, SCHEMA), FIELDS, key) for s, r in (("l", left), ("r", right))}
    threshold = 0.8
    a = [(i, plain_bits({"name": n, "town": t})) for i, n, t in left]
    b = [(i, plain_bits({"name": n, "town": t})) for i, n, t in right]
    want = {(i, j): 2 * len(x & y) / (len(x) + len(y)) for i, x in a for j, y in b if 2 * len(x & y) >= threshold * (len(x) + len(y))}
    found = L.link_encodings(code["l"], code["r"], "id", "id", threshold)
    got = {(r.left_id, r.right_id): r.dice for r in found.collect()}
    assert set(got) <= set(want) and all(abs(got[p] - want[p]) < 1e-12 for p in got)
    assert len(got) >= 0.95 * len(want)
    best = {(r.left_id, r.right_id) for r in L.mutual_best(found).collect()}
    true = {(i, i + 10_000) for i, _, _ in left}
    assert len(best & true) >= 0.9 * len(true) and len(best & true) >= 0.9 * len(best)


def test_copies_are_one_class_and_empty_records_none(spark):
    key = keyed.key_table(spark, KEY)
    left = [(i, "Anna Weber", "Kassel") for i in range(3_000)] + [(9_000, "Paul Koch", "Bremen"), (9_001, None, None), (9_002, "", " ")]
    right = [(i, "anna weber", "kassel") for i in range(20, 2_020)] + [(7, "Paul Kohc", "Bremen"), (8, None, "")]
    code = [L.encode_records(spark.createDataFrame(r, SCHEMA), FIELDS, key) for r in (left, right)]
    got = {(r.left_id, r.right_id): (r.n_left, r.n_right, r.dice) for r in L.link_encodings(*code, "id", "id", 0.7).collect()}
    assert got.pop((0, 20)) == (3_000, 2_000, 1.0)
    assert set(got) == {(9_000, 7)} and 0.7 <= got[9_000, 7][2] < 1


def test_ties_of_the_best_go_to_the_smaller_id(spark):
    links = spark.createDataFrame([(1, 5, 1, 1, 0.9), (1, 4, 1, 1, 0.9), (2, 5, 1, 1, 0.8), (3, 6, 1, 1, 0.7)],
                                  "left_id long, right_id long, n_left long, n_right long, dice double")
    assert {(r.left_id, r.right_id) for r in L.mutual_best(links).collect()} == {(1, 4), (3, 6)}


def test_empty_tables_and_parameters(spark):
    key = keyed.key_table(spark, KEY)
    empty = L.encode_records(spark.createDataFrame([], SCHEMA), FIELDS, key)
    one = L.encode_records(spark.createDataFrame([(1, "Anna", "Kassel")], SCHEMA), FIELDS, key)
    assert L.link_encodings(empty, one, "id", "id", 0.8).count() == 0
    assert L.link_encodings(empty, empty, "id", "id", 0.8).count() == 0
    assert [(r.left_id, r.dice) for r in L.link_encodings(one, one, "id", "id", 0.8).collect()] == [(1, 1.0)]
    with pytest.raises(ValueError):
        L.encode_records(one, {"code": 9}, key)
    with pytest.raises(ValueError):
        L.link_encodings(one, one, "id", "id", 0)


def test_the_key_is_in_no_plan(spark):
    df = L.encode_records(spark.createDataFrame(people(5, 1), SCHEMA), FIELDS, keyed.key_table(spark, KEY))
    plan = df._jdf.queryExecution().toString()
    assert KEY.decode() not in plan and KEY.hex() not in plan.lower()


def test_blocks_are_never_broadcast(spark, monkeypatch):
    """A row per class and band is many times the classes: a broadcast of them would fill the driver."""
    plans, stored = [], L._stored

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    key = keyed.key_table(spark, KEY)
    rows = people(300, 7)
    code = [L.encode_records(spark.createDataFrame(r, SCHEMA), FIELDS, key) for r in (rows, typed(rows, 8))]
    monkeypatch.setattr(L, "_stored", seen)
    links = L.link_encodings(*code, "id", "id", 0.8)
    assert links.count() >= 270
    assert any("Generate posexplode" in p for p in plans)
    assert not any("Broadcast" in p for p in plans)


def test_folded_encodings_differ_in_no_more_bits(spark):
    key = keyed.key_table(spark, KEY)
    rows = L._classes(L.encode_records(spark.createDataFrame(people(60, 9), SCHEMA), FIELDS, key), "id")
    bands = [[5, 70, 1023], [0, 63, 64]]
    code = {r.id: of_code(r.code) for r in rows.collect()}
    got = {r.id: r for r in L.banded(rows, bands).collect()}
    assert set(got) == set(code)
    for i, bits in code.items():
        assert list(got[i]["keys"]) == [sum((p in bits) << (2 - k) for k, p in enumerate(band)) for band in bands]
        assert got[i]["size"] == len(bits)
    fold = {i: of_code([r[f"f{w}"] for w in range(L.FOLD)]) for i, r in got.items()}
    assert all(len(fold[i] ^ fold[j]) <= len(code[i] ^ code[j]) for i in code for j in code)


def test_blocks_are_met_in_rounds_of_few_bands(spark, monkeypatch):
    """Rows of all bands at once, a row per class and band, fill the disk: jobs hold a fixed number of bands."""
    made, banded = [], L.banded

    def seen(side, bands, *run):
        made.append(len(bands))
        return banded(side, bands, *run)

    key = keyed.key_table(spark, KEY)
    rows = people(300, 7)
    code = [L.encode_records(spark.createDataFrame(r, SCHEMA), FIELDS, key) for r in (rows, typed(rows, 8))]
    monkeypatch.setattr(L, "banded", seen)
    whole = sorted(map(tuple, L.link_encodings(*code, "id", "id", 0.8).collect()))
    bands = sum(made) // 2
    assert len(whole) >= 270
    made.clear()
    monkeypatch.setattr(L, "ROUND_ROWS", 0, raising=False)
    monkeypatch.setattr(L, "ROUND_BANDS", 3, raising=False)
    monkeypatch.setattr(L, "ROUND_PAIRS", 100, raising=False)
    assert sorted(map(tuple, L.link_encodings(*code, "id", "id", 0.8).collect())) == whole
    assert bands > 3 and sum(made) == 2 * bands and max(made) <= 3


def test_bands_reach_the_threshold_and_tell_strangers_apart(spark):
    """Few and narrow blocks: looks go over all bits that differ between records, first set places tell more than bits."""
    key = keyed.key_table(spark, KEY)
    rows = L._classes(L.encode_records(spark.createDataFrame(people(1_500, 5), SCHEMA), FIELDS, key), "id")
    n = rows.count()
    bands, run = L._bands(rows, rows, n, n, 0.8, 0.98, 1, 256)
    codes = {r.id: of_code(r.code) for r in rows.collect()}
    keys = {r.id: r["keys"] for r in L.banded(rows, bands, run).collect()}
    for i, bits in list(codes.items())[:50]:  # against plain Python
        for key_of, band in zip(keys[i], bands):
            plain = 0
            for at in range(0, len(band), run):
                look = band[at:at + run]
                plain = plain * (run + 1) + max((run - k for k, p in enumerate(look) if p in bits), default=0)
            assert plain == key_of
    serving = {p for band in bands for p in band}
    telling = set.union(*codes.values()) - set.intersection(*codes.values())
    assert serving <= telling and len(bands) <= 60
    ids, r = list(codes), random.Random(4)
    met = near = 0
    for i in ids[:300]:  # the record with a fifth of its bits gone and as many others set: a pair at 0.8
        gone = set(r.sample(sorted(codes[i] & telling), round(0.2 * len(codes[i]))))
        more = set(r.sample(sorted(telling - codes[i]), round(0.2 * len(codes[i]))))
        typo = codes[i] - gone | more
        near += 1
        met += any(key_of == sum((run + 1) ** (len(band) // run - 1 - at // run) * max(
            (run - k for k, p in enumerate(band[at:at + run]) if p in typo), default=0) for at in range(0, len(band), run))
            for key_of, band in zip(keys[i], bands))
    assert met >= 0.95 * near
    strangers = [(r.choice(ids), r.choice(ids)) for _ in range(4_000)]
    assert sum(x == y for i, j in strangers if i != j for x, y in zip(keys[i], keys[j])) <= 0.05 * len(bands) * len(strangers)
