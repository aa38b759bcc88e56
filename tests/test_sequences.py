"""Sequential patterns against brute force over small sessions."""

from __future__ import annotations

from datetime import datetime, timedelta
from itertools import combinations

import pytest

from laketide.operators.sequences import sequential_patterns

SCHEMA = "id long, u long, t timestamp_ntz, item string"
START = datetime(2024, 1, 1)


def expected(rows, support, max_length):
    sessions = {}
    for i, u, t, item in sorted((r for r in rows if None not in r[1:]), key=lambda r: (r[2], r[0])):
        sessions.setdefault((u, t.date()), []).append(item)
    counts = {}
    for items in sessions.values():
        held = {c for n in range(1, max_length + 1) for c in combinations(items, n)}
        for c in held:
            counts[c] = counts.get(c, 0) + 1
    return {c: n for c, n in counts.items() if n / len(sessions) >= support}


def mined(spark, rows, support, max_length=3):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sequential_patterns(df, "u", "item", "t", ["id"], support, max_length).collect()
    assert all(r.length == len(r.pattern) for r in got)
    return {tuple(r.pattern): r.sessions for r in got}


def test_matches_brute_force_with_ties_nulls_and_a_hot_user(spark):
    rows = [(i, 7 if i % 3 == 0 else i % 11, START + timedelta(hours=(i * 7) % 120 // 2), "abcd"[(i * i + i // 5) % 4])
            for i in range(160)]
    rows += [(900, None, START, "a"), (901, 1, None, "b"), (902, 2, START, None)]
    for support in (0.2, 0.6):
        want = expected(rows, support, 3)
        assert want and mined(spark, rows, support) == want


def test_order_and_repeats(spark):
    rows = [(1, 1, START, "a"), (2, 1, START, "b"), (3, 1, START + timedelta(hours=1), "a"),
            (4, 2, START, "b"), (5, 2, START + timedelta(hours=2), "a"), (6, 2, START + timedelta(days=1), "b")]
    assert mined(spark, rows, 1.0, 2) == {("b",): 3}
    assert mined(spark, rows, 0.6, 2) == {("b",): 3, ("a",): 2, ("b", "a"): 2}
    assert mined(spark, rows, 0.3, 3) == expected(rows, 0.3, 3)


def test_empty_and_wrong_parameters(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sequential_patterns(empty, "u", "item", "t", ["id"], 0.1).count() == 0
    with pytest.raises(ValueError):
        sequential_patterns(empty, "u", "item", "t", ["id"], 0)
    with pytest.raises(ValueError):
        sequential_patterns(empty, "u", "item", "t", ["id"], 0.5, 0)
