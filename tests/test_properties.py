"""Properties of SURVEY §5 checked on generated data (hypothesis)."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from laketide.functions import keyed
from laketide.functions.text_rules import DEFAULT_RULES
from laketide.operators import model, privacy, workspace
from laketide.sources import storage
from conftest import SF_SMALL, rows

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

quasi_rows = st.lists(st.tuples(st.sampled_from(["n", "s", "e", None]), st.sampled_from(["a", "b"])),
                      min_size=1, max_size=60)


@SETTINGS
@given(data=quasi_rows, k=st.integers(min_value=2, max_value=6))
def test_no_group_below_k(spark, data, k):
    df = spark.createDataFrame([(i, r, b) for i, (r, b) in enumerate(data)], "id long, r string, b string")
    out = privacy.suppress_small_cells(df, ["r", "b"], k).collect()
    sizes = {}
    for row in out:
        sizes[(row["r"], row["b"])] = sizes.get((row["r"], row["b"]), 0) + 1
    assert all(n >= k for n in sizes.values())
    # nothing of a large enough group is lost
    full = {}
    for r, b in data:
        full[(r, b)] = full.get((r, b), 0) + 1
    assert sizes == {g: n for g, n in full.items() if n >= k}


changes = st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["I", "U", "D"]), st.integers(0, 3),
                             st.text("xyz", max_size=2)), max_size=25)


@SETTINGS
@given(delta=changes)
def test_upsert_idempotent(spark, delta):
    base = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k long, v string")
    d = spark.createDataFrame([(k, v, op, seq) for k, op, seq, v in delta],
                              "k long, v string, op string, seq int")
    once = storage.upsert_storage(base, d, ["k"], "op", "seq")
    twice = storage.upsert_storage(once, d, ["k"], "op", "seq")
    assert rows(once) == rows(twice)
    keys = [r[0] for r in once.collect()]
    assert len(keys) == len(set(keys))


events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 400), st.sampled_from("AB")), max_size=80)


@SETTINGS
@given(data=events)
def test_history_sliced_equals_whole(spark, data):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, t0 + dt.timedelta(days=d), s) for k, d, s in data],
                               "key long, ts timestamp_ntz, state string")
    a = rows(model.history_scd2(df, "key", "ts", ["state"], slice_unit="month"))
    b = rows(model.history_scd2(df, "key", "ts", ["state"], slice_unit=None))
    assert a == b
    for key in {k for k, _, _ in data}:
        runs = [r for r in a if r[0] == key]
        assert sum(1 for r in runs if r[4]) == 1  # exactly one current version


def test_workspace_extract_of_texts_leaks_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    key = keyed.key_table(spark, b"main key for tests")
    p = workspace.Policy("documents", ["doc_id", "text", "lang"], mask=["text"],
                         tokenise={"doc_id": "document"})
    out = workspace.workspace_extract(spark, p, "ws_texts", key, source=docs).collect()
    assert len(out) == docs.count()
    for rule in DEFAULT_RULES:
        rx = re.compile(rule.pattern)
        assert not any(rx.search(r["text"]) for r in out), rule.kind
    ids = {str(r["doc_id"]) for r in docs.collect()}
    assert not any(r["doc_id"] in ids for r in out)
