"""S3, S5, S6 and S4 on versioned tables: atomic loads, repeats, breaks, marks, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laketide.operators import history
from laketide.operators.model import history_scd2
from laketide.session import scratch_path
from laketide.sources import versions as V
from laketide.streaming.land import late_rows, stream_store
from conftest import rows

SCHEMA = "id long, seq string, y int, v string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def promote(spark, path, load_id, data):
    return V.promote_version(frame(spark, data), ["id"], ["seq"], path, load_id, ["y"], conform={"seq": "int"})


class Broken(RuntimeError):
    pass


def broken(*_):
    raise Broken


def test_a_broken_load_leaves_the_version_before(spark, monkeypatch):
    path = scratch_path(spark, "v")
    first = rows(promote(spark, path, "a", [(1, "1", 2020, "a"), (2, "1", 2021, "b"), (3, "x", 2020, "bad")]))
    assert first == [(1, 1, "a", 2020), (2, 1, "b", 2021)]
    second = [(1, "9", 2021, "moved"), (4, "1", 2022, "new"), (5, "y", 2022, "bad")]
    with monkeypatch.context() as m:
        m.setattr(V, "_publish", broken)  # everything but the commit is written
        with pytest.raises(Broken):
            promote(spark, path, "b", second)
    assert rows(V.read(spark, path)) == first
    assert V.side(spark, path, "quarantine").count() == 1
    # The same load again, then a repeat of it.
    for _ in range(2):
        assert rows(promote(spark, path, "b", second)) == [(1, 9, "moved", 2021), (2, 1, "b", 2021), (4, 1, "new", 2022)]
        assert sorted(r.v for r in V.side(spark, path, "quarantine").collect()) == ["bad", "bad"]
    assert V.version(spark, path).number == 1
    assert rows(V.read(spark, path, 0)) == first  # an older version stays readable
    with pytest.raises(ValueError):
        V.read(spark, path, 7)


def test_only_touched_partitions_are_rewritten_and_moved_keys_leave(spark):
    path = scratch_path(spark, "v")
    promote(spark, path, "a", [(i, "1", 2020 + i % 3, "a") for i in range(30)])
    before = {r.y: r.folder for r in V.manifest(spark, V.version(spark, path)).collect()}
    out = promote(spark, path, "b", [(0, "2", 2021, "moved")])  # id 0 was in 2020
    after = {r.y: r.folder for r in V.manifest(spark, V.version(spark, path)).collect()}
    assert after[2022] == before[2022] and after[2020] != before[2020] and after[2021] != before[2021]
    assert [r for r in rows(out) if r[0] == 0] == [(0, 2, "moved", 2021)] and out.count() == 30
    # The last row of a partition moves: the partition is gone.
    promote(spark, path, "c", [(i, "3", 2021, "all") for i in range(30)])
    assert {r.y for r in V.manifest(spark, V.version(spark, path)).collect()} == {2021}
    # Pruning reaches the files.
    plan = V.read(spark, path).where("y = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(y" in plan.split("PartitionFilters")[1].split("]")[0]


def test_folders_out_of_the_key_range_are_not_searched(spark, monkeypatch):
    path = scratch_path(spark, "v")
    promote(spark, path, "a", [(i, "1", 2000 + i // 10, "a") for i in range(50)])
    opened = []
    real = V._open
    monkeypatch.setattr(V, "_open", lambda s, v, f: opened.append(len(f)) or real(s, v, f))
    promote(spark, path, "b", [(13, "2", 2001, "b"), (15, "2", 2001, "b")])
    assert opened[:2] == [1, 1]  # one folder's keys searched, one folder read


def test_two_loads_cannot_commit_one_version(spark, monkeypatch):
    path = scratch_path(spark, "v")
    promote(spark, path, "a", [(1, "1", 2020, "a")])
    stale = V.version(spark, path)
    promote(spark, path, "b", [(2, "1", 2020, "b")])
    monkeypatch.setattr(V, "version", lambda *a: stale)
    with pytest.raises(V.CommitConflict):
        promote(spark, path, "c", [(3, "1", 2020, "c")])
    monkeypatch.undo()
    assert [r[0] for r in rows(V.read(spark, path))] == [1, 2]


def test_nulls_repeats_empty_batches_and_odd_partition_names(spark):
    path = scratch_path(spark, "v")
    schema = "id long, seq int, place string, v map<string,int>"
    put = lambda name, data: V.promote_version(frame(spark, data, schema), ["id"], ["seq"], path, name, ["place"])
    assert put("none", []).count() == 0
    odd = ["a b", "50% + x", "c=d/e", None, "ä:?*", ""]
    data = [(i, 1, p, {"k": i}) for i, p in enumerate(odd)] + [(None, 1, "n", None), (None, 2, "n", None)]
    out = put("one", data + data)
    want = {(i, p or None) for i, p in enumerate(odd)} | {(None, "n")}
    assert {(r.id, r.place) for r in out.collect()} == want and out.count() == len(want)
    out = put("two", [(None, 3, None, {"x": 1}), (1, 5, "c=d/e", None)])
    assert {(r.id, r.seq, r.place) for r in out.where("id is null or id = 1").collect()} == {(None, 3, None), (1, 5, "c=d/e")}
    assert put("three", []).count() == len(want)
    with pytest.raises(ValueError):
        V.promote_version(frame(spark, [(1, 1)], "id long, other int"), ["id"], ["other"], path, "four", ["other"])


def test_unpartitioned_table(spark):
    path = scratch_path(spark, "v")
    for name, data in (("a", [(1, "1", 1, "x"), (2, "1", 1, "x")]), ("b", [(2, "2", 1, "y"), (3, "1", 1, "z")])):
        out = V.promote_version(frame(spark, data), ["id"], ["seq"], path, name)
    assert [(r[0], r[3]) for r in rows(out)] == [(1, "x"), (2, "y"), (3, "z")]


def test_upsert_keeps_partitions_and_rewrites_only_touched_ones(spark):
    path = scratch_path(spark, "v")
    stored = "id long, y int, v string"
    V.promote_version(frame(spark, [(i, 2020 + i % 3, "old") for i in range(12)] + [(None, 2020, "n")], stored), ["id"], [], path, "a", ["y"])
    before = {r.y: r.folder for r in V.manifest(spark, V.version(spark, path)).collect()}
    delta = frame(spark, [(0, 2020, "first", "U", 1), (0, 2021, "second", "U", 2), (3, 2020, "x", "D", 1), (77, 2021, "x", "D", 1),
                          (None, 2020, "m", None, 1), (4, 2021, "x", "D", 1), (4, 2021, "back", "I", 2)],
                  stored + ", op string, seq int")
    for _ in range(2):  # the second time is a no-op
        out = V.upsert_version(delta, ["id"], path, "b", "op", "seq", ["y"])
        got = {r.id: (r.y, r.v) for r in out.collect()}
        assert got[0] == (2021, "second") and 3 not in got and 77 not in got and got[None] == (2020, "m") and got[4] == (2021, "back")
        assert out.count() == len(got) == 12 and out.columns == ["id", "v", "y"]
    after = {r.y: r.folder for r in V.manifest(spark, V.version(spark, path)).collect()}
    assert after[2022] == before[2022] and "/y=2021" in after[2021]


def test_increments_with_stored_marks_hold_each_row_once(spark, monkeypatch):
    path = scratch_path(spark, "v")
    schema = "id long, ts timestamp_ntz, v string"
    D = lambda d, us=0: dt.datetime(2024, 1, d, 0, 0, 0, us)
    at = {1: [(1, D(1), "a"), (2, D(2, 123456), "b"), (9, None, "n")]}
    at[2] = at[1] + [(3, D(2, 123456), "tie"), (4, D(3), "c")]
    at[3] = at[2] + [(5, D(3), "tie"), (1, D(5), "a again")]
    run = lambda n, load: V.load_increment(frame(spark, at[n], schema), "s", "ts", ["id"], path, load)
    run(1, "l1")
    with monkeypatch.context() as m:
        m.setattr(V, "_publish", broken)
        with pytest.raises(Broken):
            run(2, "l2")
    assert V.version(spark, path).marks["s:mark"] == "2024-01-02 00:00:00.123456"
    seen = []
    real = V.promote_version
    monkeypatch.setattr(V, "promote_version", lambda df, *a, **k: seen.append(rows(df)) or real(df, *a, **k))
    run(2, "l2")
    run(2, "l2")  # repeated: nothing is read
    out = run(3, "l3")
    run(3, "l4")  # nothing new
    assert [[r[0] for r in s] for s in seen] == [[3, 4, 9], [1, 5, 9], [9]]
    assert [(r[0], r[2]) for r in rows(out)] == [(1, "a again"), (2, "b"), (3, "tie"), (4, "c"), (5, "tie"), (9, "n")]
    # Another source into the same table has a mark of its own.
    V.load_increment(frame(spark, [(50, D(1), "other")], schema), "t", "ts", ["id"], path, "t1")
    marks = V.version(spark, path).marks
    assert marks["t:mark"].startswith("2024-01-01") and marks["s:mark"].startswith("2024-01-05")


def _runs(spark, path, batches, **more):
    for n, b in enumerate(batches):
        out = history.merge_history(b, ["k"], "ts", ["s"], path, f"b{n}", **more)
    return out


def test_history_over_batches_equals_history_of_all(spark):
    schema = "k long, ts timestamp_ntz, s string, x int"
    D = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    import random
    rng = random.Random(3)
    # A third of the rows belongs to one key; null keys, times and states; ties and repeats.
    data = [(rng.choice([1, 1, 2, 3, None]), None if rng.random() < .1 else D(rng.randrange(2000)), rng.choice(["a", "a", "b", None]), i % 3)
            for i in range(900)]
    data += data[:50]
    rng.shuffle(data)
    every = rows(history_scd2(frame(spark, data, schema), ["k"], "ts", ["s"]))
    for n, order in ((3, data), (2, sorted(data, key=lambda r: (r[1] is None, r[1] or D(0)), reverse=True))):  # shuffled; newest first
        size = -(-len(order) // n)
        batches = [frame(spark, order[i:i + size], schema) for i in range(0, len(order), size)]
        path = scratch_path(spark, "h")
        assert rows(_runs(spark, path, batches, buckets=3)) == every
        assert rows(_runs(spark, path, batches[:1], buckets=3)) == every  # a repeated load changes nothing
    tied = rows(history_scd2(frame(spark, data, schema), ["k"], "ts", ["s"], ["x"]))
    half = len(data) // 2
    assert rows(_runs(spark, scratch_path(spark, "h"), [frame(spark, data[:half], schema), frame(spark, data[half:], schema)],
                      tie_break=["x"], slice_unit="day")) == tied


def test_late_rows_cut_and_join_versions_in_their_slice_only(spark):
    schema = "k long, ts timestamp_ntz, s string"
    D = lambda m, d: dt.datetime(2024, m, d)
    path = scratch_path(spark, "h")
    first = [(1, D(1, 1), "a"), (1, D(1, 20), "a"), (1, D(2, 1), "b"), (1, D(3, 1), "a"), (2, D(1, 5), "z")]
    short = lambda df: [(r[0], r[1], r[2].month, r[2].day, r[4]) for r in rows(df, None) if r[0] == 1]
    states = lambda df: sorted(((r[2], r[1]) for r in df.collect() if r[0] == 1))
    assert states(_runs(spark, path, [frame(spark, first, schema)], buckets=1)) == [(D(1, 1), "a"), (D(2, 1), "b"), (D(3, 1), "a")]
    before = {r.h_slice: r.folder for r in V.manifest(spark, V.version(spark, path)).collect()}
    cut = history.merge_history(frame(spark, [(1, D(1, 10), "c")], schema), ["k"], "ts", ["s"], path, "cut", buckets=1)
    assert states(cut) == [(D(1, 1), "a"), (D(1, 10), "c"), (D(1, 20), "a"), (D(2, 1), "b"), (D(3, 1), "a")]
    joined = history.merge_history(frame(spark, [(1, D(2, 20), "a")], schema), ["k"], "ts", ["s"], path, "join", buckets=1)
    assert states(joined) == [(D(1, 1), "a"), (D(1, 10), "c"), (D(1, 20), "a"), (D(2, 1), "b"), (D(2, 20), "a")]
    after = {r.h_slice: r.folder for r in V.manifest(spark, V.version(spark, path)).collect()}
    assert after["2024-03-01 00:00:00"] == before["2024-03-01 00:00:00"]
    with pytest.raises(ValueError):  # the store keeps its slices
        history.merge_history(frame(spark, first, schema), ["k"], "ts", ["s"], path, "x", slice_unit="day", buckets=1)


def test_stream_keeps_late_rows_and_repeats_nothing(spark, monkeypatch):
    root = scratch_path(spark, "stream")
    schema = "event_id long, ts timestamp_ntz, v string"
    D = lambda d: dt.datetime(2024, 1, d)
    from pyspark.sql.types import _parse_datatype_string

    def arrive(n, data):
        frame(spark, data, schema).coalesce(1).write.parquet(f"{root}/src/b{n}")

    def run():
        stream_store(spark, f"{root}/src/*", _parse_datatype_string(schema), "ts", ["event_id"], "2 days", f"{root}/table",
                     f"{root}/chk", {"day": F.date_format("ts", "yyyy-MM-dd")}).awaitTermination()

    arrive(1, [(i, D(i), "first") for i in range(1, 11)] + [(5, D(5), "first"), (70, None, "no time")])
    run()
    second = [(10, D(10), "first"), (2, D(2), "first"), (40, D(2), "late"), (40, D(2), "late"), (11, D(12), "new"), (12, D(9), "in time")]
    arrive(2, second)
    with monkeypatch.context() as m:
        real = V.commit

        def then_break(*a, **k):  # the version is committed, the stream's own checkpoint is not
            real(*a, **k)
            raise Broken

        m.setattr(V, "commit", then_break)
        with pytest.raises(Exception):
            run()
    run()  # Spark runs the same batch again
    got = {(r.event_id, r.v) for r in V.read(spark, f"{root}/table").collect()}
    assert got == {(i, "first") for i in range(1, 11)} | {(70, "no time"), (11, "new"), (12, "in time")}
    late = late_rows(spark, f"{root}/table", "ts", ["event_id"])
    assert [(r.event_id, r.v) for r in late.collect()] == [(40, "late")]  # 2 is stored, so it is not lost
    assert V.version(spark, f"{root}/table").number == 1
