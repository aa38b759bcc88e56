import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from laketide.llm import jaccard_join as J
from laketide.llm.components import components


def expected(rows, words, lower, n, percent):
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets[i] = sets.get(i, set()) | ({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else
                                        {tuple(w)} if w else set())
    return sets, linked(sets, percent)


def linked(sets, percent):
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("n,percent", [(5, 80), (3, 60)])
def test_matches_brute_force(mixed, brute, n, percent):
    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    sets, comp = expected(rows, brute["ws"], brute["lower"], n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(mixed, n=n, percent=percent).collect()}
    assert got == {i: (len(sets[i]), comp[i]) for i in sets}


def test_chains_at_the_threshold(spark, brute):
    """Neighbours are linked at exactly 0.8 or miss it by one gram; far ends are not similar."""
    rows = [(i, " ".join(f"c{j}" for j in range(i * 4, i * 4 + 40))) for i in range(40)]
    rows += [(100 + i, " ".join(f"d{j}" for j in range(i * 5, i * 5 + 40))) for i in range(40)]
    sets, comp = expected(rows, brute["ws"], brute["lower"], 5, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in J.jaccard_join(df).collect()} == comp
    assert len(set(comp.values())) < 80


def test_frequent_lines_do_not_hide_links(spark, brute):
    """Short documents made mostly of one common line, some similar, some just not."""
    line = [f"line{j}" for j in range(14)]
    rows = [(i, " ".join(line + [f"x{i % 60}"] * (i % 3 + 1) + ([f"y{i}"] if i % 2 else []))) for i in range(200)]
    _, comp = expected(rows, brute["ws"], brute["lower"], 5, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in J.jaccard_join(df).collect()} == comp


def test_nasty_rows(nasty, nasty_rows, brute):
    got = J.jaccard_join(nasty).collect()
    assert len(got) == len(nasty_rows)
    alone = [r[0] for r in nasty_rows if not brute["ws"](r[1]) and r[0] is not None]
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in got if r.doc_id in alone and r.n_shingles == 0)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.component_id)
    assert by[8] == by[9] == by[10] == {7} and by[11] == {11}
    kept = J.representatives(nasty)
    assert kept.columns == nasty.columns and {r.doc_id for r in kept.collect()} & {7, 8, 9, 10} == {7}


def test_null_and_repeated_ids_are_rows_of_their_own(spark):
    """Unrelated texts without an id, one of them a near copy of document 5; a repeated id with a link of its larger text."""
    text = lambda name, n=60: " ".join(f"{name}{j}" for j in range(n))
    rows = [(5, text("a")), (None, text("a") + " end"), (None, text("b")), (None, text("c")), (None, text("c") + " end"),
            (8, text("d")), (8, text("z")), (9, text("z") + " end"), (3, text("z", 61)), (None, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_join(df).collect()), key=str)
    assert got == sorted([(5, 56, 5), (None, 57, 5), (None, 56, None), (None, 56, None), (None, 57, None), (8, 56, 8), (8, 56, 3),
                          (9, 57, 3), (3, 57, 3), (None, 0, None), (None, 0, None)], key=str)
    kept = [(r.doc_id, r.text) for r in J.representatives(df).collect()]
    assert len([t for i, t in kept if i is None and (t or "").startswith("c")]) == 1
    rest = [(i, t) for i, t in kept if not (t or "").startswith("c")]
    assert sorted(rest, key=str) == sorted([rows[0], rows[2], rows[5], rows[8], rows[9], rows[10]], key=str)


def test_empty(nothing):
    assert J.jaccard_join(nothing).count() == 0


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def test_stars_take_no_further_step(spark, monkeypatch):
    """Links that are stars already are written once; every step more is some ten exchanges for the driver to plan."""
    from laketide.llm import components as K
    names, written = [], K.written
    monkeypatch.setattr(K, "written", lambda df, name: names.append(name) or written(df, name))
    stars = spark.createDataFrame([(i, i // 10 * 10) for i in range(60)], "a long, b long")
    assert {r.doc_id: r.component_id for r in components(stars).collect()} == {i: i // 10 * 10 for i in range(60)}
    assert len(names) == 1
    names.clear()
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 52), (52, 51), (51, 50), (60, 60)], "a long, b long")
    want = {i: 0 for i in range(41)} | {50: 50, 51: 50, 52: 50}
    assert {r.doc_id: r.component_id for r in components(chain).collect()} == want
    assert len(names) > 2
    assert components(chain.where("a < 0")).count() == 0


def test_pairs_out_of_reach_are_skipped_in_the_lists(spark, brute, monkeypatch):
    """Sixty versions of one text, each with one of two wordings at 24 places: most pairs share half of their
    rare grams and are not similar."""
    rng = random.Random(2)
    rows = [(i, " ".join(f"v{j}" if j % 12 else f"v{j}-{rng.randrange(2)}" for j in range(288))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, comp = expected(rows, brute["ws"], brute["lower"], 5, 80)
    made, cross = [], J.cross_pairs
    monkeypatch.setattr(J, "cross_pairs", lambda *a: made.append(cross(*a).count()) or cross(*a))
    assert {r.doc_id: r.component_id for r in J.jaccard_join(df).collect()} == comp
    assert 1 < len(set(comp.values())) < 60 and made[0] < 60


def test_prints_never_hide_a_link(spark):
    """Prints of all lengths, folded to the shorter one, differ in no more bits than the sets in grams."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(3)
    rows = []
    for i, n in enumerate((1, 90, 100, 130, 240, 260, 1000, 1100, 7000, 9000)):
        words = [f"w{x}" for x in rng.integers(0, 10 ** 6, n)]
        swapped = [w if rng.random() > 0.02 else w + "x" for w in words]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(swapped + ["more"] * (n // 12)))]
    made = J.prints(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    doc, h = J.gram_sets(pa.array([t for _, t in rows]), 5)
    grams = [set(h[doc == i].tolist()) for i in range(len(rows))]
    seen = J._Prints(pa.table({"doc_id": [r[0] for r in made], "print": pa.array([bytes(r[1]) for r in made], pa.binary())}))
    pairs = [(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b]
    a, b = (np.array(x) for x in zip(*pairs))
    sizes = np.array([len(g) for g in grams])
    ok = seen.alike(a, b, sizes[a], sizes[b], 80)
    linked = [100 * len(grams[x] & grams[y]) >= 80 * len(grams[x] | grams[y]) for x, y in pairs]
    linked, near = np.array(linked), 100 * np.minimum(sizes[a], sizes[b]) >= 80 * np.maximum(sizes[a], sizes[b])
    assert linked.any() and ok[linked].all() and (ok & near & ~linked).sum() < (near & ~linked).sum() / 3


def exchanges(df):
    """Shuffles of the whole plan that Spark really makes."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum(line.strip(" :+-*").startswith("Exchange hashpartitioning") for line in plan.split("\n"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_shuffles_behind_a_written_table_go(spark):
    """Their files went when the driver collected its garbage, so those of many steps lay on the disk at once."""
    import time

    from laketide.llm import common
    there, before = shuffle_files(spark), spark.conf.get(common.SHUFFLES_GO, "false")
    kept = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert kept.collect() and shuffle_files(spark) - there  # the caller's own stay
    there = shuffle_files(spark)
    made = common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffles")
    for _ in range(20):  # they are removed in the background
        if not shuffle_files(spark) - there:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - there and made.count() == 7
    assert spark.conf.get(common.SHUFFLES_GO, "false") == before and len(kept.collect()) == 7


def test_levels_take_one_job_whatever_the_owners(spark):
    """One job an owner before: its events and plans are the driver's memory and disk."""
    rows = spark.createDataFrame([(i, f"a b c d e f{i % 5} g h i j") for i in range(40)], "doc_id long, text string")
    context, key = spark.sparkContext, "spark.sql.adaptive.coalescePartitions.enabled"
    context.setJobGroup("levels", "levels")
    spark.conf.set(key, "false")
    try:
        levels = J.frequency_levels(rows, 5)
    finally:
        spark.conf.set(key, "true")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("levels")) <= 3 < J.owners_of(spark)
    assert [int(x.any()) for x in levels] == [1, 1, 0]


def test_steps_take_few_shuffles(spark):
    """Every shuffle is a stage of all partitions, to plan for the driver and to keep on disk."""
    from laketide.llm import components as K
    texts = spark.createDataFrame([(i, f"a b c d e f g h i j k{i // 30} l m n o p q r s") for i in range(60)], "doc_id long, text string")
    pairs = spark.createDataFrame([(i, 0, 15, 15, 1) for i in range(1, 60)], J.PAIRS)
    found = J.compare(J.written(pairs, "pairs"), J.written(texts.mapInArrow(J.shrink, "doc_id long, text binary"), "texts"), 5)
    assert {(r.a, r.b, r.size_a, r.size_b, r.overlap) for r in found.collect()} == {
        (i, 0, 15, 15, 15 if i < 30 else 10) for i in range(1, 60)}
    assert exchanges(found) == 3  # the second join's texts are the first one's
    stars = K._stars(K.written(spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long"), "links"))
    assert len(stars.collect()) >= 40
    assert exchanges(stars) == 5
