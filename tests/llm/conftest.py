"""Small tables with everything that operators must bear."""

import random
import re

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, owner string, row string, "
          "score string, part string, n string, text_key string, id string, label string, queue string")


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="session")
def nasty_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows and ids."""
    rng = random.Random(5)
    long = " ".join(words(rng, 30_000, 5000))
    base = words(rng, 120)
    near = base[:]
    near[60] = "changed"
    passage = words(rng, 60)
    texts = [
        None, "", "   \t\n ", "one", "one two", "ÄÖ ü ñ é 中文 текст 🙂", long, " ".join(base), " ".join(base), " ".join(near),
        "  ".join(base), " ".join(words(rng, 30) + passage + words(rng, 30)), " ".join(words(rng, 40) + passage),
        "Mail a.b@c.example.com, +1 (212) 555-0199; 10.0.0.256 10.0.0.255 4111 1111 1111 1111 4111111111111112.",
        "x" * 60_000 + "@" + "y" * 10 + ".zz" * 4000, "Released under the MIT License. Apache License, Version 2.0 CC BY-NC",
        "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "<|endoftext|> a  b ",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s0", None, "s1"][i % 3], None) for i, t in enumerate(texts)]
    rows += [(None, " ".join(base), None, None, None), (None, None, None, None, None), (7, " ".join(base), "en", "s0", 1),
             (3, "other text of a repeated id", "en", "s0", 1)]
    return [(*r, *([None] * 10)) for r in rows]


@pytest.fixture(scope="session")
def nasty(spark, nasty_rows):
    return spark.createDataFrame(nasty_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def mixed(spark):
    """Documents with copies, near copies, shared lines and passages; one source and one group are hot."""
    rng = random.Random(11)
    passages = [words(rng, 55) for _ in range(3)]
    group = words(rng, 150)
    rows = []
    for i in range(400):
        kind = rng.randrange(8)
        if kind < 2:        # a third of the rows: near copies of one text
            w = group[:]
            for _ in range(rng.randrange(6)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(50)}"
        elif kind == 2:
            w = rows[rng.randrange(len(rows))][1].split() if rows else words(rng, 9)
        elif kind == 3:
            w = words(rng, rng.randrange(40)) + rng.choice(passages) + words(rng, rng.randrange(40))
        else:
            w = words(rng, rng.choice([0, 1, 3, 6, 25, 60, 200]), 3000)
        rows.append((i, " ".join(w), "en", "hot" if i % 3 else f"s{i % 7}", 0))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def ws_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


@pytest.fixture(scope="session")
def brute():
    return {"ws": ws_words, "lower": ascii_lower, "alnum": alnum_words}
