import hashlib
import random
import re

import pytest

from laketide.llm import pii as P

RX = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
      "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for o, (kind, rx) in enumerate(RX.items()):
        for m in re.finditer(rx, text or ""):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(x) > 255 for x in s.split("."))) or \
                    (kind == "card" and not (14 <= len(d) <= 19 and luhn(d))) or \
                    (kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), o, m.end(), kind))
    return sorted(out)


def expected(i, text):
    b = base(text)
    return (i, *(sum(x[3] == k for x in b) for k in RX),
            hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in b).encode()).hexdigest())


ODD = ["a@b.c_d@e.f", "a@b@c.d", "x@y", "@a.b", "..a@b.c..d", "é🙂 ü@x a.b+c@d-e.f.g, 1.2.3.4.5.6.7.8", "256.1.1.1 0001.002.3.255",
       "4111 1111 1111 1111 4111-1111-1111-1111", "41111111111111112222", "+1 (212) 555-0199 +12345 +1234567890123456",
       "+1()()()", "+1 2+3 4444444444", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "9" * 5000, "1." * 4000 + "1", "🙂" * 50 + "a@b.cc",
       "5555555555554444,4012888888881881", "10.0.0.1@x.y", "x" * 40_000 + "@" + "b.c" * 9000, "+" + "1 " * 30_000]


def test_base_spans_match_the_plain_patterns(spark):
    rng = random.Random(1)
    rows = list(enumerate(ODD)) + [(100 + i, "".join(rng.choice("ab1234567890.@+-() _\n🙂") for _ in range(300))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r)[:6] for r in P.find_pii(df).collect())
    assert got == sorted(expected(*r) for r in rows)


def test_nasty_rows(nasty, nasty_rows):
    got = sorted((tuple(r)[:6] for r in P.find_pii(nasty).collect()), key=str)
    assert got == sorted((expected(*r[:2]) for r in nasty_rows), key=str)


def test_bootstrap_finds_unseen_identifiers_in_trusted_contexts(spark):
    """"card no" stands before cards; a card with a typing error there is found, the same digits elsewhere are not."""
    rng = random.Random(4)

    def card(ok):
        while True:
            d = "".join(rng.choice("0123456789") for _ in range(16))
            if luhn(d) == ok:
                return d
    rows = [(i, f"some text then card no {card(True)} and more") for i in range(60)]
    rows += [(100 + i, f"the {card(i % 2 == 0)} thing") for i in range(60)]
    wrong = card(False)
    rows += [(900, f"pay with card no {wrong} now"), (901, f"serial {card(False)} is a number")]
    got = {r.doc_id: r for r in P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[900].spans == "card:17:33" and got[900].n_card == 0 and got[900].n_found == 1
    assert got[901].spans == "" and sum(r.n_found for r in got.values()) == 1


def test_identifiers_with_spaces_and_after_other_numbers_are_found(spark):
    """Runs of digit groups are candidates; their left words reach across earlier tokens, as those of base spans do."""
    rng = random.Random(6)
    rows = []
    for i in range(40):
        d = next(x for x in iter(lambda: "".join(rng.choice("0123456789") for _ in range(16)), None) if luhn(x))
        spaced = " ".join(d[j:j + 4] for j in range(0, 16, 4))
        rows += [(i, f"pay by card no {spaced} today"), (100 + i, f"in line {i % 9}: {d} stands"),
                 (200 + i, f"my phone +1 (212) 555-01{i + 10} rings")]
    rows += [(300 + i, f"a 4000 0000 0000 {1000 + i} b and c 212 555 0{100 + i} d") for i in range(150)]
    rows += [(900, "pay by card no 4111 1111 1111 1112 now"), (901, "in line 2: 4111111111111112 it is"),
             (902, "my phone (212) 555-0199 rings"), (903, "some 4111 1111 1111 1113 things")]
    got = {r.doc_id: r.spans for r in P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in (900, 901, 902, 903)] == ["card:15:34", "card:11:27", "phone:9:23", ""]


def test_no_python_on_the_main_path(mixed):
    plan = P.find_pii(mixed)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty(nothing):
    assert P.find_pii(nothing).count() == 0


@pytest.mark.parametrize("digits,ok", [("79927398713", True), ("79927398710", False), ("4111111111111111", True), ("0", True)])
def test_luhn(spark, digits, ok):
    assert spark.createDataFrame([(digits,)], "d string").select(P.luhn(P.F.col("d"))).first()[0] is ok
