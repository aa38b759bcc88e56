import hashlib
import re

import numpy as np
import pytest

from laketide.llm import exact_dedup as E


def expected(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    order = lambda i: (i is None, i)
    keep, size = {}, {}
    for i, t in norm:
        size[t] = size.get(t, 0) + 1
        keep[t] = i if t not in keep else min(keep[t], i, key=order)
    out, stays = [], set()
    for i, t in norm:  # one row of each text stays, also where several repeat the keeping id
        out.append((i, keep[t], size[t], i == keep[t] and t not in stays, hashlib.sha256(t.encode()).hexdigest()))
        if i == keep[t]:
            stays.add(t)
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [60, 4])  # four bits: nearly every fingerprint collides, bytes still decide
def test_matches_brute_force(mixed, bits):
    assert got(E.exact_dedup(mixed, bits=bits)) == expected([(r.doc_id, r.text) for r in mixed.collect()])


def test_nasty_rows(nasty, nasty_rows):
    assert got(E.exact_dedup(nasty)) == expected([r[:2] for r in nasty_rows])


def test_first_copies_keep_one_row_of_each_text(nasty, nasty_rows):
    kept = E.first_copies(nasty)
    assert kept.columns == nasty.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in nasty_rows})


def test_empty(nothing):
    assert E.exact_dedup(nothing).count() == 0 and E.first_copies(nothing).count() == 0


@pytest.mark.parametrize("n,space", [(1, 1 << 20), (1000, 1 << 50), (500, 512), (0, 10)])
def test_rice_round_trip(n, space):
    v = np.sort(np.random.default_rng(n).integers(0, space, n).astype(np.uint64))
    k, code = E.rice_encode(v, space)
    assert (E.rice_decode(code, n, k) == v).all()
    if n == 1000:
        assert len(code) < 8 * n * 0.8  # shorter than plain 64-bit numbers
