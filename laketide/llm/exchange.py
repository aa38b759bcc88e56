"""Packed rows for exchanges with owners of hash ranges.

A partition sends each owner one binary row of entries (document, position,
keys) instead of one row an entry. Numbers are laid out so that the shuffle's
own compression takes away what is small; texts cross a shuffle compressed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

from laketide.llm.common import mix


def _planes(a: np.ndarray, width: int = 4) -> bytes:
    """Numbers byte plane by byte plane: the high planes of small numbers are
    zeros, which the shuffle's compression takes away."""
    raw = a.astype(f"<u{width}").view(np.uint8).reshape(len(a), width)
    return np.ascontiguousarray(raw.T).tobytes()


def _unplanes(p: bytes, n: int, at: int, width: int = 4) -> np.ndarray:
    raw = np.frombuffer(p, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(raw.T).view(f"<u{width}").ravel().astype(np.int64)


def pack(owner: np.ndarray, owners: int, doc: np.ndarray, pos: np.ndarray, doc_ids: np.ndarray,
         keys: list[np.ndarray], about: tuple[np.ndarray, ...] = ()) -> list[tuple[int, bytes]]:
    """A payload for each owner that gets entries: ids, ``about`` (64-bit columns
    of a document), counts, steps between positions, keys. Entries must be
    sorted by ``doc`` (index into ``doc_ids``) and ``pos``."""
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(owners + 1))
    doc, pos, keys = doc[order], pos[order], [k[order] for k in keys]
    out = []
    for o in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[o], cuts[o + 1]
        d, steps = doc[a:b], np.diff(pos[a:b], prepend=0)
        heads = np.flatnonzero(np.diff(d, prepend=-1))
        steps[heads] = pos[a:b][heads]
        counts = np.diff(np.append(heads, b - a))
        ids = doc_ids[d[heads]]
        out.append((int(o), b"".join([
            np.array([len(heads), b - a], "<u4").tobytes(), _planes(np.diff(ids, prepend=ids[:1] * 0), 8),
            *(_planes(c[d[heads]], 8) for c in about), _planes(counts), _planes(steps), *(k[a:b].tobytes() for k in keys)])))
    return out


def unpack(payloads: list[bytes], kinds: list[str], about: int = 0):
    """All entries of an owner: doc_id, position, the key columns, the ``about`` columns."""
    docs, poss, keys, more = [], [], [[] for _ in kinds], [[] for _ in range(about)]
    for p in payloads:
        heads, n = (int(x) for x in np.frombuffer(p, "<u4", 2))
        at = 8
        ids = np.cumsum(_unplanes(p, heads, at, 8))
        at += 8 * heads
        each = []
        for _ in range(about):
            each.append(_unplanes(p, heads, at, 8))
            at += 8 * heads
        counts = _unplanes(p, heads, at)
        at += 4 * heads
        sums = np.cumsum(_unplanes(p, n, at))
        at += 4 * n
        first = np.cumsum(counts) - counts
        docs.append(np.repeat(ids, counts))
        for col, e in zip(more, each):
            col.append(np.repeat(e, counts))
        poss.append(sums - np.repeat(np.where(first > 0, sums[first - 1], 0), counts))
        for kind, col in zip(kinds, keys):
            col.append(np.frombuffer(p, kind, n, at))
            at += np.dtype(kind).itemsize * n
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return cat(docs, np.int64), cat(poss, np.int64), [cat(c, k) for c, k in zip(keys, kinds)], \
        [cat(c, np.int64) for c in more]


PLACES = "bucket int, payload binary"


def deal_places(doc: np.ndarray, pos: np.ndarray, buckets: int) -> pa.Table:
    """Places (document, position) as one packed row per bucket of documents."""
    order = np.lexsort((pos, doc))
    ids, which = np.unique(doc[order], return_inverse=True)
    bucket = (mix(ids.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    rows = pack(bucket[which], buckets, which, pos[order], ids, [])
    return pa.table({"bucket": pa.array([o for o, _ in rows], pa.int32()), "payload": pa.array([p for _, p in rows], pa.binary())})


def gather_places(key, rows):
    """The rows of a bucket as (doc_id, packed positions), one row a document."""
    doc, pos, _, _ = unpack(rows.column("payload").to_pylist(), [])
    order = np.lexsort((pos, doc))
    doc, raw = doc[order], pos[order].astype("<u4").tobytes()
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    cuts = np.append(heads, len(doc)) * 4
    return pa.table({"doc_id": pa.array(doc[heads], pa.int64()),
                     "places": pa.array([raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def shrink(batches):
    """For ``mapInArrow`` over an id, the text and more columns: the text compressed, null as empty."""
    press = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([press.compress((t or "").encode()) for t in b.column(1).to_pylist()], pa.binary()),
             *b.columns[2:]], names=b.schema.names)


def text_column(col: pa.Array) -> pa.Array:
    """A text column, unpacked if ``shrink`` made it."""
    if not pa.types.is_binary(col.type):
        return col
    grow = zstandard.ZstdDecompressor()
    return pa.array([grow.decompress(t).decode() for t in col.to_pylist()], pa.large_string())
