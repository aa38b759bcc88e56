"""Token ids of a byte-level BPE vocabulary file, as the ``tokenizers`` library gives them.

A single space before a visible character always opens a new token in this
vocabulary family, so a text splits at such spaces into pieces whose ids do
not depend on each other. Pieces repeat, so their ids are kept in a bounded
table. Pieces of plain characters that are not in it yet are merged by
``tiktoken`` over the same file's vocabulary (its ids are the merge ranks);
anything else (special tokens' strings, other scripts, runs of white space)
goes to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

LOOSE_SPACE = re.compile(r" (?:\s|$)")
PLAIN = re.compile("[\x21-\x7e\nÀ-ɏ]*")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character:
    printable Latin-1 bytes as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class TokenIds:
    """Ids of texts as packed little-endian numbers of two bytes (four for large vocabularies)."""

    def __init__(self, path: str, keep: int = 300_000):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_of_char()
        special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.fast = tiktoken.Encoding("vocabulary file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.kind = np.dtype("<u2" if self.exact.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.keep = keep

    def _whole(self, text: str) -> bytes:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        if PLAIN.fullmatch(piece, 1 if piece[:1] == " " else 0):
            return np.array(self.fast.encode_ordinary(piece), self.kind).tobytes()
        return self._whole(piece)

    def _look(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            got = self._piece(" " + word)
        if len(self.known) >= self.keep:  # forget what was not used for a while
            self.older, self.known = self.known, {}
        self.known[word] = got
        return got

    def encode(self, text: str) -> bytes:
        if LOOSE_SPACE.search(text) or (self.special and self.special.search(text)):
            return self._whole(text)
        first, *rest = text.split(" ")
        get, look = self.known.get, self._look
        return (self._piece(first) if first else b"") + b"".join([get(w) or look(w) for w in rest])


_LOADED: dict[str, TokenIds] = {}


def loaded(path: str | None) -> TokenIds:
    """One instance a worker process. ``None`` names the public 50k byte-level file."""
    if path is None:
        import public_tokenizers
        path = str(public_tokenizers.path("byte_bpe_50k.json"))
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
