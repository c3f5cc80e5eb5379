"""Byte-level BPE ids by units: the stretches between single blanks, which this kind of tokenizer never joins.

The pattern of byte-level BPE takes at most one blank along with a word, so a text falls apart before every blank that a
non-blank follows, and the ids of a text are those of its units in turn. A unit's ids are computed once per worker. Texts
that hold an added token's string go to the library whole.
"""

from __future__ import annotations

import json
import re

import numpy as np

from loomlog.llm.bpe import load, special_strings
from loomlog.llm.common import kept_in_worker

#: Units whose ids a worker keeps (about 200 bytes each); units beyond are encoded when met.
KEPT_UNITS = 600_000

#: Fixed value: how byte-level BPE cuts a text into pre-tokens.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_BREAK = re.compile(r" (?=\S)")
_RUN = re.compile(r" \s")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def ranked(path: str):
    """An encoder for ordinary text from the ranks in a byte-level vocabulary, or None where ids are not ranks."""
    def make():
        model = json.load(open(path, encoding="utf-8"))["model"]
        alphabet, vocab = byte_alphabet(), model["vocab"]
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        order = [vocab[m] for m in made]
        if order != sorted(order) or model.get("end_of_word_suffix") or any(c not in alphabet for w in vocab for c in w):
            return None
        import tiktoken
        ranks = {bytes(alphabet[c] for c in w): i for w, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
    return kept_in_worker(f"ranks:{path}", make)


def units_of(text: str) -> list[str]:
    """The first unit, then the others without their leading blank."""
    return _BREAK.split(text) if _RUN.search(text) else text.split(" ")


class UnitIds:
    """ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, kept: int = KEPT_UNITS):
        self.tokenizer, self.ranks, self.kept, self.known = load(path), ranked(path), kept, {}
        self.specials = special_strings(self.tokenizer)

    def plain(self, text: str) -> bytes:
        if self.ranks is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array(self.ranks.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *units = units_of(text)
        known = self.known
        try:
            return self.plain(first) + b"".join([known[u] for u in units])
        except KeyError:
            pass
        out = [self.plain(first)]
        for u in units:
            ids = known.get(u)
            if ids is None:
                ids = self.plain(" " + u)
                if len(known) < self.kept and len(u) < 64:
                    known[u] = ids
            out.append(ids)
        return b"".join(out)


def unit_ids(path: str) -> UnitIds:
    """The worker's encoder for ``path``."""
    return kept_in_worker(f"units:{path}", lambda: UnitIds(path))
