"""Batch tokenisation with a public byte-level BPE vocabulary.

The ids equal those of the ``tokenizers`` library for the same vocabulary
(``add_special_tokens=False``). Pre-tokens of a batch are found and hashed
with numpy; only words not seen before by the worker go through the BPE
merges, everything else is a table look-up.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

from ledgerlake.llm.spans import EDGE, LETTER, OTHER, SPACE, Batch, chunks

_SLOTS = 21
_MOST_CACHED = 6_000_000


def default_paths() -> tuple[str, str]:
    """(rank file, JSON file) of the 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def pre_tokens(b: Batch) -> np.ndarray:
    """Start flags of the pre-tokens: optional space + letters, numbers or
    other characters; English contractions; white space, whose last character
    stays apart when text follows."""
    cp, kind = b.cp, b.kind
    at, run = b.runs()
    flag = np.zeros(len(cp) + 4, bool)
    flag[at] = True
    stop = np.append(at[1:], len(cp))
    follows = np.append(run[1:], EDGE)
    white = stop[(run == SPACE) & (follows != EDGE)]
    flag[white - 1] = True
    flag[white[cp[white - 1] == 0x20]] = False
    quote = np.flatnonzero((cp == 0x27) & (kind == OTHER))
    quote = quote[flag[quote]]
    if len(quote):
        far = np.concatenate((cp, np.zeros(4, np.uint32)))
        letter = np.concatenate((kind == LETTER, np.zeros(4, bool)))
        a, c = far[quote + 1], far[quote + 2]
        one = np.isin(a, [ord(x) for x in "stmd"]) & letter[quote + 1]
        two = np.zeros(len(quote), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (c == ord(y)) & letter[quote + 1] & letter[quote + 2]
        for which, n in ((one, 2), (two, 3)):
            i = quote[which]
            flag[i + 1] = False
            flag[i + n - 1] = False if n == 2 else flag[i + n - 1]
            nxt = i + n
            flag[nxt] |= letter[nxt]
    return flag[: len(cp)]


class Tokens:
    """Worker-side tokeniser; keeps a bounded table of words already encoded."""

    def __init__(self, ranks_path: str, json_path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(i) for a, i in map(bytes.split, f)}
        self._bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._json, self._special = json_path, "<|endoftext|>"
        self._whole = None
        self._reset()

    def _reset(self):
        self._key = np.zeros(1 << _SLOTS, np.uint64)
        self._off = np.zeros(1 << _SLOTS, np.int64)
        self._len = np.zeros(1 << _SLOTS, np.int32)
        self._flat, self._used = np.zeros(1 << 20, np.int32), 0

    def encode(self, text: str) -> list[int]:
        """Ids of one text, special strings read as special tokens."""
        if self._json and self._special in text:
            if self._whole is None:
                from tokenizers import Tokenizer

                self._whole = Tokenizer.from_file(self._json)
            return self._whole.encode(text, add_special_tokens=False).ids
        return self._bpe.encode_ordinary(text)

    def encode_plain(self, text: str) -> list[int]:
        """Ids of one text, special strings read as ordinary text."""
        return self._bpe.encode_ordinary(text)

    def _starts(self, b: Batch) -> np.ndarray:
        """Start flags of the units that are encoded apart."""
        return pre_tokens(b)

    def _units(self, units: list[str]) -> list[list[int]]:
        """Ids of units not seen before."""
        return list(map(self._bpe.encode_ordinary, units))

    def _slice(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        b = Batch.of(texts)
        start = np.flatnonzero(self._starts(b))
        stop = np.append(start[1:], len(b.cp))
        real = b.kind[start] != EDGE
        start, stop = start[real], stop[real]
        key = b.hashes(start, stop)
        slot = (key >> np.uint64(64 - _SLOTS)).astype(np.int64)
        off, n = self._off[slot], self._len[slot].astype(np.int64)
        miss = np.flatnonzero(self._key[slot] != key)
        if len(miss):
            new, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
            text = "\0".join(texts)
            ids = self._units([text[i:j] for i, j in zip(start[miss[first]].tolist(), stop[miss[first]].tolist())])
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            total = int(lens.sum())
            if self._used + total > len(self._flat):
                grown = np.zeros(2 * (self._used + total), np.int32)
                grown[: self._used] = self._flat[: self._used]
                self._flat = grown
            self._flat[self._used : self._used + total] = np.fromiter((x for y in ids for x in y), np.int32, total)
            offs = self._used + np.cumsum(lens) - lens
            self._used += total
            at = (new >> np.uint64(64 - _SLOTS)).astype(np.int64)
            self._key[at], self._off[at], self._len[at] = new, offs, lens
            # two new words may share a slot: the writes above go in order for
            # all three arrays, so the last one is whole and the first misses
            off[miss], n[miss] = offs[back], lens[back]
        total = np.cumsum(n)
        flat = self._flat[np.repeat(off - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        upto = np.concatenate(([0], total))
        cut = np.concatenate((upto[np.searchsorted(start, b.first)], upto[-1:]))
        if self._used > _MOST_CACHED:
            self._reset()
        return flat, cut

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """int32 ids of each text (whole texts), special strings as special."""
        out: list[np.ndarray] = []
        for i, j in chunks(texts):
            flat, cut = self._slice(texts[i:j])
            out += [flat[cut[k] : cut[k + 1]] for k in range(j - i)]
        if self._json:
            for i, t in enumerate(texts):
                if self._special in t:
                    out[i] = np.array(self.encode(t), np.int32)
        return out


@lru_cache(maxsize=2)
def tokens(ranks_path: str, json_path: str | None = None) -> Tokens:
    """The worker's tokeniser for these files (loaded once per worker)."""
    return Tokens(ranks_path, json_path)
