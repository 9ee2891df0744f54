"""Language-model scoring by online logistic context mixing.

A text is its tokens (runs of bytes other than white space, A-Z in lower case)
and one end. Every token is a string of binary decisions: the bits of its code
word (short codes for frequent tokens), and for a token outside the code book
the escape, then the bits of its bytes and of an end mark. The decisions are
predicted one by one:

* several bit predictors, each indexed by a hash of a context and the place in
  the code, hold how often either bit followed in the training documents. For
  tokens the contexts are the last very frequent token and the previous token
  (its last two bytes if it is rare); for bytes the three preceding bytes of
  the token, and two of them with the last very frequent token;
* their log-odds are added under weights; which set of weights holds is gated
  by the predictors' confidence and the depth in the code;
* a second map, interpolated over the mixed log-odds, refines the result;
* weights and map start from those that suit all training documents best, and
  go on learning inside each document: a block of tokens is predicted with what
  the tokens before it taught.

So the probabilities of all continuations add up to at most one, and the sum of
the decisions' logarithms is the text's log probability (``score``, base 10;
``bits_per_byte`` is the same per byte of text).

What is gathered from the training documents: the counts of all tokens (they
grow with the corpus, are summed per task, then shuffled); bit counts of all
decisions, hashed to a table per context that grows with the corpus up to
``most_slots`` slots; what the mixers read at all decisions, as counts of gate,
log-odds and bit, from which the weights and maps are fitted. The first bits of
code words are counted apart, as they come in few combinations with contexts.
A document's own bits must not vouch for it when weights are fitted: the
documents fall into two folds, and each is read with the bit counts of the
other; the model's are those of both.
(``sample_docs``, if given, fits the weights to about so many documents
only; the bit counts still cover all.) Tokens with more than
one ``1 / frequent`` of all occurrences are fewer than ``frequent``: they make
the code book and their counts go to every task. The others meet their counts
in a join, where none of them is hot.

Defined cases: a null text is empty and has one token, the end; repeated rows
count and are scored each; a null id belongs to the training documents; without
training documents the model is uniform over code bits; long texts are scored
segment by segment with the state carried on; an empty table gives no row;
extra columns are ignored. A text's score does not depend on other rows of the
batch.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, unit_hash, written
from ledgerlake.llm.spans import _powers, mix

#: Contexts that predict a decision.
ORDERS = 2
END_OF_TEXT = -7046029254386353131  # the end's entry among the hashed tokens
#: A token of the book counts as new (escape and spelling) once in all its
#: occurrences, where they are no more than this: so new tokens are learned
#: from. Weights are kept in parts of ``_UNIT``, which they divide.
NOVEL, _UNIT = 3, 6
_GATES, _DEPTHS, _KNOTS = 64, 4, 25
# levels of a log-odds when weights are fitted, in steps of a quarter; all inputs of a mixer
_LEVELS = 97
_INPUTS = _GATES * _LEVELS**ORDERS * 2
_TOPICS, _COMMON = 64, 1024
# bytes of text counted at a time, and scored at a time (arrays then stay in cache)
_SEGMENT, _SCORED = 1 << 19, 1 << 19
_BLOCK, _LONGEST, _BYTES, _AT_ONCE = 16, 4096, 1 << 14, 1 << 17
_APART = 1 << 20
# the first bits of a code word come in fewer combinations with contexts: they are
# counted apart and read from rows of the most frequent contexts
_HEAD, _NEAR = 9, 1024
_LOW = 0xFFFFFFFF
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def fold(doc_id: str = "doc_id", parts: int = 7) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


# --- tokens of a batch --------------------------------------------------------------


@lru_cache(maxsize=1)
def _bytes_hashes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _is_space(data: np.ndarray) -> np.ndarray:
    """White space flag of bytes."""
    return (data == 0x20) | (data - np.uint8(0x09) < 5)


class Tokens:
    """Tokens of the texts between ``cut`` in the UTF-8 bytes ``data``: hash,
    text, start and end of each, an end token behind every text of ``ended``."""

    def __init__(self, data: np.ndarray, cut: np.ndarray, ended: np.ndarray):
        self.low = data + (data - np.uint8(65) < 26) * np.uint8(32)
        n = len(data)
        word = np.zeros(n + 2, bool)
        word[1:-1] = ~_is_space(data)
        first = np.zeros(n + 1, bool)
        first[cut] = True
        begin = np.flatnonzero(word[1:-1] & (~word[:-2] | first[:n]))
        end = np.flatnonzero(word[1:-1] & (~word[2:] | first[1:])) + 1
        up, down = _powers(1 << max(16, int(n + 1).bit_length()))
        sums = np.zeros(n + 1, np.uint64)
        each = _bytes_hashes().take(self.low)
        each *= up[:n]
        np.cumsum(each, out=sums[1:])
        h = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)).view(np.int64)
        each = np.diff(np.searchsorted(begin, cut))
        shift = np.cumsum(ended) - ended
        at = np.arange(len(h)) + np.repeat(shift, each)
        self.count = each + ended
        self.first = np.cumsum(self.count) - self.count
        total = int(self.count.sum())
        self.h = np.full(total, END_OF_TEXT, np.int64)
        self.begin, self.end = np.zeros(total, np.int64), np.zeros(total, np.int64)
        self.h[at], self.begin[at], self.end[at] = h, begin, end
        self.text = np.repeat(np.arange(len(self.count)), self.count)


def raw_texts(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and cuts of an Arrow string column; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    col = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = col.buffers()
    cut = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[cut[0] : cut[-1]], cut - cut[0]


def segments(data: np.ndarray, cut: np.ndarray, size: int = _SEGMENT):
    """(first text, last text + 1, bytes, cuts, ended) of slices of whole texts
    of about ``size`` bytes; a longer text comes alone, in several pieces cut
    at white space, of which the last is ended."""
    i, n = 0, len(cut) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(cut, cut[i] + size, side="right")) - 1)
        if cut[j] - cut[i] <= size:
            yield i, j, data[cut[i] : cut[j]], cut[i : j + 1] - cut[i], np.ones(j - i, np.int64)
        else:
            lo, stop = int(cut[i]), int(cut[j])
            while lo < stop:
                hi = min(lo + size, stop)
                while hi < stop and not _is_space(data[hi : hi + 1])[0]:
                    ahead = np.flatnonzero(_is_space(data[hi : min(hi + size, stop)]))
                    hi = hi + int(ahead[0]) if len(ahead) else min(hi + size, stop)
                yield i, j, data[lo:hi], np.array([0, hi - lo]), np.array([int(hi == stop)])
                lo = hi
        i = j


# --- codes ------------------------------------------------------------------------


def code_words(counts: np.ndarray) -> np.ndarray:
    """Prefix code of symbols with positive ``counts``: lengths of about the
    binary logarithm of the inverse share (Kraft sum at most one), as numbers
    with a leading one bit."""
    total = float(counts.sum())
    length = np.maximum(1, np.ceil(np.log2(total / counts) - 1e-12)).astype(np.int64)
    order = np.argsort(length, kind="stable")
    out, code, last = np.zeros(len(counts), np.int64), 0, 0
    step = np.flatnonzero(np.diff(np.concatenate(([0], length[order]))))
    for lo, hi in zip(step, np.append(step[1:], len(order))):
        n = int(length[order[lo]])
        code <<= n - last
        out[order[lo:hi]] = (1 << n) + code + np.arange(hi - lo)
        code, last = code + int(hi - lo), n
    return out


class Book:
    """Code book of the frequent tokens (``h``, ``c``), the escape and the end,
    and the code of bytes; built on the driver, sent to every task."""

    def __init__(self, h: np.ndarray, c: np.ndarray, n: int, v: int, bytes_seen: np.ndarray, slots: int):
        order = np.lexsort((h, -c))
        self.n, self.v, self.slots = n, v, slots
        h, c = h[order], c[order]
        if END_OF_TEXT not in h:
            h, c = np.append(h, END_OF_TEXT), np.append(c, 0)
        self.count, self.texts = c, int(c[h == END_OF_TEXT][0])
        self._h, self._seen = h, bytes_seen
        codes = code_words(np.append(np.maximum(c, 1), max(1, n - int(c.sum()))))
        self.code, self.escape = codes[:-1], codes[-1]
        self.byte_code = code_words(bytes_seen + 1.0)
        # tokens by hash, found from the hash's leading bits
        key = h.view(np.uint64)
        self._rank = np.argsort(key)
        self._key, self._bits = key[self._rank], max(8, len(h).bit_length() + 2)
        lead = (self._key >> np.uint64(64 - self._bits)).astype(np.int64)
        self._start = np.searchsorted(lead, np.arange((1 << self._bits) + 1)).astype(np.int32)

    def __reduce__(self):
        # what travels; a task builds the rest anew
        return Book, (self._h, self.count.astype(np.int64), self.n, self.v, self._seen, self.slots)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """Rank by frequency of each token, -1 outside the book."""
        key = h.view(np.uint64)
        lead = (key >> np.uint64(64 - self._bits)).view(np.int64)
        at = self._start.take(lead)
        same = self._key.take(at, mode="clip") == key
        out = np.where(same, self._rank.take(at, mode="clip"), -1)
        left = np.flatnonzero(~same)
        at, stop = at.take(left) + 1, self._start.take(lead.take(left) + 1)
        while len(left):
            some = np.flatnonzero(at < stop)
            left, at, stop = left.take(some), at.take(some), stop.take(some)
            same = self._key.take(at) == key.take(left)
            out[left[same]] = self._rank.take(at[same])
            at += 1
            at[same] = stop[same]
        return out

    def codes(self, rank: np.ndarray) -> np.ndarray:
        return np.where(rank >= 0, self.code.take(np.maximum(rank, 0)), self.escape)

    @staticmethod
    def bits(code: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last ``length`` bits of code words, one word after the other,
        and all bits before each, with the leading one."""
        left = np.repeat(np.cumsum(length) - 1, length)
        left -= np.arange(len(left))
        prefix = np.repeat(code, length)
        prefix >>= left
        bit = (prefix & 1).astype(np.int8)
        prefix >>= 1
        return bit, prefix

    @staticmethod
    def keys(contexts, first: int = 0) -> list[np.ndarray]:
        """Hashes of ``contexts``, which belong to the orders from ``first``."""
        return [mix(c.astype(np.int64).view(np.uint64) * _STEP + np.uint64(first + k + 1)) for k, c in enumerate(contexts)]

    def places(self, keys, length: np.ndarray, prefix: np.ndarray) -> list[np.ndarray]:
        """Slots of :meth:`bits`, per context; ``keys`` and ``length`` are of
        the code words."""
        place = prefix.view(np.uint64) * _ODD
        shift = np.uint64(64 - (self.slots.bit_length() - 1))
        slots = []
        for key in keys:
            x = np.repeat(key, length)
            x ^= place
            x *= _STEP
            x ^= x >> np.uint64(29)
            x *= _ODD
            x >>= shift
            slots.append(x.view(np.int64))
        return slots

    def expand(self, code: np.ndarray, contexts, first: int = 0):
        """The bits of code words: (number of the word, bit, depth, slots per
        context); ``contexts`` belong to the orders from ``first``."""
        length = _length(code)
        bit, prefix = self.bits(code, length)
        owner = np.repeat(np.arange(len(code)), length)
        return owner, bit, _length(prefix), self.places(self.keys(contexts, first), length, prefix)


def _length(code: np.ndarray) -> np.ndarray:
    return np.frexp(code.astype(np.float64))[1].astype(np.int64) - 1


@lru_cache(maxsize=1)
def _depth_classes() -> np.ndarray:
    prefix = np.arange((1 << 4 * (_DEPTHS - 1)) + 1)
    return sum((prefix >= 1 << 4 * k).astype(np.int8) for k in range(1, _DEPTHS))


def _deep(prefix: np.ndarray) -> np.ndarray:
    """Class of a bit's depth: four bits each, the last open."""
    return _depth_classes().take(prefix, mode="clip")


def _changes(x: np.ndarray) -> np.ndarray:
    """Where an array's value differs from that before; the first does."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return np.flatnonzero(out)


class Contexts:
    """Ranks and contexts of the tokens of a slice; ``state`` holds the last
    topic and previous token of a text that goes on."""

    def __init__(self, t: Tokens, book: Book, state: tuple[int, int] = (0, 0)):
        self.t, self.book = t, book
        self.rank = book.ranks(t.h)
        n = len(t.h)
        lead = t.low[np.maximum(t.end - 2, t.begin)] if n and len(t.low) else np.zeros(n, np.uint8)
        last = t.low[np.maximum(t.end - 1, 0)] if n and len(t.low) else np.zeros(n, np.uint8)
        kind = np.where((self.rank >= 0) & (self.rank < _COMMON), self.rank + 1, 4096 + lead.astype(np.int64) * 256 + last)
        previous = np.concatenate(([0], kind[:-1]))
        at = np.where((self.rank >= 0) & (self.rank < _TOPICS), np.arange(n), -1)
        seen = np.concatenate(([-1], np.maximum.accumulate(at)[:-1])) if n else at
        start = np.zeros(n, bool)
        start[t.first[t.count > 0]] = True
        previous[start] = state[1]
        self.topic = np.where(seen >= t.first[t.text], self.rank[np.maximum(seen, 0)] + 1, state[0])
        self.previous = previous
        self.state = state if not n else (int(self.rank[at.max()]) + 1 if at.max() >= 0 else state[0], int(kind[-1]))

    def packed(self) -> np.ndarray:
        """Topic (from bit 49), previous token (from bit 32) and rank + 1 of
        every token in one number."""
        return (self.topic << 17 | self.previous) << 32 | (self.rank + 1)

    def word_decisions(self, which: np.ndarray):
        """:meth:`Book.expand` of the tokens ``which``."""
        return self.book.expand(self.book.codes(self.rank.take(which)), (self.topic.take(which), self.previous.take(which) + _APART))

    def byte_decisions(self, which: np.ndarray):
        """The bytes of the tokens ``which``, an end mark (256) behind each:
        number of the token, place in it, byte and contexts."""
        t = self.t
        n = t.end[which] - t.begin[which] + 1
        owner = np.repeat(np.arange(len(which)), n)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = t.begin.take(which).take(owner) + place
        here = []  # the byte, and those before it in the token plus one
        for back in range(4):
            here.append(t.low.take(at - back, mode="clip").astype(np.int64))
            if back:
                here[back] += 1
                here[back] *= place >= back
        symbol = np.where(place == n.take(owner) - 1, 256, here[0])
        two = here[1] * 257 + here[2]
        return owner, place, symbol, (two * 257 + here[3] + (2 << 40), two * 128 + self.topic[which].take(owner) + (3 << 40))


# --- predictors, mixer, refinement --------------------------------------------------


def predictions(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """What the mixer reads of bit counts: the log-odds of a one, in steps of
    1 / 640 (about 14 bits), and two bits that say how many there were."""
    zeros, ones = zeros / _UNIT, ones / _UNIT
    odds = np.rint(640 * np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -12, 12)).astype(np.int16)
    return odds * np.int16(4) + np.digitize(np.maximum(zeros, ones), [1, 4, 16]).astype(np.int16)


class Mixer:
    """Weights and refinement map of one kind of decision, for many texts at
    a time (one lane each)."""

    rate, refine = 0.05, 0.15

    def __init__(self, weights: np.ndarray | None = None, knots: np.ndarray | None = None):
        if weights is None:
            weights = np.zeros((_GATES, ORDERS + 1))
            weights[:, :ORDERS] = 1.0 / ORDERS
            knots = np.tile(np.arange(_KNOTS) - 12.0, _DEPTHS)
        self.weights, self.knots = weights.astype(np.float32), knots.astype(np.float32)

    def start(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        return np.tile(self.weights.T, (1, lanes)), np.tile(self.knots, lanes)

    def step(self, state, lane: np.ndarray, length: np.ndarray, bit: np.ndarray, deep: np.ndarray, reads) -> np.ndarray:
        """Cost of the decisions per lane (natural logarithm); afterwards the
        lanes' state has learned from them. ``lane`` and ``length`` are of the
        code words, ``bit``, :func:`_deep` and what is read in the tables
        (changed here) of their bits."""
        w, knots = state
        x, gate = [], deep.astype(np.int16)
        for read in reads:
            gate *= np.int16(4)
            gate += read & np.int16(3)
            read >>= 2
            x.append(read.astype(np.float32))
            x[-1] *= np.float32(1 / 640)
        # texts come one after another, perhaps again with further bits
        new = _changes(lane)
        lane, upto = lane.take(new), np.concatenate((np.cumsum(length).take(new[1:] - 1), [len(bit)]))
        many = upto.copy()
        many[1:] -= upto[:-1]
        at = np.repeat(lane * _GATES, many)
        at += gate
        place = w[ORDERS].take(at)
        for own, y in zip(w, x):
            place += own.take(at) * y
        np.clip(place, np.float32(-11.9), np.float32(11.9), out=place)
        place += np.float32(12)
        knot = place.astype(np.int32)
        part = place - knot.astype(np.float32)
        knot += deep * np.int32(_KNOTS)
        on = np.repeat(lane * (_DEPTHS * _KNOTS), many)
        on += knot
        odds = knots.take(on)
        rise = knots[1:].take(on)
        rise -= odds
        rise *= part
        odds += rise
        place -= np.float32(12)
        odds += place
        against = np.float32(0.5) - bit.astype(np.float32)
        odds *= against
        np.exp(odds, out=odds)
        cost = np.bincount(lane, np.add.reduceat(np.log1p(odds), upto - many, dtype=np.float64), len(knots) // (_DEPTHS * _KNOTS))
        odds /= odds + np.float32(1)
        odds *= against
        odds *= np.float32(-2)
        error = odds.astype(np.float64)
        first = int(lane.min())
        lanes = int(lane.max()) - first + 1
        low, n = first * _GATES, lanes * _GATES
        at -= low
        own = w[:, low : low + n]
        gain = self.rate / np.sqrt(np.bincount(at, minlength=n) + 1.0)
        for k in range(ORDERS):
            pull = x[k].astype(np.float64)
            pull *= error
            own[k] += gain * np.bincount(at, weights=pull, minlength=n)
        own[ORDERS] += gain * np.bincount(at, weights=error, minlength=n)
        low, n = first * _DEPTHS * _KNOTS, lanes * _DEPTHS * _KNOTS
        on += part > 0.5
        on -= low
        knots[low : low + n] += self.refine * np.bincount(on, weights=error, minlength=n) / np.sqrt(np.bincount(on, minlength=n) + 1.0)
        return cost


def block_of(place: np.ndarray) -> np.ndarray:
    """Number of the block of a token, from its place in the text: blocks grow
    with what lies before them, up to a longest."""
    return np.searchsorted(_block_starts(int(place.max(initial=0)) + 1), place, side="right") - 1


@lru_cache(maxsize=64)
def _starts_upto(power: int) -> np.ndarray:
    out, at = [0], 0
    while at < 1 << power:
        at += min(_LONGEST, max(_BLOCK, at // 4))
        out.append(at)
    return np.array(out)


def _block_starts(n: int) -> np.ndarray:
    return _starts_upto(max(4, n.bit_length()))


class Scorer:
    """Tables and mixers of a trained model, as every task uses them."""

    def __init__(self, book: Book, tables, words: Mixer, spelled: Mixer):
        self.book, self.tables, self.words, self.spelled = book, tables, words, spelled
        self._near = None

    def __getstate__(self):
        return self.__dict__ | {"book": None, "_near": None}  # the book is sent once, on its own

    def using(self, book: Book) -> "Scorer":
        self.book = book
        return self

    def near(self, ctx: Contexts):
        """What the tables hold for the heads of code words after each topic
        and after the most frequent previous tokens of the slice met first,
        row by row; and the rows by context, -1 if there is none."""
        if self._near is None:
            met = np.bincount(ctx.previous, minlength=4096 + (1 << 16))
            often = np.argsort(-met, kind="stable")[:_NEAR]
            row = np.full(len(met), -1, np.int64)
            row[often] = np.arange(len(often)) << _HEAD
            prefix, rows = np.arange(1 << _HEAD), []
            for k, contexts in enumerate((np.arange(_TOPICS + 1), often + _APART)):
                length = np.full(len(contexts), 1 << _HEAD)
                (slots,) = self.book.places(self.book.keys([contexts], k), length, np.tile(prefix, len(contexts)))
                rows.append(self.tables[k].take(slots))
            self._near = rows, row
        return self._near

    def score(self, t: Tokens, ctx: Contexts, state, place: int = 0) -> np.ndarray:
        """Natural log cost of each text of a slice; ``state`` is that of the
        two mixers, ``place`` the tokens of the text before this slice."""
        lanes = len(t.count)
        cost = np.zeros(lanes)
        if not len(t.h):
            return cost
        rows, row = self.near(ctx)
        code = self.book.codes(ctx.rank)
        keys = self.book.keys((ctx.topic, ctx.previous + _APART))
        starts = ctx.topic << _HEAD, row.take(ctx.previous)
        head = _length(code)
        tail = np.maximum(head - _HEAD, 0)
        tail[starts[1] < 0] = head[starts[1] < 0]
        head -= tail
        block = block_of(np.arange(len(t.h)) - t.first[t.text] + place)
        order = np.argsort(block, kind="stable")
        edges = np.append(_changes(block.take(order)), len(order))
        for lo, hi in zip(edges[:-1], edges[1:]):
            for some in self._whole_lanes(order[lo:hi], t.text):
                # heads from the rows, then what is left from the tables
                one, two = some[head.take(some) > 0], some[tail.take(some) > 0]
                lengths = head.take(one), tail.take(two)
                bits, prefix = zip(self.book.bits(code.take(one) >> tail.take(one), lengths[0]), self.book.bits(code.take(two), lengths[1]))
                reads, slots = [], self.book.places([x.take(two) for x in keys], lengths[1], prefix[1])
                for near, start, table, s in zip(rows, starts, self.tables, slots):
                    at = np.repeat(start.take(one), lengths[0])
                    at += prefix[0]
                    reads.append(np.concatenate((near.take(at), table.take(s))))
                lane = t.text.take(np.concatenate((one, two)))
                cost += self.words.step(state[0], lane, np.concatenate(lengths), np.concatenate(bits), np.concatenate([_deep(x) for x in prefix]), reads)
                rare = some[ctx.rank.take(some) < 0]
                if len(rare):
                    cost += self._spell(t, ctx, rare, state[1])
        return cost

    @staticmethod
    def _whole_lanes(which: np.ndarray, text: np.ndarray):
        """Cut a block's tokens where the text changes, into parts of bounded
        size."""
        if len(which) * 14 <= _AT_ONCE:
            return [which]
        change = _changes(text[which])
        part = change // max(1, _AT_ONCE // 14)
        return np.split(which, change[np.flatnonzero(np.diff(part))  + 1])

    def _spell(self, t: Tokens, ctx: Contexts, rare: np.ndarray, state) -> np.ndarray:
        """Bytes of the tokens outside the book; a text with very many of them
        in the block learns in between."""
        cost = np.zeros(len(t.count))
        size = t.end.take(rare) - t.begin.take(rare) + 1
        before = np.cumsum(size) - size
        turn = np.zeros(1, np.int64)
        if before[-1] >= _BYTES:
            first = _changes(t.text[rare])
            turn = (before - np.repeat(before[first], np.diff(np.append(first, len(rare))))) // _BYTES
        for r in range(int(turn.max()) + 1):
            some = rare if len(turn) == 1 else rare[turn == r]
            if not len(some):
                continue
            owner, place, symbol, contexts = ctx.byte_decisions(some)
            code, lane, keys = self.book.byte_code.take(symbol), t.text.take(some).take(owner), self.book.keys(contexts)
            times = int(place.max()) // _BYTES + 1
            for k in range(times):  # more than one only for a token of that length
                now = slice(None) if times == 1 else place // _BYTES == k
                length = _length(code[now])
                bit, prefix = self.book.bits(code[now], length)
                slots = self.book.places([x[now] for x in keys], length, prefix)
                reads = [table.take(s) for table, s in zip(self.tables, slots)]
                cost += self.spelled.step(state, lane[now], length, bit, _deep(prefix), reads)
        return cost

    def fresh(self, lanes: int):
        return self.words.start(lanes), self.spelled.start(lanes)


# --- gathering from the training documents --------------------------------------------


def token_counts(docs: DataFrame) -> DataFrame:
    """``kind, h, c``: occurrences of every token (kind 0, by hash, ends
    included) and of every byte within tokens (kind 1; 256 is a token's end)."""

    def run(batches):
        import pyarrow as pa

        seen, held, size = np.zeros(257, np.int64), [], 0

        def total():
            h, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return h, np.bincount(back, weights=np.concatenate([y for _, y in held])).astype(np.int64)

        def rows(kind, h, c):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(h), kind), pa.int32()), pa.array(h, pa.int64()), pa.array(c, pa.int64())], names=["kind", "h", "c"])

        for b in batches:
            for _, _, data, cut, ended in segments(*raw_texts(b.column("text"))):
                t = Tokens(data, cut, ended)
                held.append(np.unique(t.h, return_counts=True))
                seen[:256] += np.bincount(t.low[~_is_space(t.low)], minlength=256)
                seen[256] += len(t.h)
                size += len(held[-1][0])
                if size > 1 << 20:
                    held = [total()]
                    size = len(held[0][0])
                    if size > 1 << 19:
                        yield rows(0, *held[0])
                        held, size = [], 0
        if held:
            yield rows(0, *total())
        yield rows(1, np.arange(257), seen)

    # summed by task already, so another partial sum before the shuffle would find next to nothing to add
    return docs.select("text").mapInArrow(run, "kind int, h long, c long").repartition("kind", "h").groupBy("kind", "h").agg(F.sum("c").alias("c"))


def code_book(counts: DataFrame, frequent: int, most_slots: int) -> Book:
    """The book of the frequent tokens of stored :func:`token_counts`."""
    words = counts.where("kind = 0")
    n, v = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    n = n or 0
    # fewer than ``frequent`` rows, and the end
    top = words.where((F.col("c") * frequent > n) | (F.col("h") == END_OF_TEXT)).select("h", "c").toPandas()
    seen = np.zeros(257)
    for r in counts.where("kind = 1").collect():  # 257 rows
        seen[r["h"]] = r["c"]
    slots = 1 << min(max(16, int(n).bit_length() + 1), most_slots.bit_length() - 1)
    return Book(top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64), n, v, seen, slots)


class BitCounts:
    """Counts of the bits of all decisions of a task's texts, by slot. Tokens
    are gathered first, so that each (context, token) is expanded once."""

    def __init__(self, book: Book):
        self.book = book
        self.table = np.zeros((ORDERS, 2 * book.slots), np.int32)
        self._words, self._bytes = [], []

    def add(self, t: Tokens, ctx: Contexts) -> None:
        self._words.append(ctx.packed())
        if sum(len(w) for w in self._words) > 1 << 21:
            self._count_words()
        known = np.where(ctx.rank >= 0, self.book.count.take(np.maximum(ctx.rank, 0)), 0)
        new = np.flatnonzero((known > 0) & (known <= NOVEL) & (t.h != END_OF_TEXT))
        if len(new):
            code, share = np.full(len(new), self.book.escape), _UNIT // known[new]
            for k, context in enumerate((ctx.topic, ctx.previous + _APART)):
                self._count(k, code, context[new], share)
        rare = np.flatnonzero(ctx.rank < 0)
        if len(rare) or len(new):
            some = np.concatenate((rare, new))
            weight = np.full(len(some), _UNIT)
            weight[len(rare) :] //= known[new]
            owner, _, symbol, contexts = ctx.byte_decisions(some)
            # weights are below eight, bytes and the end mark below 512
            self._bytes.append([c << 12 | symbol << 3 | weight.take(owner) for c in contexts])
            if sum(len(x[0]) for x in self._bytes) > 1 << 20:
                self._count_bytes()

    def close(self) -> np.ndarray:
        if self._words:
            self._count_words()
        if self._bytes:
            self._count_bytes()
        return self.table

    def _count_words(self) -> None:
        heads, tails = _halves(self.book, np.concatenate(self._words))
        self._words.clear()
        for k, (place, bits, apart) in enumerate(((49, 7, 0), (32, 17, _APART))):
            context = ((1 << bits) - 1) << place
            pair, times = np.unique((heads & context) >> place << 32 | heads & _LOW, return_counts=True)
            self._count(k, pair & _LOW, (pair >> 32) + apart, _UNIT * times)
            pair, times = np.unique((tails & context) >> place << 32 | tails & _LOW, return_counts=True)
            code = self.book.codes((pair & _LOW) - 1)
            self._count(k, code, (pair >> 32) + apart, _UNIT * times, _length(code) - _HEAD)

    def _count_bytes(self) -> None:
        for k, keys in enumerate(zip(*self._bytes)):
            # each (context, byte, weight) once
            pair, times = np.unique(np.concatenate(keys), return_counts=True)
            times *= pair & 7
            self._count(k, self.book.byte_code.take(pair >> 3 & 511), pair >> 12, times)
        self._bytes.clear()

    def _count(self, k: int, code, context, times, length=None) -> None:
        length, times = _length(code) if length is None else length, times.astype(np.int32)
        for some in range(0, len(code), 1 << 13):
            part = slice(some, some + (1 << 13))
            bit, prefix = self.book.bits(code[part], length[part])
            (slots,) = self.book.places(self.book.keys([context[part]], k), length[part], prefix)
            slots <<= 1
            slots += bit
            np.add.at(self.table[k], slots, np.repeat(times[part], length[part]))


def _halves(book: Book, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of tokens with their contexts (:meth:`Contexts.packed`), the first bits of
    the code words in place of the ranks, and those tokens that have more."""
    code = book.codes((words & _LOW) - 1)
    tail = np.maximum(_length(code) - _HEAD, 0)
    code >>= tail
    return words >> 32 << 32 | code, words[tail > 0]


def bit_tables(docs: DataFrame, book: Book, shared, chunk: int = 1 << 13) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """:func:`predictions` from all decisions in ``docs`` (``text, fold``), one
    table per context; and those that each fold is read with, one behind the
    other, from the decisions of the other fold. Each task counts its
    documents by fold, then sends the slots it has met. ``shared``: the broadcast
    ``book``."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        own = shared.value
        counts = BitCounts(own), BitCounts(own)
        for b in batches:
            for fold in (0, 1):
                state, column = {}, b.column("text").filter(pc.equal(b.column("fold"), fold))
                for i, _, data, cut, ended in segments(*raw_texts(column)) if len(column) else ():
                    t = Tokens(data, cut, ended)
                    ctx = Contexts(t, own, state.pop(i, (0, 0)))
                    state[i] = ctx.state
                    counts[fold].add(t, ctx)
        for fold in (0, 1):
            table = counts[fold].close()
            for k in range(ORDERS):
                rows = []
                for at in range(0, 2 * own.slots, 2 * chunk):
                    part = table[k, at : at + 2 * chunk]
                    some = np.flatnonzero(part)
                    if len(some):
                        rows.append((fold, k, at // (2 * chunk), some.astype("<u2").tobytes(), part[some].astype("<i4").tobytes()))
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["fold", "k", "part", "slots", "counts"])

    def add(batches):
        import pyarrow as pa

        total = {}  # of the parts of the tables that came to this task, by fold
        for b in batches:
            for fold, k, part, s, c in zip(*(b.column(x).to_pylist() for x in ("fold", "k", "part", "slots", "counts"))):
                if (k, part) not in total:
                    total[k, part] = np.zeros((2, 2 * chunk), np.int64)
                to = total[k, part][fold]
                to[np.frombuffer(s, "<u2").astype(np.intp)] += np.frombuffer(c, "<i4")
        for (k, part), t in total.items():
            odds = [pa.array([predictions(x[::2], x[1::2]).astype("<i2").tobytes()], pa.binary()) for x in (t.sum(axis=0), t[1], t[0])]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int32()), *odds], names=["k", "part", "odds", "other0", "other1"])

    counted = docs.select("text", "fold").mapInArrow(run, "fold int, k int, part int, slots binary, counts binary")
    summed = counted.repartition("k", "part").mapInArrow(add, "k int, part int, odds binary, other0 binary, other1 binary")
    tables = [np.zeros(book.slots, np.int16) for _ in range(ORDERS)]
    others = [np.zeros(2 * book.slots, np.int16) for _ in range(ORDERS)]
    for r in summed.collect():  # 3 * most_slots * ORDERS numbers at most
        at = r["part"] * chunk
        for to, x in ((tables[r["k"]], r["odds"]), (others[r["k"]][: book.slots], r["other0"]), (others[r["k"]][book.slots :], r["other1"])):
            to[at : at + chunk] = np.frombuffer(x, "<i2")[: book.slots]
    return tables, others


class MixerInputs:
    """How often a task's texts show a mixer each input: gate, levels of the
    log-odds and the bit, for words and for spelling. ``tables``: :func:`_levels`
    of the second ones of :func:`bit_tables`. Tokens are gathered first, as for
    the bit counts, so that each with its contexts is expanded once."""

    def __init__(self, book: Book, tables):
        self.book, self.tables = book, tables
        # what the read of each context adds to the number of an input
        read = np.arange(4 * _LEVELS)
        self._adds = [(read & 3) * 4 ** (ORDERS - 1 - k) * _LEVELS**ORDERS + (read >> 2) * _LEVELS ** (ORDERS - 1 - k) for k in range(ORDERS)]
        self.met = np.zeros((2, _INPUTS), np.int64)
        self._words, self._bytes = [], []

    def add(self, t: Tokens, ctx: Contexts, fold: np.ndarray) -> None:
        """``fold``: of each token."""
        self._words.append(fold << 56 | ctx.packed())
        if sum(len(w) for w in self._words) > 1 << 21:
            self._meet_words()
        known = np.where(ctx.rank >= 0, self.book.count.take(np.maximum(ctx.rank, 0)), 0)
        new = np.flatnonzero((known > 0) & (known <= NOVEL) & (t.h != END_OF_TEXT))
        if len(new):
            for f in (0, 1):
                some = new[fold.take(new) == f]
                self._meet(0, f, np.full(len(some), self.book.escape), (ctx.topic[some], ctx.previous[some] + _APART), _UNIT // known[some])
        rare = np.flatnonzero(ctx.rank < 0)
        if len(rare) or len(new):
            some = np.concatenate((rare, new))
            weight = np.full(len(some), _UNIT)
            weight[len(rare) :] //= known[new]
            owner, _, symbol, contexts = ctx.byte_decisions(some)
            self._bytes.append(fold[some].take(owner) << 56 | (contexts[0] - (2 << 40)) << 19 | (contexts[1] & 127) << 12 | symbol << 3 | weight.take(owner))
            if sum(len(x) for x in self._bytes) > 1 << 20:
                self._meet_bytes()

    def close(self) -> np.ndarray:
        if self._words:
            self._meet_words()
        if self._bytes:
            self._meet_bytes()
        return self.met

    def _meet_words(self) -> None:
        heads, tails = _halves(self.book, np.concatenate(self._words))
        self._words.clear()
        for words in (heads, tails):
            word, times = np.unique(words, return_counts=True)
            code = word & _LOW if words is heads else self.book.codes((word & _LOW) - 1)
            length = _length(code) - (0 if words is heads else _HEAD)
            contexts = word >> 49 & 127, (word >> 32 & 0x1FFFF) + _APART
            self._meet_folds(0, word, code, contexts, _UNIT * times, length)

    def _meet_bytes(self) -> None:
        key, times = np.unique(np.concatenate(self._bytes), return_counts=True)
        self._bytes.clear()
        times *= key & 7
        three, topic = key >> 19 & (1 << 37) - 1, key >> 12 & 127
        code = self.book.byte_code.take(key >> 3 & 511)
        self._meet_folds(1, key, code, (three + (2 << 40), three // 257 * 128 + topic + (3 << 40)), times, _length(code))

    def _meet_folds(self, kind: int, key, code, contexts, times, length) -> None:
        edge = int(np.searchsorted(key, 1 << 56))
        for fold, part in enumerate((slice(edge), slice(edge, None))):
            self._meet(kind, fold, code[part], [c[part] for c in contexts], times[part], length[part])

    def _meet(self, kind: int, fold: int, code, contexts, times, length=None) -> None:
        length = _length(code) if length is None else length
        tables = [table[fold * self.book.slots :] for table in self.tables]
        for some in range(0, len(code), 1 << 13):
            part = slice(some, some + (1 << 13))
            bit, prefix = self.book.bits(code[part], length[part])
            slots = self.book.places(self.book.keys([c[part] for c in contexts]), length[part], prefix)
            cell = _deep(prefix) * np.int64(4**ORDERS * _LEVELS**ORDERS)
            for table, s, add in zip(tables, slots, self._adds):
                cell += add.take(table.take(s))
            cell <<= 1
            cell += bit
            np.add.at(self.met[kind], cell, np.repeat(times[part], length[part]))


def _levels(read: np.ndarray) -> np.ndarray:
    """Level of the log-odds and the two bits of :func:`predictions`."""
    half = np.int16(160 * (_LEVELS // 2) + 80)
    return ((read >> 2) + half) // np.int16(160) * np.int16(4) + (read & np.int16(3))


def fitted(met: np.ndarray) -> Mixer:
    """The mixer whose weights, then map, give the bits of ``met`` (one row of
    :class:`MixerInputs`) the highest likelihood; a little weight holds what is
    met seldom to the start."""
    mixer, bits = Mixer(), met.reshape(-1, 2) / _UNIT
    some = np.flatnonzero(bits.sum(axis=1))
    zeros, ones = bits[some].T
    gate = some // _LEVELS**ORDERS
    x = [(some // _LEVELS ** (ORDERS - 1 - k) % _LEVELS - _LEVELS // 2) / 4 for k in range(ORDERS)]
    inputs = np.stack([*x, np.ones(len(some))], axis=1)
    weights = mixer.weights.astype(np.float64)
    slot = np.tile(np.arange(ORDERS + 1), (len(some), 1))
    weights = _likeliest(gate, slot, inputs, zeros, ones, weights, np.zeros(len(some)))
    place = np.clip((weights[gate] * inputs).sum(axis=1), -11.9, 11.9) + 12
    knot = place.astype(np.int64)
    part = place - knot
    deep = gate // 4**ORDERS
    knots = mixer.knots.astype(np.float64).reshape(_DEPTHS, _KNOTS)
    between = np.stack((knot, knot + 1), axis=1)
    knots = _likeliest(deep, between, 0.5 * np.stack((1 - part, part), axis=1), zeros, ones, knots, 0.5 * (place - 12))
    return Mixer(weights, knots.ravel())


def _likeliest(group, slot, inputs, zeros, ones, start, offset, rounds: int = 40) -> np.ndarray:
    """Logistic regressions, one per row of ``start``, on cells of ``group``
    with ``zeros`` and ``ones``: Newton's method with bounded steps. A cell's
    log-odds are ``offset`` and ``inputs`` times the entries ``slot`` of its
    group's row; a distance from ``start`` of one costs half a bit or so."""
    groups, width = start.shape
    at, w = group[:, None] * width + slot, start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(offset + (w.ravel()[at] * inputs).sum(axis=1))))
        error = ones - (zeros + ones) * p
        slope = np.bincount(at.ravel(), (error[:, None] * inputs).ravel(), groups * width).reshape(groups, width) - (w - start)
        bend = np.tile(np.eye(width), (groups, 1, 1))
        sharp = (zeros + ones) * p * (1 - p)
        for i in range(slot.shape[1]):
            for j in range(slot.shape[1]):
                bend += np.bincount(at[:, i] * width + slot[:, j], sharp * inputs[:, i] * inputs[:, j], groups * width * width).reshape(bend.shape)
        move = np.linalg.solve(bend, slope[:, :, None])[:, :, 0]
        w += np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return w


def learned_mixers(docs: DataFrame, tables, book) -> tuple[Mixer, Mixer]:
    """Mixers of words and spelling, fitted to all decisions in ``docs``
    (``text, fold``) with the ``tables`` of the other fold. ``book``: broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast([_levels(x) for x in tables])

    def run(batches):
        import pyarrow as pa

        inputs = MixerInputs(book.value, shared.value)
        for b in batches:
            state, folds = {}, b.column("fold").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, _, data, cut, ended in segments(*raw_texts(b.column("text"))):
                t = Tokens(data, cut, ended)
                ctx = Contexts(t, book.value, state.pop(i, (0, 0)))
                state[i] = ctx.state
                inputs.add(t, ctx, folds[t.text + i])
        met = inputs.close()
        for kind in (0, 1):
            some = np.flatnonzero(met[kind])
            yield pa.RecordBatch.from_arrays([pa.array(some + kind * _INPUTS, pa.int64()), pa.array(met[kind, some], pa.int64())], names=["input", "times"])

    met = np.zeros(2 * _INPUTS, np.int64)
    got = docs.select("text", "fold").mapInArrow(run, "input long, times long").groupBy("input").agg(F.sum("times").alias("times")).toPandas()
    met[got["input"].to_numpy(np.int64)] = got["times"].to_numpy(np.int64)  # 2 * _INPUTS rows at most
    shared.destroy()
    return fitted(met[:_INPUTS]), fitted(met[_INPUTS:])


def train(docs: DataFrame, frequent: int = 1 << 24, most_slots: int = 1 << 21, sample_docs: int | None = None):
    """The model of ``docs`` (``text, key``, key a hash of the row), its book
    as a broadcast, and the stored counts of its tokens. Weights are fitted to
    all documents, unless ``sample_docs`` asks for about so many only."""
    counts = written(token_counts(docs), "token-counts")
    book = code_book(counts, frequent, most_slots)
    docs = docs.select("text", "key", F.col("key").bitwiseAND(1).cast("int").alias("fold"))
    shared = docs.sparkSession.sparkContext.broadcast(book)
    tables, others = bit_tables(docs, book, shared)
    fit = docs if sample_docs is None else docs.where(unit_hash(F.col("key")) < sample_docs / max(book.texts, 1))
    return Scorer(book, tables, *learned_mixers(fit, others, shared)), shared, counts


def score_documents(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: :data:`RESULT`."""
    spark = prepare(docs.sparkSession)
    held = (fold() == 2).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", held, "text")
    training = rows.where("NOT held_out").select("text", F.xxhash64("doc_id", "text").alias("key"))
    scorer, shared_book, counts = train(training, **settings)
    book = scorer.book
    shared = spark.sparkContext.broadcast(scorer)
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long, words array<long>, times array<long>"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        import pyarrow as pa

        model, row = shared.value.using(shared_book.value), TaskContext.get().partitionId() << 40
        known_log = np.log10(model.book.count + 1.0)

        for b in batches:
            data, cut = raw_texts(b.column("text"))
            n = b.num_rows
            tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, cost = np.zeros(n), np.zeros(n)
            rare = [[] for _ in range(3)]
            carried = None
            for i, j, part, bounds, ended in segments(data, cut, _SCORED):
                t = Tokens(part, bounds, ended)
                if carried is None or carried[0] != i:
                    carried = (i, model.fresh(j - i), (0, 0), 0)
                ctx = Contexts(t, model.book, carried[2])
                cost[i:j] += model.score(t, ctx, carried[1], carried[3])
                carried = (i, carried[1], ctx.state, carried[3] + len(t.h))
                tokens[i:j] += t.count
                own = ctx.rank >= 0
                seen = own & (model.book.count[np.maximum(ctx.rank, 0)] > 0)
                known[i:j] += np.bincount(t.text[seen], minlength=j - i)
                base[i:j] += np.bincount(t.text[own], weights=known_log[ctx.rank[own]], minlength=j - i)
                h, d = t.h[~own], t.text[~own] + i
                order = np.lexsort((h, d))
                h, d = h[order], d[order]
                first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))) if len(h) else np.zeros(0, bool))
                for x, y in zip(rare, (d[first], h[first], np.diff(np.append(first, len(h))))):
                    x.append(y)
            d, h, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in rare)
            off = pa.array(np.concatenate(([0], np.cumsum(np.bincount(d, minlength=n)))), pa.int32())
            lists = [pa.ListArray.from_arrays(off, pa.array(x, pa.int64())) for x in (h, times)]
            cols = [pa.array(np.arange(row, row + n)), b.column("doc_id"), b.column("held_out"), pa.array(tokens), pa.array(known), pa.array(base), pa.array(-cost / math.log(10)), pa.array(np.diff(cut))]
            row += n
            yield pa.RecordBatch.from_arrays([*cols, *lists], names=names)

    scored = written(rows.mapInArrow(run, schema), "lm-scores")
    shared.destroy()
    shared_book.destroy()
    rest = (
        scored.where(F.size("words") > 0)
        .select("row", F.explode(F.arrays_zip("words", "times")).alias("x"))
        .select("row", F.col("x.words").alias("h"), F.col("x.times").alias("times"))
        .join(counts.where("kind = 0").select("h", "c"), "h")
        .groupBy("row")
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_base"))
    )
    all_tokens = math.log10(book.n + book.v + 1)
    zero = F.lit(0)
    return scored.drop("words", "times").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(book.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * all_tokens).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
