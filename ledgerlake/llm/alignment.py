"""Cross-tokenizer alignment: where two public vocabularies cut the same text.

Vocabulary A is a byte-level BPE read on ``" " + text``; vocabulary B is a
piece model that puts the space in front by itself. Offsets where a token of
both ends cut the tokens into groups; the tokens that end there are linked.

1. Documents are shuffled by their full text and counted: each distinct text
   is tokenised and aligned once, copies only raise its multiplicity.
2. The aligned texts (numbers, digest, distinct linked id pairs with how often
   each occurs) are stored. Pair counts over the corpus weigh each text's
   pairs by its multiplicity, summed per task before the shuffle.
3. Pairs that hold more than one ``1 / frequent`` of all links are fewer than
   ``frequent``, so their counts go to every task; the others meet their
   counts in a join (none of them is hot).
4. The measures are joined to the documents by the text's SHA-256. A text with
   very many copies is dealt over tasks.

Special and control strings inside texts are plain text for both vocabularies.
Long texts are read part by part: a part starts at a single space between two
other characters, where neither vocabulary has a token that spans it.

Defined cases: null and empty text, and a text that B does not give back byte
for byte (it holds U+2581), have no tokens: zeros and an empty digest column;
every row of ``documents`` has a result row, repeated rows and null ids
included; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import Tokens
from ledgerlake.llm.common import prepare, spread_join, written
from ledgerlake.llm.spans import EDGE, Batch, chunks

_PART = 1 << 19
_CUT = re.compile(r"(?<=\S)(?= \S)")
_MARK = "\u2581"
ALIGNED = "key binary, c long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def default_paths() -> tuple[str, str]:
    """(rank file of A, model file of B)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


class Pieces(Tokens):
    """Worker-side piece model on texts that start with a space: runs of
    spaces with the word that follows are encoded apart and kept, as no piece
    holds a space after another character. A unit that does not come back
    byte for byte has the id -1."""

    def __init__(self, model_path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = self._model.get_piece_size()
        names = [self._model.id_to_piece(i) for i in range(n)]
        odd = [self._model.is_control(i) or self._model.is_unknown(i) for i in range(n)]
        self.bytes = [
            b"" if odd[i] else bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace(_MARK, " ").encode()
            for i, p in enumerate(names)
        ]
        self._apart = not any(_MARK in p.lstrip(_MARK) for p, x in zip(names, odd) if not x)
        self._lead = len(self._model.encode("x"))
        self._json = None
        self._reset()

    def _starts(self, b: Batch) -> np.ndarray:
        edge = b.kind == EDGE
        flag = edge.copy()
        flag[1:] |= edge[:-1]
        if self._apart:
            space = b.cp == 0x20
            flag[1:] |= space[1:] & ~space[:-1]
        flag[:1] = True
        return flag

    def _units(self, units: list[str]) -> list[list[int]]:
        if self._apart:  # behind "x", so that a unit of spaces keeps them all
            ids = [x[self._lead :] for x in self._model.encode(["x" + u for u in units], num_threads=1)]
        else:
            ids = self._model.encode([u[1:] for u in units], num_threads=1)
        if b"".join([self.bytes[i] for x in ids for i in x]) == "".join(units).encode():
            return ids
        return [x if b"".join([self.bytes[i] for i in x]) == u.encode() else [-1] for x, u in zip(ids, units)]


@lru_cache(maxsize=2)
def _tools(a_path: str, b_path: str):
    """A worker's tokenisers and the byte lengths of their tokens."""
    import base64

    a, b = Tokens(a_path), Pieces(b_path)
    with open(a_path, "rb") as f:
        ranks = {int(i): len(base64.b64decode(t)) for t, i in map(bytes.split, f)}
    len_a = np.zeros(max(ranks) + 1, np.int64)
    len_a[list(ranks)] = list(ranks.values())
    return a, b, len_a, np.array([len(x) for x in b.bytes], np.int64)


@lru_cache(maxsize=2)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1 as bytes, right-aligned, and which count."""
    width = len(str(n))
    power = 10 ** np.arange(width - 1, -1, -1, dtype=np.int64)
    i = np.arange(n, dtype=np.int64)[:, None]
    shown = i >= power
    shown[:, -1] = True
    return (i // power % 10 + 48).astype(np.uint8), shown


def group_text(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of tokens whose group ends are flagged, as bytes with
    a ``;`` behind every group, and the byte offset behind each group."""
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    upto_a, upto_b = np.flatnonzero(ends_a) + 1, np.flatnonzero(ends_b) + 1
    n = len(a) + len(b)
    at_a = np.arange(len(a)) + np.concatenate(([0], upto_b))[group_a]
    at_b = np.arange(len(b)) + upto_a[group_b]
    ids, mark = np.empty(n, np.int64), np.empty(n, np.uint8)
    ids[at_a], ids[at_b] = a, b
    mark[at_a] = np.where(ends_a, ord("|"), ord(","))
    mark[at_b] = np.where(ends_b, ord(";"), ord(","))
    digits, shown = _digits(1 << int(ids.max(initial=1)).bit_length())
    text = np.concatenate((digits[ids], mark[:, None]), axis=1)
    keep = np.concatenate((shown[ids], np.ones((n, 1), bool)), axis=1)
    ends = np.cumsum(keep.sum(axis=1))
    return text[keep], ends[upto_a + upto_b - 1]


def parts(text: str, size: int = _PART) -> list[str]:
    """A text cut into parts of about ``size`` characters at single spaces
    between two non-space characters; the first part gets its leading space."""
    text, out = " " + text, []
    while len(text) > size:
        cut = _CUT.search(text, size)
        if cut is None:
            break
        out.append(text[: cut.start()])
        text = text[cut.start() :]
    return [*out, text]


def align_parts(texts: list[str], a_path: str, b_path: str, base: int) -> list[tuple | None]:
    """(n_a, n_b, n_groups, group text, pairs, times) of each part, None where
    B does not give it back; a pair is ``a * base + b``."""
    tok_a, tok_b, len_a, len_b = _tools(a_path, b_path)
    ids_b = tok_b.batch(texts)
    good = [k for k, x in enumerate(ids_b) if len(x) and x.min() >= 0]
    out: list[tuple | None] = [None] * len(texts)
    if not good:
        return out
    ids_a = tok_a.batch([texts[k] for k in good])
    ids_b = [ids_b[k] for k in good]
    a, b = np.concatenate(ids_a).astype(np.int64), np.concatenate(ids_b).astype(np.int64)
    ends_a, ends_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
    here = np.zeros(ends_a[-1] + 1, np.uint8)
    here[ends_a] = 1
    here[ends_b] += 2
    last_a, last_b = here[ends_a] == 3, here[ends_b] == 3
    text, upto = group_text(a, b, last_a, last_b)
    pair = a[last_a] * base + b[last_b]
    cut_a = np.cumsum([0, *map(len, ids_a)])
    cut = np.concatenate(([0], np.cumsum(last_a)))[cut_a]  # first group of each part
    byte = np.concatenate(([0], upto))[cut]
    part = np.repeat(np.arange(len(good)), np.diff(cut))
    order = np.lexsort((pair, part))
    p, q = pair[order], part[order]
    first = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (q[1:] != q[:-1]))))
    times = np.diff(np.append(first, len(p)))
    at = np.searchsorted(q[first], np.arange(len(good) + 1))
    for n, k in enumerate(good):
        lo, hi = at[n], at[n + 1]
        out[k] = (len(ids_a[n]), len(ids_b[n]), int(cut[n + 1] - cut[n]), text[byte[n] : byte[n + 1]], p[first[lo:hi]], times[lo:hi])
    return out


def align_texts(texts: list[str], a_path: str, b_path: str, base: int = 1 << 20) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, digest, pairs, times) of whole texts."""
    pieces = [(k, x) for k, t in enumerate(texts) for x in ([] if not t or _MARK in t else parts(t))]
    got: dict[int, list] = {}
    for i, j in chunks([x for _, x in pieces], _PART):
        for (k, _), r in zip(pieces[i:j], align_parts([x for _, x in pieces[i:j]], a_path, b_path, base)):
            if r is None:
                got[k] = None
                continue
            old = got.setdefault(k, [0, 0, 0, hashlib.sha256(), [], []])
            if old is None:
                continue
            for x in range(3):
                old[x] += r[x]
            # the ";" behind a part's last group is due once another part follows
            old[3].update((b";" if old[4] else b"") + r[3][:-1].tobytes())
            old[4].append(r[4])
            old[5].append(r[5])
    out, none = [], np.zeros(0, np.int64)
    for k in range(len(texts)):
        r = got.get(k)
        if r is None:
            out.append((0, 0, 0, 0, "", none, none))
            continue
        pairs, times = r[4][0], r[5][0]
        if len(r[4]) > 1:
            pairs, back = np.unique(np.concatenate(r[4]), return_inverse=True)
            times = np.bincount(back, weights=np.concatenate(r[5])).astype(np.int64)
        out.append((r[0], r[1], r[2], r[2], r[3].hexdigest(), pairs, times))
    return out


def aligned_texts(docs: DataFrame, paths: tuple[str, str], base: int) -> DataFrame:
    """One row per distinct non-empty text of ``docs``: :data:`ALIGNED`."""
    a_path, b_path = paths
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def run(batches):
        import pyarrow as pa

        def lists(arrays):
            off = np.cumsum([0, *map(len, arrays)])
            return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(np.int64)))

        for batch in batches:
            all_texts, copies = batch.column("text").to_pylist(), batch.column("c").to_pylist()
            for i, j in chunks(all_texts, 4 * _PART):
                texts = all_texts[i:j]
                cols = list(zip(*align_texts(texts, a_path, b_path, base)))
                keys = [hashlib.sha256(t.encode()).digest() for t in texts]
                arrays = [pa.array(keys, pa.binary()), pa.array(copies[i:j], pa.int64())]
                arrays += [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.string())]
                yield pa.RecordBatch.from_arrays([*arrays, lists(cols[5]), lists(cols[6])], names=names)

    distinct = docs.where("text IS NOT NULL AND text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("c"))
    return distinct.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n``: corpus-wide links of each id pair, copies counted."""

    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def total():
            pair, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return pair, np.bincount(back, weights=np.concatenate([y for _, y in held])).astype(np.int64)

        def rows(pair, n):
            return pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

        for b in batches:
            pairs, times = b.column("pairs"), b.column("times")
            each = np.diff(pairs.offsets.to_numpy())
            held.append((pairs.flatten().to_numpy(), times.flatten().to_numpy() * np.repeat(b.column("c").to_numpy(), each)))
            size += int(each.sum())
            if size > 1 << 22:
                held = [total()]
                size = len(held[0][0])
                if size > 1 << 21:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*total())

    return aligned.select("c", "pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None, frequent: int = 1 << 20) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row of ``docs`` (columns ``doc_id``, ``text``)."""
    spark = prepare(docs.sparkSession)
    paths = paths or default_paths()
    base = 1 << 20  # more than any id of B
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = written(aligned_texts(source.select("text"), paths, base), "aligned")
    counts = written(pair_counts(aligned), "pair-counts")
    links = counts.agg(F.sum("n")).first()[0] or 0
    # more than links / frequent each, so fewer than ``frequent`` rows
    top = counts.where(F.col("n") * frequent > links).toPandas().sort_values("pair")
    # at most one row per id of B
    best = counts.groupBy((F.col("pair") % base).alias("b")).agg(F.max("n").alias("n")).toPandas()
    most = np.zeros(int(best["b"].max()) + 1 if len(best) else 1, np.int64)
    most[best["b"].to_numpy(np.int64)] = best["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), most))
    slim = [x for x in aligned.columns if x not in ("pairs", "times")]

    def run(batches):
        import pyarrow as pa

        pair, n, most = shared.value
        for b in batches:
            pairs, times = b.column("pairs").flatten().to_numpy(), b.column("times").flatten().to_numpy()
            off = np.diff(b.column("pairs").offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), off)
            at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            known = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            c = np.zeros(len(pairs), np.int64)
            c[known] = n[at[known]]
            sums = [np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)]
            np.add.at(sums[0], row[known], (times * (c == most[pairs % base]))[known])
            np.add.at(sums[1], row[known], (times * c)[known])
            rest = ~known
            cut = np.concatenate(([0], np.cumsum(np.bincount(row[rest], minlength=b.num_rows))))
            rare = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x[rest])) for x in (pairs, times)]
            cols = [b.column(x) for x in slim] + [pa.array(x) for x in sums] + rare
            yield pa.RecordBatch.from_arrays(cols, names=[*slim, "n_best", "count_sum", "pairs", "times"])

    schema = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    schema = schema.select(*slim, "n_best", "count_sum", "pairs", "times").schema
    measured = written(aligned.mapInArrow(run, schema), "aligned-measures")
    rare = measured.where(F.size("pairs") > 0).select("key", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rare = rare.select("key", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    most_of = F.broadcast(spark.createDataFrame(best.astype("int64"), "b long, n long").withColumnRenamed("n", "most"))
    rest = (
        rare.join(counts, "pair")
        .join(most_of, F.col("pair") % base == F.col("b"))
        .groupBy("key")
        .agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    )
    per_text = measured.drop("pairs", "times").join(rest, "key", "left").select(
        "key", "c", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
    keyed = source.where("text IS NOT NULL AND text <> ''").select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    out = spread_join(keyed, per_text, ["key"], keyed.count(), measured.select("key", "c")).drop("key")
    zero = F.lit(0).cast("long")
    bare = source.where("text IS NULL OR text = ''").select("doc_id", *[zero.alias(x) for x in MEASURES], F.lit("").alias("groups_sha256"))
    return out.unionByName(bare).select("doc_id", *MEASURES, "groups_sha256")
