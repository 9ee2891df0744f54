"""Whitening, language-model scoring and tokenizer alignment against brute
force, with nulls, odd values, long texts, repeated rows, empty tables and
clashing extra columns."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import alignment, lm_scoring, whitening
from ledgerlake.llm.common import prepare


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


# --- whitening --------------------------------------------------------------------


def test_inertia_counts_negative_eigenvalues():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(1, 40))
        a = rng.integers(-3, 4, (n, n)).astype(float)
        a = a + a.T
        if rng.random() < 0.3:
            np.fill_diagonal(a, 0)  # needs two-by-two pivots
        value = np.linalg.eigvalsh(a)
        if np.abs(value).min() > 1e-9:
            assert whitening.negatives(a) == int((value < 0).sum())


@pytest.mark.parametrize("kind", ["random", "equal", "one far", "low rank", "rising", "clustered", "falling"])
def test_contours_find_the_largest_eigenpairs(kind):
    rng = np.random.default_rng(1)
    turn, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    x = rng.standard_normal((40, 3))
    v = {
        "random": np.cov(rng.standard_normal((40, 300))),
        "equal": np.eye(40) * 3,
        "one far": np.diag([1e8] + [1.0] * 39),
        "low rank": x @ x.T,
        "rising": np.diag(np.arange(1.0, 41)),
        "clustered": turn @ np.diag(1 + 1e-9 * np.arange(40)) @ turn.T,
        "falling": turn @ np.diag(2.0 ** -np.arange(40)) @ turn.T,
    }[kind]
    v = (v + v.T) / 2
    parts = whitening.intervals(v, 8)
    pairs = [whitening.contour_eigenpairs(v, *p) for p in parts]
    assert sum(p[2] for p in parts) == sum(len(a) for a, _ in pairs) >= min(8, np.linalg.matrix_rank(v))
    found = np.sort(np.concatenate([a for a, _ in pairs]))[::-1][:8]
    want = np.linalg.eigvalsh(v)[::-1][: len(found)]
    assert np.allclose(found, want, rtol=1e-12, atol=1e-15 * want[0])
    for value, vector in pairs:
        assert np.linalg.norm(v @ vector - vector * value) < 1e-10 * want[0]


def _vectors(session, dim=12, n=300):
    rng = np.random.default_rng(3)
    spread = rng.standard_normal((dim, dim)) * np.linspace(0.02, 0.5, dim)
    rows = [(i, (rng.standard_normal(dim) @ spread).tolist()) for i in range(n)]
    rows += [rows[0]] * 100  # repeated rows
    odd = [None, [], [float("nan")] + [0.1] * (dim - 1), [float("-inf")] + [0.1] * (dim - 1), [None] + [0.1] * (dim - 1), [0.5], [1e30] + [0.1] * (dim - 1)]
    used = rows + [(None, rows[5][1])]
    return used, session.createDataFrame([(i, v, "x", 1) for i, v in used + [(1000 + k, v) for k, v in enumerate(odd)]], "vec_id long, embedding array<double>, component string, n int").repartition(4)


def test_whitening_equals_a_dense_solver(session):
    used, frame = _vectors(session)
    out = whitening.whiten(frame).toPandas()
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in used])
    n, total = len(x), x.sum(axis=0)
    z = x - total / n
    value, vector = np.linalg.eigh(z.T @ z / n)
    value, vector = value[::-1][:8], vector[:, ::-1][:, :8]
    want = z @ vector / np.sqrt(value)
    assert len(out) == 8 * n and set(out["n"]) == {n} and set(out["component"]) == set(range(1, 9))
    assert (out["identity_error"] <= 1e-10).all() and out["identity_error"].nunique() == 1
    wide = out[out["vec_id"].notna()].drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    at = [k for k, (i, _) in enumerate(used) if i is not None and k < 300]
    got = wide.loc[[used[k][0] for k in at]].to_numpy()
    sign = np.sign((got * want[at]).sum(axis=0))
    assert np.allclose(got * sign, want[at], atol=1e-9)
    share = out.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, value / np.trace(z.T @ z / n), rtol=1e-10)
    exact = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for (i, _), row in zip(used, x)}
    named = out[out["vec_id"].notna()]
    assert all(exact[int(i)] == int(t) == int(d) for i, t, d in zip(named["vec_id"], named["deviation_text"], named["deviation"]))


def test_whitening_of_few_or_equal_vectors(session):
    schema = "vec_id long, embedding array<float>"
    frame = lambda rows: session.createDataFrame(rows, schema)
    assert whitening.whiten(frame([])).count() == 0
    assert whitening.whiten(frame([(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    two = whitening.whiten(frame([(1, [0.5, 0.25]), (2, [0.0, 0.25]), (3, None)])).toPandas()
    assert two["component"].tolist() == [1, 1] and np.allclose(sorted(two["whitened"]), [-1, 1]) and np.allclose(two["explained"], 1)
    far = whitening.whiten(frame([(1, [3e9, 0.0]), (2, [-3e9, 1.0]), (3, [0.0, 0.5])])).toPandas()
    assert far["deviation"].isna().sum() == 2 and all(int(t) >= 0 for t in far["deviation_text"])
    assert (far["identity_error"] < 1e-6).all()


# --- language-model scoring -----------------------------------------------------------

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _tokens(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return [*WORD.findall(raw), None]


def test_tokens_and_segments_equal_a_regular_expression():
    rng = random.Random(2)
    texts = ["", " ", "a", "A b\tC\x0bd", "é Ü x", "x" * 500] + ["".join(rng.choice("aB é\n\t. ") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    cut = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids: dict = {}
    for size in (64, 1 << 12, 1 << 20):
        got = [[] for _ in texts]
        for i, j, part, bounds, ended in lm_scoring.segments(data, cut, size):
            t = lm_scoring.Tokens(part, bounds, ended)
            for h, text, a, b in zip(t.h.tolist(), t.text.tolist(), t.begin.tolist(), t.end.tolist()):
                word = None if h == lm_scoring.END_OF_TEXT else t.low[a:b].tobytes()
                assert ids.setdefault(word, h) == h
                got[i + text].append(word)
        assert got == [_tokens(t) for t in texts]
    assert len(set(ids.values())) == len(ids)


def test_code_words_are_a_prefix_code():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 100, 1000):
        counts = rng.zipf(1.3, n).astype(float)
        codes = [bin(c)[3:] for c in lm_scoring.code_words(counts).tolist()]
        assert all(len(c) <= 1 + max(1, math.ceil(math.log2(counts.sum() / k))) for c, k in zip(codes, counts))
        ranked = sorted(codes)
        assert not any(b.startswith(a) for a, b in zip(ranked, ranked[1:]))


def _prose(rng, n, tongue):
    return " ".join(rng.choice(tongue) for _ in range(n))


def _corpus(session, n=260):
    rng = random.Random(9)
    tongues = [[("".join(rng.choice(s) for _ in range(rng.randint(1, 3)))) for _ in range(150)] for s in (["ka", "to", "mi"], ["Br", "el", "sun"], ["é", "où", "ra"])]
    texts = [_prose(rng, rng.randint(5, 120), tongues[i % 3]) for i in range(n)]
    texts += [None, "", " \n\t ", "z" * 40000, "kato " * 9000, "UNSEEN-" + "q" * 30, texts[0], texts[0]]
    rows = [(i, t, 5, "x", 1.0) for i, t in enumerate(texts)] + [(3, texts[3], 5, "x", 1.0), (None, texts[4], 5, "x", 1.0), (None, None, 5, "x", 1.0)]
    return rows, session.createDataFrame(rows, "doc_id long, text string, n_tokens int, words string, score double")


def test_base_score_equals_brute_force_and_reruns_agree(session):
    rows, frame = _corpus(session)
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    c = Counter(w for i, t, *_ in rows if not held(i) for w in _tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted(
        (-1 if i is None else i, held(i), len(_tokens(t)), sum(c[w] > 0 for w in _tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in _tokens(t)), 6))
        for i, t, *_ in rows
    )
    results = []
    # a small book: tokens outside it meet their counts in the join
    for parts, frequent in ((3, 1 << 24), (3, 200), (7, 200)):
        got = lm_scoring.score_documents(frame.repartition(parts), frequent=frequent, most_slots=1 << 18, sample_docs=30).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score < 0 for r in got)
        assert all((r.bits_per_byte is None) == (r.n_tokens == 1 and r.bits_per_byte is None) for r in got)
        results.append(sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, round(r.score, 5)) for r in got))
    assert results[1] == results[2]  # no dependence on partitions or batches
    assert lm_scoring.score_documents(frame.limit(0)).count() == 0
    only_held = frame.where(frame.doc_id == next(i for i in range(20) if held(i)))
    alone = lm_scoring.score_documents(only_held).collect()
    assert [r.train_tokens for r in alone] == [0] and all(r.n_known == 0 and r.score < 0 for r in alone)


def _model(texts, least=2):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    cut = np.cumsum([0, *(len(t.encode()) for t in texts)])
    t = lm_scoring.Tokens(data, cut, np.ones(len(texts), np.int64))
    h, c = np.unique(t.h, return_counts=True)
    seen = np.bincount(t.low, minlength=257)[:257].astype(float)
    often = c >= least
    book = lm_scoring.Book(h[often], c[often], int(c.sum()), len(h), seen, 1 << 16)
    counts = lm_scoring.BitCounts(book)
    counts.add(t, lm_scoring.Contexts(t, book))
    tables = [lm_scoring.predictions(x[::2].astype(np.int64), x[1::2].astype(np.int64)) for x in counts.close()]
    return lm_scoring.Scorer(book, tables, lm_scoring.Mixer(), lm_scoring.Mixer())


def _cost(model, texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    cut = np.cumsum([0, *(len(t.encode()) for t in texts)])
    t = lm_scoring.Tokens(data, cut, np.ones(len(texts), np.int64))
    return model.score(t, lm_scoring.Contexts(t, model.book), model.fresh(len(texts)))


def test_probabilities_of_all_continuations_add_up_to_at_most_one():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    model = _model([_prose(rng, rng.choice([1, 1, 1, 5]), words) for _ in range(300)])
    # every text of one token of up to four letters, and the empty one
    every = [""] + ["".join(x) for n in (1, 2, 3, 4) for x in itertools.product("abcd", repeat=n)]
    total = np.exp(-_cost(model, every)).sum()
    assert 0.2 < total <= 1 + 1e-6
    # the same for the last token of texts that share all others
    lead = _prose(rng, 40, words)
    ends = -_cost(model, [lead + " " + w for w in every[1:]])
    assert np.exp(ends - ends.max()).sum() >= 1 and np.isfinite(ends).all()
    assert (ends < -_cost(model, [lead[: len(lead) // 2]])[0] + 10).all()


def test_bits_follow_a_scalar_rendering_of_the_mixer():
    """The vectorised cost of one text equals one decision after the other."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(80)]
    model = _model([_prose(rng, 30, words) for _ in range(40)])
    text = _prose(rng, 50, words + ["unseen", "eeeee"])
    data = np.frombuffer(text.encode(), np.uint8)
    t = lm_scoring.Tokens(data, np.array([0, len(data)]), np.ones(1, np.int64))
    ctx = lm_scoring.Contexts(t, model.book)
    blocks = lm_scoring.block_of(np.arange(len(t.h)))
    total = 0.0
    w = {k: (m.weights.astype(float).copy(), m.knots.astype(float).copy()) for k, m in (("word", model.words), ("byte", model.spelled))}
    for block in range(int(blocks.max()) + 1):
        some = np.flatnonzero(blocks == block)
        rare = some[ctx.rank[some] < 0]
        streams = [("word", ctx.word_decisions(some))]
        if len(rare):
            _, _, symbol, contexts = ctx.byte_decisions(rare)
            streams.append(("byte", model.book.expand(model.book.byte_code[symbol], contexts)))
        for kind, (_, bits, depth, slots) in streams:
            weights, knots = w[kind]
            sums, hits = np.zeros_like(weights), np.zeros(len(weights))
            pull, met = np.zeros_like(knots), np.zeros(len(knots))
            for i, bit in enumerate(bits.tolist()):
                deep = gate = min(int(depth[i]) >> 2, 3)
                x = []
                for k in range(lm_scoring.ORDERS):
                    read = int(model.tables[k][slots[k][i]])
                    x.append((read >> 2) / 640)
                    gate = gate * 4 + (read & 3)
                mixed = weights[gate, -1] + sum(a * b for a, b in zip(weights[gate], x))
                place = min(max(mixed, -11.9), 11.9) + 12
                knot = int(place)
                part, at = place - knot, deep * 25 + knot
                refined = knots[at] + (knots[at + 1] - knots[at]) * part
                p = 1 / (1 + math.exp(-0.5 * (place - 12 + refined)))
                total -= math.log(p if bit else 1 - p)
                sums[gate] += np.array([*x, 1.0]) * (bit - p)
                hits[gate] += 1
                pull[at + (part > 0.5)] += bit - p
                met[at + (part > 0.5)] += 1
            weights += lm_scoring.Mixer.rate * sums / np.sqrt(hits + 1)[:, None]
            knots += lm_scoring.Mixer.refine * pull / np.sqrt(met + 1)
    assert abs(_cost(model, [text])[0] - total) < 1e-3 * total


def test_model_is_learned_from_every_training_document(session):
    """Bit counts cover all texts, and weights are fitted to the decisions of
    all texts, each read with the bit counts of the other fold's."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(90)]
    rows = [(_prose(rng, rng.randint(1, 40), words), rng.randrange(-(1 << 63), 1 << 63)) for _ in range(150)] + [(None, 4), ("once met", 5)]
    docs = session.createDataFrame(rows, "text string, key long")
    model, book, _ = lm_scoring.train(docs.repartition(5), frequent=100, most_slots=1 << 16)
    assert model.book.n == sum(len(_tokens(t)) for t, _ in rows)

    def read(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        t = lm_scoring.Tokens(data, np.array([0, len(data)]), np.ones(1, np.int64))
        return t, lm_scoring.Contexts(t, model.book)

    counts = [lm_scoring.BitCounts(model.book) for _ in range(2)]
    for text, key in rows:
        counts[key & 1].add(*read(text))
    by_fold = [c.close().astype(np.int64) for c in counts]
    tables = [[lm_scoring.predictions(x[::2], x[1::2]) for x in c] for c in (by_fold[0] + by_fold[1], *by_fold)]
    assert all(np.array_equal(a, b) for a, b in zip(model.tables, tables[0]))

    met = np.zeros((2, lm_scoring._INPUTS))
    for text, key in rows:
        t, ctx = read(text)
        for i in range(len(t.h)):
            known = model.book.count[ctx.rank[i]] if ctx.rank[i] >= 0 else 0
            new = 1 / known if 0 < known <= lm_scoring.NOVEL and t.h[i] != lm_scoring.END_OF_TEXT else 0
            one = np.array([i])
            contexts = (ctx.topic[one], ctx.previous[one] + lm_scoring._APART)
            streams = [(0, 1, ctx.word_decisions(one))]
            if new:
                streams.append((0, new, model.book.expand(np.array([model.book.escape]), contexts)))
            if new or ctx.rank[i] < 0:
                _, _, symbol, spelled = ctx.byte_decisions(one)
                streams.append((1, new or 1, model.book.expand(model.book.byte_code[symbol], spelled)))
            for kind, share, (_, bits, depth, slots) in streams:
                for k, bit in enumerate(bits.tolist()):
                    seen = [int(table[s[k]]) for table, s in zip(tables[2 - (key & 1)], slots)]
                    cell = min(int(depth[k]) >> 2, 3)
                    for x in seen:
                        cell = cell * 4 + (x & 3)
                    for x in seen:
                        cell = cell * 97 + math.floor((x >> 2) / 160 + 0.5) + 48
                    met[kind, 2 * cell + bit] += share * lm_scoring._UNIT
    met = np.rint(met).astype(np.int64)
    assert met[0].sum() > 0 and met[1].sum() > 0
    for kind, mixer in enumerate((model.words, model.spelled)):
        want = lm_scoring.fitted(met[kind])
        assert np.allclose(mixer.weights, want.weights, atol=1e-4) and np.allclose(mixer.knots, want.knots, atol=1e-4)
        assert not np.allclose(mixer.weights, lm_scoring.Mixer().weights, atol=1e-2)
    book.destroy()


def test_model_beats_single_tokens_on_held_out_documents(session):
    docs = session.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = lm_scoring.score_documents(docs).where("held_out").selectExpr("sum(score)", "sum(base_score)", "count(*)").first()
    assert got[2] > 1000 and got[0] > 0.98 * got[1]  # scores are negative


def test_training_reads_the_documents_once_a_step(session):
    """Token counts, bit counts and weights: three readings."""
    rng = random.Random(13)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(50)]
    rows = [(_prose(rng, rng.randint(1, 20), words), rng.randrange(-(1 << 63), 1 << 63)) for _ in range(60)]
    read = session.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = session.createDataFrame(rows, "text string, key long").repartition(3).mapInArrow(count, "text string, key long")
    _, book, _ = lm_scoring.train(docs, most_slots=1 << 16)
    book.destroy()
    assert read.value == 3 * len(rows)


def test_first_bits_counted_apart_add_up_to_all_bits():
    rng = random.Random(14)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    model = _model([_prose(rng, 60, words) for _ in range(120)], least=1)
    assert max(c.bit_length() - 1 for c in model.book.code.tolist()) > lm_scoring._HEAD
    data = np.frombuffer(_prose(rng, 4000, words).encode(), np.uint8)
    t = lm_scoring.Tokens(data, np.array([0, len(data)]), np.ones(1, np.int64))
    ctx = lm_scoring.Contexts(t, model.book)
    counts = lm_scoring.BitCounts(model.book)
    counts._words.append(ctx.packed())
    got, want = counts.close(), np.zeros_like(counts.table)
    _, bit, _, slots = ctx.word_decisions(np.arange(len(t.h)))
    for k, s in enumerate(slots):
        np.add.at(want[k], 2 * s + bit, lm_scoring._UNIT)
    assert want.sum() > 0 and np.array_equal(got, want)


def test_score_does_not_depend_on_the_contexts_that_have_rows(monkeypatch):
    """Rows of frequent contexts hold what the tables hold."""
    rng = random.Random(15)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(2000)]
    texts = [_prose(rng, rng.randint(0, 200), words) for _ in range(40)] + ["", "never seen"]
    model = _model(texts)
    costs = []
    for near in (1024, 3, 0):
        monkeypatch.setattr(lm_scoring, "_NEAR", near)
        model._near = None
        costs.append(_cost(model, texts))
    assert np.allclose(costs[0], costs[1], rtol=1e-9) and np.allclose(costs[0], costs[2], rtol=1e-9)


# --- tokenizer alignment -----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as paths
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths.path("piece_bpe_32k.model"))
    with open(paths.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def align(text):
        """n_a, n_b, groups, links of one text by the two libraries alone."""
        none = (0, 0, [], Counter())
        if not text:
            return none
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a, raw_b = [ranks[i] for i in ids_a], [piece(i) for i in ids_b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return none
        ends_a, ends_b = np.cumsum([*map(len, raw_a)]).tolist(), np.cumsum([*map(len, raw_b)]).tolist()
        groups, low = [], 0
        for e in sorted(set(ends_a) & set(ends_b)):
            groups.append(tuple([i for i, x in zip(ids, ends) if low < x <= e] for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))))
            low = e
        at_b = {}
        for i, x in zip(ids_b, ends_b):
            at_b.setdefault(x, []).append(i)
        return len(ids_a), len(ids_b), groups, Counter((i, j) for i, x in zip(ids_a, ends_a) for j in at_b.get(x, []))

    return align


def _odd_texts():
    rng = random.Random(1)
    pool = "ab'sтé 1½\n\t .,!?  中<>▁x0A"
    texts = ["", None, " ", "  ", "a", "<s> <0x41> <|endoftext|> </s> <unk>", "x▁y", "hi  there\t\n x", " a ", "  b", "\0 a\0", "word " * 3000, "x" * 3000]
    return texts + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(120)]


@pytest.mark.parametrize("size", [1 << 19, 40])
def test_aligned_texts_equal_the_libraries(library, monkeypatch, size):
    monkeypatch.setattr(alignment, "_PART", size)
    monkeypatch.setattr(alignment.parts, "__defaults__", (size,))
    texts = _odd_texts()
    for text, got in zip(texts, alignment.align_texts(texts, *alignment.default_paths(), 1 << 20)):
        n_a, n_b, groups, links = library(text)
        digest = hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest() if groups else ""
        assert got[:5] == (n_a, n_b, len(groups), links.total(), digest), text
        assert {(p >> 20, p % (1 << 20)): n for p, n in zip(got[5].tolist(), got[6].tolist())} == dict(links)


@pytest.mark.parametrize("frequent", [1 << 20, 60])
def test_alignment_query_equals_brute_force(session, library, frequent):
    texts = _odd_texts()[:60]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)]
    rows += [(500 + i, "the same text again, many times", "x", 7) for i in range(300)]
    rows += [(3, texts[3], "x", 7), (None, texts[20], "x", 7), (None, None, "x", 7)]
    frame = session.createDataFrame(rows, "doc_id long, text string, key string, c int").repartition(4)
    each = [library(t) for _, t, *_ in rows]
    total: Counter = Counter()
    for r in each:
        total += r[3]
    best: dict = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    want = []
    for (i, *_), (n_a, n_b, groups, links) in zip(rows, each):
        digest = hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest() if groups else ""
        want.append((str(i), n_a, n_b, len(groups), links.total(), sum(n for p, n in links.items() if total[p] == best[p[1]]), sum(n * total[p] for p, n in links.items()), digest))
    got = alignment.align_documents(frame, frequent=frequent)
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == sorted(want)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert alignment.align_documents(frame.limit(0)).count() == 0
