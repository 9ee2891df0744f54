"""Training-data operators against brute force, with nulls, empty and long
texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import (
    bpe,
    chat_format,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    ordinal_quality,
    packing,
    training_order,
    vector_dedup,
    vector_search,
)
from ledgerlake.llm.common import components, prepare, spread_join

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, line string, rep long, task int"


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def _words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def make_docs(spark, rows=None):
    """Documents with every odd case; extra columns clash with working names."""
    rng = random.Random(5)
    if rows is None:
        base = [_words(rng, rng.randint(6, 60)) for _ in range(40)]
        near = [b + " tail" for b in base[:6]]
        lines = [base[0][:60] + "\n" + base[1], base[0][:59] + "\n" + base[2], "\n\n" + base[3] + "\n"]
        texts = [*base, *near, *lines, base[5], base[5], None, "", "   \n ", "ab", "word " * 30000, base[7].upper(), "12 345 !!", base[9][:30] + "x" + base[9][31:]]
        rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "c"][i % 4]) for i, t in enumerate(texts)]
        rows += [rows[3], rows[3], (None, base[11], "en", "a"), (None, None, None, None)]
    full = [(i, t, x, s, len(t or ""), 7, "k", "l", 1, 2) for i, t, x, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def docs(session):
    return make_docs(session).cache()


@pytest.fixture(scope="module")
def empty(session):
    return session.createDataFrame([], DOCS)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


# --- tokens ---------------------------------------------------------------------


ODD = ["", " ", "  ", "a  b", "a\n b", "\n\n", "x\n", " 's", "it's they'll 've''s 'st !'s\n's we'd", "été 12½ 　x  y", "<|endoftext|> hi",
       "'", "a'", "'re", "'r e", "🤔🤔 ok\t\tz  ", "I'LL 'Sx", "a\0b \0", "x'ś 'll's", "word " * 5000]


def test_batch_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    ranks, json_file = bpe.default_paths()
    whole = Tokenizer.from_file(json_file)
    rng = random.Random(1)
    pool = "ab'sтé 1½\n\t .,!?  中"
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    got = bpe.Tokens(ranks, json_file).batch(texts)
    assert [list(x) for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


# --- packing and training order ---------------------------------------------------


def test_packing_plan_is_complete_and_tight():
    rng = random.Random(3)
    for capacity in (10, 64, 1024):
        for _ in range(20):
            hist = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(rng.randint(1, 40))}
            runs, n = packing.packing_plan(hist, capacity)
            used, placed = {}, {}
            for size, rank, count, first, offset in runs.tolist():
                for k in range(count):
                    used.setdefault(first + k, []).append((offset, size))
                    placed.setdefault(size, []).append(rank + k)
            assert {s: sorted(r) for s, r in placed.items()} == {s: list(range(c)) for s, c in hist.items()}
            assert set(used) == set(range(n))
            for items in used.values():
                at = 0
                for offset, size in sorted(items):
                    assert offset == at
                    at += size
                assert at <= capacity
                assert sum(3 * s > capacity for _, s in items) <= 2
            sizes = sorted((s for s, c in hist.items() for _ in range(c)), reverse=True)
            bins = []
            for s in sizes:  # best-fit decreasing
                fit = [i for i, g in enumerate(bins) if g >= s]
                if fit:
                    bins[min(fit, key=lambda i: bins[i])] -= s
                else:
                    bins.append(capacity - s)
            assert n <= 1.05 * len(bins) + 1


def test_packed_documents(session, docs, empty):
    out = packing.pack_documents(docs).toPandas()
    ranks, json_file = bpe.default_paths()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(json_file)
    want = []
    for r in docs.collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [2]
        head = len(ids) % 1024 or min(len(ids), 1024)
        cuts = [0, *range(head, len(ids), 1024), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [tuple(None if x != x else int(x) for x in row) for row in out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    out = out.sort_values(["sequence_id", "offset"])
    assert (out["offset"] == out.groupby("sequence_id")["length"].cumsum() - out["length"]).all()
    assert out.groupby("sequence_id")["length"].sum().max() <= 1024
    assert packing.pack_documents(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    got = training_order.feistel(np.arange(n), n, key=9)
    assert sorted(got.tolist()) == list(range(n))
    if n > 50:
        assert got.tolist() != training_order.feistel(np.arange(n), n, key=10).tolist()


def test_training_order_round_trip(session, docs, empty, tmp_dir):
    path = f"{tmp_dir}/docs"
    docs.write.parquet(path)
    stored = session.read.parquet(path)
    out = training_order.training_order(stored, length=64, shard_rows=50).toPandas()
    assert out["intact"].all() and sorted(out["slot"]) == list(range(len(out)))
    assert (out["slot"] == out["shard"] * 50 + out["place"]).all()
    ranks, json_file = bpe.default_paths()
    want = []
    for r, ids in zip(rows := docs.collect(), bpe.Tokens(ranks, json_file).batch([r.text or "" for r in rows])):
        raw = np.append(ids, 2)
        want += [(-1 if r.doc_id is None else r.doc_id, k, s, zlib.crc32(raw[s : s + n].astype("<u4").tobytes())) for k, (s, n) in enumerate(packing.cut_points(len(raw), 64))]
    got = [(-1 if d != d or d is None else int(d), p, s, c) for d, p, s, c in out[["doc_id", "piece", "start", "ids_crc32"]].itertuples(index=False)]
    assert sorted(got) == sorted(want)
    assert training_order.training_order(empty).count() == 0


# --- lines ------------------------------------------------------------------------


def edit_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def test_line_dedup_equals_brute_force(session, docs, empty):
    rng = random.Random(8)
    pool = [_words(rng, 6) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            x = rng.choice(pool)
            at, kind = rng.randrange(len(x)), rng.randint(0, 4)
            lines.append({0: x, 1: x[:at] + "é" + x[at + 1 :], 2: x[:at] + x[at + 1 :], 3: x[:at] + "q" + x[at:], 4: rng.choice(["", " ", "short"])}[kind])
        rows.append((i, "\n".join(lines), "en", "a"))
    mixed = make_docs(session, rows + [(None, pool[0], "en", "a"), (60, None, None, None), rows[4]])
    for frame in (mixed, docs):
        seen = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in frame.collect() if r.text is not None})
        first = {}
        for none, i, text in seen:
            for pos, line in enumerate(text.split("\n")):
                if line.strip(" "):
                    first.setdefault(line, (none, i, text, pos))
        near = {a for a, x in first.items() if len(a) >= 20 for b, y in first.items() if len(b) >= 20 and y < x and edit_at_most_one(a, b)}
        want = []
        for r in frame.collect():
            if r.text is None:
                want.append((r.doc_id, None, 0))
                continue
            keep = [x for pos, x in enumerate(r.text.split("\n")) if not x.strip(" ") or (x not in near and first[x] == (r.doc_id is None, r.doc_id or 0, r.text, pos))]
            want.append((r.doc_id, "\n".join(keep), len(r.text.split("\n")) - len(keep)))
        got = [tuple(r) for r in line_dedup.dedup_lines(frame).select("doc_id", "text", "n_dropped").collect()]
        key = lambda r: tuple((x is not None, str(x)) for x in r)
        assert sorted(got, key=key) == sorted(want, key=key)
    assert line_dedup.dedup_lines(empty).count() == 0
    assert set(docs.columns) == set(line_dedup.drop_repeated_lines(docs).columns)


# --- n-gram Jaccard join -------------------------------------------------------------


def shingle_set(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(items, near):
    ids = sorted(items)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = dict.fromkeys(ids, 0)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if near(items[a], items[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (links[i], find(i)) for i in ids}


@pytest.mark.parametrize("chunk", [400_000, 1500])
def test_jaccard_join_equals_brute_force(session, docs, empty, chunk):
    rng = random.Random(4)
    base = [_words(rng, 40) for _ in range(12)]
    rows = []
    for i in range(90):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w) + ("!" if i % 7 == 0 else ""), "en", "a"))
    for frame in (make_docs(session, rows), docs):
        got = {r.doc_id: (r.n_links, r.component_id) for r in jaccard_join.jaccard_join(frame, chunk_shingles=chunk).collect() if r.doc_id is not None}
        sets = {r.doc_id: shingle_set(r.text) for r in frame.collect() if r.doc_id is not None}
        assert got == brute_groups(sets, lambda a, b: bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b))
    out = jaccard_join.jaccard_join(docs)
    assert out.where("doc_id IS NULL").count() == 2 and out.where("doc_id IS NULL AND NOT kept").count() == 0
    assert jaccard_join.drop_near_duplicates(docs).columns == docs.columns
    assert jaccard_join.jaccard_join(empty).count() == 0


@pytest.mark.parametrize("chunk", [400_000, 300])
def test_near_duplicates_of_one_id_with_different_texts(session, chunk):
    rng = random.Random(14)
    base = [_words(rng, 40) for _ in range(12)]
    rows = [(i, base[i], "a") for i in range(4)]
    # id 9: near copies of smaller ids, texts of its own, one of them in two writings
    rows += [(9, base[i] + " tail", "a") for i in range(4)] + [(9, base[i], "b") for i in range(4, 8)] + [(9, base[4].upper() + "!", "b")]
    rows += [(9, base[4], "b"), (9, "", "b"), (9, None, "b")]
    # other ids near to the texts of id 9, and texts of one id near to each other
    rows += [(20 + i, base[i] + " tail", "c") for i in range(4, 8)] + [(30, base[8], "c"), (30, base[8] + " tail", "c"), (30, base[9], "c")]
    rows += [(40, base[8] + " end", "d"), (40, base[10], "d")]
    frame = session.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = jaccard_join.drop_near_duplicates(frame, chunk_shingles=chunk).collect()
    assert len({tuple(r) for r in kept}) == len(kept) and {tuple(r) for r in kept} <= set(rows)
    group = {b.split()[0]: x for x, b in enumerate(base)}
    got = sorted((group[r.text.lower().split()[0]], r.doc_id) for r in kept if r.text)
    assert got == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 9), (5, 9), (6, 9), (7, 9), (8, 30), (9, 30), (10, 40)]
    assert {r.text for r in kept if not r.text} == {"", None}
    out = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in jaccard_join.jaccard_join(frame, chunk_shingles=chunk).collect()}
    assert out == {i: (1, i, True) for i in range(4)} | {9: (8, 9, True), 30: (4, 30, True), 40: (2, 40, True)} | {20 + i: (1, 9, False) for i in range(4, 8)}


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = jaccard_join.choose_bands(threshold, 0.99)
        assert bands * rows <= 128 and 1 - (1 - threshold**rows) ** bands >= 0.99


def test_spread_join_deals_a_hot_key_and_keeps_every_row(session):
    prepare(session)
    rows = session.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("m"))
    for given in (None, counts):
        got = spread_join(rows, counts, ["k"], 3000, given)
        assert got.columns == ["k", "x", "m"]
        assert sorted(tuple(r) for r in got.collect()) == sorted((-1, x, 0) if x % 3 == 0 else (x, x, x) for x in range(3000))
    none = spread_join(rows.where("false"), counts.where("false"), ["k"], 0)
    assert none.count() == 0


def test_components(session):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 202), (5, 5)] + [(300, 300 + i) for i in range(1, 60)]
    got = {r.node: r.component for r in components(session.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[100] == 0
    assert got[201] == got[202] == 200 and all(got[300 + i] == 300 for i in range(1, 60))
    assert components(session.createDataFrame([], "u long, v long")).count() == 0


def test_stages_keep_clashing_columns_and_collapse_repeated_rows(session):
    rng = random.Random(12)
    texts = [_words(rng, 30) for _ in range(6)]
    rows = [(i, t, 10 + i, 20 + i, f"p{i}", 0.25 * i) for i, t in enumerate(texts)]
    rows += [(6, texts[0], 1, 2, "p", 0.5), (7, texts[1] + "\n" + texts[2], 3, 4, "q", 0.5), rows[3], rows[3]]
    frame = session.createDataFrame(rows, "doc_id long, text string, n_dropped int, n_lines int, lang_pred string, score double")
    extra = ["n_dropped", "n_lines", "lang_pred", "score"]
    want = {r[0]: r[2:] for r in rows}
    cut = line_dedup.drop_repeated_lines(frame)
    assert cut.columns == frame.columns
    assert {r.doc_id: tuple(r[c] for c in extra) for r in cut.collect()} == {i: x for i, x in want.items() if i < 6}
    kept = jaccard_join.drop_near_duplicates(frame).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 3, 4, 5, 7]
    told = language_id.keep_identified(frame.withColumn("lang", F.lit("en")), min_score=0.0)
    assert {r.doc_id: tuple(r[c] for c in extra) for r in told.collect()} == want


# --- vectors ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(session):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 24))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(base)]
    for i in range(60, 240):
        rows.append((i, (base[i % 9] + rng.standard_normal(24) * rng.choice([0.02, 0.1, 0.2])).tolist(), "x"))
    rows += [(240 + i, base[3].tolist(), "x") for i in range(15)] + [(260, (base[3] * 4).tolist(), "x"), (261, None, "x"), (262, [], "x"), (263, [0.0] * 24, "x")]
    rows += [(264, [float("nan")] + [1.0] * 23, "x"), (265, [float("inf")] + [1.0] * 23, "x"), (266, [None] + [1.0] * 23, "x"), (None, base[0].tolist(), "x"), (267, [1.0, 2.0], "x"), (268, [2.0, 4.0], "x")]
    rows += [(300, base[5].tolist(), "x"), (350, base[6].tolist(), "x")]
    return session.createDataFrame(rows, "vec_id long, embedding array<float>, keys string")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    if len(a) != len(b):
        return -2.0
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


@pytest.mark.parametrize("chunk", [512, 8])
def test_near_vectors_equal_brute_force(session, vectors, chunk):
    good = {r.vec_id: r.embedding for r in vectors.collect() if r.vec_id is not None and usable(r.embedding)}
    want = brute_groups(good, lambda a, b: cosine(a, b) >= 0.95)
    rows = vector_dedup.near_vectors(vectors, chunk=chunk).collect()
    assert len(rows) == vectors.count()
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    assert {i: got[i] for i in want} == want
    assert all(got[i] == (0, i) for i in range(261, 267))
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows if r.vec_id is not None)
    assert vector_dedup.near_vectors(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [512, 4])
def test_near_vectors_of_one_id_with_different_vectors(session, chunk):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((8, 24))
    rows = [(9, v.tolist()) for v in base] + [(9, base[0].tolist())]
    rows += [(20 + i, (v + rng.standard_normal(24) * 0.01).tolist()) for i, v in enumerate(base)]
    rows += [(i, (base[i] + rng.standard_normal(24) * 0.01).tolist()) for i in (3, 5)] + [(40, rng.standard_normal(24).tolist()), (40, base[7].tolist())]
    frame = session.createDataFrame(rows, "vec_id long, embedding array<float>")
    near = [[cosine(a, b) >= 0.95 for _, b in rows] for _, a in rows]
    want = []
    for x, (i, _) in enumerate(rows):
        group, todo = {x}, [x]
        while todo:
            z = todo.pop()
            new = {y for y in range(len(rows)) if near[z][y]} - group
            group |= new
            todo += new
        least = min(rows[y][0] for y in group)
        want.append((i, sum(near[x]) - 1, least, i == least))
    assert sorted(tuple(r) for r in vector_dedup.near_vectors(frame, chunk=chunk).collect()) == sorted(want)


def test_search_recall_and_order(session, vectors):
    good = {r.vec_id: r.embedding for r in vectors.collect() if r.vec_id is not None and usable(r.embedding)}
    out = vector_search.search(vectors, vectors.vec_id % 50 == 0, part_rows=40, unit_pairs=200).toPandas()
    hits = total = 0
    for q in [i for i in good if i % 50 == 0]:
        mine = out[out["query_id"] == q].sort_values("rank")
        best = sorted(((-cosine(good[q], v), i) for i, v in good.items() if i != q and len(v) == len(good[q])))[:5]
        assert mine["rank"].tolist() == list(range(1, len(best) + 1))
        assert np.allclose(mine["score"], [cosine(good[q], good[i]) for i in mine["vec_id"]], atol=1e-12)
        assert mine.sort_values(["score", "vec_id"], ascending=[False, True])["rank"].tolist() == mine["rank"].tolist()
        hits += len({i for _, i in best} & set(mine["vec_id"]))
        total += len(best)
    assert hits >= 0.9 * total
    few = vector_search.search(vectors.where("vec_id IN (0, 1, 2)"), vectors.vec_id == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert vector_search.search(vectors.limit(0), vectors.vec_id % 50 == 0).count() == 0


def test_search_of_repeated_query_rows(session):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(40)]
    # one query row three times, a hot id of equal and different vectors
    rows += [rows[10]] * 2 + [rows[20]] * 30 + [(20, v) for v in rng.standard_normal((3, 8)).tolist()]
    frame = session.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = vector_search.search(frame, F.col("vec_id") % 10 == 0, part_rows=8, unit_pairs=100, recall=1.0, eps=50.0).collect()
    want = []
    for q, v in {(i, tuple(x)) for i, x in rows if i % 10 == 0}:
        best = sorted((-cosine(v, x), i) for i, x in rows if i != q)[:5]
        want += [(q, rank + 1, i, round(-c, 9)) for rank, (c, i) in enumerate(best)]
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in out) == sorted(want)


# --- chat -------------------------------------------------------------------------------


def test_escape_is_reversible():
    rng = random.Random(6)
    parts = chat_format.CONTROL + chat_format.FOREIGN + ["\\", "[", "<", "s>", "x", "/INST]", " "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        out = chat_format.escape(text)
        assert chat_format.unescape(out) == text
        assert not any(c in out for c in chat_format.CONTROL + chat_format.FOREIGN)


def test_chat_round_trip(session):
    rows = [(1, 0, "system", "be [INST] good\\"), (1, 1, "user", "é</s>"), (1, 2, "assistant", "<s>[/INST]🤔"), (1, 3, "assistant", "a"), (2, 0, None, None),
            (2, None, "tool", "x<|end|>"), (2, 1, "assistant", ""), (None, 0, "user", "q"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "user", "long " * 40000),
            (4, 1, "we[INST]ird\nrole", "<|endoftext|>"), (5, 0, "Assistant", "not masked")]
    frame = session.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, position int")
    got = {r.conv_id: r for r in chat_format.format_conversations(frame).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in mine)
        loss = "".join(x for _, _, r, x in mine if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256) == (len(mine), hashlib.sha256(text.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == sum(len(s) for _, _, r, x in mine for s, _, _ in chat_format.segments(r, x))
    turns = chat_format.format_turns(frame).orderBy("conv_id", "position").collect()
    at = {}
    for r in turns:
        assert r.token_start == at.get(r.conv_id, 0)
        at[r.conv_id] = r.token_start + len(r.input_ids)
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------


def test_mix_targets_and_cuts(session, docs, empty):
    rng = random.Random(7)
    rows = [(i, _words(rng, rng.randint(0, 30)), None, rng.choice(["a", "b", "b", "b", "b", "é", None, "z"])) for i in range(400)]
    for frame in (make_docs(session, rows), docs):
        out = mixing.mix(frame, slice_rows=10).collect()
        assert len(out) == frame.count()
        source = {}
        for r in frame.collect():
            source.setdefault(r.source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
        names = sorted(source, key=lambda s: (s is None, (s or "").encode()))
        weight = {s: k % 3 + 1 for k, s in enumerate(names)}
        total, goal, open_ = sum(map(sum, source.values())), {}, set(names)
        while open_:  # share, stop at three times the size, share the rest again
            left = total - sum(goal.values())
            share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            over = [s for s in open_ if share[s] > 3 * sum(source[s])]
            if not over:
                goal |= share
                break
            for s in over:
                goal[s] = 3 * sum(source[s])
                open_.discard(s)
        by_size = {}
        for r in out:
            assert 0 <= r.taken <= 3 * r.size
            by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
        want = sorted((sum(source[s]), round(goal[s], 6), round(goal[s])) for s in names)
        assert sorted((*k, sum(v)) for k, v in by_size.items()) == want or len(by_size) < len(want)
        assert abs(sum(r.taken for r in out) - total) <= len(names)
        again = mixing.mix(frame.repartition(5), slice_rows=10000).collect()
        assert sorted(map(str, again)) == sorted(map(str, out))
    assert mixing.mix(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_mixed_documents_hold_what_the_plan_takes(session, docs):
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    n = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect())
    assert n == mixing.mix(docs).agg({"taken": "sum"}).first()[0]
    assert all(r.n_chars == len(r.text) for r in mixed.collect())
    whole = {r.text for r in docs.collect() if r.text}
    assert all(any(t.startswith(r.text) for t in whole) for r in mixed.collect())


def test_mixed_documents_of_one_id_and_text_stay_with_their_source(session):
    rng = random.Random(9)
    texts = [_words(rng, 20) for _ in range(30)]
    rows = [(i if i % 3 else None, t, "en", s) for i, t in enumerate(texts) for s in ("a", "b", "", None)]
    frame = make_docs(session, rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want, got = {}, {}
    for r in mixing.targets(frame.select("source", mixing.words_in("text").alias("size")), 3).collect():
        want[r.source] = int(r.target + 0.5)
    for r in mixing.mix_documents(frame).collect():
        got[r.source] = got.get(r.source, 0) + size(r.text)
    assert got == want


# --- classifiers ------------------------------------------------------------------------


def test_kernel_matches_its_definition():
    texts = ["the cat", "the dog", "le chat", "xyz", "the cat and the dog"]
    model = language_id.train(texts, ["en", "en", "fr", "zz", "en"], order=3)

    def grams(t):
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    slot = model.slots()
    m, _ = language_id.presence(texts, 3, model.bits, slot, len(model.known))
    got = m @ m.T
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert got[i, j] == len(grams(a) & grams(b))


def test_language_id(session, docs, empty):
    rng = random.Random(9)
    kinds = {"aa": "abcde ", "bb": "uvwxy ", "cc": "mnopq "}
    rows = []
    for i in range(240):
        lang = rng.choice(list(kinds))
        rows.append((i, _words(rng, rng.randint(2, 30), kinds[lang].strip()), lang if i % 5 else None, "s"))
    out = language_id.language_id(make_docs(session, rows + [(240, None, "aa", "s"), (241, "12 !", "aa", "s"), (242, "", None, "s")])).collect()
    truth = {i: t for i, t, _, _ in rows}
    held = [r for r in out if r.held_out and r.doc_id < 240]
    right = sum(set(truth[r.doc_id]) - {" "} <= set(kinds[r.lang_pred]) for r in held)
    assert held and right >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id >= 240} == {"und"}
    odd = language_id.language_id(docs).collect()
    assert len(odd) == docs.count()
    assert language_id.keep_identified(docs).columns == docs.columns
    assert language_id.language_id(empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit(empty.select("text", "lang"))).collect()} == {"und"}


def test_ordinal_quality(session, docs, empty):
    rng = random.Random(10)
    texts, grades = [], []
    for i in range(600):
        g = i % 3
        t = _words(rng, 20) + {0: " vile nasty", 1: " ### $$$", 2: ""}[g]
        texts.append(t)
        grades.append(g)
    feats = ordinal_quality.features(texts, 18)
    model = ordinal_quality.train(feats[:400], np.array(grades[:400]), 3, 18)
    assert (np.diff(model.theta) > 0).all()
    tails = model.tails(feats[400:])
    assert (np.diff(tails, axis=1) <= 0).all()
    grade = (tails >= 0.5).sum(axis=1)
    assert (grade == np.array(grades[400:])).mean() > 0.95
    labels = session.createDataFrame([(i, i % 2, 1 if i % 7 == 0 else 0, "t") for i in range(40)] + [(None, 1, 1, "t"), (5, None, None, "t"), (6, 9, None, "t")], "doc_id long, quality int, toxic int, text string")
    fitted = ordinal_quality.fit(docs, ordinal_quality.graded(labels), 3)
    out = ordinal_quality.score(docs, fitted, 2).collect()
    assert len(out) == docs.count() and all(0 <= r.tail_prob <= 1 and 0 <= r.expected_grade <= 2 for r in out)
    none = ordinal_quality.fit(empty, ordinal_quality.graded(labels), 3)
    assert ordinal_quality.score(docs, none, 2).count() == docs.count()
    assert ordinal_quality.score(empty, fitted, 2).count() == 0
