"""The pipeline's five stages, chained, against plain Python on a fixture; and
the language model's prediction against exact kernel ridge regression."""

import os
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from ledgerlake.llm import bpe, language_id
from ledgerlake.llm.common import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def _line(rng, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(4, 12)))


@pytest.fixture(scope="module")
def corpus(session, tmp_path_factory):
    rng = random.Random(21)
    kinds = {"aa": "abcdefg", "bb": "stuvwxyz", "cc": "klmnopq"}
    texts, langs = [], []
    for i in range(150):
        lang = list(kinds)[i % 3]
        texts.append("\n".join(_line(rng, kinds[lang]) for _ in range(rng.randint(1, 6))))
        langs.append(lang if i % 4 else None)
    for i in range(0, 40, 2):  # near copies, copies, lines of others with one edit
        other = texts[i]
        texts += [other + " tail", other, other.split("\n")[0][:-1] + "\n" + _line(rng, kinds[list(kinds)[i % 3]])]
        langs += [langs[i], None, langs[i]]
    texts += [None, "", "123 456 !", " \n ", "a" * 3000]
    langs += ["aa", "bb", None, None, "aa"]
    rows = [(i, t, x, ["s", "t", "t", "t", None][i % 5], len(t or ""), i * 7) for i, (t, x) in enumerate(zip(texts, langs))]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra int")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def _identified(session, rows):
    """The model's own labels and scores, text by text."""
    docs = session.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    taught = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = language_id.fit(docs.where(docs.doc_id.isin([r[0] for r in taught])).select("text", "lang"))
    slot = model.slots()
    out = []
    for r in rows:
        label, score = model.predict([r[1] or ""], slot)
        if label[0] != language_id.UNKNOWN and score[0] >= 0.05:
            out.append(r)
    return out


def _without_lines(rows):
    first = {}
    for r in sorted(rows):
        for pos, line in enumerate(r[1].split("\n")):
            if line.strip(" "):
                first.setdefault(line, (r[0], pos))
    near = {a for a, x in first.items() if len(a) >= 20 for b, y in first.items() if len(b) >= 20 and y < x and _one_edit(a, b)}
    out = []
    for r in rows:
        kept = [x for pos, x in enumerate(r[1].split("\n")) if not x.strip(" ") or (x not in near and first[x] == (r[0], pos))]
        text = "\n".join(kept)
        if text.strip():
            out.append((r[0], text, *r[2:4], len(text), *r[5:]))
    return out


def _first_of_groups(rows):
    sets = {}
    for r in rows:
        w = re.findall(r"[^\W_]+", r[1].lower())
        sets[r[0]] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [r for r in rows if find(r[0]) == r[0]]


def _targets(rows):
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(WORD.findall(r[1]))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight, goal, left = {s: k % 3 + 1 for k, s in enumerate(names)}, {}, set(names)
    while left:
        rest = sum(size.values()) - sum(goal.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 3 * size[s]]
        goal |= {s: 3 * size[s] for s in over} if over else share
        left = left - set(over) if over else set()
    return size, {s: int(goal[s] + 0.5) for s in names}


def test_stages_chained_equal_plain_python(session, corpus):
    folder, rows = corpus
    docs = session.read.parquet(f"{folder}/documents.parquet")
    wanted = rows
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (lambda r: _identified(session, r), _without_lines, _first_of_groups, None, None)):
        out = stage(session, docs, folder)
        got = [tuple(r) for r in out.collect()]
        if plain is not None:
            wanted = plain(wanted)
            assert out.columns == docs.columns and sorted(got, key=str) == sorted(wanted, key=str), name
        elif name == "mix_sources":
            size, goal = _targets(wanted)
            assert out.columns == docs.columns
            for source in size:
                mine = [r for r in got if r[3] == source]
                assert sum(len(WORD.findall(r[1])) for r in mine) == goal[source]
                whole = {r[0]: r[1] for r in wanted if r[3] == source}
                times = {i: sum(r[0] == i and r[1] == t for r in mine) for i, t in whole.items()}
                words = {i: len(WORD.findall(t)) for i, t in whole.items() if WORD.search(t)}
                cut = [r for r in mine if r[1] != whole[r[0]]]
                # whole epochs for all, one more for some, and one document cut
                assert len(cut) <= 1 and all(whole[r[0]].startswith(r[1]) for r in cut)
                assert {times[i] for i in words} <= {goal[source] // size[source], goal[source] // size[source] + 1}
            assert all(r[4] == len(r[1]) for r in got)
        else:
            tokens = bpe.tokens(*bpe.default_paths())
            pieces = []
            for r in docs.collect():
                ids = [*tokens.encode(r.text), 2]
                head = len(ids) % 1024 or min(len(ids), 1024)
                cuts = [0, *range(head, len(ids), 1024), len(ids)]
                pieces += [(r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == sorted(pieces)
            bins = {}
            for r in out.collect():
                bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
            for items in bins.values():
                at = 0
                for offset, length in sorted(items):
                    assert offset == at
                    at += length
                assert at <= 1024
            assert len(bins) <= 1.1 * sum(p[3] for p in pieces) / 1024 + 2
        path = f"{folder}/after-{name}"
        out.write.parquet(path) if name != "mix_sources" else session.createDataFrame(got, docs.schema).write.parquet(path)
        docs = session.read.parquet(path)
        if name == "mix_sources":
            wanted = got
    ran = corpus_pipeline.run(session, folder)
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in ran.collect()) == sorted((r.doc_id, r.piece, r.start, r.length) for r in docs.collect())


def test_run_leaves_only_its_result(session, corpus):
    folder, _ = corpus
    from ledgerlake.session import ensure_checkpoint_dir

    shared = ensure_checkpoint_dir(session).removeprefix("file:")
    before = set(os.listdir(shared))
    out = corpus_pipeline.run(session, folder)
    assert out.count() > 0
    new = {n for n in set(os.listdir(shared)) - before if not re.fullmatch(r"rdd-\d+", n)}
    assert len(new) == 1 and next(iter(new)).startswith("stage-best_fit_packing")


def test_prediction_equals_exact_kernel_ridge():
    """With every training text a landmark, the Nyström model is kernel ridge
    regression on the normalised presence kernel."""
    rng = random.Random(3)
    kinds = {"aa": "abcdef", "bb": "defghi", "cc": "ghiabc"}
    texts = [_line(rng, kinds[k]) for k in list(kinds) * 20]
    labels = list(kinds) * 20
    fresh = [_line(rng, kinds[k]) for k in list(kinds) * 10]
    ridge = 1e-2
    model = language_id.train(texts, labels, landmarks=len(texts), order=3, ridge=ridge)

    def grams(t):
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    known = set().union(*map(grams, texts))
    kernel = lambda a, b: len(grams(a) & grams(b) & known) / np.sqrt(len(grams(a) & known) * len(grams(b) & known))
    k = np.array([[kernel(a, b) for b in texts] for a in texts])
    y = np.array([[x == lang for lang in sorted(kinds)] for x in labels], float)
    dual = np.linalg.solve(k + ridge * len(texts) / np.linalg.matrix_rank(k, tol=1e-6 * np.linalg.norm(k, 2)) * np.eye(len(texts)), y)
    value = np.array([[kernel(a, b) for b in texts] for a in fresh]) @ dual
    got_label, got_score = model.predict(fresh, model.slots())
    assert [sorted(kinds)[i] for i in value.argmax(axis=1)] == list(got_label)
    assert np.allclose(np.clip(value.max(axis=1), 0, 1), got_score, atol=2e-3)
