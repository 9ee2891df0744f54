"""Hot and repeated rows that once met in one task, and results that once
depended on the order of rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard_join, mixing, ordinal_quality, training_order, vector_search
from ledgerlake.llm.common import prepare


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


# --- mixing -----------------------------------------------------------------------------


def test_null_ids_spread_over_the_slices(session):
    i = F.col("id")
    docs = session.range(0, 20000, 1, 4).select(
        F.when(i % 3 != 0, i).alias("doc_id"), F.concat_ws(" ", F.md5(i.cast("string")), F.lit("two words")).alias("text"), F.lit("s").alias("source")
    )
    place = F.conv(F.substring(mixing.order_key(), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    sizes = [r[1] for r in docs.groupBy(F.floor(place * 100).alias("slice")).count().collect()]
    assert len(sizes) == 100 and max(sizes) < 2 * np.median(sizes)


def test_identical_rows_are_one_before_the_window_and_many_after(session, monkeypatch):
    monkeypatch.setattr(mixing, "_AT_ONCE", 16)
    rng = random.Random(3)
    rows = [(100 + i, _words(rng, 5 + i % 7), "ab"[i % 2]) for i in range(50)] + [(7, "one hot text of words", "a")] * 100 + [(None, "no id", None)] * 40
    docs = session.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    hot = [r for r in out if r.doc_id == 7 and r.size == 5]
    assert len(hot) >= 100 and all(0 <= r.taken <= 3 * r.size for r in out)
    plan = mixing.mix_plan(docs).collect()
    assert sum(r.same for r in plan) == len(rows) and max(r.same for r in plan) == 100
    assert sum(r.taken for r in out) == sum(r.all_taken for r in plan)
    for goal in {(r.source_size, r.target) for r in out}:
        assert sum(r.taken for r in out if (r.source_size, r.target) == goal) == int(goal[1] + 0.5)
    # identical rows: whole copies first, one cut, the rest a round less
    steps = sorted({r.taken for r in hot})
    assert len(steps) <= 3
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixing.mix_documents(docs).collect())
    assert words == sum(r.taken for r in out)


# --- ordinal quality ---------------------------------------------------------------------


def test_one_model_whatever_the_order_of_rows(session):
    rng = random.Random(5)
    good, bad = ["clear", "useful", "precise", "sound"], ["spam", "junk", "click", "win"]
    rows, ratings = [], []
    for i in range(60):
        grade = i % 3
        pool = [good, good + bad, bad][2 - grade] if grade else bad
        rows += [(i, " ".join(rng.choice(pool) for _ in range(20))) for _ in range(3)]  # three texts of one id
        ratings.append((i, grade))
    models = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = session.createDataFrame(rows, "doc_id long, text string").repartition(seed + 1)
        models.append(ordinal_quality.fit(docs, session.createDataFrame(ratings, "doc_id long, grade int"), levels=3))
    for m in models[1:]:
        assert np.array_equal(m.weight, models[0].weight) and np.array_equal(m.theta, models[0].theta)


def test_fit_reaches_the_optimum_of_a_second_optimiser():
    """The penalised loss of the fit against slow projected subgradient steps
    on the same features, started from the fit and from zero."""
    rng = np.random.default_rng(4)
    n, width, l1 = 300, 12, 3e-3
    feats = [np.unique(rng.integers(0, width, 5)).astype(np.int32) for _ in range(n)]
    true = rng.standard_normal(width)
    z = np.array([true[f].sum() for f in feats]) + rng.logistic(size=n)
    grades = (z > -0.5).astype(int) + (z > 1)
    model = ordinal_quality.train(feats, grades, 3, bits=4, l1=l1, steps=2000)

    def loss(w, th):
        s = 1 / (1 + np.exp(th[None, :] - np.array([w[f].sum() for f in feats])[:, None]))
        tails = np.concatenate((np.ones((n, 1)), s, np.zeros((n, 1))), axis=1)
        return -np.log(tails[np.arange(n), grades] - tails[np.arange(n), grades + 1]).mean() + l1 * np.abs(w).sum()

    at = loss(model.weight, model.theta)
    # coordinate descent: no single weight or threshold can be moved for a gain
    best = at
    w, th = model.weight.copy(), model.theta.copy()
    for _ in range(3):
        for vector in (w, th):
            for k in range(len(vector)):
                for step in (0.3, 0.03, 0.003):
                    for sign in (1, -1):
                        vector[k] += sign * step
                        new = loss(w, th) if (np.diff(th) > 0).all() else np.inf
                        if new < best - 1e-12:
                            best = new
                        else:
                            vector[k] -= sign * step
    assert at - best < 2e-5


# --- Jaccard join ------------------------------------------------------------------------


def test_sharing_counts_a_pair_in_its_first_band():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 6, (40, 5)) + 10 * np.arange(5), rng.integers(0, 6, (30, 5)) + 10 * np.arange(5)
    same = a[:, None, :] == b[None, :, :]
    assert (jaccard_join.sharing(a, b) == same.any(axis=2)).all()
    first = np.where(same.any(axis=2), same.argmax(axis=2), -1)
    total = np.zeros((40, 30), int)
    for k in range(5):
        for key in np.unique(a[:, k]):
            got = jaccard_join.sharing(a, b, int(key))
            assert (got == ((first == k) & (a[:, k] == key)[:, None])).all()
            total += got
    assert (total == same.any(axis=2)).all()  # each pair once


def test_only_the_pairs_asked_for_are_compared():
    rng = np.random.default_rng(3)

    class Counted(list):
        reads = 0

        def __getitem__(self, k):
            Counted.reads += 1
            return super().__getitem__(k)

    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(50)]
    full = jaccard_join.linked(list(sets), None, 0.5)
    pairs = np.zeros((50, 50), bool)
    some = rng.integers(0, 50, (100, 2))
    pairs[some[:, 0], some[:, 1]] = pairs[some[:, 1], some[:, 0]] = True
    np.fill_diagonal(pairs, False)
    got = jaccard_join.linked(Counted(sets), None, 0.5, pairs)
    assert (got == (full & pairs)).all() and Counted.reads == pairs.sum()  # two sets a pair, each pair once
    cross = jaccard_join.linked(sets[:20], sets[20:], 0.5, pairs[:20, 20:])
    assert (cross == (full & pairs)[:20, 20:]).all()


@pytest.mark.parametrize("chunk", [400_000, 4_000])
def test_chains_of_overlapping_texts(session, chunk):
    """Each text shares a half with the next: bands percolate, links are rare.
    With small chunks the group is compared by its buckets."""
    rng = random.Random(11)
    words = _words(rng, 6000).split()
    rows = [(i, " ".join(words[i * 25 : i * 25 + 50])) for i in range(230)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(0, 230, 10)]
    rows += [(2000 + i, " ".join([*words[:60], str(i)])) for i in range(40)]  # a dense group besides
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    grams = {}
    for i, t in rows:
        w = t.lower().split()
        grams[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    links = {i: set() for i in grams}
    for i in grams:
        for j in grams:
            if i < j and 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j]):
                links[i].add(j)
                links[j].add(i)
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(docs, chunk_shingles=chunk).collect()}
    assert {i: got[i].n_links for i in got} == {i: len(x) for i, x in links.items()}
    for i in got:
        group, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        assert got[i].component_id == min(group)


# --- vector search -------------------------------------------------------------------------


def _true_share(found, rows, queries, k=5):
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hits = 0
    for q in queries:
        near = m @ m[q]
        near[q] = -2
        hits += len(set(np.argsort(-near, kind="stable")[:k].tolist()) & found[q])
    return hits / (k * len(queries))


@pytest.mark.parametrize("kind", ["clustered", "spread"])
def test_search_recall_and_probes(session, kind):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((60, 32))
    points = rng.standard_normal((4000, 32)) * (0.25 if kind == "clustered" else 1.0) + (centres[rng.integers(0, 60, 4000)] if kind == "clustered" else 0)
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    frame = session.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {}
    for r in vector_search.search(frame, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert _true_share(found, rows, range(0, 4000, 50)) >= 0.95
    unit = vector_search.unit(points)
    c = vector_search.centroids(unit, 63, 8, 5)
    probes = vector_search.probes_for(unit, c, 5, 0.97)
    assert probes <= 6 if kind == "clustered" else probes > 10


@pytest.mark.parametrize("n", [1000, 3000])
def test_each_vector_is_sent_once(session, n, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((n, 8)))]
    sent = []
    real = vector_search._units

    def counted(*args):
        out = real(*args)
        sent.append({r[0]: r[1] for r in out.groupBy("kind").count().collect()})
        return out

    monkeypatch.setattr(vector_search, "_units", counted)
    got = vector_search.search(session.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, unit_pairs=2000)
    assert got.count() == n // 50 * 5
    assert sent[0][0] == n  # whatever the number of queries and parts


# --- training order --------------------------------------------------------------------------


def test_shards_are_written_by_exact_ranges(session, tmp_path, monkeypatch):
    frame = type(session.range(0))
    seen, real = [], frame.repartitionById

    def watched(self, n, expr):
        out = real(self, n, expr)
        seen.append((n, {(r[0], r[1]) for r in out.select(F.spark_partition_id(), "shard").distinct().collect()}))
        return out

    monkeypatch.setattr(frame, "repartitionById", watched)
    session.createDataFrame([(i, "some words of a text " * (i % 9)) for i in range(400)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    total = training_order.write_shards(session.read.parquet(f"{tmp_path}/docs"), f"{tmp_path}/out", length=8, shard_rows=16, shards_per_task=3)
    (n, pairs), shards = seen[0], -(-total // 16)
    assert len(pairs) == shards and {s for _, s in pairs} == set(range(shards))
    assert all(p == s // -(-shards // n) for p, s in pairs)  # each task a range of whole shards
    back = training_order.read_shards(session, f"{tmp_path}/out", length=8, shard_rows=16)
    assert [r.slot for r in back.orderBy("slot").collect()] == list(range(total)) and back.where("NOT intact").count() == 0
