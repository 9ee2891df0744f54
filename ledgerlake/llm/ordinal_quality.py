"""Ordinal quality classifier: cumulative-link (proportional odds) regression.

Graded ratings share one weight vector over hashed text features, with ordered
thresholds: P(grade >= k) = sigmoid(w.x - theta_k). Expected grade and tail
probabilities follow, and a tail probability selects documents.

Features of a whole text are hashed and only say "present": each run of
letters, of digits and of other characters (lower case), and a few buckets of
document shape (share of distinct words, of capitals, of other characters).
Weights are fitted by accelerated proximal gradient with an L1 penalty on a
bounded sample of rated documents, so rare words get no weight and a long
text is not swamped by noise.

Defined cases: a null text is an empty one (no features: the grade of the
thresholds alone); null or unknown ratings teach nothing; repeated rows and
equal ratings of one document count once; with fewer than two grades in the
sample every document gets that grade; an empty table gives no row; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, unit_hash
from ledgerlake.llm.spans import EDGE, LETTER, OTHER, SPACE, Batch, chunks, mix


def features(texts: list[str], bits: int) -> list[np.ndarray]:
    """Sorted distinct hashed features of each whole text."""
    out: list[np.ndarray] = []
    for i, j in chunks(texts):
        raw = Batch.of(texts[i:j])
        lower = [t.lower() for t in texts[i:j]]
        b = Batch.of(lower)
        at, kind = b.runs()
        stop = np.append(at[1:], len(b.cp))
        real = (kind != SPACE) & (kind != EDGE)
        start, stop, kind = at[real], stop[real], kind[real]
        h = b.hashes(start, stop)
        first, end = np.searchsorted(start, b.first), np.searchsorted(start, b.end)
        capital = np.concatenate(([0], np.cumsum((raw.cp >= 65) & (raw.cp <= 90))))
        letter = np.concatenate(([0], np.cumsum(raw.kind == LETTER)))
        other = np.concatenate(([0], np.cumsum(raw.kind == OTHER)))
        for k in range(j - i):
            mine = np.unique(h[first[k] : end[k]])
            is_word = kind[first[k] : end[k]] == LETTER
            n = int(is_word.sum())
            lo, hi = raw.first[k], raw.end[k]
            letters = int(letter[hi] - letter[lo])
            shares = (
                len(np.unique(h[first[k] : end[k]][is_word])) / max(n, 1),
                (capital[hi] - capital[lo]) / max(letters, 1),
                (other[hi] - other[lo]) / max(hi - lo, 1),
            )
            depth = int(np.log2(n + 1))  # shape shares mean different things in short and long texts
            shape = [s << 16 | min(int(x * 10), 9) << 8 | d << 4 for s, x in enumerate(shares, 1) for d in (0, min(depth, 15))]
            mine = np.concatenate((mine, mix(np.array(shape, np.uint64))))
            out.append(np.unique((mine >> np.uint64(64 - bits)).astype(np.int32)))
    return out


@dataclass
class OrdinalModel:
    """``P(grade >= k+1) = sigmoid(sum of weights - theta[k])``."""

    weight: np.ndarray
    theta: np.ndarray
    bits: int

    def tails(self, feats: list[np.ndarray]) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of each text."""
        z = np.array([self.weight[f].sum() for f in feats])
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.theta[None, :], -40, 40)))


def train(feats: list[np.ndarray], grades: np.ndarray, levels: int, bits: int, l1: float = 3e-4, steps: int = 200) -> OrdinalModel:
    """Fit weights and ordered thresholds. Thresholds are a first value plus
    positive steps, so their order holds by construction."""
    n = len(feats)
    grades = np.asarray(grades)
    if n == 0 or len(np.unique(grades)) < 2:
        grade = int(grades[0]) if n else 0
        return OrdinalModel(np.zeros(1 << bits), np.where(np.arange(1, levels) <= grade, -40.0, 40.0), bits)
    idx = np.concatenate(feats)
    row = np.repeat(np.arange(n), [len(f) for f in feats])
    # a text adds at most 1/n to a weight's gradient, so a feature in fewer than
    # l1 * n texts can never leave zero
    seen = np.bincount(idx, minlength=1 << bits)[idx] >= l1 * n
    idx, row = idx[seen], row[seen]
    used, col = np.unique(idx, return_inverse=True)
    share = np.array([max(0.5, (grades >= k).sum()) / n for k in range(1, levels)])
    share = np.clip(share, 0.5 / n, 1 - 0.5 / n)
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(levels - 1))
    gap = np.log(np.maximum(np.diff(start), 1e-3))
    w, t = np.zeros(len(used)), np.concatenate((start[:1], gap))
    above = (grades[:, None] >= np.arange(1, levels)[None, :]).astype(float)
    # P(y = g) = P(y >= g) - P(y >= g+1)
    lower, upper = np.clip(grades - 1, 0, levels - 2), np.clip(grades, 0, levels - 2)
    bottom, top = grades == 0, grades == levels - 1

    def thetas(t):
        return np.concatenate((t[:1], t[0] + np.cumsum(np.exp(np.clip(t[1:], -8, 8)))))

    def gradient(w, t):
        th = thetas(t)
        z = np.bincount(row, w[col], minlength=n)
        s = 1 / (1 + np.exp(-np.clip(z[:, None] - th[None, :], -40, 40)))
        a = np.where(bottom, 1.0, s[np.arange(n), lower])
        b = np.where(top, 0.0, s[np.arange(n), upper])
        p = np.maximum(a - b, 1e-9)
        da, db = np.where(bottom, 0, a * (1 - a)), np.where(top, 0, b * (1 - b))
        dz = -(da - db) / p / n
        dth = np.zeros(levels - 1)
        np.add.at(dth, lower[~bottom], (da / p / n)[~bottom])
        np.add.at(dth, upper[~top], (-db / p / n)[~top])
        dt = np.concatenate(([dth.sum()], np.exp(np.clip(t[1:], -8, 8)) * np.cumsum(dth[::-1])[::-1][1:]))
        return -np.log(p).mean(), np.bincount(col, dz[row], minlength=len(w)), dt

    def penalised(loss, w):
        return loss + l1 * np.abs(w).sum()

    rate, momentum = 1.0, 1.0
    yw, yt = w.copy(), t.copy()
    for _ in range(steps):
        loss, gw, gt = gradient(yw, yt)
        while True:
            step = yw - rate * gw
            nw = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
            nt = yt - rate * gt
            new = gradient(nw, nt)[0]
            dw, dt = nw - yw, nt - yt
            if new <= loss + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * rate) + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        m = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        yw, yt = nw + (momentum - 1) / m * (nw - w), nt + (momentum - 1) / m * (nt - t)
        small = np.abs(nw - w).max() < 1e-4 and np.abs(nt - t).max() < 1e-4
        w, t, momentum, rate = nw, nt, m, rate * 1.1
        if small:
            break
    weight = np.zeros(1 << bits)
    weight[used] = w
    return OrdinalModel(weight, thetas(t), bits)


def fit(docs: DataFrame, ratings: DataFrame, levels: int, most: int = 8000, bits: int = 18, l1: float = 3e-4) -> OrdinalModel:
    """Train on at most ``most`` ratings (columns ``doc_id``, ``grade`` 0 to
    ``levels - 1``), those that come first by a hash of the id, and the texts
    they belong to; of several texts of one id, one. The model does not depend
    on the order of rows. The chosen ratings, a bounded number, are broadcast to the
    documents, so no text is shuffled that is not trained on."""
    prepare(docs.sparkSession)
    valid = ratings.where(f"doc_id IS NOT NULL AND grade BETWEEN 0 AND {levels - 1}").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade")
    ).withColumn("h", F.xxhash64("doc_id", "grade"))
    n = valid.count()
    chosen = valid.where(unit_hash(F.col("h")) <= (2 * most + 50) / max(n, 1)).orderBy("h", "grade").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # of several texts of one id the one with the smallest hash (then code
    # points): the same whatever order the rows come in
    rated = texts.join(F.broadcast(chosen.distinct()), "doc_id")
    sample = rated.groupBy("h", "grade").agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text")).alias("t")).select("h", "grade", "t.text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            f = features(b.column("text").to_pylist(), bits)
            yield pa.RecordBatch.from_pydict({"h": b.column("h"), "grade": b.column("grade"), "f": pa.array(f, pa.list_(pa.int32()))})

    rows = sample.mapInArrow(run, "h long, grade int, f array<int>").orderBy("h", "grade").limit(most).toArrow()
    column = rows.column("f").combine_chunks()
    feats = np.split(column.flatten().to_numpy(), np.cumsum(np.diff(column.offsets.to_numpy()))[:-1]) if len(rows) else []
    return train(feats, rows.column("grade").to_numpy(), levels, bits, l1)


def score(docs: DataFrame, model: OrdinalModel, tail: int, least: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, tail_prob, kept``: the mean of the predicted
    grade, P(grade >= ``tail``), and whether that reaches ``least``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        m = shared.value
        for b in batches:
            if b.num_rows:
                t = m.tails(features([x or "" for x in b.column("text").to_pylist()], m.bits))
                cols = {
                    "doc_id": b.column("doc_id"),
                    "expected_grade": pa.array(t.sum(axis=1)),
                    "tail_prob": pa.array(t[:, tail - 1]),
                    "kept": pa.array(t[:, tail - 1] >= least),
                }
                yield pa.RecordBatch.from_pydict(cols)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, expected_grade double, tail_prob double, kept boolean")


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade``: a three-step rating from the two binary labels: 0
    toxic, 1 low quality, 2 good. A toxic label decides whatever the quality."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 2)
    return labels.select("doc_id", grade.alias("grade")).where("grade IS NOT NULL")
