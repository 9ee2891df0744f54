"""Language identification with a string kernel.

The kernel of two texts is the cosine of their presence vectors over hashed
character n-grams of all orders up to ``order`` (a blended spectrum, presence
instead of counts). A bounded, hash-ordered sample of labelled texts trains
it: landmarks of the sample span a Nyström feature space, one-versus-rest
kernel ridge regression gives one function per language, and every other text
is scored from the n-grams it shares with the landmarks. As scores are linear
in presence, landmarks and coefficients fold into one weight per n-gram and
language: a batch of texts is one matrix product.

Defined cases: null texts and texts without a letter are ``und`` with score
0, as is every text when no labelled text exists; null languages teach
nothing; repeated rows are predicted alike; equal scores go to the first
language by code point; an empty table gives no row; extra columns pass by.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, unit_hash
from ledgerlake.llm.spans import EDGE, LETTER, Batch, _char_hash, chunks

_ORDERS_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
UNKNOWN = "und"


def grams(texts: list[str], order: int, bits: int) -> tuple[list[np.ndarray], Batch]:
    """For each order, the hashed n-gram starting at every position (those that
    touch a text's end hold the EDGE position's value and are masked by the
    caller through ``Batch.kind``)."""
    b = Batch.of([t.lower() for t in texts])
    one = _char_hash()[b.cp]
    out, roll = [], np.zeros(len(one), np.uint64)
    for k in range(order):
        shifted = one[k:] if k else one
        roll = roll[: len(shifted)] * _ORDERS_STEP + shifted
        out.append(((roll * _ORDERS_STEP) >> np.uint64(64 - bits)).astype(np.int32))
    return out, b


def presence(texts: list[str], order: int, bits: int, slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """0/1 matrix of texts by known n-grams (``slot`` maps a hash to its column,
    -1 if unknown), and which texts hold a letter."""
    found, b = grams(texts, order, bits)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), b.end - b.first + 1)
    edge = b.kind == EDGE
    m = np.zeros(len(texts) * width + 1, np.float32)
    inside = ~edge
    for k, g in enumerate(found):
        if k:
            inside = inside[: len(g)] & ~edge[k : k + len(g)]
        col = slot[g]
        hit = inside & (col >= 0)
        m[owner[: len(g)][hit] * width + col[hit]] = 1
    letters = np.zeros(len(texts), bool)
    letters[owner[b.kind == LETTER]] = True
    return m[:-1].reshape(len(texts), width), letters


@dataclass
class LanguageModel:
    """``weight[slot, language]`` over known n-grams of the landmarks."""

    languages: list[str]
    order: int
    bits: int
    known: np.ndarray
    weight: np.ndarray

    def slots(self) -> np.ndarray:
        out = np.full(1 << self.bits, -1, np.int32)
        out[self.known] = np.arange(len(self.known), dtype=np.int32)
        return out

    def predict(self, texts: list[str], slot: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of whole texts."""
        label, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return label, score
        for i, j in chunks(texts, 1 << 18):
            for lo in range(i, j, 64):
                part = texts[lo : min(j, lo + 64)]
                m, letters = presence(part, self.order, self.bits, slot, len(self.known))
                norm = np.sqrt(np.maximum(m.sum(axis=1), 1))
                value = (m @ self.weight) / norm[:, None]
                best = value.argmax(axis=1)
                for k in np.flatnonzero(letters):
                    label[lo + k] = self.languages[best[k]]
                    score[lo + k] = min(1.0, max(0.0, float(value[k, best[k]])))
        return label, score


def train(texts: list[str], labels: list[str], landmarks: int = 256, order: int = 3, bits: int = 22, ridge: float = 1e-2) -> LanguageModel:
    """Fit on labelled whole texts; the first ``landmarks`` texts span the
    feature space."""
    languages = sorted(set(labels), key=lambda x: x.encode())
    marks = texts[:landmarks]
    hashed = [g[b.kind[: len(g)] != EDGE] for i, j in chunks(marks) for f, b in [grams(marks[i:j], order, bits)] for g in f]
    known = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, np.int64)
    if not languages or not len(known):
        return LanguageModel([], order, bits, known, np.zeros((len(known), 0), np.float32))
    slot = LanguageModel([], order, bits, known, None).slots()

    def unit(part):
        m, _ = presence(part, order, bits, slot, len(known))
        return m / np.sqrt(np.maximum(m.sum(axis=1, keepdims=True), 1))

    z = unit(marks)
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])
    size = half.shape[1]
    xx, xy = np.zeros((size, size)), np.zeros((size, len(languages)))
    column = {x: k for k, x in enumerate(languages)}
    for lo in range(0, len(texts), 64):
        phi = (unit(texts[lo : lo + 64]) @ z.T).astype(np.float64) @ half
        y = np.zeros((len(phi), len(languages)))
        y[np.arange(len(phi)), [column[x] for x in labels[lo : lo + 64]]] = 1
        xx += phi.T @ phi
        xy += phi.T @ y
    coef = half @ np.linalg.solve(xx + ridge * len(texts) * np.eye(size) / size, xy)
    return LanguageModel(languages, order, bits, known, (z.T.astype(np.float64) @ coef).astype(np.float32))


def training_sample(labelled: DataFrame, per_language: int, most: int) -> list[tuple[str, str]]:
    """(text, language) of a bounded sample: of each language the first
    ``per_language`` distinct texts by a hash of the text, in rounds over the
    languages, ``most`` in all; of more than ``most`` languages the most
    frequent. The order depends on texts alone.

    Distinct texts are counted per language first; rows far above the cut
    that the count implies are dropped before any text is shuffled."""
    hashed = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", F.xxhash64("text").alias("h"))
    share = (
        hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lang").limit(most)
        .select("lang", ((2 * per_language + 50) / F.col("n")).alias("share"))
    )
    share = F.broadcast(share)  # at most ``most`` rows
    ranked = (
        hashed.join(share, "lang")
        .where(unit_hash(F.col("h")) <= F.col("share"))
        .dropDuplicates(["lang", "h"])
        .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
        .where(F.col("r") <= per_language)
        .orderBy("r", "h", "lang")
        .limit(most)
    )
    return [(r["text"], r["lang"]) for r in ranked.collect()]


def fit(labelled: DataFrame, per_language: int = 400, most: int = 2000, landmarks: int = 256, order: int = 3) -> LanguageModel:
    """Train on a bounded sample (``per_language`` texts of each language, at
    most ``most``) of ``labelled`` (columns ``text``, ``lang``)."""
    prepare(labelled.sparkSession)
    sample = training_sample(labelled, per_language, most)
    return train([t for t, _ in sample], [x for _, x in sample], landmarks, order)


def identify(docs: DataFrame, model: LanguageModel, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and score of the whole text in the columns
    ``names``, which replace columns of that name."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        m = shared.value
        slot = m.slots()
        for b in batches:
            if not b.num_rows:
                continue
            label, score = m.predict([t or "" for t in b.column("text").to_pylist()], slot)
            out = {n: b.column(n) for n in b.schema.names}
            yield pa.RecordBatch.from_pydict(out | {names[0]: pa.array(label), names[1]: pa.array(score)})

    clean = docs.drop(*names)
    return clean.mapInArrow(run, clean.withColumns({names[0]: F.lit(""), names[1]: F.lit(0.0)}).schema)


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id's decimal text, modulo 4 (fold 2 is held out)."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("binary")) % 4


def language_id(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learned from
    the documents that are not held out."""
    held = (fold(F.col("doc_id").cast("string")) == 2).alias("held_out")
    model = fit(docs.where(~held).select("text", "lang"), **settings)
    return identify(docs.select("doc_id", held, "text"), model).drop("text")


def keep_identified(docs: DataFrame, min_score: float = 0.05, **settings) -> DataFrame:
    """Drop the documents whose language cannot be told: no letters, or no
    language's score reaches ``min_score``. Columns are unchanged, also those
    named ``lang_pred`` or ``score``."""
    model = fit(docs.where(~(fold(F.col("doc_id").cast("string")) == 2)).select("text", "lang"), **settings)
    scored = identify(docs, model, ("__lang", "__score"))
    return scored.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= min_score)).select(*docs.columns)
