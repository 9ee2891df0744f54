"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

A document's set holds the hashes of its runs of ``n`` words (lower case,
maximal runs of letters and digits); a document of fewer words has one run,
all of its words; a document without words links with nothing.

1. One pass over the texts gives each document the 128-bit hash of its word
   sequence and one key per band. Documents of equal word sequence form a
   numbered class; from here on only one document of each class takes part.
2. Representatives that share a band key are tied to the smallest one of that
   key (one row per member, never all pairs). Their connected components are
   groups that no candidate pair leaves.
3. The full sets of the members are built again from the whole texts and meet
   in units: a group as a whole where that ships fewer sets (near copies share
   most bands), else each band bucket of it (long chains of texts that share
   few). A large unit is cut into chunks, and each pair of chunks is a unit of
   bounded size. So a set is shipped at most as often as it has bands, beyond
   the pairs of chunks that a bucket's own pairs need.
   Inside a unit only pairs that share a band are verified, in a bucket only
   those for which it is the first. A unit gives out one row per member (its
   links, and a spanning tie), never a row per pair.
4. Ties of verified links give the result's components.

Band and row counts follow from the threshold and the target recall.

Defined cases: null text counts as empty; rows of one id and one word sequence
are one document, rows of one id and different words are documents of their own
(:func:`jaccard_join` then folds them to one row per id); a null id links with
nothing and is kept; empty table, no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, prepare, spread_join, whole_groups, written
from ledgerlake.llm.spans import chunks, mix, words

_STEP = np.uint64(0xD6E8FEB86659FD93)
# What one document adds to a chunk besides its shingles; bounds the number of
# documents, and so the size of a unit's matrix, where documents are short.
_ROW_COST = 400


def choose_bands(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false candidates,
    whose recall at ``threshold`` reaches ``recall`` with at most
    ``most_hashes`` hashes."""
    best = None
    for rows in range(1, most_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best or (most_hashes, 1)


def shingles(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of a slice of texts, the (first, end) shingle of each
    text, and two 64-bit hashes of each text's word sequence."""
    h, first, end = words(texts)
    count = end - first
    m = np.where(count == 0, 0, np.maximum(count - n + 1, 1))
    stop = np.cumsum(m)
    begin = stop - m
    total = int(stop[-1]) if len(stop) else 0
    at = np.repeat(first - begin, m) + np.arange(total)
    last = np.repeat(end, m)
    out = np.zeros(total, np.uint64)
    for k in range(n):
        inside = at + k < last
        word = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else out
        out = np.where(inside, (out ^ word) * _STEP + np.uint64(k + 1), out)
    # order-sensitive hashes of the whole word sequence
    place = np.arange(len(h), dtype=np.uint64) - np.repeat(first, count).astype(np.uint64)
    whole = [
        np.concatenate(([np.uint64(0)], np.cumsum(mix(h ^ mix(place + np.uint64(seed))), dtype=np.uint64)))
        for seed in (1, 1 << 32)
    ]
    ids = np.stack([mix(w[end] - w[first] + count.astype(np.uint64)) for w in whole])
    return mix(out), begin, stop, ids


def signatures(docs: DataFrame, n: int, bands: int, rows: int, seed: int = 7) -> DataFrame:
    """``doc_id, th, h1, h2, n_shingles, bands`` of every row; ``th`` is a hash
    of the text as it stands, ``h1, h2`` of its words."""

    def run(batches):
        import pyarrow as pa

        rng = np.random.default_rng(seed)
        mult = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        plus = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            parts = []
            for i, j in chunks(texts):
                h, begin, stop, ids = shingles(texts[i:j], n)
                key = np.zeros((bands, j - i), np.uint64)
                some = np.flatnonzero(stop > begin)
                for p in range(bands * rows if len(some) else 0):
                    least = np.minimum.reduceat(h * mult[p] + plus[p], begin[some])
                    key[p // rows, some] = mix(key[p // rows, some] ^ least) + np.uint64(p // rows + 1)
                parts.append((ids, stop - begin, key.T))
            if not parts:
                continue
            ids = np.concatenate([p[0] for p in parts], axis=1).view(np.int64)
            key = np.concatenate([p[2] for p in parts])
            flat = pa.array(np.ascontiguousarray(key).view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    b.column("th"),
                    pa.array(ids[0]),
                    pa.array(ids[1]),
                    pa.array(np.concatenate([p[1] for p in parts]), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * bands, pa.int32()), flat),
                ],
                names=["doc_id", "th", "h1", "h2", "n_shingles", "bands"],
            )

    return _rows(docs).mapInArrow(run, "doc_id long, th long, h1 long, h2 long, n_shingles long, bands array<long>")


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id, th, text`` of every row."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _sets(docs: DataFrame, n: int, carry: list[str]) -> DataFrame:
    """``carry`` columns and each document's sorted distinct shingle hashes as
    binary (``grams``)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts, out = [t or "" for t in b.column("text").to_pylist()], []
            for i, j in chunks(texts):
                h, begin, stop, _ = shingles(texts[i:j], n)
                out += [np.unique(h[x:y]).tobytes() for x, y in zip(begin, stop)]
            cols = {c: b.column(c) for c in carry} | {"grams": pa.array(out, pa.binary())}
            yield pa.RecordBatch.from_pydict(cols)

    schema = docs.select(*carry, F.lit(b"").alias("grams")).schema
    return docs.select(*carry, "text").mapInArrow(run, schema)


def sharing(a: np.ndarray, b: np.ndarray | None, key: int | None = None) -> np.ndarray:
    """Which rows of the band keys ``a`` and ``b`` (of ``a`` among themselves
    if None) share a band: a boolean matrix. With ``key``, only pairs whose
    first shared band has that key."""
    other = a if b is None else b
    out = np.zeros((len(a), len(other)), bool)
    for k in reversed(range(a.shape[1])):
        same = a[:, k, None] == other[None, :, k]
        if key is None:
            out |= same
        else:  # earlier bands come later here, and decide
            out = np.where(same, (a[:, k] == key)[:, None], out)
    if b is None:
        np.fill_diagonal(out, False)
    return out


def linked(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float, pairs: np.ndarray | None = None, room: int = 1 << 22) -> np.ndarray:
    """Which sets of ``a`` and ``b`` (of ``a`` among themselves if None) have a
    Jaccard similarity of at least ``threshold``: a boolean matrix; of
    ``pairs`` only, if given. Shared elements are counted exactly: where most
    pairs are asked for with products of 0/1 matrices in slices of at most
    ``room`` cells, else pair by pair."""
    if pairs is not None and 2 * pairs.sum() < pairs.size:
        near = np.zeros(pairs.shape, bool)
        other = a if b is None else b
        for x, y in zip(*np.nonzero(pairs)):
            if b is None and x > y:
                continue
            p, q = a[x], other[y]
            small, large = (p, q) if len(p) <= len(q) else (q, p)
            # whole numbers: shared / union >= threshold without rounding a boundary away
            if len(small) < threshold * len(large) - 1e-6:
                continue
            common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
            near[x, y] = common >= threshold * (len(p) + len(q) - common) - 1e-6
            if b is None:
                near[y, x] = near[x, y]
        return near
    both = a if b is None else a + b
    size = np.array([len(x) for x in both])
    values, back = np.unique(np.concatenate(both), return_inverse=True)
    row = np.repeat(np.arange(len(both)), size)
    shared = np.bincount(back, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[back]
    row, col = row[keep], column[back[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = max(1, min(room // len(both), int(shared.sum())))
    common = np.zeros((len(a), len(both) - (len(a) if b is not None else 0)), np.float32)
    for lo in range(0, int(shared.sum()), width):
        x, y = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(both), width), np.float32)
        m[row[x:y], col[x:y] - lo] = 1
        common += m[: len(a)] @ (m if b is None else m[len(a) :]).T
    left, right = size[: len(a)], size if b is None else size[len(a) :]
    union = left[:, None] + right[None, :] - common
    near = (common >= threshold * union - 1e-6) & (union > 0)
    if b is None:
        np.fill_diagonal(near, False)
    return near if pairs is None else near & pairs


def spanning(near: np.ndarray) -> np.ndarray:
    """Smallest row index reachable from each row of a symmetric matrix."""
    label = np.arange(len(near))
    while True:
        low = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near)))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def ties(near: np.ndarray, ids: np.ndarray, weight: np.ndarray, cross: int | None = None):
    """(id, weighted links, id it is tied to) of every member with a link.
    ``cross`` splits the members in two sides that ``near`` compares."""
    if cross is not None:
        full = np.zeros((len(ids), len(ids)), bool)
        full[:cross, cross:] = near
        full[cross:, :cross] = near.T
        near = full
    hit = near.any(axis=1)
    return ids[hit], (near @ weight)[hit], ids[spanning(near)][hit]


def compare_blocks(blocks: DataFrame, threshold: float) -> DataFrame:
    """Verify the pairs that share a band in each unit (``unit, bucket, i,
    j``; ``bucket``: the unit is the band key ``unit``); ``side`` 0 belongs to
    chunk i, 1 to chunk j. Returns ``cls, links, tied``."""
    import pandas as pd

    names = ["bucket", "unit", "i", "j"]

    def run(frames):
        for f in whole_groups(frames, names, ["side", "cls"]):
            out = []
            key = f[names].to_numpy(np.int64)
            edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1), [True])))
            ids, weight, side, grams, bands = (f[c].to_numpy() for c in ("cls", "copies", "side", "grams", "bands"))
            for lo, hi in zip(edge[:-1], edge[1:]):
                sets = [np.frombuffer(x, np.uint64) for x in grams[lo:hi]]
                keys = np.stack(bands[lo:hi])
                first = int(key[lo, 1]) if key[lo, 0] else None
                if key[lo, 2] == key[lo, 3]:
                    if hi - lo > 1 and (pairs := sharing(keys, None, first)).any():
                        out.append(ties(linked(sets, None, threshold, pairs), ids[lo:hi], weight[lo:hi]))
                elif (cut := int((side[lo:hi] == 0).sum())) and cut < len(sets):
                    pairs = sharing(keys[:cut], keys[cut:], first)
                    if pairs.any():
                        out.append(ties(linked(sets[:cut], sets[cut:], threshold, pairs), ids[lo:hi], weight[lo:hi], cut))
            if out:
                yield pd.DataFrame({c: np.concatenate([o[k] for o in out]) for k, c in enumerate(("cls", "links", "tied"))})

    return (
        blocks.repartition(*names)
        .sortWithinPartitions(*names, "side", "cls")
        .mapInPandas(run, "cls long, links long, tied long")
    )


def near_documents(
    docs: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    recall: float = 0.9995,
    most_hashes: int = 128,
    chunk_shingles: int = 400_000,
) -> tuple[DataFrame, DataFrame]:
    """The verdict of every document with an id (``doc_id, h1, h2, th, last_th,
    n_shingles, n_links, component_id, kept``; ``th`` and ``last_th`` are the
    smallest and largest text hash of its rows), and the :func:`signatures` of
    all rows. The first document of a component, by id and hash, is kept."""
    prepare(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall, most_hashes)
    signed = written(signatures(docs, n, bands, rows), "signatures")
    # the grouping also makes the stored table independent of how the input was split
    one = written(
        signed.where("doc_id IS NOT NULL")
        .groupBy("doc_id", "h1", "h2")
        .agg(F.min(F.struct("th", "n_shingles", "bands")).alias("s"), F.max("th").alias("last_th"))
        .select("doc_id", "h1", "h2", "s.*", "last_th"),
        "signed",
    )
    classes = written(
        # an id may have several texts, so a class goes by a number of its own
        one.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "th")).alias("s"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n_shingles"))
        .select("h1", "h2", F.col("s.doc_id").alias("rep"), "s.th", "copies", "n_shingles")
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    n_classes = classes.count()
    signed_classes = one.where("n_shingles > 0").join(classes.select("h1", "h2", "rep", "cls", F.col("th").alias("__th")), ["h1", "h2"]).where(
        "doc_id = rep AND th = __th"
    )
    keys = signed_classes.select("cls", "n_shingles", F.explode("bands").alias("key"))
    load = F.sum(F.col("n_shingles") + _ROW_COST)
    chunks_of = F.ceil(load / F.lit(chunk_shingles)).cast("int").alias("chunks")
    buckets = written(keys.groupBy("key").agg(F.min("cls").alias("m"), F.count(F.lit(1)).alias("c"), chunks_of).where("c > 1"), "buckets")
    in_bucket = written(spread_join(keys.select("cls", "key"), buckets, ["key"], bands * n_classes), "in-buckets")
    member = components(in_bucket.select(F.col("cls").alias("u"), F.col("m").alias("v")))
    roots = member.select("component").distinct().select(F.col("component").alias("cls"), F.col("component").alias("grp"))
    member = written(member.select(F.col("node").alias("cls"), F.col("component").alias("grp")).unionByName(roots), "members")
    # sets shipped if the group is one unit, or if each of its buckets is
    by_bucket = buckets.join(member, F.col("m") == F.col("cls")).groupBy("grp").agg(F.sum(F.col("c") * F.col("chunks")).alias("by_bucket"))
    size = (
        member.join(classes.select("cls", "n_shingles"), "cls")
        .groupBy("grp")
        .agg(chunks_of, F.count(F.lit(1)).alias("c"))
        .join(by_bucket, "grp")
        .select("grp", "c", "chunks", (F.col("by_bucket") < F.col("c") * F.col("chunks")).alias("bucket"))
    )
    # a group may hold a large part of all documents
    member = written(spread_join(member, size, ["grp"], n_classes), "sized-members")
    split = in_bucket.join(member.where("bucket").select("cls"), "cls").groupBy("cls").agg(F.collect_list(F.struct(F.col("key").alias("unit"), "chunks")).alias("units"))
    member = (
        member.join(split, "cls", "left")
        .select("cls", "bucket", F.coalesce("units", F.array(F.struct(F.col("grp").alias("unit"), "chunks"))).alias("units"))
        .join(signed_classes.select("cls", "bands"), "cls")
        .join(classes.select("cls", "rep", "th", "copies"), "cls")
    )
    texts = _rows(docs).withColumnRenamed("doc_id", "rep").join(
        # the members grow with the corpus, so they are never broadcast
        member.hint("merge"), ["rep", "th"]
    )
    carried = ["cls", "bucket", "units", "copies", "bands"]
    place = "pmod(xxhash64(cls), u.chunks)"
    spread = F.expr(
        f"""flatten(transform(units, u -> transform(sequence(0, u.chunks - 1), o -> struct(
              u.unit AS unit, int(least({place}, o)) AS i, int(greatest({place}, o)) AS j, IF({place} <= o, 0, 1) AS side))))"""
    )
    blocks = _sets(texts, n, carried).select("cls", "copies", "grams", "bands", F.col("bucket").cast("int").alias("bucket"), F.explode(spread).alias("b"))
    blocks = blocks.select("cls", "copies", "grams", "bands", "bucket", "b.*")
    found = written(compare_blocks(blocks, threshold), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    linked_to = components(found.select(F.col("cls").alias("u"), F.col("tied").alias("v")))
    grouped = written(
        classes.select("cls", "rep", "h1", "h2", "copies")
        .join(linked_to.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls")),
        "grouped",
    )
    head = grouped.groupBy("component").agg(F.min(F.struct("rep", "h1", "h2")).alias("head"), F.count(F.lit(1)).alias("c"))
    known = (
        # a component may hold a large part of all classes
        spread_join(grouped, head, ["component"], n_classes)
        .join(links, "cls", "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "head")
    )
    verdict = one.drop("bands").join(known, ["h1", "h2"], "left").select(
        "doc_id", "h1", "h2", "th", "last_th", "n_shingles",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("head.rep", "doc_id").alias("component_id"),
        F.coalesce(F.col("head") == F.struct(F.col("doc_id").alias("rep"), "h1", "h2"), F.lit(True)).alias("kept"),
    )
    return verdict, signed


def jaccard_join(docs: DataFrame, **settings) -> DataFrame:
    """One row per document id: ``doc_id``, ``n_links`` (other documents of
    Jaccard similarity ``threshold`` or more found, copies included),
    ``component_id`` (smallest id reachable by links) and ``kept`` (the
    smallest of its component). Rows of null ids are kept, with no links.

    An id with several different texts adds up their links; it is kept, in a
    component of its own name, if one of its texts is, and else goes by the
    smallest of their components. ``settings`` are those of
    :func:`near_documents`."""
    verdict, signed = near_documents(docs, **settings)
    result = (
        verdict.groupBy("doc_id")
        .agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"), F.max("kept").alias("kept"))
        .select("doc_id", "n_links", F.when(F.col("kept"), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "kept")
    )
    lone = signed.where("doc_id IS NULL").select(
        "doc_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
    )
    return result.unionByName(lone)


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The documents that :func:`near_documents` keeps, all columns unchanged:
    each row is judged by its own text, also where an id has several. Of texts
    of one id and the same words one stays; identical repeated rows of a kept
    id collapse to one (rows of null id, which cannot be told apart, all stay)."""
    verdict, signed = near_documents(docs, **settings)
    verdict = written(verdict, "verdicts")
    # the same words in another writing, under one id
    several = verdict.where("kept AND n_shingles > 0 AND th <> last_th").select("doc_id", "h1", "h2", F.col("th").alias("stays"))
    spelt = signed.select("doc_id", "th", "h1", "h2").join(several, ["doc_id", "h1", "h2"]).where("th <> stays")
    lost = signed.select("doc_id", "th", "h1", "h2").join(verdict.where("NOT kept").select("doc_id", "h1", "h2"), ["doc_id", "h1", "h2"])
    gone = lost.select("doc_id", "th").unionByName(spelt.select("doc_id", "th")).toDF("__id", "__th")
    tagged = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__th": F.xxhash64(F.col("text").cast("string"))})
    kept = tagged.join(gone, ["__id", "__th"], "left_anti").select(*docs.columns)
    again = written(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_anti").select(*docs.columns)
    return once.unionByName(kept.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates())
