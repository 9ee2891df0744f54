"""Approximate nearest neighbours: inverted lists with an adaptive dimension
scan.

Vectors are normalised (largest cosine = smallest distance) and rotated by a
random orthogonal matrix, so that any prefix of their columns is an unbiased
sample of a distance. Centroids are fitted on a bounded sample; every vector
is filed under its nearest centroid, one list number a row. How many of its
nearest lists a query visits is measured on the sample: as many as hold the
wanted share of the true neighbours there. Vectors with clusters need few;
without clusters most lists are needed, and the work then grows with queries
times vectors whatever the index.

Inside a list, columns come in blocks: after each block, candidates whose
scaled partial distance rejects "closer than the current k-th" by a hypothesis
test are abandoned; survivors get their exact cosine on the original vectors.

A list is split by a hash of row numbers into parts, small enough for the
memory and for the number of queries that visit it. Each part is one unit of
work: every vector is sent to one part, once, and the queries go to the parts
of their lists and stream past the vectors there. So no list, however large,
meets in one task. Queries that find fewer than ``k`` candidates in their
lists search all lists.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, or with a null id, take no part; queries meet candidates of their
own dimension; ties go to the smaller id; repeated rows are candidates of
their own, except those with the query's id; a repeated query row asks once, and
different vectors of one id are queries of their own, each with its ranks; an empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, unit_hash, written
from ledgerlake.llm.vector_dedup import _matrix, usable


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def centroids(sample: np.ndarray, lists: int, rounds: int, seed: int) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    c = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        at = (sample @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, at, sample)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def scan(
    q: np.ndarray, qid: int, rotated: np.ndarray, ids: np.ndarray, raw: np.ndarray, raw_q: np.ndarray, k: int, block: int, eps: float
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (ids, cosines) of one query among the rows of one part.
    ``rotated`` are rotated unit vectors, ``raw`` the unit vectors as given."""
    dim, alive = rotated.shape[1], np.flatnonzero(ids != qid)
    best_id, best = np.zeros(0, np.int64), np.zeros(0)
    for lo in range(0, len(alive), 256):
        rows = alive[lo : lo + 256]
        if len(best) >= k:
            limit = 2 - 2 * best[-1]  # squared distance of the k-th so far
            part = np.zeros(len(rows))
            for at in range(0, dim, block):
                part += ((rotated[rows, at : at + block] - q[at : at + block]) ** 2).sum(axis=1)
                seen = min(at + block, dim)
                if seen < dim:
                    stay = part * dim / seen <= (1 + eps / math.sqrt(seen)) ** 2 * limit + 1e-12
                    rows, part = rows[stay], part[stay]
                    if not len(rows):
                        break
        if len(rows):
            cos = (raw[rows] * raw_q).sum(axis=1)
            best_id, best = np.concatenate((best_id, ids[rows])), np.concatenate((best, cos))
            top = np.lexsort((best_id, -best))[:k]
            best_id, best = best_id[top], best[top]
    return best_id, best


def probes_for(sample: np.ndarray, c: np.ndarray, k: int, recall: float, asked: int = 512) -> int:
    """How many nearest lists hold ``recall`` of the ``k`` true neighbours of
    vectors of the sample (unit vectors, in random order)."""
    q = sample[:asked]
    near = q @ sample.T
    near[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    home = (sample @ c.T).argmax(axis=1)[best]
    to = q @ c.T
    before = (to[:, None, :] > np.take_along_axis(to, home, axis=1)[:, :, None]).sum(axis=2)
    return int(np.quantile(before, recall, method="higher")) + 1


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    sample_rows: int = 20_000,
    rows_per_list: float | None = None,
    recall: float = 0.97,
    part_rows: int = 4096,
    unit_pairs: int = 1 << 28,
    block: int = 16,
    eps: float = 2.4,
    seed: int = 5,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each different row
    of ``vectors`` (columns ``vec_id``, ``embedding``) where ``is_query`` holds.
    There are as many lists as vectors in each, by default, but no more than
    the sample can place (a sixteenth of its rows); longer lists have more parts."""
    spark = prepare(vectors.sparkSession)
    base = (
        vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
        .withColumn("dim", F.size("v"))
    )
    sizes = {r["dim"]: r["n"] for r in base.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    models = {}
    for dim, n in sizes.items():
        # the bound holds for vectors that occur often too: distinct ones, by hash
        h = F.xxhash64("v")
        rows = (
            base.where(F.col("dim") == dim)
            .select("v", h.alias("h"))
            .where(unit_hash(F.col("h")) <= (2 * sample_rows + 50) / n)
            .dropDuplicates(["h"])
            .orderBy("h")
            .limit(sample_rows)
            .toArrow()
        )
        flat = rows.column("v").combine_chunks()
        points = unit(_matrix(flat.flatten().to_numpy().reshape(len(rows), dim))) if len(rows) else unit(np.ones((1, dim)))
        wanted = math.sqrt(n) if rows_per_list is None else n / rows_per_list
        c = centroids(points, max(1, min(round(wanted), max(round(math.sqrt(len(points))), len(points) // 16))), 8, seed)
        models[dim] = c, probes_for(points, c, k, recall)
    shared = spark.sparkContext.broadcast(models)

    def file_rows(batches):
        import pyarrow as pa

        for b in batches:
            dims, flat = b.column("dim").to_numpy(), b.column("v")
            column = pd.Series(flat.to_pylist(), dtype=object)
            home, lists, asks = np.zeros(len(column), np.int32), [None] * len(column), b.column("q").to_pylist()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                c, probes = shared.value[int(dim)]
                near = unit(_matrix(column.iloc[rows])) @ c.T
                home[rows] = near.argmax(axis=1)
                for r, to in zip(rows, near):
                    if asks[r]:  # only queries need more than their own list
                        lists[r] = np.argsort(-to, kind="stable")[:probes].tolist()
            out = {n: b.column(n) for n in b.schema.names}
            yield pa.RecordBatch.from_pydict(out | {"list": pa.array(home), "lists": pa.array(lists, pa.list_(pa.int32()))})

    filed = base.mapInArrow(file_rows, "vec_id long, v array<double>, q boolean, dim int, list int, lists array<int>")
    # an id may be that of many rows, so rows go by a number of their own
    filed = written(filed.withColumn("row", F.monotonically_increasing_id()), "filed")
    entries = filed.select("row", "vec_id", "v", "dim", "list")
    counts = entries.groupBy("dim", "list").agg(F.count(F.lit(1)).alias("held"))
    asking = filed.where("q").withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")}).dropDuplicates(["vec_id", "h1", "h2"])
    asking = written(asking.select("row", "vec_id", "v", "dim", "lists"), "queries")
    visits = asking.select("row", "vec_id", "v", "dim", F.explode("lists").alias("list"))
    first = _scan_units(entries, visits, counts, k, part_rows, unit_pairs, block, eps, seed)
    merged = written(_merge(first, k), "found")

    # queries whose lists held fewer than k candidates search all lists
    goal = F.least(F.lit(k), F.col("n") - 1)
    per_dim = spark.createDataFrame([(d, n) for d, n in sizes.items()] or [(0, 0)], "dim int, n long")
    got = merged.groupBy("row").agg(F.count(F.lit(1)).alias("got"))
    short = (
        asking.select("row", "vec_id", "v", "dim").join(per_dim, "dim")
        .join(got, "row", "left")
        .where(F.coalesce("got", F.lit(0)) < goal)
    )
    short = written(short.select("row", "vec_id", "v", "dim"), "short")
    if short.isEmpty():
        return merged.drop("row")
    every = short.join(counts.select("dim", "list"), "dim")
    rest = _merge(_scan_units(entries, every, counts, k, part_rows, unit_pairs, block, eps, seed), k)
    return merged.join(short.select("row"), "row", "left_anti").unionByName(rest).drop("row")


def _units(entries, visits, counts, part_rows, unit_pairs) -> DataFrame:
    """``dim, list, part, kind, row, vec_id, v``: every stored vector
    (kind 0) in its part, every query (kind 1) in all parts of its lists."""
    asked_of = visits.groupBy("dim", "list").agg(F.count(F.lit(1)).alias("asked"))
    parts = F.greatest(F.ceil(F.col("held") / part_rows), F.ceil(F.col("held") * F.col("asked") / F.lit(unit_pairs)))
    # one row per list, of which there are no more than the sample has rows; a
    # list may hold a large part of all vectors, so they are not shuffled by it
    plan = F.broadcast(counts.join(asked_of, ["dim", "list"]).select("dim", "list", F.least(parts, F.col("held")).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    stored = entries.join(plan, ["dim", "list"]).select("dim", "list", mine.alias("part"), F.lit(0).alias("kind"), "row", "vec_id", "v")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asked = visits.join(plan, ["dim", "list"]).select("dim", "list", every.alias("part"), F.lit(1).alias("kind"), "row", "vec_id", "v")
    return stored.unionByName(asked)


def _scan_units(entries, visits, counts, k, part_rows, unit_pairs, block, eps, seed) -> DataFrame:
    """Scan every part of the visited lists for the queries that visit it."""
    keys = ["dim", "list", "part"]

    def run(frames):
        now, held, ready = None, [], None  # the part at hand: its rows, then ready for queries
        for f in frames:
            out: list[tuple] = []
            for key, g in f.groupby(keys, sort=False):
                if key != now:
                    now, held, ready = key, [], None
                stored = g[g["kind"] == 0]
                if len(stored):
                    held.append((unit(_matrix(stored["v"])), stored["vec_id"].to_numpy()))
                asking = g[g["kind"] == 1]
                if not len(asking) or not held:
                    continue
                if ready is None:
                    m, ids = np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
                    ready = m, ids, m @ rotation(int(key[0]), seed)
                m, ids, turned = ready
                q = unit(_matrix(asking["v"]))
                for i, (raw, there) in enumerate(zip(q, q @ rotation(int(key[0]), seed))):
                    qid = int(asking["vec_id"].iloc[i])
                    found, score = scan(there, qid, turned, ids, m, raw, k, block, eps)
                    out += [(int(asking["row"].iloc[i]), qid, int(x), float(c)) for x, c in zip(found, score)]
            if out:
                yield pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])

    return (
        _units(entries, visits, counts, part_rows, unit_pairs)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "kind", "row")
        .mapInPandas(run, "row long, query_id long, vec_id long, score double")
    )


def _merge(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("row", "query_id", "rank", "vec_id", "score")
    )
