"""Embedding near-dedup: Euclidean p-stable hashing, exact cosine checks.

Vectors are normalised; projections on random Gaussian directions, shifted and
cut into steps of width ``width``, form one bucket key per table. The number
of projections per key grows with the logarithm of the row count, so that an
unrelated vector rarely shares a bucket, and the number of tables then follows
from the target recall at the cosine threshold.

Equal vectors form a numbered class first and one row of each class takes part;
ids come back only at the end, so an id may stand for several vectors. The members of a bucket are compared in units of bounded size: a large
bucket is dealt into chunks by hash and each pair of chunks is a unit. A unit
computes exact cosines in double precision, counts a pair only in the first
table where the two share a bucket, and gives out one row per member.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors of null id, link with nothing and are kept with
themselves; vectors of different dimension do not meet; repeated rows are
vectors of their own (equal ids, of equal or different vectors: each row has a
result row, by its own vector); ties need no rule; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, prepare, spread_join, whole_groups, written
from ledgerlake.llm.jaccard_join import ties
from ledgerlake.llm.spans import mix


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(
        (F.size(vector) > 0) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def collision(distance: float, width: float) -> float:
    """Chance that two points at ``distance`` share one quantised projection."""
    if distance <= 0:
        return 1.0
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def choose_tables(rows: int, cosine: float, recall: float, width: float) -> tuple[int, int]:
    """(tables, projections per table): at most about one unrelated vector in
    four buckets, and ``recall`` for a pair exactly at ``cosine``."""
    near = collision(math.sqrt(max(0.0, 2 - 2 * cosine)), width)
    far = collision(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(4 * max(rows, 2)) / -math.log(far)))
    hit = near**k
    return (1 if hit >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit)))), k


def bucket_keys(vectors: np.ndarray, tables: int, k: int, width: float, seed: int) -> np.ndarray:
    """One 64-bit bucket key per row and table (rows of one dimension)."""
    dim = vectors.shape[1]
    rng = np.random.default_rng([seed, dim])
    direction = rng.standard_normal((dim, tables * k))
    shift = rng.uniform(0, width, tables * k)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    step = np.floor((unit @ direction + shift) / width).astype(np.int64).view(np.uint64).reshape(len(vectors), tables, k)
    key = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim), step.shape[:2]).copy()
    for j in range(k):
        key = mix(key ^ (step[:, :, j] + np.uint64(j)))
    return key


def _matrix(column) -> np.ndarray:
    """Rows of equal length as a double matrix, scaled so that squares neither
    overflow nor vanish."""
    m = np.array(column.tolist() if hasattr(column, "tolist") else list(column), dtype=np.float64)
    return m / np.abs(m).max(axis=1, keepdims=True)


def compare_buckets(units: DataFrame, cosine: float) -> DataFrame:
    """Compare the members of each unit (``key, i, j``): ``cls, links, tied``."""

    def run(frames):
        for f in whole_groups(frames, ["key", "i", "j"], ["side", "cls"]):
            out = []
            key = f[["key", "i", "j"]].to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1), [True])))
            ids_all, copies, side_all = (f[c].to_numpy() for c in ("cls", "copies", "side"))
            for lo, hi in zip(edge[:-1], edge[1:]):
                if hi - lo < 2:
                    continue
                ids, weight, side = ids_all[lo:hi], copies[lo:hi], side_all[lo:hi]
                cut = hi - lo if key[lo, 1] == key[lo, 2] else int((side == 0).sum())
                if not 0 < cut <= hi - lo or (key[lo, 1] != key[lo, 2] and cut == hi - lo):
                    continue
                v = _matrix(f["embedding"].iloc[lo:hi])
                v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
                keys = np.stack(f["keys"].iloc[lo:hi].to_numpy())
                table = int(np.flatnonzero(keys[0] == key[lo, 0])[0])
                whole = cut == hi - lo
                a, b = v[:cut], v if whole else v[cut:]
                product = a @ b.T
                near = product >= cosine
                for x, y in np.argwhere(np.abs(product - cosine) < 1e-12):
                    near[x, y] = (a[x] * b[y]).sum() >= cosine
                if whole:
                    np.fill_diagonal(near, False)
                if not near.any():
                    continue
                # a pair counts in the first table where the two meet
                ka, kb = keys[:cut], keys if whole else keys[cut:]
                for t in range(table):
                    near &= ka[:, t, None] != kb[None, :, t]
                if near.any():
                    out.append(ties(near, ids, weight, None if whole else cut))
            if out:
                yield pd.DataFrame({c: np.concatenate([o[k] for o in out]) for k, c in enumerate(("cls", "links", "tied"))})

    return (
        units.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side", "cls")
        .mapInPandas(run, "cls long, links long, tied long")
    )


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, recall: float = 0.995, width: float = 2.0, chunk: int = 512, seed: int = 11
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``
    (columns ``vec_id``, ``embedding``)."""
    prepare(vectors.sparkSession)
    good = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", good.alias("good"))
    # double arrays from here on, with -0.0 as 0.0: equal vectors, equal classes
    clean = base.where("good").select("vec_id", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"))
    h1, h2 = F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")
    hashed = clean.select("vec_id", "embedding", h1.alias("h1"), h2.alias("h2"))
    classes = written(
        # an id may stand for several vectors, so a class goes by a number of its own
        hashed.groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("cls", F.monotonically_increasing_id()),
        "vector-classes",
    )
    n_classes = classes.count()
    tables, k = choose_tables(n_classes, cosine, recall, width)

    def keys(batches):
        import pyarrow as pa

        for b in batches:
            column = pd.Series(b.column("embedding").to_pylist(), dtype=object)
            out = np.zeros((len(column), tables), np.uint64)
            for dim, rows in column.groupby(column.map(len)).indices.items():
                out[rows] = bucket_keys(_matrix(column.iloc[rows]), tables, k, width, seed)
            flat = pa.array(out.view(np.int64).ravel())
            offsets = pa.array(np.arange(len(column) + 1) * tables, pa.int32())
            yield pa.RecordBatch.from_pydict({"cls": b.column("cls"), "keys": pa.ListArray.from_arrays(offsets, flat)})

    signed = written(classes.select("cls", "embedding").mapInArrow(keys, "cls long, keys array<long>"), "vector-keys")
    slim = signed.select("cls", F.explode("keys").alias("key"))
    counts = written(slim.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "bucket-sizes")
    spread = F.expr("transform(sequence(0, m - 1), o -> struct(least(p, o) AS i, greatest(p, o) AS j, IF(p <= o, 0, 1) AS side))")
    placed = (
        # a bucket may hold a large part of all vectors
        spread_join(slim, counts.withColumn("m", F.ceil(F.col("c") / chunk).cast("int")), ["key"], tables * n_classes)
        .withColumn("p", F.pmod(F.xxhash64("cls"), F.col("m")).cast("int"))
        .select("key", "cls", F.explode(spread).alias("u"))
        .select("key", "cls", "u.*")
    )
    full = classes.select("cls", "copies", "embedding").join(signed, "cls")
    found = written(compare_buckets(placed.join(full, "cls"), cosine), "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("cls").alias("u"), F.col("tied").alias("v"))).withColumnRenamed("node", "cls")
    # the name of a component is the smallest id of its classes
    grouped = written(
        classes.select("cls", "rep", "copies", "h1", "h2").join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls")),
        "vector-components",
    )
    name = grouped.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("c"))
    known = (
        # a component may hold a large part of all classes
        spread_join(grouped, name, ["component"], n_classes)
        .join(links, "cls", "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    result = hashed.select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = base.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
