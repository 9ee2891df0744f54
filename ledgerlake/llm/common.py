"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

# Rows and bytes of one Arrow batch: most batches of texts are a few MB, and
# very long texts or whole files make shorter ones.
BATCH_ROWS, BATCH_BYTES = 512, 64 << 20

# A key with more than this part (1 / HOT_SHARE) of the rows is dealt over tasks.
HOT_SHARE = 1000

_SHIPPED: set[str] = set()
_WRITTEN: list[str] = []  # folders made by written(), for scratch()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: small Arrow batches, a checkpoint
    folder, and this package on the workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that their
    Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it came as an archive that Spark ships already
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "ledgerlake_package.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one table of the data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage
    is cut and a lost executor costs nothing already written."""
    path = shared_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scratch(spark: SparkSession, keep: list[str]):
    """On leaving, delete the folders that :func:`written` made inside, but for
    those whose name begins with one of ``keep``. Whatever is still needed must
    have been written there by then."""
    start = len(_WRITTEN)
    yield
    for path in _WRITTEN[start:]:
        if not any(path.rsplit("/", 1)[1].startswith(k) for k in keep):
            delete(spark, path)
    del _WRITTEN[start:]


def unit_hash(h: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1."""
    return h.cast("double") / F.lit(2.0**64) + F.lit(0.5)


def spread_join(rows: DataFrame, per_key: DataFrame, keys: list[str], total: int, counts: DataFrame | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``per_key`` (one row per key, whose column
    ``c`` counts the key's rows in ``rows`` or more; it is dropped), safe for
    hot keys. A key with more than one ``HOT_SHARE``-th of ``total`` (at least
    the sum of ``c``) is dealt over several salts by a hash of the row, and its
    one row of ``per_key`` is repeated for each.

    AQE splits a skewed partition only where both sides come straight from a
    shuffle, which a freshly aggregated ``per_key`` does not. Fewer than
    ``HOT_SHARE`` keys can be hot, so their list is broadcast. ``counts`` may
    hold the keys and ``c`` where ``per_key`` costs much to work out twice."""
    salts = F.greatest(F.lit(1), F.ceil(F.col("c") * HOT_SHARE / F.lit(max(total, 1)))).cast("int")
    hot = (per_key if counts is None else counts).select(*keys, salts.alias("__salts")).where("__salts > 1")
    salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("__salts", F.lit(1))).cast("int")
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", salt).drop("__salts")
    copied = per_key.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("c")
    return dealt.join(copied, [*keys, "__salt"]).drop("__salt")


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str], unique: list[str] | None = None) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that no group of equal ``keys`` is cut: each
    frame given out holds one or more complete groups. Of rows of a group that
    agree in ``unique`` the first stays. Memory is bounded by one batch plus
    the largest group."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if not len(frame):
            continue
        rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if unique:
            rest = rest.drop_duplicates([*keys, *unique], ignore_index=True)
        last = rest[keys].iloc[-1]
        same = (rest[keys] == last).all(axis=1).to_numpy()
        # rows are sorted, so the last group is the tail of equal rows
        cut = len(same) - int(same[::-1].cumprod().sum())
        if cut:
            yield rest.iloc[:cut].reset_index(drop=True)
            rest = rest.iloc[cut:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Connected components of the undirected ``edges`` (columns ``u``, ``v``,
    long). Returns ``node``, ``component``: the smallest id reachable, for
    every node of an edge between different nodes.

    Alternates large-star and small-star contraction (Kiveris et al., 2014)
    until the edge set stops changing. Each round keeps one row per edge; a
    node with very many edges is met by a one-row-per-node table of minima,
    so its rows are dealt over several tasks. Nulls and self-loops are ignored; no edge
    gives no row. ``rounds`` limits the rounds in tests only.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)

    def stamp(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    e = (
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint(eager=True)
    )
    seen, n = stamp(e), 0
    while seen[0] and (rounds is None or n < rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")).select("u", F.least("u", "m").alias("m"), "c")
        large = (
            spread_join(both.where("v > u"), least, ["u"], 2 * seen[0])
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
            .select(F.col("x.u").alias("u"), F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        e, before = small.checkpoint(eager=True), seen
        seen, n = stamp(e), n + 1
        if seen == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
