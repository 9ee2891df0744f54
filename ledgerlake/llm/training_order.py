"""Training-order materialisation: fixed-stride binary shards in the order of a
keyed permutation.

Every document becomes its token ids and an end id, cut into sequences of
``length`` tokens (the first of a document may be shorter). Sequences are
numbered without gaps; a balanced Feistel network over the next even power of
two, walked until it falls inside the range (cycle-walking), is a keyed
permutation of these numbers and gives each sequence its global slot. Slots
are dealt to shards by range: shard ``s`` holds slots ``s * shard_rows`` to
``(s + 1) * shard_rows - 1``, in order, as records of one fixed size. A reader
finds any slot by arithmetic and can resume anywhere.

Record (little endian, :func:`record_type`): document id int64 (the least int64
for a null id), start int64, piece uint32, token count uint16, ids uint16 x
length (zero padded), crc32 of the used ids (as uint32 values), a zero byte and
a line feed.

The numbering needs the number of sequences per task before any id is
written, so texts are tokenised twice: counting first, then each task writes
into known numbers. That costs CPU and saves storing all ids once more. The
input must split alike both times, as files do; a task that meets another
number of sequences than it counted fails instead of writing wrong slots.

Defined cases: null or empty text is one sequence holding the end id; null
ids are carried; repeated rows are sequences of their own; order before the
permutation is that of documents by task and row; an empty table gives an
empty result and no shard; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import default_paths, tokens
from ledgerlake.llm.common import prepare, shared_path, written
from ledgerlake.llm.packing import cut_points
from ledgerlake.llm.spans import mix
from ledgerlake.session import parallelism

NULL_ID = -(1 << 63)


def record_type(length: int) -> np.dtype:
    return np.dtype(
        [("doc_id", "<i8"), ("start", "<i8"), ("piece", "<u4"), ("count", "<u2"), ("ids", "<u2", (length,)), ("crc", "<u4"), ("mark", "u1"), ("end", "u1")]
    )


def feistel(x: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed permutation of 0..n-1 applied to each of ``x``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = np.asarray(x, np.uint64).copy()
    walk = np.ones(len(out), bool)
    while walk.any():
        left, right = out[walk] >> np.uint64(half), out[walk] & low
        for r in range(rounds):
            turn = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
            left, right = right, left ^ (mix(right ^ turn) & low)
        out[walk] = left << np.uint64(half) | right
        walk = out >= np.uint64(n)
    return out.astype(np.int64)


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _ids(batch, encode, end_id: int):
    for doc, ids in zip(batch.column("doc_id").to_pylist(), encode.batch([t or "" for t in batch.column("text").to_pylist()])):
        yield doc, np.append(ids, end_id)


def write_shards(
    docs: DataFrame,
    path: str,
    length: int = 256,
    shard_rows: int = 4096,
    key: int = 2024,
    end_id: int = 2,
    paths: tuple[str, str] | None = None,
    shards_per_task: int = 16,
) -> int:
    """Write all sequences of ``docs`` below ``path`` (one folder per shard, one
    file in each); returns the number of sequences. A task writes a range of
    at most ``shards_per_task`` shards, fewer where that leaves cores idle."""
    spark = prepare(docs.sparkSession)
    ranks, json_file = paths or default_paths()
    source = _text(docs)

    def count(batches):
        import pyarrow as pa

        encode, task, n = tokens(ranks, json_file), TaskContext.get().partitionId(), 0
        for b in batches:
            n += sum(-(-len(ids) // length) for _, ids in _ids(b, encode, end_id))
        yield pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "n": pa.array([n], pa.int64())})

    # one row per task
    per_task = written(source.mapInArrow(count, "task int, n long"), "sequence-counts")
    order = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = per_task.select("task", "n", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")).collect()
    bases = {r["task"]: (r["base"], r["base"] + r["n"]) for r in begun}
    total = per_task.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if not total:
        return 0
    shared = spark.sparkContext.broadcast(bases)
    kind = record_type(length)

    def write(batches):
        import pyarrow as pa

        encode, (at, due) = tokens(ranks, json_file), shared.value[TaskContext.get().partitionId()]
        for b in batches:
            rows = []
            for doc, ids in _ids(b, encode, end_id):
                for k, (s, n) in enumerate(cut_points(len(ids), length)):
                    r = np.zeros(1, kind)
                    r["doc_id"], r["start"], r["piece"], r["count"] = NULL_ID if doc is None else doc, s, k, n
                    r["ids"][0, :n] = ids[s : s + n]
                    r["crc"] = zlib.crc32(ids[s : s + n].astype("<u4").tobytes())
                    r["end"] = 10
                    rows.append(r.tobytes()[:-1])
            slot = feistel(np.arange(at, at + len(rows)), total, key)
            at += len(rows)
            if at > due:
                break
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot), "record": pa.array(rows, pa.binary())})

        if at != due:
            raise ValueError("the input was split differently the second time; store it first")

    placed = source.mapInArrow(write, "slot long, record binary").withColumn("shard", F.expr(f"slot div {shard_rows}"))
    # slots have no gaps, so equal ranges of whole shards are known beforehand
    shards = -(-total // shard_rows)
    each = max(1, min(shards_per_task, shards // max(1, parallelism(spark))))
    (
        placed.repartitionById(-(-shards // each), F.expr(f"cast(shard div {each} as int)"))
        .sortWithinPartitions("shard", "slot")
        # the text writer adds the line feed that ends each record
        .select(F.col("record").cast("string").alias("value"), "shard")
        .write.partitionBy("shard")
        .option("lineSep", "\n")
        .text(path)
    )
    return total


def read_shards(spark: SparkSession, path: str, length: int = 256, shard_rows: int = 4096) -> DataFrame:
    """Every record of the shards: ``slot, shard, place, doc_id, piece, start,
    length, ids_crc32, intact`` (the ids in the file have the stored crc)."""
    kind = record_type(length)
    schema = "slot long, shard long, place long, doc_id long, piece int, start long, length long, ids_crc32 long, intact boolean"

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content")):
                r = np.frombuffer(content.as_buffer(), kind)
                crc = [zlib.crc32(x[:n].astype("<u4").tobytes()) for x, n in zip(r["ids"], r["count"])]
                place = np.arange(len(r))
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(shard * shard_rows + place, pa.int64()),
                        "shard": pa.array(np.full(len(r), shard), pa.int64()),
                        "place": pa.array(place, pa.int64()),
                        "doc_id": pa.array(r["doc_id"].copy(), pa.int64(), mask=r["doc_id"] == NULL_ID),
                        "piece": pa.array(r["piece"].astype(np.int32)),
                        "start": pa.array(r["start"].copy()),
                        "length": pa.array(r["count"].astype(np.int64)),
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "intact": pa.array((r["crc"] == np.array(crc)) & (r["end"] == 10)),
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    shard = F.regexp_extract(F.col("path"), r"/shard=(\d+)/", 1).cast("long").alias("shard")
    return files.select(shard, "content").mapInArrow(run, schema)


def training_order(docs: DataFrame, length: int = 256, shard_rows: int = 4096, key: int = 2024, **settings) -> DataFrame:
    """Materialise ``docs`` in training order below the shared folder and return
    what reading every shard back gives."""
    spark = prepare(docs.sparkSession)
    path = shared_path(spark, "shards")
    if not write_shards(docs, path, length, shard_rows, key, **settings):
        schema = "slot long, shard long, place long, doc_id long, piece int, start long, length long, ids_crc32 long, intact boolean"
        return spark.createDataFrame([], schema)
    return read_shards(spark, path, length, shard_rows)
