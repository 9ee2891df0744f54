"""Positional operators without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Positions are computed in two phases instead:

1. sort (range-partitioned, so every task holds one contiguous, ordered slice)
   and tag each row with its partition id and its place inside the partition;
2. count rows per partition — one row per partition, a size bounded by the
   partition count — turn the counts into starting offsets and broadcast
   them back.

The tagged rows are checkpointed first (to the shared folder in
``spark.checkpoint.dir``), so both phases see the same partitioning even if
AQE re-plans or an executor is lost and tasks are recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

# monotonically_increasing_id() puts the partition index in the upper bits.
_PARTITION_SHIFT = 33


def indexed_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "row_index",
    presorted: bool = False,
    checkpoint: bool = True,
) -> tuple[DataFrame, int]:
    """Add ``name``: the 0-based position of each row in ``order_by`` order;
    also return the number of rows.

    ``presorted=True`` skips the sort when the partitions of ``df`` are
    already ordered slices (e.g. a fresh ``spark.range``);
    ``checkpoint=False`` is safe only when ``df`` recomputes to the same
    partitions (again, ``spark.range``).
    """
    spark = df.sparkSession
    if presorted:
        ordered = df
    else:
        # A content hash as the last sort key lets the range partitioner spread
        # rows that tie on ``order_by`` (a hot key) over several partitions;
        # only fully identical rows still tie, and their order is immaterial.
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        ordered = df.orderBy(*order_by, spread)
    tagged = ordered.withColumn("__ri_pid", F.spark_partition_id()).withColumn(
        "__ri_pos",
        F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), _PARTITION_SHIFT),
    )
    if checkpoint:
        ensure_checkpoint_dir(spark)
        tagged = tagged.checkpoint(eager=True)
    # One row per partition — bounded by the partition count, not the data —
    # so it is collected, turned into starting offsets and broadcast back.
    counts = sorted(tuple(r) for r in tagged.groupBy("__ri_pid").agg(F.count(F.lit(1))).collect())
    offsets, total = [], 0
    for pid, n in counts:
        offsets.append((int(pid), total))
        total += int(n)
    offsets_df = spark.createDataFrame(offsets, "__ri_pid int, __ri_offset long")
    indexed = (
        tagged.join(F.broadcast(offsets_df), "__ri_pid")
        .withColumn(name, F.col("__ri_offset") + F.col("__ri_pos"))
        .drop("__ri_pid", "__ri_pos", "__ri_offset")
    )
    return indexed, total


def row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "row_index",
    presorted: bool = False,
    checkpoint: bool = True,
) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order_by`` order
    (see :func:`indexed_rows`)."""
    return indexed_rows(df, order_by, name, presorted, checkpoint)[0]


def running_allocation(
    df: DataFrame,
    order_by: Sequence[str | Column],
    flag: Column,
    start: int | Column,
    name: str = "allocated",
    presorted: bool = False,
    checkpoint: bool = True,
) -> DataFrame:
    """W4 — each flagged row takes the previous allocation + 1, starting after
    ``start``, in ``order_by`` order; other rows get null.

    The running counter is the row's position among the flagged rows, so it
    is a :func:`row_index` of the flagged subset.
    """
    flagged = df.where(flag)
    rest = df.where(~flag | flag.isNull()).withColumn(name, F.lit(None).cast("long"))
    indexed = row_index(flagged, order_by, "__k", presorted, checkpoint)
    start_col = start if isinstance(start, Column) else F.lit(start)
    allocated = indexed.withColumn(name, (start_col + F.col("__k") + 1).cast("long")).drop("__k")
    return allocated.unionByName(rest)
