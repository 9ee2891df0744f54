"""Best-fit packing of documents into fixed-capacity sequences.

Every document becomes its token ids followed by an end id. A longer document
is cut into pieces of exactly ``capacity`` tokens, its first piece taking the
remainder, so each document has at most one piece below the capacity. Full
pieces are sequences of their own; the others are packed:

* large items (above a third of the capacity) meet at most one other large
  item per bin: the largest is matched with the largest partner that fits;
* smaller items go, largest first, into the tightest remaining gap.

Only piece *lengths* matter for the packing, so it runs on the histogram of
lengths (at most ``capacity`` numbers, whatever the input size) and yields
runs "items r..r+n of length s go to sequences q..q+n at offset o". Each piece
finds its run from its rank among the pieces of its length. Ranks come from
per-task counters plus prefix sums over tasks: no sort, no single-task window,
and token ids are never shuffled.

Defined cases: null or empty text is the end id alone (one piece of length
1); repeated rows are packed each on their own; null ids are carried through;
ties among pieces of equal length go by task and reading order; an empty
table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import default_paths, tokens
from ledgerlake.llm.common import prepare, written

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, nth long"
_RANK_BITS = 44


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: only the
    first may be shorter than ``capacity``."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(
    docs: DataFrame,
    capacity: int = 1024,
    end_id: int = 2,
    paths: tuple[str, str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents (columns ``doc_id``, ``text``), with the crc32 of
    their little-endian unsigned 32-bit ids, the task that made them and
    their rank among that task's pieces of the same length. ``with_ids`` adds
    the ids themselves (``ids``, binary)."""
    prepare(docs.sparkSession)
    ranks, json_file = paths or default_paths()

    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids

    def run(batches):
        import pyarrow as pa

        encode = tokens(ranks, json_file)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            texts = [t or "" for t in b.column("text").to_pylist()]
            for doc, ids in zip(b.column("doc_id").to_pylist(), encode.batch(texts)):
                raw = np.append(ids, end_id).astype("<u4")
                for k, (s, n) in enumerate(cut_points(len(raw), capacity)):
                    piece = raw[s : s + n].tobytes()
                    row = (doc, k, s, n, zlib.crc32(piece), task, int(seen[n]))
                    rows.append((*row, piece) if with_ids else row)
                    seen[n] += 1
            cols = list(zip(*rows)) or [()] * len(names)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def packing_plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Runs of the packing and the number of sequences.

    A run (length, first rank, count, first sequence, offset) places ``count``
    items one per sequence. The work depends on the number of distinct
    lengths, not on the number of items."""
    left = {s: n for s, n in histogram.items() if n > 0}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(size: int, count: int, first: int, offset: int) -> None:
        runs.append((size, rank[size], count, first, offset))
        rank[size] += count
        left[size] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            gaps.setdefault(gap, []).append((first, count))

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((x for x in large if x <= min(a, capacity - a) and left[x] >= 1 + (x == a)), None)
            n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            place(a, n, sequences, 0)
            if b is not None:
                place(b, n, sequences, a)
            leave(capacity - a - (b or 0), sequences, n)
            sequences += n

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            gap = min((g for g in gaps if g >= s), default=None)
            if gap is None:
                gap, bins = capacity, -(-left[s] // (capacity // s))
                first, sequences = sequences, sequences + bins
            else:
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            each = gap // s
            full = min(bins, left[s] // each)
            for k in range(each if full else 0):
                place(s, full, first, capacity - gap + k * s)
            leave(gap - each * s, first, full)
            part = left[s] if full < bins else 0
            if part:
                for k in range(part):
                    place(s, 1, first + full, capacity - gap + k * s)
                leave(gap - part * s, first + full, 1)
            leave(gap, first + full + bool(part), bins - full - bool(part))
    return np.array(runs, np.int64).reshape(-1, 5), sequences


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (columns ``length``,
    ``task``, ``nth`` as made by :func:`token_pieces`)."""
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    per_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = packing_plan(per_length, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    key = (runs[:, 0] << _RANK_BITS) + runs[:, 1]

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = pieces.drop("task", "nth").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    carried = [n for n in schema.names if n in pieces.columns]

    def place(batches):
        import pyarrow as pa

        for b in batches:
            length = b.column("length").to_numpy().astype(np.int64)
            rank = b.column("base").to_numpy() + b.column("nth").to_numpy()
            at = np.searchsorted(key, (length << _RANK_BITS) + rank, side="right") - 1
            cols = {n: b.column(n) for n in carried}
            cols["sequence_id"] = pa.array(runs[at, 3] + rank - runs[at, 1], pa.int64())
            cols["offset"] = pa.array(runs[at, 4], pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    return pieces.join(bases, ["length", "task"]).select(*pieces.columns, "base").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, paths: tuple[str, str] | None = None) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece with its
    sequence and place (``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``)."""
    pieces = written(token_pieces(docs, capacity, end_id, paths), "pieces")
    return pack(pieces, capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
