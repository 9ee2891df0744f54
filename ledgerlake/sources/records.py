"""Records of CSV files with line breaks inside quotes, split in parallel.

A line break ends a record only if an even number of quotes precedes it in the
file. So the text is read by byte ranges like any other, and

1. each range counts its quotes (one row per range);
2. the parity before each range is a prefix sum over the ranges of a file;
3. each range cuts its lines into whole records, in reading order, with the
   parity it starts with. What it cannot finish (the tail of a record begun
   earlier, the head of one that goes on) it gives out as fragments, two at
   most;
4. fragments are put together per record.

Only ranges that begin inside quotes are broadcast (one row per range of
``spark.sql.files.maxPartitionBytes``), and only fragments are shuffled. Files
follow RFC 4180: a quote inside quoted text is doubled, none stands in unquoted
text; records end with a line feed, or all with a carriage return and one
(breaks inside quotes are then read as a line feed alone, too).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RECORDS = "file string, block long, place long, kind string, record string, head boolean"


def _cut(batches):
    """Records and fragments of ranges (columns ``value``, ``file``, ``block``,
    ``odd``: whether the range begins inside quotes), in reading order."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    schema = pa.schema(zip([x.split()[0] for x in _RECORDS.split(", ")], (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())))
    # of the range at hand: where it is, lines before the batch, whether quotes
    # are open; lines of the record at hand, what it is and where it began; the
    # place of the file's first record
    now, place, inside = None, 0, False
    held, kind, began = [], "head", 0
    head = None

    def row(what):
        return (*now, began, what, "\n".join(held), now[1] == 0 and began == head and what != "tail")

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for b in batches:
        if not b.num_rows:
            continue
        files, blocks, odd = b.column("file"), b.column("block").to_numpy(), b.column("odd")
        code = files.dictionary_encode().indices.to_numpy()  # two files may both be at one offset
        change = np.flatnonzero((np.diff(blocks, prepend=blocks[0] - 1) != 0) | (np.diff(code, prepend=code[0]) != 0))
        for lo, hi in zip(change, [*change[1:], b.num_rows]):
            here, rows = (files[int(lo)].as_py(), int(blocks[lo])), []
            if here != now:
                if held:
                    rows.append(row(kind))
                now, place, inside, head = here, 0, bool(odd[int(lo)].as_py()), None
                held, kind, began = [], "middle" if inside else "head", 0
            part = b.column("value").slice(int(lo), int(hi - lo))
            quotes = pc.count_substring(part, '"').to_numpy(zero_copy_only=False)
            after = (np.cumsum(quotes) + inside) % 2 == 1
            before = np.concatenate(([inside], after[:-1]))
            if now[1] == 0 and head is None:
                some = np.flatnonzero(~before & ~pc.is_in(part, pa.array(["", "\r"])).to_numpy(zero_copy_only=False))
                head = place + int(some[0]) if len(some) else None
            at = np.flatnonzero(~(before | after))
            if len(at):
                n = len(at)
                cols = [pa.array([now[0]] * n), pa.array(np.full(n, now[1])), pa.array(place + at), pa.array(["whole"] * n), part.take(pa.array(at))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array((place + at == head) & (now[1] == 0) if head is not None else np.zeros(n, bool))], schema=schema)
            for k in np.flatnonzero(before | after).tolist():  # lines of records with several
                if not held and not before[k]:
                    kind, began = "head", place + k
                held.append(part[k].as_py())
                if not after[k]:
                    # whole if it began here
                    rows.append(row("whole" if kind == "head" else "tail"))
                    held, kind = [], "head"
            inside, place = bool(after[-1]), place + int(hi - lo)
            if rows:
                yield out(rows)
    if held:
        yield out([row(kind)])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, place, record, head``: one row per record of the CSV
    files at ``path``, blank lines left out. ``block`` (the range) and
    ``place`` order the records of a file; ``head`` is true for its first
    (which begins in the file's first range)."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = blocks.select("file", "block", (F.sum("quotes").over(before) % 2 == 1).alias("odd")).where("odd")
    started = lines.join(F.broadcast(odd), ["file", "block"], "left").select("value", "file", "block", F.coalesce("odd", F.lit(False)).alias("odd"))
    cut = started.mapInArrow(_cut, _RECORDS)

    pieces = cut.where("kind <> 'whole'")
    upto = Window.partitionBy("file").orderBy("block", "place")
    number = F.sum((F.col("kind") == "head").cast("long")).over(upto)
    joined = (
        pieces.withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("block", "place", "record", "head"))).alias("parts"))
        .select(
            "file",
            F.col("parts")[0]["block"].alias("block"),
            F.col("parts")[0]["place"].alias("place"),
            F.array_join("parts.record", "\n").alias("record"),
            F.col("parts")[0]["head"].alias("head"),
        )
    )
    out = cut.where("kind = 'whole'").drop("kind").unionByName(joined)
    r = F.col("record")
    r = F.when(r.endswith("\r"), F.replace(F.expr("substr(record, 1, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))).otherwise(r)
    out = out.withColumn("record", r).where("record <> ''")
    return out.withColumn("record", F.when(F.col("head"), F.ltrim(F.col("record"), F.lit("\ufeff"))).otherwise(F.col("record")))


def parsed(records: DataFrame, columns: list[str]) -> DataFrame:
    """Fields of :func:`csv_records` as text columns. The first record of each
    file must hold the names ``columns`` and goes; a record with another
    number of fields raises."""
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true"}
    rows = records.select("head", "file", F.from_csv("record", schema, options).alias("r"))
    fields = [F.col(f"r.c{i}") for i in range(len(columns))]
    same = F.lit(True)
    for f, name in zip(fields, columns):
        same = same & f.eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.concat(F.lit("the header is not "), F.lit(",".join(columns)), F.lit(" in "), F.col("file")))
    kept = rows.where(F.when(~F.col("head"), True).when(same, False).otherwise(wrong.cast("boolean")))
    return kept.select(*[f.alias(name) for f, name in zip(fields, columns)])
