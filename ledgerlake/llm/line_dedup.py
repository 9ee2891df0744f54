"""Line dedup by a deletion-neighbourhood join (DataFrame operations only).

A line goes if an earlier line of the corpus (by document id, then position)
is equal to it or within one edit (one character inserted, deleted or
replaced). The first of them stays. Blank lines always stay. Lines shorter
than ``least_chars`` go only as exact repeats.

1. Equal lines: grouped by a 128-bit hash; the earliest occurrence stands for
   them. Everything below sees each different line once.
2. Half keys: two lines within one edit share their first or their last half.
   Only lines that share one with another line of fitting length go on.
3. Deletion variants: such a line emits the hash of the line without its
   i-th character, for every i in the half that may differ, and its own hash.
   Equal variants meet: two lines without the same i-th character differ in
   that character; a line equal to another without one character is one
   deletion away. So each member of a meeting is tied to the earliest one, and
   no pairs inside a meeting are formed.
4. Every tie is verified by the edit distance of the texts.

Defined cases: a null text stays null; rows are told apart by id and text, so
identical rows are one document and fare alike; null ids come last; an empty
table gives no row; extra columns pass by, and working columns have names
that cannot clash (``__`` prefix).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, spread_join, written

EDITS = 1


def _two_hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: its document key (``none, id, th``), place
    ``pos`` (from 0), text ``line`` and hashes ``h1, h2``."""
    text = F.col("text").cast("string")
    base = docs.where(text.isNotNull()).select(*_doc_key(), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    h1, h2 = _two_hashes(F.col("line"))
    return base.where(F.trim("line") != "").select("*", h1.alias("h1"), h2.alias("h2"))


def _doc_key() -> list[Column]:
    return [
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("th"),
    ]


def _half_keys(line: Column) -> Column:
    """Keys of a line as the shorter or equal (its own length) and as the
    longer one (length - 1) of a pair; ``half`` is the part that the pair has
    in common."""
    n = F.length(line)
    out = []
    for length in (n, n - 1):
        first = F.floor(length / 2).cast("int")
        rest = (length - first).cast("int")
        for half, part in (("first", F.substring(line, F.lit(1), first)), ("last", F.substring(line, -rest, rest))):
            out.append(F.struct(F.lit(half == "first").alias("first"), F.xxhash64(length, F.lit(half), part).alias("k")))
    return F.array(*out)


def _variants(lo: Column, hi: Column) -> Column:
    """(place, hash) of the line without its i-th character, lo <= i <= hi."""
    return F.transform(
        F.sequence(lo, hi),
        lambda i: F.struct(
            i.alias("i"),
            F.xxhash64(F.concat(F.substring(F.col("line"), F.lit(1), i - 1), F.substring(F.col("line"), i + 1, F.col("n")))).alias("v"),
        ),
    )


def near_lines(every: DataFrame, first: DataFrame, n_keys: int) -> DataFrame:
    """Different lines within one edit of a line born earlier: ``h1, h2``.

    ``first`` holds ``h1, h2, born, n, keys`` of each different line (``born``:
    its first occurrence); the text of those that share a half key is then
    taken from ``every``."""
    halves = first.select("h1", "h2", F.explode("keys").alias("x")).select("h1", "h2", "x.first", "x.k")
    # a line holds a key once, so a count of two means two different lines
    shared = halves.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    mine = spread_join(halves, shared, ["k"], n_keys).groupBy("h1", "h2").agg(
        F.bool_or(~F.col("first")).alias("edit_first"), F.bool_or("first").alias("edit_last")
    )
    alive = first.select("h1", "h2", "n", "born", "born.*").join(mine, ["h1", "h2"])
    texts = every.select("none", "id", "th", "pos", "line")
    # identical rows of one document give the same line twice
    alive = texts.join(alive, ["none", "id", "th", "pos"]).drop("none", "id", "th", "pos").dropDuplicates(["h1", "h2"])
    # numbers in order of birth: one long stands for a line from here on
    alive = written(alive.orderBy("born").withColumn("ln", F.monotonically_increasing_id()), "near-lines")
    # the differing half, one position wider for pairs of different length
    half = F.floor(F.col("n") / 2).cast("int")
    lo = F.when(F.col("edit_first"), F.lit(1)).otherwise(F.greatest(F.lit(1), half - 1)).cast("int")
    hi = F.when(F.col("edit_last"), F.col("n")).otherwise(F.least(F.col("n"), half + 2)).cast("int")
    own = F.struct(F.lit(0).alias("i"), F.xxhash64("line").alias("v"))
    meet = alive.select("ln", F.explode(F.concat(F.array(own), _variants(lo, hi))).alias("x")).select("ln", "x.i", "x.v")
    # Different lines with one variant in common differ in the character left
    # out, so a variant's rows are bounded by the alphabet, not by the corpus.
    place, variant = Window.partitionBy("v", "i"), Window.partitionBy("v")
    met = meet.select(
        "ln",
        # the same character replaced: equal variants of the same place
        F.when(F.col("i") > 0, F.min("ln").over(place)).alias("same"),
        # one character more or less: a line and another one's variant
        F.when(F.col("i") > 0, F.min(F.when(F.col("i") == 0, F.col("ln"))).over(variant))
        .otherwise(F.min(F.when(F.col("i") > 0, F.col("ln"))).over(variant))
        .alias("other"),
    )
    ties = met.select("ln", F.explode(F.array("same", "other")).alias("w")).where("w < ln").distinct()
    text = alive.select("ln", "h1", "h2", "line")
    earlier = alive.select(F.col("ln").alias("w"), F.col("line").alias("earlier"))
    checked = ties.join(text, "ln").join(earlier, "w")
    return checked.where(F.levenshtein("line", "earlier", EDITS) >= 0).select("h1", "h2").distinct()


def dropped_lines(docs: DataFrame, least_chars: int = 20) -> DataFrame:
    """``none, id, th, drop``: the positions of the lines that go, per
    document."""
    every = lines(docs)
    born = F.struct("none", "id", "th", "pos")
    # hashes, places and half keys are grouped; the text of a line is not shuffled
    first = written(
        every.withColumn("n", F.length("line"))
        .withColumn("keys", F.when(F.col("n") >= least_chars, _half_keys(F.col("line"))))
        .groupBy("h1", "h2")
        .agg(F.min(born).alias("born"), F.count(F.lit(1)).alias("c"), F.min("n").alias("n"), F.first("keys").alias("keys")),
        "first-lines",
    )
    n_lines, n_keys = first.agg(F.sum("c"), F.sum(F.when(F.col("n") >= least_chars, F.size("keys")))).first()
    near = near_lines(every, first.where(F.col("n") >= least_chars), n_keys or 0)
    verdict = first.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("c > 1 OR near").select("h1", "h2", "born", "near", "c")
    # a line that a large part of the corpus repeats has its places dealt over tasks
    gone = (
        spread_join(every.select("none", "id", "th", "pos", "h1", "h2"), verdict, ["h1", "h2"], n_lines or 0, first)
        .where(F.coalesce("near", F.lit(False)) | (F.struct("none", "id", "th", "pos") != F.col("born")))
    )
    return gone.groupBy("none", "id", "th").agg(F.collect_set("pos").alias("drop"))


def _cut_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text`` (``n_chars``, if
    present, follows), and ``__n_dropped``, ``__n_lines``."""
    prepare(docs.sparkSession)
    drop = dropped_lines(docs, least_chars)
    keys = ["__none", "__id", "__th"]
    tagged = docs.select("*", *(c.alias(k) for c, k in zip(_doc_key(), keys)))
    joined = tagged.join(drop.toDF(*keys, "__drop"), keys, "left")
    parts = F.split(F.col("text").cast("string"), "\n")
    gone = F.map_from_entries(F.transform("__drop", lambda p: F.struct(p, F.lit(True))))
    kept = F.filter(parts, lambda x, i: F.element_at(F.col("__gone"), i).isNull())
    out = joined.withColumns(
        {
            "__gone": gone,
            "__n_dropped": F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).cast("long"),
            "__n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long"),
        }
    )
    out = out.withColumn("text", F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns, "__n_dropped", "__n_lines")


def dedup_lines(docs: DataFrame, least_chars: int = 20) -> DataFrame:
    """``docs`` without the dropped lines, and ``n_dropped``, ``n_lines``: lines
    dropped, lines before. They replace columns of that name."""
    out = _cut_lines(docs, least_chars).drop("n_dropped", "n_lines")
    return out.withColumnsRenamed({"__n_dropped": "n_dropped", "__n_lines": "n_lines"})


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20) -> DataFrame:
    """Pipeline form: columns of ``docs``, also those named as the counts of
    :func:`dedup_lines`; a document that loses all its text goes, one that had
    none before stays."""
    done = _cut_lines(docs, least_chars)
    return done.where((F.col("__n_dropped") == 0) | (F.trim("text") != "")).select(*docs.columns)
