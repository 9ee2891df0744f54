"""Mixing sources to target weights (DataFrame operations only).

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share
100 % of all words. A target stops at ``most_epochs`` times its source's
size; the excess is shared again by weight until no target is above that.
As every source below its limit holds the same number of words per unit of
weight at each stage, this is one level: sources whose limit lies below
weight x level stop there, and the level follows from prefix sums over the
sources ordered by limit / weight (one row per source).

Within a source, documents come in the order of a keyed hash. Prefix sums of
their sizes are distributed: the hash range is cut into slices of bounded
row count, slice totals are summed per source (one row per slice), and
running sums inside a slice complete them. A hot source has more slices, not
larger ones. The target is cut exactly: each document is taken once per whole
epoch, and the last, partial epoch ends inside one document.

Defined cases: null text has size 0; a null source is a source of its own,
last; null ids take part (as empty text in the hash); rows of the same id,
text and source are interchangeable; sizes of zero give targets of zero; an
empty table gives no row; extra columns are ignored by the plan and kept by
:func:`mix_documents`. Order keys hash the text and source with the id, so many
rows of one id, or of none, spread over the slices like others; only identical
rows meet, and those are added up to one row with a count before any window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, spread_join, written

# A word is a maximal run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# A cut after each word, so that the pieces join to the text again.
_WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
_WEIGHTS = 3
_AT_ONCE = 1 << 16  # result rows of identical documents made in one go
_HEX = 13  # hex digits of the hash that place a document in its slice


def _wide(name: str) -> Column:
    """A whole number as a decimal, so that products cannot overflow."""
    return F.col(name).cast("decimal(19,0)")


def words_in(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, most_epochs: int = 3) -> DataFrame:
    """``source, source_size, documents, target`` of each source of ``sized``
    (columns ``source``, ``size``)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = per.withColumn("w", ((F.row_number().over(order) - 1) % _WEIGHTS + 1).cast("long")).withColumn(
        "stop", F.col("source_size") * most_epochs
    )
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rise = Window.orderBy(F.col("stop") / F.col("w"), F.col("source").asc_nulls_last())
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        weighed.withColumn("total", F.sum("source_size").over(every))
        .withColumn("words_left", F.col("total") - F.coalesce(F.sum("stop").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        # the first source, in this order, that the common level does not fill
        .withColumn("open", _wide("words_left") * _wide("w") <= _wide("stop") * _wide("weight_left"))
        .withColumn("first_open", F.max(F.col("open").cast("int")).over(rise.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("at_words", F.max(F.when(F.col("open") & (F.col("first_open") == 1), F.col("words_left"))).over(every))
        .withColumn("at_weight", F.max(F.when(F.col("words_left") == F.col("at_words"), F.when(F.col("open"), F.col("weight_left")))).over(every))
    )
    target = F.when(
        F.col("first_open") == 1,
        F.col("at_words").cast("double") * F.col("w").cast("double") / F.col("at_weight").cast("double"),
    ).otherwise(F.col("stop").cast("double"))
    return level.select("source", "source_size", "documents", target.alias("target"))


def order_key(seed: str = "mix") -> Column:
    """Hash of a row's id, text and source, nulls told from empty text."""
    source = F.when(F.col("source").isNull(), F.lit("|")).otherwise(F.concat(F.lit("|="), F.col("source").cast("string")))
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), text, source).cast("binary"))


def mix_plan(docs: DataFrame, most_epochs: int = 3, seed: str = "mix", slice_rows: int | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and the order key ``key``)
    of every document; identical rows (of one ``key``) as one row with their
    number ``same`` and what they take together, ``all_taken``."""
    sized = docs.select("doc_id", "source", words_in("text").alias("size"), order_key(seed).alias("key"))
    # identical rows become one, added up before the shuffle: one id and text
    # may be a large part of all rows
    same = ["doc_id", "source", "size", "key"]
    sized = written(sized.groupBy(*same).agg(F.count(F.lit(1)).alias("same")).withColumn("in_all", F.col("size") * F.col("same")), "sized")
    goal = written(targets(sized.select("source", F.col("in_all").alias("size")), most_epochs).withColumn("c", F.col("documents")), "targets")
    total = goal.agg(F.sum("c")).first()[0] or 0
    by_source = lambda df: df.withColumns({"s": F.coalesce("source", F.lit("")), "none": F.col("source").isNull()}).drop("source")
    # by default as many slices as rows in each: both grow with the square root
    wanted = F.sqrt(F.col("documents")) if slice_rows is None else F.col("documents") / slice_rows
    slices = F.greatest(F.lit(1), F.ceil(wanted)).cast("long")
    place = F.conv(F.substring("key", 1, _HEX), 16, 10).cast("double") / F.lit(float(16**_HEX))
    placed = (
        spread_join(by_source(sized), by_source(goal), ["s", "none"], total)
        .withColumn("slice", F.floor(place * slices).cast("long"))
        # else the join's partitioning by source could serve the window below
        .repartition("s", "none", "slice")
    )
    totals = placed.groupBy("s", "none", "slice").agg(F.sum("in_all").alias("in_slice"))
    earlier = Window.partitionBy("s", "none").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("s", "none", "slice", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s", "none", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    running = (
        placed.withColumn("run", F.coalesce(F.sum("in_all").over(inside), F.lit(0)))
        .join(bases, ["s", "none", "slice"])
        .withColumn("before", F.col("base") + F.col("run"))
    )
    cut = running.withColumn("budget", F.floor(F.col("target") + 0.5).cast("long")).withColumn(
        "epochs", F.expr("IF(source_size > 0, budget div source_size, 0)")
    )
    # of the rows ``same`` the first ones are taken first
    part = F.greatest(F.lit(0), F.least(F.col("in_all"), F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")))
    return cut.withColumn("part", part.cast("long")).select(
        "doc_id", "size", "source_size", "target", "key", "same", "epochs", "part",
        (F.col("epochs") * F.col("in_all") + F.col("part")).alias("all_taken"),
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The plan's rows: ``doc_id, size, source_size, target, taken``, one for
    each row of ``docs``."""
    prepare(docs.sparkSession)
    plan = written(mix_plan(docs, **settings), "mix")
    # a row that stands for very many goes to several tasks
    last = F.col("same") - 1
    few = plan.where(F.col("same") <= _AT_ONCE).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    parts = plan.where(F.col("same") > _AT_ONCE).withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / _AT_ONCE)))).repartition("key", "lot")
    upto = F.least(last, F.col("lot") * _AT_ONCE + (_AT_ONCE - 1))
    many = parts.withColumn("nth", F.explode(F.sequence(F.col("lot") * _AT_ONCE, upto))).drop("lot")
    each = few.unionByName(many)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("nth") * F.col("size")))
    taken = (F.col("epochs") * F.col("size") + part).cast("long")
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: each row repeated once per time it is taken; the one
    that a source's budget ends in is cut there, after a whole word.
    Columns are those of ``docs``; ``n_chars`` (if present) follows the text.
    Documents without words share no budget and are not part of the mix."""
    prepare(docs.sparkSession)
    plan = mix_plan(docs, **settings).where("all_taken > 0")
    share = written(plan.select(F.col("key").alias("__key"), F.col("all_taken").alias("__taken"), F.col("size").alias("__size"), F.col("same").alias("c")), "shares")
    counted = share.agg(F.sum("c")).first()[0] or 0
    # the row's number tells identical rows apart, so that a hot key is dealt
    numbered = docs.withColumns({"__key": order_key(), "__row": F.monotonically_increasing_id()})
    found = spread_join(numbered, share.withColumn("__same", F.col("c")), ["__key"], counted)
    # identical rows of one id and source share what they take; one of them stands for all
    rows = found.where("__same = 1").unionByName(found.where("__same > 1").dropDuplicates(["__key"]))
    rows = rows.withColumn("__whole", F.expr("CAST(__taken div __size AS INT)")).withColumn("__rest", F.expr("CAST(__taken % __size AS INT)"))
    copies = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__whole") + F.when(F.col("__rest") > 0, 1).otherwise(0))))
    start = F.array_join(F.slice(F.split("text", _WORD_END), F.lit(1), F.col("__rest")), "")
    text = F.when((F.col("__copy") > F.col("__whole")), start).otherwise(F.col("text"))
    out = copies.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
