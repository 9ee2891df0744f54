"""Column coercions: untyped text → declared types, bad values → null.

All of these are built-in Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen. Each accepts either a text column or a column that
is already of the target type, so the same plan runs on CSV text and on typed
Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens a pandas CSV reader treats as missing by
# default (ledger L11). Kept for parity; pass ``na_tokens=()`` to keep e.g.
# the country code "NA" as text.
PANDAS_NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Default timestamp text pattern: ISO date, space, time, and a numeric UTC
# offset ("2024-01-10 17:07:01+00:00") that may be missing: naive text is UTC
# (ledger L6), the session's zone. Other layouts become null (ledger L7).
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss[XXX]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens=PANDAS_NA_TOKENS) -> Column:
    """Text equal to one of ``tokens`` becomes null (ledger L11)."""
    col = _col(c)
    if not tokens:
        return col
    return F.when(~col.isin(list(tokens)) | col.isNull(), col)


def whole_number(c: str | Column) -> Column:
    """Text or number → BIGINT; fractional or unparseable → null.

    ``"9.0"`` is 9 (ids written from a float column); ``"1.5"`` and ``"x"``
    are null. Parsing goes through an exact decimal, so ids above 2^53 keep
    every digit.
    """
    dec = _col(c).try_cast(T.DecimalType(38, 6))
    whole = dec == F.floor(dec)
    return F.when(whole, dec.try_cast(T.LongType()))


def amount(c: str | Column, dtype: T.DecimalType = T.DecimalType(18, 2)) -> Column:
    """Text or number → exact decimal; unparseable → null."""
    return _col(c).try_cast(dtype)


def utc_timestamp(c: str | Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Text of the pattern → UTC timestamp, naive text read as UTC; other text →
    null (P6, L6, L7).

    Use :func:`coerce_column` when the input may already be typed.
    """
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def coerce_column(
    name: str,
    source: T.DataType,
    target: T.DataType,
    pattern: str = TIMESTAMP_PATTERN,
) -> Column:
    """Coerce column ``name`` of type ``source`` to ``target``.

    Text is parsed with the rules above; a column already of the target
    type passes through; other typed input is cast with ``try_cast``
    (a TIMESTAMP_NTZ is read as UTC wall-clock time).
    """
    c = F.col(name)
    if source == target:
        return c.alias(name)
    if isinstance(source, T.StringType):
        if isinstance(target, T.TimestampType):
            return utc_timestamp(c, pattern).alias(name)
        return parse_text(c, target).alias(name)
    if isinstance(target, T.LongType) and isinstance(
        source, (T.DecimalType, T.DoubleType, T.FloatType)
    ):
        return whole_number(c).alias(name)
    return c.try_cast(target).alias(name)


def parse_text(c: str | Column, dtype: T.DataType) -> Column:
    """Coerce one text column to a declared type."""
    if isinstance(dtype, T.LongType):
        return whole_number(c)
    if isinstance(dtype, T.DecimalType):
        return amount(c, dtype)
    if isinstance(dtype, T.TimestampType):
        return utc_timestamp(c)
    if isinstance(dtype, T.BooleanType):
        return boolean(c)
    return _col(c).cast(dtype)


def truth_text(c: str | Column) -> Column:
    """KYC gate test: text upper-cased equals ``TRUE``; anything else, null
    included, is false (F4, ledger L10). A BOOLEAN column casts to
    ``true``/``false`` first, so typed input works too."""
    return F.coalesce(F.upper(_col(c).cast("string")) == F.lit("TRUE"), F.lit(False))


def boolean(c: str | Column) -> Column:
    """Text → BOOLEAN for the landing table; unknown text → null."""
    return _col(c).try_cast(T.BooleanType())


def coerce_frame(df, schema: T.StructType, pattern: str = TIMESTAMP_PATTERN, keep_extra=True):
    """Coerce the columns of ``df`` named in ``schema`` to their declared types.

    Column order of ``df`` is kept; columns not in ``schema`` pass through
    (or are dropped when ``keep_extra`` is false). One projection, no shuffle.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    cols = []
    for f in df.schema.fields:
        if f.name in declared:
            cols.append(coerce_column(f.name, f.dataType, declared[f.name], pattern))
        elif keep_extra:
            cols.append(F.col(f.name))
    return df.select(*cols)
