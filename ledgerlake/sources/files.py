"""File sources and sinks.

CSV is read untyped (every column text, by header name), null tokens are
applied (ledger L11) and the declared columns are coerced with the rules of
:mod:`ledgerlake.functions.coerce`. Writers are Spark's distributed writers;
each returns the path, like the reference's helpers, so steps can hand a
location to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.coerce import PANDAS_NA_TOKENS, TIMESTAMP_PATTERN, coerce_frame, null_tokens
from ledgerlake.schemas import SCHEMAS
from ledgerlake.sources import records

# Text layout of timestamps written to CSV: "2024-01-10 17:07:01+00:00"
# (``xxx`` prints "+00:00" for UTC where ``XXX`` would print "Z").
CSV_TIMESTAMP_OUT = "yyyy-MM-dd HH:mm:ssxxx"

# Columns that stay text in the raw frame because a later step applies a text
# rule to them (the KYC flag, ledger L10).
RAW_TEXT_COLUMNS = {"players": ("is_kyc_approved",)}


def raw_schema(table: str) -> T.StructType:
    """Declared schema of a raw table: like the landing schema, but columns
    read by a text rule stay strings."""
    keep = RAW_TEXT_COLUMNS.get(table, ())
    return T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in keep else f for f in SCHEMAS[table].fields]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    na_tokens=PANDAS_NA_TOKENS,
    pattern: str = TIMESTAMP_PATTERN,
    multi_line: bool = False,
) -> DataFrame:
    """S1 — header CSV → DataFrame. All columns are read as text, named by the
    header; ``na_tokens`` become null; columns named in ``schema`` are coerced
    (bad values → null), the others stay text. Quotes inside quoted text are
    doubled, as spreadsheet programs and pandas write them.

    Nothing is read wrong in silence: a record with another number of fields
    than the header raises, and so does a file whose header differs from that
    of the first file. Text with line breaks inside quotes needs
    ``multi_line=True``, which finds the records' ends by counting quotes, over
    byte ranges in parallel (:mod:`ledgerlake.sources.records`, at the price of
    a second scan); without it such a record raises."""
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # else a short record goes unnoticed
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    df = reader.csv(path)
    if multi_line:  # of that reader only the names, from the first file's header
        df = records.parsed(records.csv_records(spark, path), df.columns)
    df = df.select(*[null_tokens(F.col(f"`{c}`"), na_tokens).alias(c) for c in df.columns])
    return coerce_frame(df, schema, pattern) if schema is not None else df


def read_raw_table(
    spark: SparkSession,
    path: str,
    table: str,
    na_tokens=PANDAS_NA_TOKENS,
    pattern: str = TIMESTAMP_PATTERN,
    multi_line: bool = False,
) -> DataFrame:
    """S1 for one of the three base tables (players/affiliates/transactions)."""
    return read_csv(spark, path, raw_schema(table), na_tokens, pattern, multi_line)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S2 — Parquet scan; filters and projections are pushed into it.

    With a declared ``schema``, a timestamp column that arrives as BIGINT is
    a nanosecond timestamp from a pandas writer (ledger L26) and is converted
    back; other declared columns are coerced as usual.
    """
    df = spark.read.parquet(path)
    if schema is None:
        return df
    declared = {f.name: f.dataType for f in schema.fields}
    fixed = []
    for f in df.schema.fields:
        target = declared.get(f.name)
        if isinstance(target, T.TimestampType) and isinstance(f.dataType, T.LongType):
            fixed.append(F.timestamp_micros(F.floor(F.col(f.name) / 1000).cast("long")).alias(f.name))
        else:
            fixed.append(F.col(f"`{f.name}`"))
    return coerce_frame(df.select(*fixed), schema)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any file system Spark can reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_parquet(df: DataFrame, path: str) -> str:
    """S3 — Parquet sink, replacing what is there. Returns the path."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, timestamp_format: str = CSV_TIMESTAMP_OUT) -> str:
    """S4 — header CSV sink, no index column, replacing what is there.
    Timestamps are written with their UTC offset (X4); text keeps its outer
    blanks, and quotes are doubled. Returns the path."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", timestamp_format)
        .csv(path)
    )
    return path
