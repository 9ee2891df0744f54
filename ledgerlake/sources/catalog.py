"""Catalog tables — landing tables with a fixed schema (full refresh),
named source scans, and marts materialised as tables.

Table writes go through Spark's catalog, so the declared types are enforced
on load; in particular ``VARCHAR(4)`` rejects a longer country code
(ledger L25).

Every load writes new folders and then commits them all at once, by adding one
file to the database's manifest: a numbered list of which folder each table
has. :func:`snapshot` reads all tables of one number. The catalog's tables are
pointed at the same folders after the commit, one by one, for SQL users; a
load that finds them behind the manifest (because an earlier one was cut off
there) brings them up to date first. Replaced folders stay for a grace period
(:func:`vacuum`), so a reader that opened one can finish.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.schemas import LANDING_BUCKET_COLUMNS, LANDING_COLUMNS, LANDING_NAMES


def _q(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_landing_table(
    spark: SparkSession, database: str, table: str, buckets: int | None = None
) -> str:
    """S5 — create the database and the landing table if absent.

    The truncate of the reference is folded into the load, which switches the
    table to completely written files (:func:`load_table`), so readers never
    see an empty table between two steps.
    With ``buckets``, players are stored bucketed by ``id`` and transactions
    by ``player_id``, so the marts read them already partitioned by player
    and skip their shuffles. Use it only when no single player dominates:
    a bucketed scan reads a whole bucket in one task.
    """
    name = f"{database}.{LANDING_NAMES[table]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")
    layout = ""
    if buckets and table in LANDING_BUCKET_COLUMNS:
        layout = f" CLUSTERED BY ({LANDING_BUCKET_COLUMNS[table]}) INTO {int(buckets)} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} ({LANDING_COLUMNS[table]}) USING parquet{layout}")
    return name


def _bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """Bucket columns and count of a catalog table, or None."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect()
    info = {r[0]: r[1] for r in rows if r[0]}
    if "Num Buckets" not in info:
        return None
    cols = [c.strip(" `[]") for c in info.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return cols, int(info["Num Buckets"])


_VERSION = "__v_"


def _version_path(spark: SparkSession, name: str) -> str:
    """A new folder next to the tables of the database of ``name``."""
    database, table = name.split(".")
    return f"{_base(spark, database)}/{table}{_VERSION}{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").where("col_name = 'Location'").collect()
    return rows[0][1]


def _base(spark: SparkSession, database: str) -> str:
    return spark.sql(f"DESCRIBE DATABASE {_q(database)}").where("info_name = 'Location'").first()[1].rstrip("/")


# --- the manifest ------------------------------------------------------------------

_MANIFEST = "_manifest"
#: Seconds that a replaced folder stays readable.
GRACE = 24 * 3600


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _versions(spark: SparkSession, database: str) -> list[int]:
    """Committed manifest numbers, rising."""
    fs, folder = _fs(spark, f"{_base(spark, database)}/{_MANIFEST}")
    if not fs.exists(folder):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, database: str, version: int | None = None) -> dict:
    """``{"version", "at", "tables": {name: folder}}`` of a committed version
    (default: the latest; version 0, no tables, before the first load)."""
    if version is None:
        version = max(_versions(spark, database), default=0)
    if not version:
        return {"version": 0, "at": 0.0, "tables": {}}
    fs, path = _fs(spark, f"{_base(spark, database)}/{_MANIFEST}/{version}.json")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, database: str, tables: dict[str, str]) -> dict:
    """Add a version in which ``tables`` have new folders. It is written aside
    and renamed to its number, which fails if another load has taken it; then
    the next number is tried, on top of that load."""
    folder = f"{_base(spark, database)}/{_MANIFEST}"
    fs, top = _fs(spark, folder)
    fs.mkdirs(top)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(rename, 1)
    none[0] = rename.NONE
    while True:
        last = manifest(spark, database)
        new = {"version": last["version"] + 1, "at": time.time(), "tables": last["tables"] | tables}
        _, aside = _fs(spark, f"{folder}/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        _, path = _fs(spark, f"{folder}/{new['version']}.json")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(aside, path, none)
            return new
        except Exception:
            fs.delete(aside, False)
            if not fs.exists(path):
                raise


def sync(spark: SparkSession, database: str, version: dict | None = None) -> None:
    """Point the catalog's tables at the folders of the latest version."""
    for table, path in (version or manifest(spark, database))["tables"].items():
        name = f"{database}.{table}"
        if spark.catalog.tableExists(name) and _location(spark, name).rstrip("/") != path.rstrip("/"):
            spark.sql(f"ALTER TABLE {_q(name)} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)


def snapshot(spark: SparkSession, database: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of one committed version (default: the latest), read from
    its folders: tables loaded together are seen together, and later loads do
    not change what the frames read."""
    return {t: spark.read.parquet(p) for t, p in manifest(spark, database, version)["tables"].items()}


def vacuum(spark: SparkSession, database: str, grace: float = GRACE) -> list[str]:
    """Delete folders that no version has held for ``grace`` seconds, and
    manifests older than the oldest version still needed; folders of loads
    that never committed go after the same time. Returns what it deleted."""
    now, numbers = time.time(), _versions(spark, database)
    kept: set[str] = set()
    known = [manifest(spark, database, v) for v in numbers]
    # a version ends when the next one begins
    ends = [*(m["at"] for m in known[1:]), now]
    needed = [m for m, end in zip(known, ends) if m is known[-1] or end > now - grace]
    for m in needed:
        kept |= {p.rstrip("/").rsplit("/", 1)[1] for p in m["tables"].values()}
    base = _base(spark, database)
    fs, top = _fs(spark, base)
    gone = []
    for entry in fs.listStatus(top) if fs.exists(top) else []:
        name = entry.getPath().getName()
        if _VERSION in name and name not in kept and entry.getModificationTime() / 1000 <= now - grace:
            gone.append(str(entry.getPath()))
            _delete(spark, gone[-1])
    for m in known:
        if m not in needed:
            _delete(spark, f"{base}/{_MANIFEST}/{m['version']}.json")
    return gone


def _stage(df: DataFrame, name: str, column_order: list[str] | None = None) -> str:
    """Write ``df`` under the declared types of table ``name`` to a new folder
    and return it; nothing is left if a row is rejected."""
    spark = df.sparkSession
    order = column_order or spark.table(name).columns
    out = df.select(*order)
    spec = _bucket_spec(spark, name)
    if spec:
        cols, n = spec
        out = out.repartition(n, *[F.col(c) for c in cols])
    path = _version_path(spark, name)
    staged = f"{name.split('.')[0]}.{path.rsplit('/', 1)[1]}"
    spark.sql(f"CREATE TABLE {_q(staged)} LIKE {_q(name)} LOCATION '{path}'")
    try:
        out.write.insertInto(staged)
    except Exception:
        spark.sql(f"DROP TABLE {_q(staged)}")
        _delete(spark, path)
        raise
    spark.sql(f"DROP TABLE {_q(staged)}")  # the entry only: its files were given a location
    return path


def load_tables(loads: dict[str, tuple[DataFrame, list[str] | None]], grace: float = GRACE) -> None:
    """S6 for several tables of one database (``db.table`` → frame and column
    order) in one commit: all of them change, or none."""
    names = list(loads)
    database = names[0].split(".")[0]
    spark = loads[names[0]][0].sparkSession
    sync(spark, database)
    staged: dict[str, str] = {}
    try:
        for name, (df, order) in loads.items():
            staged[name] = _stage(df, name, order)
    except Exception:
        for path in staged.values():
            _delete(spark, path)
        raise
    sync(spark, database, _commit(spark, database, {n.split(".")[1]: p for n, p in staged.items()}))
    vacuum(spark, database, grace)


def load_table(df: DataFrame, name: str, column_order: list[str] | None = None) -> str:
    """S6 — replace the content of table ``name`` with ``df``, all or nothing.

    The rows are written to a new folder under the declared types first; only
    when that has succeeded is the table pointed at it. A rejected load leaves
    the table as it was.

    Columns are selected in ``column_order`` (default: the table's own
    order), because ``insertInto`` matches by position. For a bucketed table
    the rows are first hash-partitioned on the bucket columns with the bucket
    count, which is the same assignment the bucketing uses, so each task
    writes one file per bucket instead of one per bucket it happens to see.
    """
    load_tables({name: (df, column_order)})
    return name


def land(df: DataFrame, spark: SparkSession, database: str, table: str, buckets: int | None = None) -> str:
    """C4 for one table: S5 + S6."""
    name = ensure_landing_table(spark, database, table, buckets)
    return load_table(df, name)


def land_all(frames: dict[str, DataFrame], spark: SparkSession, database: str, buckets: int | None = None) -> dict[str, str]:
    """C4 for several tables (``players``, ``affiliates``, ``transactions``)
    in one commit: a failure in any of them leaves all as they were."""
    names = {t: ensure_landing_table(spark, database, t, buckets) for t in frames}
    load_tables({names[t]: (df, None) for t, df in frames.items()})
    return names


def source(spark: SparkSession, database: str, table: str) -> DataFrame:
    """S7 — scan a named table of the catalog."""
    return spark.table(f"{database}.{table}")


def materialize(df: DataFrame, database: str, name: str, order: list[Column] | None = None) -> str:
    """S8 — store a query result as a table, replacing the previous one only
    once the new rows are written. With ``order`` the rows are range-partitioned
    and sorted by it, one file per range in order, so that :func:`places`
    reads the order off the files."""
    spark = df.sparkSession
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")
    full = f"{database}.{name}"
    path = _version_path(spark, full)
    try:
        df.write.parquet(path)
    except Exception:
        _delete(spark, path)
        raise
    sync(spark, database)
    version = _commit(spark, database, {name: path})
    known = spark.catalog.tableExists(full)
    if known and [(f.name, f.dataType) for f in spark.table(full).schema] != [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"DROP TABLE {_q(full)}")
        known = False
    if not known:
        spark.catalog.createTable(full, path=path, source="parquet")
    sync(spark, database, version)
    vacuum(spark, database)
    return full


def places(df: DataFrame, name: str = "place") -> DataFrame:
    """The rows of a table stored with an ``order``, with each row's place in
    it from 0: rows of the files before it plus its index in its file. Neither
    sorts nor shuffles the rows; the list of files (one row each) is broadcast.
    """
    # part-<number>-...: the number is the range's
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    rows = df.select("*", number.alias("__file"), F.col("_metadata.row_index").alias("__row"))
    files = df.groupBy(number.alias("__file")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(starts), "__file").select(*df.columns, (F.col("__start") + F.col("__row")).alias(name))


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    column_order: list[str],
    properties: dict[str, str] | None = None,
    batch_size: int = 10_000,
) -> str:
    """S6 into an external database over JDBC: full refresh that keeps the
    table definition (``truncate`` instead of drop/create), columns in
    ``column_order``. Each partition writes its rows in parallel batches; the
    number of partitions bounds the number of open connections.

    Not exercised by the tests (they run without a database server).
    """
    (
        df.select(*column_order)
        .write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", str(batch_size))
        .jdbc(url, table, properties=properties or {})
    )
    return table
