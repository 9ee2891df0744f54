"""Time the three forms of the latest row per key on unique, repeated and hot
keys and write docs/latest.md. Rows come from the ``lineitem`` table of
``$BENCH_SF_DIR`` (default sf0.1), repeated to ``--times`` its size."""

from __future__ import annotations

import argparse
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators import keyed  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--times", type=int, default=4)
    parser.add_argument("--repeat", type=int, default=3)
    args = parser.parse_args()
    scratch = tempfile.mkdtemp(prefix="run-latest-", dir="/tmp")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=16, warehouse=f"{scratch}/wh")
    source = spark.read.parquet(f"{os.environ.get('BENCH_SF_DIR', '/root/testdata/sf0.1')}/lineitem.parquet")
    rows = source.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(args.times)))).select(
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + F.col("copy")).alias("n"),
        F.timestamp_seconds(F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "copy"), F.lit(10**9))).alias("at"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        "l_linestatus",
        F.md5(F.col("l_partkey").cast("string")).alias("note"),
    )
    keys = {
        "all keys different": F.col("n"),
        "seven rows a key": F.floor(F.col("n") / 70),
        "one key in a third of the rows": F.when(F.col("n") % 3 == 0, F.lit(-1)).otherwise(F.col("n")),
    }
    lines, total = [], None
    for name, key in keys.items():
        path = f"{scratch}/{re.sub('[^a-z]', '-', name)}"
        rows.withColumn("k", key).drop("n").write.parquet(path)
        df = spark.read.parquet(path)
        total = df.count()
        cells = []
        for form in keyed.FORMS:
            best = float("inf")
            for _ in range(args.repeat):
                start = time.perf_counter()
                keyed.latest_by_key(df, "k", "at", form=form).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - start)
            cells.append(f"{best:.2f}")
        lines.append(f"| {name} | " + " | ".join(cells) + " |")
        print(lines[-1], flush=True)
    head = ["| keys | " + " | ".join(f"{f}, s" for f in keyed.FORMS) + " |", "| --- |" + " --- |" * len(keyed.FORMS)]
    text = f"""# Latest row per key: three forms

`operators/keyed.py:latest_by_key(form=...)`, {total:,} rows of 5 columns (two of
them text), 16 shuffle partitions, local[{os.environ.get('BENCH_CPUS', '8')}], best of {args.repeat}
(`python tools/measure_latest.py`).

""" + "\n".join(head + lines) + """

* `struct` (default): `SortAggregate` before and after one shuffle; a hot key
  leaves each map task as one row.
* `hash`: `HashAggregate` of the key and a long, a `ShuffledHashJoin` to fetch
  the rows; a sort only in the branch of keys that have several rows, which
  settles ties. The rows are shuffled besides the aggregate, and a hot key's
  rows all are; AQE splits them.
* `window`: a sort and `WindowGroupLimit` before and after one shuffle.

All three give the same rows, ties and nulls included (`tests/test_skew.py`).
"""
    with open(os.path.join(HERE, "docs", "latest.md"), "w") as f:
        f.write(text)
    spark.stop()


if __name__ == "__main__":
    main()
