"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "rows": {...},
 "rows_per_sec": {...}, "sf": ...}

Each query is timed end to end: the query function (which includes any writes
it performs, e.g. the CSV hop and table load of ``append_batch``) plus a full
execution of the returned frame (``noop`` sink, every row produced).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from report_lake.plans.catalog import QUERIES  # noqa: E402
from report_lake.session import local_session, shared_dir  # noqa: E402

HEADLINE = ["report_lines", "st1_records", "st49_records", "append_batch", "sym_diff"]


def run(spark, name, sf_dir):
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    obs = Observation(f"bench_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return time.time() - t0, int(obs.get["n"])


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="report_lake_bench", raw_local_fs=os.environ.get("BENCH_RAW_LOCAL_FS", "1") == "1")
    shared_dir(spark)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for n in ("st1_records", "st49_records"):
            run(spark, n, warm)
    times, rows = {}, {}
    for n in names:
        sec, cnt = run(spark, n, sf_dir)
        times[n] = round(sec, 3)
        rows[n] = cnt
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "rows_per_sec": {k: round(rows[k] / times[k], 1) if times[k] else None for k in times},
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
