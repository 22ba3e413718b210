"""Order of the CSV sink, read back: files, splits and rows of a report."""

import pytest
from pyspark.sql import functions as F

from report_lake.sources.csv import read_report_order, write_report_csv
from report_lake.sources.files import list_files
from report_lake.spec import ST1

SIZES = {"2025-01-01": 500, "2025-01-02": 1, "2025-01-03": 23}


def records(spark):
    """Rows of three days, dealt over tasks in no order; equal rows among them."""
    rows = [(i, day, f"L{i % 7}", "x" * (i % 90)) for day, n in SIZES.items() for i in range(n)]
    df = spark.createDataFrame(rows, "record_no long, date string, licence_number string, well_name string").repartition(13, F.hash("record_no"))
    return df.select("record_no", *[F.col(c) if c in df.columns else F.lit(c).alias(c) for c in ST1.columns])


@pytest.mark.parametrize("per_file", [1_000_000, 10])
@pytest.mark.parametrize("split", ["128MB", "2KB"])
def test_places_are_record_numbers(spark, tmp_shared, per_file, split):
    out = tmp_shared("ordered")
    # without coalescing, so that the small parts are files of their own
    conf = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_report_csv(records(spark), out, "st1", records_per_file=per_file, ordered=True)
        got = read_report_order(spark, out, "st1").select("report", "place", "licence_number", F.coalesce("well_name", F.lit("")).alias("w")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = {(day.replace("-", "") + "_WELLS", i + 1, f"L{i % 7}", "x" * (i % 90)) for day, n in SIZES.items() for i in range(n)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    if per_file == 10:
        assert list_files(spark, out, glob="*.csv", recursive=True).count() > len(SIZES)


def test_order_is_found_without_shuffling_rows(spark, tmp_shared):
    out = tmp_shared("ordered")
    write_report_csv(records(spark), out, "st1", records_per_file=10, ordered=True)
    plan = read_report_order(spark, out, "st1")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 1 and "SortMergeJoin" not in plan
