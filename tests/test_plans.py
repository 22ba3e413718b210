"""Plan guards for the scale design: no window spans a whole file."""

import re

from conftest import lines_df
from report_lake.operators.parse import parse_reports, report_lines
from test_golden import ST1_GOLDEN, ST49_GOLDEN, render_st1_report, render_st49_report

WINDOW = re.compile(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]")


def window_specs(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [(p, o) for p, o in WINDOW.findall(plan)]


def assert_block_bounded(df):
    specs = window_specs(df)
    assert specs, "expected windows in the plan"
    for part, order in specs:
        keys = [k.strip().split("#")[0] for k in part.split(",") if k.strip()]
        first_order = order.split(",")[0].strip().split("#")[0]
        # either inside a block, or over the block summaries (ordered by block)
        assert "blk" in keys or first_order == "blk", (part, order)


def test_parse_windows_are_block_bounded(spark):
    st1 = parse_reports(lines_df(spark, {"a": render_st1_report(ST1_GOLDEN)}), "st1")
    st49 = parse_reports(lines_df(spark, {"b": render_st49_report(ST49_GOLDEN)}), "st49")
    for df in (st1.records, st49.records):
        assert_block_bounded(df)
    for df in (st1.status, st49.status):
        assert not window_specs(df)  # the status reads the small staged tables only
    assert_block_bounded(report_lines(lines_df(spark, {"c": "x\ny\n\nz"})))


def test_staged_lines_are_bucketed(spark):
    st1 = parse_reports(lines_df(spark, {"a": render_st1_report(ST1_GOLDEN)}), "st1")
    plan = st1.records._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan or "rl_lines_" in plan


def test_parse_plans_are_small(spark):
    """Records and status come from one staged table of lines and two small ones."""
    st1 = parse_reports(lines_df(spark, {"a": render_st1_report(ST1_GOLDEN)}), "st1")
    st49 = parse_reports(lines_df(spark, {"b": render_st49_report(ST49_GOLDEN)}), "st49")
    for df, scans in ((st1.records, 2), (st1.chunks, 2), (st1.section, 1), (st49.records, 1), (st1.status, 0), (st49.status, 0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 8 and len(re.findall(r"Scan parquet \S*rl_lines_", plan)) <= scans, plan


def test_bucket_count_follows_the_input(spark):
    from report_lake.session import bucket_count

    assert bucket_count(spark, None) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count(spark, 100 << 40) == (100 << 40) // (128 << 20)


def test_staged_tables_can_be_dropped(spark):
    from report_lake.session import drop_staged, staged_tables

    before = staged_tables()
    p = parse_reports(lines_df(spark, {"a": render_st1_report(ST1_GOLDEN)}), "st1")
    assert p.records.count() == 3
    new = staged_tables() - before
    assert new and all(spark.catalog.tableExists(t) for t in new)
    drop_staged(spark, before)
    assert staged_tables() == before and not any(spark.catalog.tableExists(t) for t in new)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_days_choose_directories(spark, tmp_shared):
    from pyspark.sql import functions as F

    from report_lake.operators.table import append_candidates, create_or_open_table, load_candidates, read_table
    from report_lake.sources.csv import report_partitions, write_report_csv
    from report_lake.spec import ST1

    csv, table = tmp_shared("csv"), tmp_shared("table")
    row = ", ".join(f"'v' AS {c}" for c in ST1.columns[1:])
    write_report_csv(spark.sql(f"SELECT date_format(date_add(DATE'2025-01-01', CAST(id AS INT)), 'yyyy-MM-dd') AS date, {row}, id AS record_no FROM range(70)"), csv, "st1")
    rows = report_partitions(spark, csv, "st1")
    plan = rows.where(F.col("report_day") == F.to_date(F.lit("2025-02-01")))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*report", plan)
    days = spark.range(70).select(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("day"), "id").where("id = 40")
    assert "dynamicpruning" in executed(rows.join(days.select(F.col("day").alias("report_day")), "report_day", "left_semi"))

    # a candidate frame drives the append: what the driver collects is counts, a row at a time
    create_or_open_table(spark, table, "st1")
    cands = load_candidates(spark, "st1", tmp_shared("ledger"), csv_folder=csv).withColumn("batch", F.lit("b"))
    frame, sizes = type(cands), []
    collect = frame.collect

    def counted(self):
        out = collect(self)
        sizes.append(len(out))
        return out

    frame.collect = counted
    try:
        assert append_candidates(spark, table, cands, "st1", csv).rows == 70
    finally:
        frame.collect = collect
    assert max(sizes) <= 1
    got = read_table(spark, table, "st1", days=days)
    assert "dynamicpruning" in executed(got) and got.count() == 1


def test_records_compile(spark):
    """The JVM interprets methods of 8,000 bytes or more: cutting the fields must not be one."""
    st1 = parse_reports(lines_df(spark, {"a": render_st1_report(ST1_GOLDEN)}), "st1")
    st49 = parse_reports(lines_df(spark, {"b": render_st49_report(ST49_GOLDEN)}), "st49")
    key, before = "spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(key, "false")  # else the code is only made as the stages run
    try:
        for df in (st1.records, st49.records):
            stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
            sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
            assert sizes and max(sizes) < 8000, sizes
    finally:
        spark.conf.set(key, before)


def test_whole_blocks_are_read_once(spark):
    """Blocks of whole records are not read again for records that cross an edge; others are."""
    whole = parse_reports(lines_df(spark, {"a": render_st1_report(ST1_GOLDEN)}), "st1").records
    assert len(whole.collect()) == 3
    plan = whole._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet \S*rl_lines_", plan)) == 1, plan
