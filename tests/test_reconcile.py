from report_lake.operators.reconcile import except_rows, sym_diff, table_count, table_head


def frames(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y"), (4, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "Y"), (5, "w"), (5, "w")], "k int, v string")
    return a, b


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_except_matches_spark(spark):
    a, b = frames(spark)
    assert rows(except_rows(a, b)) == rows(a.subtract(b))
    counted = except_rows(a, b, all=True)
    assert sorted((*r[:-1],) for r in counted.collect() for _ in range(r["copies"])) == rows(a.exceptAll(b))


def test_sym_diff(spark):
    a, b = frames(spark)
    got = rows(sym_diff(a, b))
    assert got == [(3, "Y", "right_only"), (3, "y", "left_only"), (4, "z", "left_only"), (5, "w", "right_only")]
    multi = rows(sym_diff(a, b, all=True))
    assert (1, "x", "left_only", 1) in multi and (5, "w", "right_only", 2) in multi
    assert sym_diff(a, a).count() == 0


def test_count_and_head(spark):
    a, _ = frames(spark)
    assert table_count(a).first()["n"] == 5
    assert [r.k for r in table_head(a, 2, ["k", "v"]).collect()] == [1, 1]


def test_days_that_agree_are_not_read(spark, tmp_shared):
    from pyspark.sql import functions as F

    from report_lake.operators.reconcile import reconcile_days
    from report_lake.operators.table import create_or_open_table, fingerprint_path, load_table, table_fingerprints
    from report_lake.session import drop_path
    from report_lake.sources.csv import write_report_csv
    from report_lake.spec import ST1
    from report_lake.streaming.incremental import records_to_table

    csv, table = tmp_shared("csv"), tmp_shared("table")
    row = ", ".join(f"IF(id % 7 = 0, '', concat('v', id % 4)) AS {c}" for c in ST1.columns[1:])
    recs = spark.sql(f"SELECT date_format(date_add(DATE'2025-01-01', CAST(id % 20 AS INT)), 'yyyy-MM-dd') AS date, {row}, id AS record_no FROM range(200)")
    write_report_csv(recs, csv, "st1")
    create_or_open_table(spark, table, "st1")
    load_table(spark, table, "st1", csv_folder=csv)
    diff, days = reconcile_days(spark, csv, table, "st1")
    assert days.isEmpty() and diff.isEmpty()

    one = recs.where("date = '2025-01-03'")
    records_to_table(one.limit(1), table, "st1", batch="more")  # a copy too many
    records_to_table(recs.limit(1).withColumn("date", F.lit(None).cast("string")), table, "st1", batch="no day")
    write_report_csv(recs.where("date = '2025-01-05' and record_no > 10"), csv, "st1")  # the CSV lost a row
    for kept in (True, False):
        if not kept:  # as for a table of older batches
            drop_path(spark, fingerprint_path(table))
        diff, days = reconcile_days(spark, csv, table, "st1")
        assert sorted(r["day"] for r in days.collect()) == ["2025-01-03", "2025-01-05"]
        assert sorted((r["date"] or "", r["side"], r["copies"]) for r in diff.collect()) == [("", "right_only", 1), ("2025-01-03", "right_only", 1), ("2025-01-05", "right_only", 1)]
    assert table_fingerprints(spark, table, "st1").agg(F.sum("n")).first()[0] == 202
