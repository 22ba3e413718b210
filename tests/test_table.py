import pytest

from pyspark.sql import functions as F

from report_lake.operators.table import (
    append_batch,
    append_candidates,
    compact,
    create_or_open_table,
    default_ledger_path,
    load_candidates,
    load_table,
    read_quarantine,
    read_table,
    stale_files,
)
from report_lake.sources.csv import read_report_csv, scan_report_csv, write_report_csv
from report_lake.sources.files import list_files, write_named_files
from report_lake.sources.ledger import open_batches, read_ledger, read_ledger_entries
from report_lake.spec import ST1

ROW = ["x"] * 18


def records(spark, rows):
    cols = ["record_no", *ST1.columns]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ", ".join(f"{c} {'long' if c == 'record_no' else 'string'}" for c in cols))


def test_csv_round_trip_quoting_and_nulls(spark, tmp_shared):
    r = ["2025-01-02", 'A "QUOTED" | PIPE', "", " lead", "trail ", *["v"] * 13]
    out = tmp_shared("csv")
    write_report_csv(records(spark, [r]), out, "st1")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(out)
    assert files.count() == 1
    assert files.first()["path"].split("/")[-2] == "report=20250102_WELLS"
    back = read_report_csv(spark, out, "st1").first()
    assert back["well_name"] == 'A "QUOTED" | PIPE'
    assert back["licence_number"] is None  # '' is stored as NULL
    assert back["mineral_rights"] == " lead" and back["ground_elevation"] == "trail "


def test_rewriting_a_day_replaces_only_that_day(spark, tmp_shared):
    out = tmp_shared("csv")
    write_report_csv(records(spark, [["2025-01-02", "A", *["v"] * 16], ["2025-01-03", "B", *["v"] * 16]]), out, "st1")
    write_report_csv(records(spark, [["2025-01-02", "C", *["v"] * 16]]), out, "st1")
    got = sorted((r.date, r.well_name) for r in read_report_csv(spark, out, "st1").collect())
    assert got == [("2025-01-02", "C"), ("2025-01-03", "B")]


def test_malformed_csv_file_is_dropped_whole(spark, tmp_shared):
    base = tmp_shared("csv")
    good = "|".join(ST1.columns) + "\n" + "|".join(["2025-01-02", *["g"] * 17]) + "\n"
    bad = "|".join(ST1.columns) + "\n" + "|".join(["2025-01-03", *["b"] * 17]) + "\n" + "|".join(["short"] * 5) + "\n"
    header_only = "|".join(ST1.columns) + "\n"
    df = spark.createDataFrame([("good_WELLS.csv", good), ("bad_WELLS.csv", bad), ("empty_WELLS.csv", header_only)], "n string, t string")
    for n, t in df.collect():
        spark.createDataFrame([(t,)], "value string").coalesce(1).write.text(f"{base}/{n}")
    rows, files = scan_report_csv(spark, [f"{base}/good_WELLS.csv", f"{base}/bad_WELLS.csv", f"{base}/empty_WELLS.csv"], "st1", recursive=False)
    assert [r.date for r in rows.collect()] == ["2025-01-02"]
    st = {r.csv_file.split("/")[-2]: r.status for r in files.collect()}
    assert st == {"bad_WELLS.csv": "malformed", "good_WELLS.csv": "ok", "empty_WELLS.csv": "ok"}


def test_ledger_ignores_malformed_and_partial_lines(spark, tmp_shared):
    path = tmp_shared("ledger")
    lines = ['{"csv_file": "a.csv", "timestamp": "t"}', '{"csv_file": "b.csv"', '{"csv_file": "c.csv"}', "junk",
             '{"csv_file": "a.csv", "timestamp": "t2"}']
    spark.createDataFrame([(l,) for l in lines], "value string").write.text(path)
    assert sorted(r.csv_file for r in read_ledger(spark, path).collect()) == ["a.csv"]
    assert read_ledger(spark, tmp_shared("missing")).count() == 0


def test_load_is_incremental_and_recreate_resets(spark, tmp_shared):
    csv, table = tmp_shared("csv"), tmp_shared("table")
    write_report_csv(records(spark, [["2025-01-02", "A", *["v"] * 16]]), csv, "st1")
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 1
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 0  # already in the ledger
    write_report_csv(records(spark, [["2025-01-03", "B", *["v"] * 16]]), csv, "st1")
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 1
    assert read_table(spark, table, "st1").count() == 2
    assert read_ledger(spark, default_ledger_path(table)).count() == 2
    assert load_table(spark, table, "st1", csv_folder=csv, recreate=True).rows == 2
    assert read_table(spark, table, "st1").count() == 2


def test_schema_mismatch_is_an_error(spark, tmp_shared):
    table = tmp_shared("table")
    create_or_open_table(spark, table, "st49")
    with pytest.raises(ValueError):
        create_or_open_table(spark, table, "st1")


def test_compact_writes_a_new_folder(spark, tmp_shared):
    table, target = tmp_shared("table"), tmp_shared("compact")
    create_or_open_table(spark, table, "st1")
    spark.createDataFrame([tuple(f"{c}{i}" for c in ST1.columns) for i in range(200)], ST1.schema).repartition(10) \
        .write.mode("append").parquet(table)
    before = list_files(spark, table).count()
    res = compact(spark, table, target)
    assert res.files_before == before and res.files_after == 1
    assert read_table(spark, target, "st1").count() == read_table(spark, table, "st1").count() == 200
    assert stale_files(spark, table).count() == 0  # inside the retention window
    assert stale_files(spark, table, retention_hours=0).count() == before
    assert stale_files(spark, table, retention_hours=0, live_tables=table).count() == 0  # still in use
    assert stale_files(spark, table, retention_hours=0, live_tables=[target, tmp_shared("none")]).count() == before
    with pytest.raises(ValueError):
        compact(spark, table, tmp_shared("x"), fmt="delta")


def text_file(spark, path, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def test_candidate_names(spark, tmp_shared):
    base, table = tmp_shared("WELLS names"), tmp_shared("table")
    line = "|".join(["2025-01-01", *["v"] * 17])
    csv = "|".join(ST1.columns) + "\n" + line
    text_file(spark, f"{base}/in", csv)
    src = [r["path"] for r in list_files(spark, f"{base}/in").collect()][0]
    content = spark.read.format("binaryFile").load(src).first()["content"]
    names = ["WELLS/20250101_SPUD.csv", "a/20250101_WELLS.csv", "a/foo.csv", "a/20250102_WELLS.txt"]
    for n in names:
        folder, name = n.split("/")
        write_named_files(spark.createDataFrame([(name, content)], "name string, content binary"), f"{base}/{folder}").count()
    got = load_candidates(spark, "st1", tmp_shared("ledger"), csv_folder=base).collect()
    assert [r["path"].split("/")[-1] for r in got] == ["20250101_WELLS.csv"]
    assert load_table(spark, table, "st1", csv_paths=f"{base}/a/foo.csv").rows == 1  # a path given is taken
    assert load_table(spark, table, "st1", csv_paths=f"{base}/a/foo.csv").rows == 0


def test_header_only_and_malformed_files_are_settled(spark, tmp_shared):
    base, table, bad = tmp_shared("csv"), tmp_shared("table"), tmp_shared("quarantine")
    head = "|".join(ST1.columns)
    for n, t in {"e_WELLS.csv": head, "b_WELLS.csv": head + "\nshort|row", "g_WELLS.csv": head + "\n" + "|".join(["2025-01-01", *["v"] * 17])}.items():
        write_named_files(spark.createDataFrame([(n, (t + "\n").encode())], "name string, content binary"), base).count()
    res = load_table(spark, table, "st1", csv_folder=base, quarantine_path=bad)
    assert (res.rows, res.candidates) == (1, 3)
    assert {r["csv_file"].split("/")[-1]: (r["rows"], r["status"]) for r in res.files.collect()} == {
        "e_WELLS.csv": (0, "ok"), "b_WELLS.csv": (1, "malformed"), "g_WELLS.csv": (1, "ok")}
    assert load_table(spark, table, "st1", csv_folder=base).candidates == 0
    assert [r["path"].split("/")[-1] for r in spark.read.parquet(bad).collect()] == ["b_WELLS.csv"]
    assert load_table(spark, table, "st1", csv_folder=base, retry_skipped=True).candidates == 1


def test_reparsed_day_loads_once(spark, tmp_shared):
    csv, table = tmp_shared("csv two"), tmp_shared("table")
    for _ in range(2):
        write_report_csv(records(spark, [["2025-01-02", "A", *["v"] * 16]]), csv, "st1")
        load_table(spark, table, "st1", csv_folder=csv)
    assert read_table(spark, table, "st1").count() == 1


def dies(*a, **k):
    raise RuntimeError("lost driver")


def day_csv(day, rows=1, tag="r"):
    lines = ["|".join(ST1.columns), *["|".join([f"2025-01-{day:02d}", f"{tag}{i}", *["v"] * 16]) for i in range(rows)]]
    return ("\n".join(lines) + "\n").encode()


def put(spark, folder, files):
    write_named_files(spark.createDataFrame(list(files.items()), "name string, content binary"), folder).count()


@pytest.mark.parametrize("stop", ["append_candidates", "unit_status"])
def test_crash_before_or_after_the_append(spark, tmp_shared, monkeypatch, stop):
    """Whatever a stopped load had done, the next one gives every row once."""
    from report_lake.operators import table as T

    csv, table = tmp_shared("csv"), tmp_shared("table")
    write_report_csv(records(spark, [["2025-01-02", "A", *["v"] * 16], ["2025-01-02", "A", *["v"] * 16], ["2025-01-03", "B", *["v"] * 16]]), csv, "st1")
    for _ in range(2):
        with monkeypatch.context() as m:
            m.setattr(T, stop, dies)
            with pytest.raises(RuntimeError):
                load_table(spark, table, "st1", csv_folder=csv)
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 3
    assert load_table(spark, table, "st1", csv_folder=csv).candidates == 0
    assert read_table(spark, table, "st1").count() == 3 and open_batches(spark, default_ledger_path(table)).isEmpty()


def test_rows_shared_with_a_loaded_report_are_not_taken_for_the_batch(spark, tmp_shared, monkeypatch):
    from report_lake.operators import table as T

    csv, table = tmp_shared("csv"), tmp_shared("table")
    put(spark, csv, {"a_WELLS.csv": day_csv(2, 2)})
    load_table(spark, table, "st1", csv_folder=csv)
    put(spark, csv, {"b_WELLS.csv": day_csv(2, 3)})  # two of its rows are in the table already
    with monkeypatch.context() as m:
        m.setattr(T, "append_candidates", dies)
        with pytest.raises(RuntimeError):
            load_table(spark, table, "st1", csv_folder=csv)
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 3
    assert read_table(spark, table, "st1").count() == 5


def remove(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@pytest.mark.parametrize("appended", [False, True])
def test_vanished_files_stop_nothing(spark, tmp_shared, monkeypatch, appended):
    from report_lake.operators import table as T

    csv, table, bad = tmp_shared("csv"), tmp_shared("table"), tmp_shared("bad")
    put(spark, csv, {"a_WELLS.csv": day_csv(2), "b_WELLS.csv": day_csv(3)})
    with monkeypatch.context() as m:
        m.setattr(T, "unit_status" if appended else "append_candidates", dies)
        with pytest.raises(RuntimeError):
            load_table(spark, table, "st1", csv_folder=csv)
    remove(spark, f"{csv}/a_WELLS.csv")
    put(spark, csv, {"c_WELLS.csv": day_csv(4)})
    res = load_table(spark, table, "st1", csv_folder=csv, quarantine_path=bad)
    assert res.rows == 2  # b again or for the first time, and c
    assert sorted(r["date"] for r in read_table(spark, table, "st1").collect()) == (["2025-01-02"] if appended else []) + ["2025-01-03", "2025-01-04"]
    status = {r["csv_file"].split("/")[-1]: r["status"] for r in read_ledger_entries(spark, default_ledger_path(table)).where("status <> 'pending'").collect()}
    assert status == {"a_WELLS.csv": "loaded" if appended else "missing", "b_WELLS.csv": "loaded", "c_WELLS.csv": "loaded"}
    assert [r["status"] for r in read_quarantine(spark, bad).collect()] == ([] if appended else ["missing"])
    assert load_table(spark, table, "st1", csv_folder=csv).candidates == 0
    if not appended:  # it came back
        put(spark, csv, {"a_WELLS.csv": day_csv(2)})
        assert load_table(spark, table, "st1", csv_folder=csv).rows == 1


def test_files_that_go_between_listing_and_reading(spark, tmp_shared):
    csv, table = tmp_shared("csv"), tmp_shared("table")
    put(spark, csv, {"a_WELLS.csv": day_csv(2), "b_WELLS.csv": day_csv(3), "e_WELLS.csv": "|".join(ST1.columns).encode()})
    create_or_open_table(spark, table, "st1")
    cands = load_candidates(spark, "st1", tmp_shared("ledger"), csv_folder=csv).select("*", F.lit("x").alias("batch"))
    cands = spark.createDataFrame(cands.collect(), cands.schema)
    remove(spark, f"{csv}/a_WELLS.csv")
    res = append_candidates(spark, table, cands, "st1", csv)
    assert res.rows == 1 and {r["csv_file"].split("/")[-1]: r["status"] for r in res.files.collect()} == {"a_WELLS.csv": "missing", "b_WELLS.csv": "ok", "e_WELLS.csv": "ok"}


def test_named_paths_are_replayed_by_name(spark, tmp_shared, monkeypatch):
    from report_lake.operators import table as T

    base, csv, table = tmp_shared("x"), tmp_shared("csv"), tmp_shared("table")
    put(spark, base, {"foo.csv": day_csv(2), "bar.csv": day_csv(5)})
    put(spark, csv, {"a_WELLS.csv": day_csv(3)})
    with monkeypatch.context() as m:
        m.setattr(T, "append_candidates", dies)
        with pytest.raises(RuntimeError):
            load_table(spark, table, "st1", csv_paths=[f"{base}/foo.csv", f"{base}/bar.csv"])
    remove(spark, f"{base}/bar.csv")
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 2
    assert load_table(spark, table, "st1", csv_folder=csv, csv_paths=f"{base}/foo.csv").candidates == 0


def test_mixed_folder_and_pruned_reads(spark, tmp_shared):
    csv, table = tmp_shared("csv"), tmp_shared("table")
    write_report_csv(records(spark, [[f"2025-01-{d:02d}", f"w{d}", *["v"] * 16] for d in range(1, 9)]), csv, "st1")
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 8
    write_report_csv(records(spark, [["2025-01-20", "n", *["v"] * 16]]), csv, "st1")
    put(spark, csv, {"plain_WELLS.csv": day_csv(25, 2)})  # a plain file beside the directories
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 3
    days = spark.createDataFrame([("2025-01-03", "x"), ("2025-01-25", "x"), ("2024-01-01", "y")], "day string, kind string").where("kind = 'x'")
    got = read_table(spark, table, "st1", days=days.withColumn("day", F.to_date("day")))
    assert sorted(r["date"] for r in got.collect()) == ["2025-01-03", "2025-01-25", "2025-01-25"]
    plan = read_table(spark, table, "st1", start="2025-01-02", end="2025-01-04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_month" in plan and "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2025-01-02)" in plan


def test_append_batch_twice_is_one(spark, tmp_shared):
    csv, table = tmp_shared("csv"), tmp_shared("table")
    put(spark, csv, {"a_WELLS.csv": day_csv(2, 3)})
    create_or_open_table(spark, table, "st1")
    for batch in ("b1", "b1", "b2"):
        append_batch(spark, table, [f"{csv}/a_WELLS.csv", f"{csv}/none.csv"], "st1", batch=batch)
    assert read_table(spark, table, "st1").count() == 6


def test_a_report_with_a_bad_part_is_skipped_whole(spark, tmp_shared):
    csv, table = tmp_shared("csv"), tmp_shared("table")
    write_report_csv(records(spark, [["2025-01-02", f"A{i}", *["v"] * 16] for i in range(40)]), csv, "st1", records_per_file=20)
    put(spark, f"{csv}/report=20250102_WELLS", {"part-bad.csv": ("|".join(ST1.columns) + "\nshort|row\n").encode()})
    assert load_table(spark, table, "st1", csv_folder=csv).rows == 0
    assert load_table(spark, table, "st1", csv_folder=csv).candidates == 0
    put(spark, f"{csv}/report=20250102_WELLS", {"part-bad.csv": day_csv(2)})
    assert load_table(spark, table, "st1", csv_folder=csv, retry_skipped=True).rows == 41
    assert read_table(spark, table, "st1").count() == 41


def test_sink_keeps_report_order(spark, tmp_shared):
    out = tmp_shared("csv")
    rows = [["2025-01-02", f"n{i:03d}", *["v"] * 16] for i in range(50)]
    write_report_csv(records(spark, rows).repartition(5), out, "st1", records_per_file=20)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(out).collect()
    names = [[l.split("|")[1] for l in bytes(f["content"]).decode().splitlines()[1:]] for f in files]
    assert all(n == sorted(n) for n in names) and sorted(sum(names, [])) == [r[1] for r in rows]
    write_report_csv(records(spark, rows).drop("record_no"), out, "st1")  # without numbers: no order, all rows
    assert read_report_csv(spark, out, "st1").count() == 50
