import io
import zipfile

from pyspark.sql import functions as F

from report_lake.operators.ingest import ingest_archives, ingest_folder
from report_lake.operators.routing import route
from report_lake.sources.download import download_plan, fetch_reports
from report_lake.sources.files import content_lines, read_lines, write_named_files
from report_lake.plans.fixtures import write_report_files
from report_lake.session import to_local_or_uri


def zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            if name.endswith("/"):
                z.writestr(zipfile.ZipInfo(name), b"")
            else:
                z.writestr(name, data)
    return buf.getvalue()


def damaged():
    """An archive with one member whose checksum is wrong, and a good one."""
    data = bytearray(zip_bytes([("BAD.TXT", b"0123456789"), ("GOOD.TXT", b"fine")]))
    at = data.index(b"0123456789")
    data[at : at + 4] = b"ABCD"
    return bytes(data)


def test_archives(spark, tmp_shared):
    folder = tmp_shared("zips")
    inner = zip_bytes([("SPUD0102.TXT", b"inner")])
    files = [
        ("WELLS2024.zip", zip_bytes([("WELLS0102.TXT", b"a"), ("dir/", b""), ("README", b"r"), ("../up.TXT", b"u"),
                                     ("nested.zip", inner), ("notes.pdf", b"p")])),
        ("OTHER2023.zip", zip_bytes([("WELLS0102.TXT", b"b")])),
        ("noyear.zip", zip_bytes([("WELLS0103.TXT", b"c")])),
        ("broken2024.zip", b"not a zip"),
        ("crc2024.zip", damaged()),
    ]
    write_named_files(spark.createDataFrame(files, "name string, content binary"), folder).count()
    members, _ = ingest_archives(spark, folder, "st1")
    got = {(r.archive.split("/")[-1], r.member, r.out_name, r.status.split(":")[0]) for r in members.collect()}
    assert ("WELLS2024.zip", "WELLS0102.TXT", "WELLS01022024.TXT", "extracted") in got
    assert ("OTHER2023.zip", "WELLS0102.TXT", "WELLS01022023.TXT", "extracted") in got  # same name kept apart
    assert ("WELLS2024.zip!nested.zip", "SPUD0102.TXT", "SPUD01022024.TXT", "extracted") in got  # outer year
    assert ("WELLS2024.zip", "README", None, "skipped") in got
    assert ("WELLS2024.zip", "dir/", None, "directory") in got
    assert ("WELLS2024.zip", "../up.TXT", None, "unsafe") in got
    assert ("crc2024.zip", "BAD.TXT", "BAD2024.TXT", "error") in got  # a row, not the end of the run
    assert ("crc2024.zip", "GOOD.TXT", "GOOD2024.TXT", "extracted") in got
    assert ("noyear.zip", "WELLS0103.TXT", None, "error") in got
    assert ("broken2024.zip", None, None, "error") in got


def test_invalid_utf8_file_gets_a_status(spark, tmp_shared):
    folder = tmp_shared("reports")
    good = "X\nDATE: 02 January 2024\n".encode()
    write_named_files(spark.createDataFrame([("A.TXT", good), ("B.TXT", b"\xff\xfe DATE"), ("c.txt", good), ("d.dat", good)],
                                            "name string, content binary"), folder).count()
    res = ingest_folder(spark, folder, "st1")
    st = {r.path.split("/")[-1]: (r.status, r.error) for r in res.status.collect()}
    assert set(st) == {"A.TXT", "B.TXT", "c.txt", "d.dat"}  # every file has a status
    assert st["d.dat"] == ("file_format", "d.dat - Invalid file extension. Expected: TXT, Got: dat")
    assert st["B.TXT"][0] == "io_error"
    assert st["A.TXT"][0] == "missing_section"
    lines = content_lines(spark.createDataFrame([("p", b"a\xffb")], "path string, content binary"), "replace")
    assert lines.first()["line"] == "a�b"
    lines = read_lines(spark, folder, ["B.TXT"], on_bad_utf8="replace").collect()
    assert [(r["line"], r["bad"]) for r in lines] == [("�� DATE", False)]


def test_download_plan_and_fetch(spark, tmp_shared):
    plan = download_plan(spark, "st49", "2024-02-27", "2024-03-01", "https://host.invalid/wells/")
    got = [(str(r.report_date), r.url, r.target) for r in plan.orderBy("report_date").collect()]
    assert got[0] == ("2024-02-27", "https://host.invalid/wells/SPUD0227.txt", "SPUD02272024.txt")
    assert len(got) == 4
    folder = tmp_shared("srv")
    write_named_files(spark.createDataFrame([("SPUD0228.txt", b"x")], "name string, content binary"), folder).count()
    plan = download_plan(spark, "st49", "2024-02-27", "2024-03-01", to_local_or_uri(folder) + "/")
    st = {str(r.report_date): r.status for r in fetch_reports(plan, parallelism=2).collect()}
    assert st["2024-02-28"] == "ok" and st["2024-02-27"].startswith("failed")


def test_routing(spark):
    df = spark.createDataFrame([("a.TXT", "ST1"), ("b.csv", "st49"), ("c", "st1"), ("d.txt", "nope")], "n string, t string")
    got = [tuple(r) for r in df.select(*route(F.col("n"), F.col("t"))).collect()]
    assert got[0] == ("st1", "WELLS", "TXT", True, None)
    assert got[1][3] is False and got[1][4] == "Invalid file extension. Expected: txt, Got: csv"
    assert got[2][4] == "Invalid file extension. Expected: TXT, Got: none"
    assert got[3][0] is None and got[3][4] == "Invalid report type: nope"


def test_date_range_ingest_keeps_content_dates_in_range(spark, tmp_shared):
    from report_lake.operators.ingest import ingest_date_range
    from test_stream import report

    folder = tmp_shared("srv")
    # remote names carry only MMdd: the day-02 file holds a report of another year
    files = [("WELLS0101.TXT", report(1, 2)), ("WELLS0102.TXT", report(2, 1).replace(b"2025", b"2019"))]
    write_named_files(spark.createDataFrame(files, "name string, content binary"), folder).count()
    fetched, res = ingest_date_range(spark, "st1", "2025-01-01", "2025-01-03", to_local_or_uri(folder) + "/",
                                     parallelism=2)
    st = {r.path: r.status for r in res.status.collect()}
    assert st == {"WELLS01012025.TXT": "ok", "WELLS01022025.TXT": "out_of_range"}
    assert sorted(r.date for r in res.records.collect()) == ["2025-01-01", "2025-01-01"]
    assert {r.status.split(":")[0] for r in fetched.collect()} == {"ok", "failed"}


def test_ingest_file_and_csv_glob_view(spark, tmp_shared):
    from report_lake.operators.ingest import ingest_file
    from report_lake.sources.csv import csv_glob_view
    from test_stream import report

    folder, csv = tmp_shared("txt"), tmp_shared("csv")
    write_named_files(spark.createDataFrame([("WELLS0105.TXT", report(5, 3))], "name string, content binary"),
                      folder).count()
    res = ingest_file(spark, f"{folder}/WELLS0105.TXT", "st1", csv_out=csv)
    assert [r.status for r in res.status.collect()] == ["ok"]
    csv_glob_view(spark, f"{csv}/*WELLS*/*.csv", "st1", "wells_csv")
    got = spark.sql("SELECT COUNT(*) AS n, MIN(date) AS d FROM wells_csv").first()
    assert (got.n, got.d) == (3, "2025-01-05")


def test_error_text(spark):
    from report_lake.operators.routing import error_text

    df = spark.createDataFrame([("Parsing", "bad field", True), ("Date", "no line", False)], "c string, d string, r boolean")
    got = [r.m for r in df.select(error_text(F.col("c"), F.col("d"), F.col("r")).alias("m")).collect()]
    assert got == ["Parsing - bad field", "Date: no line"]


def test_large_file_is_read_in_splits(spark, tmp_shared):
    """A report larger than a split is parsed like a small one, and in its order."""
    from report_lake.operators.ingest import ingest_file
    from test_stream import report

    folder = tmp_shared("one file")
    write_named_files(spark.createDataFrame([("WELLS0101.TXT", report(1, 9))], "name string, content binary"), folder).count()
    whole = ingest_file(spark, f"{folder}/WELLS0101.TXT", "st1").records.orderBy("record_no").collect()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        res = ingest_file(spark, f"{folder}/WELLS0101.TXT", "st1")
        lines = read_lines(spark, folder)
        assert lines.select("blk").distinct().count() > 3
        split = res.records.orderBy("record_no").collect()
        assert [tuple(r) for r in split] == [tuple(r) for r in whole] and len(split) == 9
        assert " " in split[0]["path"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_two_reports_of_one_day(spark, tmp_shared):
    from report_lake.sources.csv import read_report_csv
    from test_stream import report

    folder, csv, bad = tmp_shared("txt"), tmp_shared("csv"), tmp_shared("quarantine")
    write_named_files(spark.createDataFrame([("A.TXT", report(5, 3)), ("B.TXT", report(5, 2)), ("C.TXT", b"x")], "name string, content binary"), folder).count()
    res = ingest_folder(spark, folder, "st1", csv_out=csv, quarantine_path=bad)
    assert read_report_csv(spark, csv, "st1").count() == 2  # the greatest path counts
    st = {r.path.split("/")[-1]: r.status for r in res.status.collect()}
    assert st == {"A.TXT": "superseded", "B.TXT": "ok", "C.TXT": "date_parse"}
    assert sorted(r["path"].split("/")[-1] for r in spark.read.parquet(bad).collect()) == ["A.TXT", "C.TXT"]


def test_each_url_is_fetched_once(spark, tmp_shared):
    from report_lake.operators.ingest import ingest_date_range
    from test_stream import report

    calls = tmp_shared("calls").removeprefix("file:")
    body = report(1, 1)

    def fetcher(url):
        import os
        import uuid

        os.makedirs(calls, exist_ok=True)
        open(f"{calls}/{uuid.uuid4().hex}", "w").close()
        return body

    import os

    fetched, res = ingest_date_range(spark, "st1", "2025-01-01", "2025-01-01", "x/", fetcher=fetcher, csv_out=tmp_shared("csv"), txt_out=tmp_shared("bodies"))
    assert res.status.count() == res.records.count() == fetched.count() == 1
    assert len(os.listdir(calls)) == 1


def test_report_file_larger_than_one_value(spark, tmp_path):
    """Reports are written in parts, none of which passes through a row: here no file
    longer than 64 bytes can be read as one."""
    lines = [("BIG.TXT", (i % 7 << 40) + i, f"line {i % 7} {i:04d}") for i in range(300)] + [("ONE.TXT", i, f"only {i}") for i in range(20)]
    df = spark.createDataFrame(lines, "path string, pos long, line string").repartition(4)
    key, folder = "spark.sql.sources.binaryFile.maxLength", tmp_path / "reports"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        write_report_files(df, f"file:{folder}", f"file:{tmp_path}/staging")
    finally:
        spark.conf.set(key, before)
    for name in ("BIG.TXT", "ONE.TXT"):
        want = [x[2] for x in sorted(lines, key=lambda x: x[1]) if x[0] == name]
        assert (folder / name).read_text().splitlines() == want
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["BIG.TXT", "ONE.TXT"]


def test_report_files_are_copied_under_a_second_name(spark, tmp_path):
    """One write of the lines gives both names, for reports of one part and of several."""
    lines = [("BIG.TXT", i, f"line {i} " + "x" * 100) for i in range(3000)] + [("ONE.TXT", i, f"one {i}") for i in range(4)]
    df = spark.createDataFrame(lines, "path string, pos long, line string").repartition(4)
    folder = tmp_path / "out"
    write_report_files(df, f"file:{folder}", f"file:{tmp_path}/staging", also=lambda p: F.concat(F.lit("OLD"), p))
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["BIG.TXT", "OLDBIG.TXT", "OLDONE.TXT", "ONE.TXT"]
    for name in ("BIG.TXT", "ONE.TXT"):
        want = [x[2] for x in lines if x[0] == name]
        assert (folder / name).read_text().splitlines() == want == (folder / f"OLD{name}").read_text().splitlines()


def plans_of(monkeypatch, module, name):
    """The plans of the frames that ``module.name`` gets, as text."""
    seen, real = [], getattr(module, name)

    def spy(df, *args, **kwargs):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(module, name, spy)
    return seen


def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


def default_splits(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_folder_lines_are_written_as_they_come(spark, tmp_shared, monkeypatch):
    """Files read in splits are parsed without a shuffle of their lines, and give what
    the same lines give as rows without order."""
    import random

    from conftest import lines_df
    from report_lake.operators import parse
    from test_parse import random_report, rec, st1_text

    rng = random.Random(3)
    texts = {f"R{i:02d}.TXT": random_report(rng, "st1") for i in range(12)}
    texts.update({f"V{i}.TXT": st1_text(["", *sum((rec(j) + [" "] * (j % 2) for j in range(9 * i)), [])]) for i in range(4)})
    texts["BLANK.TXT"] = " \n\n\r\n"
    folder = tmp_shared("txt")
    files = [(n, t.encode()) for n, t in texts.items()] + [("BAD.TXT", st1_text(rec(1)).encode() + b"\n\xe2\x80\n")]
    write_named_files(spark.createDataFrame(files, "name string, content binary"), folder).count()
    want = parse.parse_reports(lines_df(spark, texts), "st1")
    staged = plans_of(monkeypatch, parse, "stage")
    tiny_splits(spark)
    try:
        got = ingest_folder(spark, folder, "st1")
        assert "Scan text" in staged[0] and "Exchange" not in staged[0]
        assert not [p for p in staged[1:] if "Scan text" in p]
        name = F.regexp_extract("path", r"([^/]*)$", 1)
        rows = lambda df: sorted(map(tuple, df.withColumn("path", name).collect()), key=repr)
        assert rows(got.records) == rows(want.records) and len(rows(want.records)) > 50
        status = [r for r in rows(got.status) if r[0] != "BAD.TXT"]
        assert status == rows(want.status)
        assert [r["status"] for r in got.status.where("path like '%BAD.TXT'").collect()] == ["io_error"]
    finally:
        default_splits(spark)


def test_one_file_of_many_reports_is_not_shuffled(spark, tmp_shared, monkeypatch):
    """Of one file with several reports, the lines of the first section alone are put together."""
    from report_lake.operators import parse
    from report_lake.operators.ingest import ingest_file
    from test_stream import report

    folder = tmp_shared("txt")
    write_named_files(spark.createDataFrame([("ALL.TXT", report(1, 9) + report(2, 50))], "name string, content binary"), folder).count()
    staged = plans_of(monkeypatch, parse, "stage")
    tiny_splits(spark)
    try:
        res = ingest_file(spark, f"{folder}/ALL.TXT", "st1")
        assert "Exchange" not in staged[0]
        assert [(r.record_no, r.well_name) for r in res.records.orderBy("record_no").collect()] == [(i, f"WELL 1{i}") for i in range(9)]
        assert [(r.status, r.records) for r in res.status.collect()] == [("ok", 9)]
    finally:
        default_splits(spark)


def test_paths_that_come_twice_are_not_taken_in_order(spark, monkeypatch):
    from report_lake.operators import ingest, parse
    from test_stream import report

    orders = []
    real = parse.staged_in_order
    monkeypatch.setattr(parse, "staged_in_order", lambda *a: orders.append(1) or real(*a))
    once = spark.createDataFrame([("a", report(1, 2)), ("b", report(2, 3))], "path string, content binary")
    assert ingest.ingest_reports(once, "st1").records.count() == 5 and orders
    orders.clear()
    ingest.ingest_reports(once.union(once), "st1")
    assert not orders
    monkeypatch.setattr(ingest, "BROADCAST_BLOCKS", 1)  # nor are more blocks than are broadcast
    assert ingest.ingest_reports(once, "st1").records.count() == 5 and not orders


def test_saved_texts_are_not_shuffled_and_staged_bodies_can_go(spark, tmp_shared, monkeypatch):
    """Texts are saved from where they were fetched; days out of range are not put together;
    what a range staged can be dropped, as a second fetch replaces its texts."""
    from pyspark.sql import DataFrameWriter

    from report_lake.operators.ingest import ingest_date_range
    from report_lake.session import drop_staged, path_exists, staged_tables
    from test_stream import report

    saved, plans, before = tmp_shared("texts"), {}, staged_tables()
    write = DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        plans[path] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    pages = {"x/WELLS0101.TXT": report(1, 2), "x/WELLS0102.TXT": report(2, 3).replace(b"2025", b"2019"), "x/WELLS0103.TXT": report(3, 4)}
    for _ in range(2):
        drop_staged(spark, before)
        assert staged_tables() == before
        _, res = ingest_date_range(spark, "st1", "2025-01-01", "2025-01-03", "x/", fetcher=pages.__getitem__, txt_out=saved)
    bodies = [p for p in staged_tables() - before if "/fetched-" in p]
    assert len(bodies) == 1 and path_exists(spark, bodies[0])
    assert "Exchange" not in plans[saved]
    assert sorted((r.path, r.date) for r in res.records.collect()) == 2 * [("WELLS01012025.TXT", "2025-01-01")] + 4 * [("WELLS01032025.TXT", "2025-01-03")]
    assert {r.path: (r.status, r.records) for r in res.status.collect()} == {
        "WELLS01012025.TXT": ("ok", 2), "WELLS01022025.TXT": ("out_of_range", 3), "WELLS01032025.TXT": ("ok", 4)}
    assert sorted(r.n for r in spark.read.parquet(saved).groupBy("target").agg(F.count(F.lit(1)).alias("n")).collect()) == [1, 1, 1]
    drop_staged(spark, before)
    assert not path_exists(spark, bodies[0])


def test_reports_are_written_from_orders(spark, tmp_path, monkeypatch):
    """Files of rendered reports hold the rendered lines in order, although what is dealt
    out by range are order rows: keys below zero lie among the header lines, keys and days
    are null or come twice. The parts are dropped."""
    from pyspark.sql import types as T

    from report_lake.plans import fixtures
    from report_lake.plans.render import render_st1, render_st49, st1_reports, st49_reports

    schema = T.StructType.fromDDL("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    import datetime

    day = lambda n: datetime.datetime(2025, 1, n)
    keys = [*range(-15, 40), 7, 7, 2**40]
    orders = [(k, abs(k) % 3, "OFP"[k % 3], 10.5 * abs(k), day(12 + k % 3), "1-URGENT") for k in keys]
    orders += [(None, 1, "P", 3.0, day(12), "5-LOW"), (50, 9, "F", 4.0, day(20), "5-LOW"), (51, 2, None, None, day(13), None)]
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/t/orders.parquet")
    spark.createDataFrame([(i, f"Customer#{i}", i, 1.5 * i, "BUILDING") for i in range(3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/t/customer.parquet")
    spark.createDataFrame([(i, f"NATION {i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/t/nation.parquet")
    monkeypatch.setattr(fixtures, "ORDERS_PER_TASK", 5)
    written = plans_of(monkeypatch, fixtures, "_write_ordered")
    for which, render, reports in (("a", render_st1, st1_reports), ("b", render_st49, st49_reports)):
        folder, staging = tmp_path / which, tmp_path / f"staging_{which}"
        fixtures.write_reports(reports(spark, f"{tmp_path}/t"), f"file:{folder}", f"file:{staging}", len(orders))
        assert not staging.exists()
        dealt = written.pop()
        assert dealt.index("Generate explode(lines") < dealt.index("rangepartitioning")  # lines are made above it
        want = {}
        for r in render(spark, f"{tmp_path}/t").collect():
            want.setdefault(r.path, []).append((r.pos is not None, r.pos or 0, r.line or ""))
        assert {p.name for p in folder.iterdir() if not p.name.startswith(".")} == set(want) and len(want) == 4
        for path, lines in want.items():
            got = (folder / path).read_bytes().decode().split("\n")[:-1]
            blocks = {}
            for known, pos, line in lines:
                blocks.setdefault((known, pos), []).append(line)
            at = 0
            for key in sorted(blocks):  # lines of one position are in no order
                assert sorted(got[at : at + len(blocks[key])]) == sorted(blocks[key]), (path, key)
                at += len(blocks[key])
            assert at == len(got)
