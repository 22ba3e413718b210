"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or reports Spark renders from them), so
its work grows with the tables. Queries that need files on disk write them
below the session's shared checkpoint folder first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import byte_slice as _byte_slice
from ..functions.text import plain_path
from ..functions.text import ruler_boundaries as _ruler_boundaries
from ..operators.parse import STATUS_DATE, STATUS_OK, parse_reports
from ..operators.parse import report_lines as _report_lines
from ..operators.ranges import in_date_range
from ..sources.files import text_lines
from ..operators.ingest import ingest_archives, ingest_date_range, ingest_file, ingest_folder
from ..operators.islands import IslandSpec, parse_islands
from ..operators.reconcile import except_rows, reconcile_days, sym_diff, table_count, table_head
from ..operators.routing import route
from ..operators.table import (
    announce,
    append_candidates,
    compact,
    create_or_open_table,
    default_ledger_path,
    load_candidates,
    load_table,
    quarantine,
    read_table,
    stale_files,
)
from ..session import drop_path, drop_staged, scratch_path, stage, staged_tables, to_local_or_uri
from ..sources.archives import member_names
from ..sources.csv import csv_glob_view, read_report_csv, read_report_days, read_report_order, report_unit, write_report_csv
from ..sources.download import download_plan, fetch_reports, local_name_pattern
from ..sources.files import list_files, utf8_gate
from ..sources.ledger import append_ledger, read_ledger, read_ledger_entries
from ..streaming.incremental import incremental_stream, records_to_table
from ..spec import ST1
from . import fixtures, oracles
from .render import EVENTS_SPEC, load, render_events, render_st1, render_st49, st1_reports


def q_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    lines = text_lines(docs, F.concat(F.lit("doc/"), F.col("doc_id").cast("string")), "text")
    return _report_lines(lines)


def q_byte_slice(spark: SparkSession, sf: str) -> DataFrame:
    rl = q_report_lines(spark, sf)
    return rl.select(
        "path", "line_no",
        _byte_slice("line", 0, 37).alias("f0"),
        _byte_slice("line", 37, 47).alias("f1"),
        _byte_slice("line", 47, 68).alias("f2"),
        _byte_slice("line", 68).alias("f3"),
    )


def q_st1_records(spark: SparkSession, sf: str) -> DataFrame:
    return parse_reports(render_st1(spark, sf), "st1").records


def q_st49_records(spark: SparkSession, sf: str) -> DataFrame:
    return parse_reports(render_st49(spark, sf), "st49").records


def q_record_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = parse_reports(render_st1(spark, sf), "st1").chunks
    return c.select("path", "record_no", *[f"line{i}" for i in range(5)])


def q_section_block(spark: SparkSession, sf: str) -> DataFrame:
    s = parse_reports(render_st1(spark, sf), "st1").section
    return s.select("path", F.col("r").alias("line_index"), "line")


def q_ruler_block(spark: SparkSession, sf: str) -> DataFrame:
    s = parse_reports(render_st49(spark, sf), "st49").section
    return s.select("path", "record_no", "line")


def q_ruler_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    # every line of every document as a ruler: words of one to four byte characters
    docs = load(spark, sf, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "ruler"))
    return lines.select("doc_id", "line_no", F.posexplode(_ruler_boundaries("ruler")).alias("idx", "b")).select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("idx").cast("long").alias("idx"),
        F.col("b.start").cast("long").alias("start_pos"), F.col("b.end").cast("long").alias("end_pos"),
    )


def _dates(status: DataFrame) -> DataFrame:
    return status.select(
        "path", "report_date", F.when(F.col("status") == STATUS_DATE, F.col("error")).alias("error")
    )


def q_st1_date(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(parse_reports(render_st1(spark, sf), "st1").status)


def q_st49_date(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(parse_reports(render_st49(spark, sf), "st49").status)


def q_error_summary(spark: SparkSession, sf: str) -> DataFrame:
    s1 = parse_reports(render_st1(spark, sf), "st1").status
    s49 = parse_reports(render_st49(spark, sf), "st49").status
    return s1.unionByName(s49).groupBy("report_type", "status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("records").alias("records")
    )


def q_date_range_filter(spark: SparkSession, sf: str) -> DataFrame:
    p = parse_reports(render_st1(spark, sf), "st1")
    st = in_date_range(p.status, oracles.RANGE_START, oracles.RANGE_END)
    return st.select(
        "path", "report_date", "status",
        F.when(F.col("status") == STATUS_OK, F.col("records")).otherwise(F.lit(0)).cast("long").alias("records"),
    )


def q_custom_spec(spark: SparkSession, sf: str) -> DataFrame:
    return parse_reports(render_events(spark, sf), EVENTS_SPEC).records



# ---------------------------------------------------------------- table side

def _staged_records(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed ST1 records written once to the shared folder (read by several writes)."""
    path = scratch_path(spark, "records_st1")
    fixtures.parsed_st1(spark, sf).records.write.parquet(path)
    return spark.read.parquet(path)


def _loaded_table(spark: SparkSession, sf: str, two_batches: bool = True) -> str:
    """Parse ST1 -> CSV in two batches -> two incremental loads; returns the table path."""
    recs = _staged_records(spark, sf) if two_batches else fixtures.parsed_st1(spark, sf).records
    csv = scratch_path(spark, "csv")
    table = scratch_path(spark, "table_st1")
    early = F.to_date("date") < F.lit("1998-01-01").cast("date")
    if two_batches:
        write_report_csv(recs.where(early), csv, "st1")
        load_table(spark, table, "st1", csv_folder=csv)
        write_report_csv(recs.where(~early), csv, "st1")
        load_table(spark, table, "st1", csv_folder=csv)
    else:
        write_report_csv(recs, csv, "st1")
        load_table(spark, table, "st1", csv_folder=csv)
    return table


def q_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = fixtures.csv_folder(spark, sf)
    return read_report_csv(spark, folder, "st1")


def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    folder = fixtures.csv_folder(spark, sf, damaged=True)
    return read_report_csv(spark, folder, "st1")


def q_table_create(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_path(spark, "table_st1")
    create_or_open_table(spark, table, "st1")
    create_or_open_table(spark, table, "st1")  # second call opens, keeps the table
    csv = fixtures.csv_folder(spark, sf)
    load_table(spark, table, "st1", csv_folder=csv)
    return read_table(spark, table, "st1")


def q_append_batch(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _loaded_table(spark, sf), "st1")


def q_table_count(spark: SparkSession, sf: str) -> DataFrame:
    return table_count(read_table(spark, _loaded_table(spark, sf, two_batches=False), "st1"))


def q_table_head(spark: SparkSession, sf: str) -> DataFrame:
    t = read_table(spark, _loaded_table(spark, sf, two_batches=False), "st1")
    return table_head(t, 10, ["date", "licence_number"])


def q_table_recreate(spark: SparkSession, sf: str) -> DataFrame:
    recs = fixtures.parsed_st1(spark, sf).records
    csv = scratch_path(spark, "csv")
    table = scratch_path(spark, "table_st1")
    write_report_csv(recs, csv, "st1")
    load_table(spark, table, "st1", csv_folder=csv)
    load_table(spark, table, "st1", csv_folder=csv, recreate=True)  # replaces table and ledger: rows once
    return read_table(spark, table, "st1")


def q_ledger_append(spark: SparkSession, sf: str) -> DataFrame:
    table = _loaded_table(spark, sf)
    e = read_ledger_entries(spark, default_ledger_path(table))
    e = e.where("status <> 'pending'")
    return e.select(F.regexp_extract("csv_file", r"report=([^/]+)$", 1).alias("report"), "status")


def q_ledger_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ledger")
    fixtures.ledger_lines(spark, sf).write.text(path)
    return read_ledger(spark, path)


def q_load_candidates(spark: SparkSession, sf: str) -> DataFrame:
    listing = fixtures.candidate_listing(spark, sf)
    ledger = scratch_path(spark, "ledger")
    append_ledger(listing.where(F.col("lang") == "en").select(F.col("path").alias("csv_file")), ledger)
    offered = listing.unionByName(listing.where(F.col("lang") == "fr"))  # offered twice: once by folder, once by path
    return load_candidates(spark, "st1", ledger, listing=offered.select("path", "length")).select("path")


def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    st = in_date_range(fixtures.parsed_st1(spark, sf).status, oracles.RANGE_START, oracles.RANGE_END)
    q = quarantine(st, scratch_path(spark, "quarantine"))
    return q.select("path", "status", "error")


def _compacted(spark: SparkSession, sf: str) -> tuple[str, str]:
    table, target = scratch_path(spark, "table_st49"), scratch_path(spark, "table_st49_compact")
    create_or_open_table(spark, table, "st49")
    records_to_table(fixtures.parsed_st49(spark, sf).records, table, "st49", spread=F.col("record_no") % 3)
    res = compact(spark, table, target)
    if res.files_after >= res.files_before:
        raise AssertionError(f"compaction did not reduce files: {res}")
    return table, target


def q_compact(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _compacted(spark, sf)[1], "st49")


def q_stale_files(spark: SparkSession, sf: str) -> DataFrame:
    table, _ = _compacted(spark, sf)
    return stale_files(spark, table, retention_hours=0).select(
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), "length"
    )


def q_stale_unreferenced(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by version and month that lie in files past use: of a folder with a table and
    its compacted successor, those of the first alone."""
    root = scratch_path(spark, "versions_st49")
    table, target = f"{root}/v1", f"{root}/v2"
    create_or_open_table(spark, table, "st49")
    records_to_table(fixtures.parsed_st49(spark, sf).records, table, "st49", spread=F.col("record_no") % 3)
    compact(spark, table, target)
    stale = stage(stale_files(spark, root, retention_hours=0, live_tables=[target]).select("path"), "stale")
    rows = [spark.read.parquet(p).select(F.lit(v).alias("version"), F.col("report_month").cast("string").alias("report_month"), plain_path(F.col("_metadata.file_path")).alias("path")) for v, p in (("v1", table), ("v2", target))]
    return reduce(DataFrame.unionByName, rows).join(stale, "path", "left_semi").groupBy("version", "report_month").agg(F.count(F.lit(1)).alias("rows"))


def q_report_order(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every record in its report's files, several files a report."""
    out = scratch_path(spark, "csv_ordered")
    write_report_csv(_staged_records(spark, sf), out, "st1", records_per_file=4, ordered=True)
    return read_report_order(spark, out, "st1").select("date", "licence_number", "well_name", "place")


def q_load_single_path(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files given by path load whatever their name; found by folder they would not."""
    csv = fixtures.csv_folder(spark, sf)
    copy, table = scratch_path(spark, "plain"), scratch_path(spark, "table_st1")
    rows = spark.read.option("recursiveFileLookup", "true").text(csv).where(~F.col("value").startswith("date|"))
    header = "|".join(ST1.columns)
    rows.select(F.col("value").alias(header)).write.option("header", "true").option("sep", "\x01").option("quote", "").csv(copy)
    load_table(spark, table, "st1", csv_folder=copy)  # no prefix in the names: no candidate
    paths = [r["path"] for r in list_files(spark, copy, glob="*.csv").select("path").collect()]
    load_table(spark, table, "st1", csv_paths=paths)
    load_table(spark, table, "st1", csv_paths=paths)  # known by now
    return read_table(spark, table, "st1")


def q_reload_same_report(spark: SparkSession, sf: str) -> DataFrame:
    """Parse, load, parse again, load again, in a folder with a space: rows once."""
    recs = _staged_records(spark, sf)
    csv, table = scratch_path(spark, "csv two"), scratch_path(spark, "table_st1")
    for _ in range(2):
        write_report_csv(recs, csv, "st1")
        load_table(spark, table, "st1", csv_folder=csv)
    return read_table(spark, table, "st1")


def q_rows_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """What one load put into the table: rows and status by report."""
    csv, table = fixtures.csv_folder(spark, sf, damaged=True), scratch_path(spark, "table_st1")
    files = load_table(spark, table, "st1", csv_folder=csv).files
    report = F.regexp_extract(report_unit("csv_file"), r"report=([^/]+)$", 1)
    return files.groupBy(report.alias("report")).agg(
        F.sum(F.when(F.col("status") == "ok", F.col("rows")).otherwise(0)).alias("rows"),
        F.when(F.max(F.col("status") != "ok"), "skipped").otherwise("loaded").alias("status"),
    )


def q_crash_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Loads that stop at every point, rows shared between reports, a file that goes:
    the rows of the table, and how often they are there."""
    recs, csv, table = _staged_records(spark, sf), scratch_path(spark, "csv"), scratch_path(spark, "table_st1")
    ledger, year = default_ledger_path(table), F.year(F.to_date("date"))
    create_or_open_table(spark, table, "st1")

    def announced(batch):
        cands = load_candidates(spark, "st1", ledger, csv_folder=csv).withColumn("batch", F.lit(batch))
        cands = stage(cands, "candidates")
        announce(cands, ledger)
        return cands

    write_report_csv(recs.where(year <= 1993), csv, "st1")
    announced("stopped-before")  # announced, not appended
    load_table(spark, table, "st1", csv_folder=csv)
    write_report_csv(recs.where((year > 1993) & (year <= 1996)), csv, "st1")
    append_candidates(spark, table, announced("stopped-after"), "st1", csv)  # appended, not recorded
    # another folder's report of the same days, rows equal to stored ones: a report of its own
    twice = scratch_path(spark, "csv")
    write_report_csv(recs.where(year == 1992), twice, "st1")
    gone = F.lit(f"{to_local_or_uri(csv)}/report=19000101_WELLS")
    announce(spark.range(1).select(gone.alias("unit"), F.lit("stopped-after").alias("batch")), ledger)
    load_table(spark, table, "st1", csv_folder=twice)
    write_report_csv(recs.where(year > 1996), csv, "st1")
    for _ in range(2):
        load_table(spark, table, "st1", csv_folder=csv)
    return read_table(spark, table, "st1").groupBy(*ST1.columns).agg(F.count(F.lit(1)).alias("copies"))


def q_append_from_frame(spark: SparkSession, sf: str) -> DataFrame:
    """An append driven by a candidate frame: all days, no list of them on the driver."""
    csv, table = fixtures.csv_folder(spark, sf), scratch_path(spark, "table_st1")
    create_or_open_table(spark, table, "st1")
    cands = load_candidates(spark, "st1", default_ledger_path(table), csv_folder=csv).withColumn("batch", F.lit("frame"))
    append_candidates(spark, table, cands, "st1", csv)
    return read_table(spark, table, "st1")


def _wanted_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days as a relation: those of orders of one priority in one year's quarter."""
    o = load(spark, sf, "orders").where((F.col("o_orderpriority") == "2-HIGH") & (F.quarter("o_orderdate") == 2) & (F.year("o_orderdate") == 1995))
    return o.select(F.to_date("o_orderdate").alias("day")).distinct()


def q_pruned_range(spark: SparkSession, sf: str) -> DataFrame:
    """A range of days and a relation of days, read from the CSV folder and from the
    table; only their directories are opened."""
    csv, table = fixtures.csv_folder(spark, sf), scratch_path(spark, "table_st1")
    load_table(spark, table, "st1", csv_folder=csv)
    a, b, days = oracles.RANGE_START, oracles.RANGE_END, _wanted_days(spark, sf)
    parts = {
        "csv_range": read_report_days(spark, csv, "st1", start=a, end=b).drop("report_day"),
        "csv_days": read_report_days(spark, csv, "st1", days=days).drop("report_day"),
        "table_range": read_table(spark, table, "st1", start=a, end=b),
        "table_days": read_table(spark, table, "st1", days=days),
    }
    return reduce(DataFrame.unionByName, [df.withColumn("part", F.lit(k)) for k, df in parts.items()])


def q_csv_glob_view(spark: SparkSession, sf: str) -> DataFrame:
    csv = fixtures.csv_folder(spark, sf)
    csv_glob_view(spark, f"{csv}/*199[67]*_WELLS/*.csv", "st1", "well_rows")
    return spark.sql("SELECT * FROM well_rows")


def _reconcile(spark: SparkSession, records: DataFrame, report_type: str, column: str) -> DataFrame:
    """The CSV folder against a table that lost, changed and doubled rows."""
    staged, csv, table = scratch_path(spark, "records"), scratch_path(spark, "csv"), scratch_path(spark, f"table_{report_type}")
    records.write.parquet(staged)
    records = spark.read.parquet(staged)
    write_report_csv(records, csv, report_type)
    dom = F.dayofmonth(F.to_date("date"))
    kept = records.where(dom != 6).withColumn(column, F.when(dom == 5, F.concat(F.lit("x"), column)).otherwise(F.col(column)))
    create_or_open_table(spark, table, report_type)
    records_to_table(kept.unionByName(kept.where(dom == 7)), table, report_type)
    return sym_diff(read_report_csv(spark, csv, report_type), read_table(spark, table, report_type), all=True)


def q_reconcile_st1(spark: SparkSession, sf: str) -> DataFrame:
    return _reconcile(spark, fixtures.parsed_st1(spark, sf).records, "st1", "licensee")


def q_reconcile_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """The same comparison through fingerprints: only days that differ are read row by
    row; each difference comes with how many days these were."""
    records, csv, table = fixtures.parsed_st1(spark, sf).records, scratch_path(spark, "csv"), scratch_path(spark, "table_st1")
    records = stage(records, "records")
    write_report_csv(records, csv, "st1")
    dom = F.dayofmonth(F.to_date("date"))
    kept = records.where(dom != 6).withColumn("licensee", F.when(dom == 5, F.concat(F.lit("x"), "licensee")).otherwise(F.col("licensee")))
    create_or_open_table(spark, table, "st1")
    records_to_table(kept, table, "st1")
    records_to_table(kept.where(dom == 7), table, "st1")
    diff, days = reconcile_days(spark, csv, table, "st1")
    return diff.join(days.agg(F.count(F.lit(1)).alias("days_read")), how="cross")


def q_reconcile_st49(spark: SparkSession, sf: str) -> DataFrame:
    return _reconcile(spark, fixtures.parsed_st49(spark, sf).records, "st49", "activity_type")


def q_except_rows(spark: SparkSession, sf: str) -> DataFrame:
    a, b = perturbed_orders(spark, sf)
    return except_rows(a, b)


def q_sym_diff(spark: SparkSession, sf: str) -> DataFrame:
    a, b = perturbed_orders(spark, sf)
    return sym_diff(a, b)


def perturbed_orders(spark: SparkSession, sf: str):
    """``orders`` and a copy with changed, dropped, duplicated and NULLed rows;
    both sides also share rows with a NULL, which must compare equal."""
    o = load(spark, sf, "orders")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    shared_null = (pr == "4-NOT SPECIFIED") & (st == "O")
    a = o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.when(shared_null, F.lit(None)).otherwise(pr).alias("o_orderpriority"),
    )
    b0 = o.where(~((pr == "2-HIGH") & (st == "O"))).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when((pr == "1-URGENT") & (st == "F"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(shared_null | ((pr == "3-MEDIUM") & (st == "F")), F.lit(None)).otherwise(pr).alias("o_orderpriority"),
    )
    b = b0.unionByName(b0.where(st == "P"))
    return a, b


# ---------------------------------------------------------------- sources

def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.regexp_extract("path", r"([^/]*)$", 1))


def q_ingest_folder(spark: SparkSession, sf: str) -> DataFrame:
    folder = fixtures.report_folder(spark, sf, "st1")
    fixtures.add_report_files(spark, sf, folder, "st49")  # decoys: another report type
    return _named(ingest_folder(spark, folder, "st1").records)


def q_folder_status(spark: SparkSession, sf: str) -> DataFrame:
    """Every file of a folder has a status: reports, reports of another type, and other names."""
    folder = fixtures.report_folder(spark, sf, "st1")
    fixtures.add_report_files(spark, sf, folder, "st49", also=lambda p: F.concat(p, F.lit(".dat")))
    return _named(ingest_folder(spark, folder, "st1").status).select("path", "status", "recoverable", "records")


def q_folder_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """A folder filtered by prefix, among files of the same extension."""
    folder = fixtures.report_folder(spark, sf, "st1", also=lambda p: F.concat(F.lit("OLD"), p))
    return _named(ingest_folder(spark, folder, "st1", prefix="WELLS").records)


def q_ingest_file(spark: SparkSession, sf: str) -> DataFrame:
    """All reports one after another in a single file: it is one report, with the
    first date and the first section."""
    reports, folder = st1_reports(spark, sf), scratch_path(spark, "one_file")
    base = F.datediff("d", F.lit("1970-01-01").cast("date")).cast("long") * F.lit(10**12)  # of a day's lines in the file
    slot = base + F.shiftleft(F.col("slot"), reports.slot_bits)
    day = F.datediff(F.to_date(F.substring("path", 6, 8), "MMddyyyy"), F.lit("1970-01-01").cast("date")).cast("long")

    def in_one(lines: DataFrame) -> DataFrame:
        return lines.select(F.lit("ALL.TXT").alias("path"), (day * F.lit(10**12) + F.col("pos")).alias("pos"), "line")

    fixtures.write_reports(reports, folder, scratch_path(spark, "render_staging"), load(spark, sf, "orders").count(), by=(slot,), renamed=in_one)
    return _named(ingest_file(spark, f"{folder}/ALL.TXT", "st1").records)


def q_date_range_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Days fetched, parsed and kept by their content's date; records counted from the records."""
    folder = fixtures.report_folder(spark, sf, "st1")
    base = to_local_or_uri(folder).rstrip("/") + "/"
    plan = download_plan(spark, "st1", None, None, base, url_pattern=local_name_pattern("st1"), bounds=_order_day_bounds(spark, sf))
    _, res = ingest_date_range(spark, "st1", oracles.RANGE_START, oracles.RANGE_END, base, plan=plan)
    counts = res.records.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    return res.status.join(counts, "path", "left").select("path", "report_date", "status", F.coalesce("n", F.lit(0)).alias("records"))


def q_utf8_gate(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    _, bad = utf8_gate(F.encode("text", "ISO-8859-1"))
    return docs.select("doc_id", (~bad).alias("valid_utf8"))


def q_utf8_lossy(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with 0, 1 or 2 invalid bytes put around them: each is replaced once."""
    docs = load(spark, sf, "documents")
    n, raw = F.col("doc_id") % 3, F.encode("text", "UTF-8")
    raw = F.when(n == 0, raw).when(n == 1, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(F.concat(F.unhex(F.lit("FE")), raw, F.unhex(F.lit("C3"))))
    text, _ = utf8_gate(raw, "replace")
    fixed = docs.select("doc_id", text.alias("t"))
    mark = F.lit("\ufffd")
    return fixed.select("doc_id", (F.length("t") - F.length(F.replace("t", mark, F.lit("")))).cast("long").alias("replaced"), F.replace("t", mark, F.lit("")).alias("text"))


def _order_day_bounds(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))


def q_download_plan(spark: SparkSession, sf: str) -> DataFrame:
    return download_plan(spark, "st1", None, None, oracles.URL_BASE, bounds=_order_day_bounds(spark, sf))


def q_fetch_reports(spark: SparkSession, sf: str) -> DataFrame:
    folder = fixtures.report_folder(spark, sf, "st1")
    base = to_local_or_uri(folder).rstrip("/") + "/"
    plan = download_plan(spark, "st1", None, None, base, url_pattern=local_name_pattern("st1"),
                         bounds=_order_day_bounds(spark, sf))
    got = fetch_reports(plan)
    return got.select(
        "report_date", "target",
        F.when(F.col("status") == "ok", F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
    )


def q_archive_members(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    d = F.col("d")
    dom = F.dayofmonth(d)
    mmdd = F.date_format(d, "MMdd")
    archive = F.when(dom == 29, F.lit("WELLS_ARCHIVE.zip")).otherwise(
        F.concat(F.lit("WELLS"), mmdd, F.lit("_"), F.date_format(d, "yyyy"), F.lit(".zip")))
    member = (
        F.when(dom == 30, F.lit("README")).when(dom == 31, F.lit("../evil.TXT"))
        .when(dom == 28, F.concat(F.lit("WELLS"), mmdd, F.lit(".zip"))).when(dom == 27, F.lit("docs/"))
        .when(dom % 5 == 0, F.concat(F.lit("WELLS"), mmdd, F.lit(".txt")))
        .otherwise(F.concat(F.lit("WELLS"), mmdd, F.lit(".TXT")))
    )
    names = o.select(archive.alias("archive"), member.alias("member"))
    return names.select("archive", "member", *member_names(F.col("archive"), F.col("member")))


def q_archive_expand(spark: SparkSession, sf: str) -> DataFrame:
    folder = fixtures.zip_folder(spark, sf)
    members, _ = ingest_archives(spark, folder, "st1")
    return members.select(
        F.regexp_extract("archive", r"([^/]*)$", 1).alias("archive"), "member", "year", "out_name", "status"
    )


def q_archive_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records parsed from archives, nested ones too, by archive and member."""
    _, res = ingest_archives(spark, fixtures.zip_folder(spark, sf), "st1")
    return _named(res.records)


def q_date_range_saved(spark: SparkSession, sf: str) -> DataFrame:
    """A date range fetched twice into one folder of texts: each text once, and its records."""
    folder, saved = fixtures.report_folder(spark, sf, "st1"), scratch_path(spark, "texts")
    base = to_local_or_uri(folder).rstrip("/") + "/"
    plan = download_plan(spark, "st1", None, None, base, url_pattern=local_name_pattern("st1"), bounds=_order_day_bounds(spark, sf))
    before = staged_tables()
    for _ in range(2):
        drop_staged(spark, before)  # the first result is not read: what it staged goes
        _, res = ingest_date_range(spark, "st1", oracles.RANGE_START, oracles.RANGE_END, base, plan=plan, txt_out=saved)
    texts = spark.read.parquet(saved).groupBy(F.col("target").alias("path")).agg(F.count(F.lit(1)).alias("texts"))
    return res.records.join(texts, "path")


ISLANDS = IslandSpec("CONV ", (("conv_id", 5, 15),), (("turn", 0, 6), ("role", 6, 18), ("text_md5", 18, None)), ends="END")


def render_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as report files: a header line for each, then a line a turn; an
    end mark and a stray line after every third one."""
    c = load(spark, sf, "conversations")
    path = F.concat(F.lit("CONV"), (F.col("conv_id") % 5).cast("string"), F.lit(".TXT"))
    head = F.concat(F.lit("CONV "), F.lpad(F.col("conv_id").cast("string"), 10, "0"))
    turn = F.concat(F.rpad(F.col("turn").cast("string"), 6, " "), F.rpad("role", 12, " "), F.md5("text"))
    base = F.col("conv_id") * 1_000_000
    heads = c.select("conv_id").distinct().select(path.alias("path"), base.alias("pos"), head.alias("line"))
    turns = c.select(path.alias("path"), (base + 1 + F.col("turn")).alias("pos"), turn.alias("line"))
    stray = c.where("conv_id % 3 = 0").select("conv_id").distinct()
    stray = stray.select(path.alias("path"), F.explode(F.array(F.struct((base + 999_000).alias("pos"), F.lit("END OF CONVERSATION").alias("line")), F.struct((base + 999_001).alias("pos"), F.lit("page 1 of 1").alias("line")))).alias("x"))
    return heads.union(turns).union(stray.select("path", "x.pos", "x.line"))


def q_custom_islands(spark: SparkSession, sf: str) -> DataFrame:
    return parse_islands(render_conversations(spark, sf), ISLANDS)


def q_report_routing(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    ext = (F.when(F.col("lang") == "en", F.lit(".TXT")).when(F.col("lang") == "fr", F.lit(".txt"))
           .when(F.col("lang") == "de", F.lit(".csv")).otherwise(F.lit("")))
    name = F.concat(F.lpad(F.col("doc_id").cast("string"), 6, "0"), ext)
    rtype = (F.when(F.length("source") == 4, F.lit("ST1"))
             .when(F.col("source").isin("src10", "src11", "src12"), F.lit("st49"))
             .when(F.col("source") == "src13", F.lit("Bogus")).otherwise(F.lit("St49")))
    named = docs.select("doc_id", name.alias("name"), rtype.alias("requested"))
    return named.select("doc_id", "name", "requested", *route(F.col("name"), F.col("requested")))


def q_incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    early = F.col("path").substr(10, 4) < F.lit("1998")
    folder = fixtures.report_folder(spark, sf, "st1", where=early)
    table = scratch_path(spark, "table_stream")
    ckpt = scratch_path(spark, "stream_ckpt")
    incremental_stream(spark, folder, "st1", table, ckpt)
    fixtures.add_report_files(spark, sf, folder, "st1", ~early)
    incremental_stream(spark, folder, "st1", table, ckpt)
    return read_table(spark, table, "st1")


def q_stream_stateful(spark: SparkSession, sf: str) -> DataFrame:
    """A stream whose last epoch is forgotten and replayed, and whose files are offered
    again under a fresh checkpoint: every row once."""
    early = F.col("path").substr(10, 4) < F.lit("1998")
    folder = fixtures.report_folder(spark, sf, "st1", where=early)
    table, ckpt = scratch_path(spark, "table_stream"), scratch_path(spark, "stream_ckpt")
    incremental_stream(spark, folder, "st1", table, ckpt)
    fixtures.add_report_files(spark, sf, folder, "st1", ~early)
    incremental_stream(spark, folder, "st1", table, ckpt)
    # the driver was lost before the second epoch was committed and its files recorded
    drop_path(spark, f"{ckpt}/commits/1")
    entries = stage(read_ledger_entries(spark, default_ledger_path(table)), "ledger")
    entries.where("status = 'pending' or batch like '%-0'").write.mode("overwrite").json(default_ledger_path(table))
    incremental_stream(spark, folder, "st1", table, ckpt)
    incremental_stream(spark, folder, "st1", table, scratch_path(spark, "stream_ckpt"))
    return read_table(spark, table, "st1")


def q_stream_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's ledger says what became of every file, failed ones included."""
    folder = fixtures.report_folder(spark, sf, "st1")
    table = scratch_path(spark, "table_stream")
    incremental_stream(spark, folder, "st1", table, scratch_path(spark, "stream_ckpt"))
    e = read_ledger_entries(spark, default_ledger_path(table)).where("status <> 'pending'")
    return e.select(F.regexp_extract("csv_file", r"([^/]*)$", 1).alias("file"), "status")


QUERIES = {
    "report_lines": q_report_lines,
    "byte_slice": q_byte_slice,
    "section_block": q_section_block,
    "record_chunks": q_record_chunks,
    "st1_records": q_st1_records,
    "ruler_block": q_ruler_block,
    "ruler_boundaries": q_ruler_boundaries,
    "st49_records": q_st49_records,
    "st1_date": q_st1_date,
    "st49_date": q_st49_date,
    "error_summary": q_error_summary,
    "date_range_filter": q_date_range_filter,
    "custom_spec": q_custom_spec,
    "csv_round_trip": q_csv_round_trip,
    "csv_scan": q_csv_scan,
    "table_create": q_table_create,
    "append_batch": q_append_batch,
    "table_count": q_table_count,
    "table_head": q_table_head,
    "table_recreate": q_table_recreate,
    "ledger_append": q_ledger_append,
    "ledger_read": q_ledger_read,
    "load_candidates": q_load_candidates,
    "quarantine": q_quarantine,
    "compact": q_compact,
    "stale_files": q_stale_files,
    "stale_unreferenced": q_stale_unreferenced,
    "report_order": q_report_order,
    "except_rows": q_except_rows,
    "sym_diff": q_sym_diff,
    "ingest_folder": q_ingest_folder,
    "utf8_gate": q_utf8_gate,
    "utf8_lossy": q_utf8_lossy,
    "download_plan": q_download_plan,
    "fetch_reports": q_fetch_reports,
    "archive_members": q_archive_members,
    "archive_expand": q_archive_expand,
    "report_routing": q_report_routing,
    "incremental_stream": q_incremental_stream,
    "stream_ledger": q_stream_ledger,
    "load_single_path": q_load_single_path,
    "reload_same_report": q_reload_same_report,
    "rows_loaded": q_rows_loaded,
    "csv_glob_view": q_csv_glob_view,
    "reconcile_fingerprint": q_reconcile_fingerprint,
    "archive_records": q_archive_records,
    "date_range_saved": q_date_range_saved,
    "custom_islands": q_custom_islands,
    "crash_replay": q_crash_replay,
    "append_from_frame": q_append_from_frame,
    "pruned_range": q_pruned_range,
    "stream_stateful": q_stream_stateful,
    "reconcile_st1": q_reconcile_st1,
    "reconcile_st49": q_reconcile_st49,
    "folder_status": q_folder_status,
    "folder_prefix": q_folder_prefix,
    "ingest_file": q_ingest_file,
    "date_range_ingest": q_date_range_ingest,
}

ORACLES = {
    "report_lines": oracles.report_lines(),
    "byte_slice": oracles.byte_slice(),
    "section_block": oracles.section_block(),
    "record_chunks": oracles.record_chunks(),
    "st1_records": oracles.st1_records(),
    "ruler_block": oracles.ruler_block(),
    "ruler_boundaries": oracles.ruler_boundaries(),
    "st49_records": oracles.st49_records(),
    "st1_date": oracles.st1_date(),
    "st49_date": oracles.st49_date(),
    "error_summary": oracles.error_summary(),
    "date_range_filter": oracles.date_range_filter(),
    "custom_spec": oracles.custom_spec(),
    "csv_round_trip": oracles.st1_stored(),
    "csv_scan": oracles.st1_stored(),
    "table_create": oracles.st1_stored(),
    "append_batch": oracles.st1_stored(),
    "table_count": oracles.table_count(),
    "table_head": oracles.table_head(),
    "table_recreate": oracles.st1_stored(),
    "ledger_append": oracles.ledger_append(),
    "ledger_read": oracles.ledger_read(),
    "load_candidates": oracles.load_candidates(),
    "quarantine": oracles.quarantine(),
    "compact": oracles.st49_stored(),
    "stale_unreferenced": oracles.stale_unreferenced(),
    "report_order": oracles.report_order(),
    "except_rows": oracles.except_rows(),
    "sym_diff": oracles.sym_diff(),
    "ingest_folder": oracles.st1_records(),
    "utf8_gate": oracles.utf8_gate(),
    "download_plan": oracles.download_plan(),
    "fetch_reports": oracles.fetch_reports(),
    "archive_members": oracles.archive_members(),
    "archive_expand": oracles.archive_expand(),
    "report_routing": oracles.report_routing(),
    "incremental_stream": oracles.st1_stored(),
    "utf8_lossy": oracles.utf8_lossy(),
    "stream_ledger": oracles.stream_ledger(),
    "load_single_path": oracles.st1_stored(),
    "reload_same_report": oracles.st1_stored(),
    "rows_loaded": oracles.rows_loaded(),
    "csv_glob_view": oracles.csv_glob_view(),
    "reconcile_fingerprint": oracles.reconcile_fingerprint(),
    "archive_records": oracles.archive_records(),
    "date_range_saved": oracles.date_range_saved(),
    "custom_islands": oracles.custom_islands(),
    "crash_replay": oracles.crash_replay(),
    "append_from_frame": oracles.st1_stored(),
    "pruned_range": oracles.pruned_range(),
    "stream_stateful": oracles.st1_stored(),
    "reconcile_st1": oracles.reconcile(oracles.st1_stored(), "licensee"),
    "reconcile_st49": oracles.reconcile(oracles.st49_stored(), "activity_type"),
    "folder_status": oracles.folder_status(),
    "folder_prefix": oracles.st1_records(),
    "ingest_file": oracles.ingest_file(),
    "date_range_ingest": oracles.date_range_filter(),
}
