"""On-disk inputs for the registered queries, built by Spark from the driver
tables and written below the session's shared checkpoint folder.

* report files: rendered reports written as ``WELLSmmddyyyy.TXT`` files;
* CSV folders: parsed records through the CSV sink, optionally with damaged
  files (rows with too few fields) for days with day-of-month 5;
* zip archives: one archive per report file, named ``WELLSmmdd_yyyy.zip``;
  day 28: the report is inside a nested zip; day 30: a member without
  extension and a directory entry; day 31: a member with an unsafe path;
* ledger lines from ``documents``: ``de`` malformed, ``es`` without timestamp.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import Parsed, parse_reports
from ..session import drop_path, scratch_path, stage, to_local_or_uri
from ..sources.csv import report_key, write_report_csv
from ..sources.files import write_named_files
from ..spec import ST1
from .render import Reports, load, render_st1, render_st49, st1_reports, st49_reports


def parsed_st1(spark: SparkSession, sf: str) -> Parsed:
    return parse_reports(render_st1(spark, sf), "st1")


def parsed_st49(spark: SparkSession, sf: str) -> Parsed:
    return parse_reports(render_st49(spark, sf), "st49")


def _file_joiner(staging_uri: str, folder_uri: str):
    def run(batches):
        import shutil

        import pyarrow.fs as pafs

        fs, source = pafs.FileSystem.from_uri(staging_uri)
        _, root = pafs.FileSystem.from_uri(folder_uri)
        fs.create_dir(root, recursive=True)
        for pdf in batches:
            for names, parts in zip(pdf["names"], pdf["parts"]):
                parts, targets = [f"{source}/{p}" for p in parts], [f"{root}/{name}" for name in names]
                if len(parts) == 1 and fs.get_file_info(parts[0]).type == pafs.FileType.NotFound:  # moved by an earlier try
                    continue
                for target in targets if len(parts) > 1 else targets[1:]:
                    with fs.open_output_stream(target) as out:
                        for p in parts:
                            with fs.open_input_stream(p) as f:
                                shutil.copyfileobj(f, out, 8 << 20)
                if len(parts) == 1:
                    fs.move(parts[0], targets[0])
            yield pdf[["name"]]

    return run


def write_report_files(lines: DataFrame, folder: str, staging: str, also=None) -> None:
    """Write a line relation ``(path, pos, line)`` as one text file per report,
    named by ``path``, into ``folder``: Spark writes the lines by range of report and
    position, so a large report comes in several parts. A single part is moved to its
    report's name; several are streamed into one file, a few megabytes at a time.
    ``also`` maps a name to another that each report gets a copy under: the file is
    copied, the lines are neither rendered nor shuffled again. The parts are dropped
    once the files stand."""
    _write_ordered(lines.repartitionByRange("path", "pos"), folder, staging, also)


def _write_ordered(lines: DataFrame, folder: str, staging: str, also=None) -> None:
    """:func:`write_report_files` of lines that are partitioned by range of report and position."""
    spark = lines.sparkSession
    (
        lines.sortWithinPartitions("path", "pos")
        .select("line", F.col("path").alias("report"))
        .write.partitionBy("report")
        .text(staging)
    )
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(staging)
    task = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("long")
    part = F.struct(task.alias("task"), F.regexp_extract("path", r"([^/]*/[^/]*)$", 1).alias("file"))
    reports = found.groupBy(F.col("report").alias("name")).agg(F.array_sort(F.collect_list(part))["file"].alias("parts"))
    name = F.col("name")
    reports = reports.withColumn("names", F.array(name, also(name)) if also else F.array(name))
    reports.mapInPandas(_file_joiner(to_local_or_uri(staging), to_local_or_uri(folder)), "name string").count()
    drop_path(spark, staging)


#: Orders whose lines one task sorts and writes (1.2 million lines of ST1).
ORDERS_PER_TASK = 200_000


def write_reports(reports: Reports, folder: str, staging: str, orders: int, also=None, where=None, by=("d", "slot"), renamed=None) -> None:
    """Rendered reports as one text file each. Order rows and header lines are
    partitioned by range of ``by`` (day and slot), and the lines are made after that, so
    what is shuffled is the orders and not their text.

    ``where`` chooses reports by ``path``; ``renamed`` changes path and position of the
    lines, as ``by`` then has to do for the rows. ``orders`` (about how many there are)
    sizes the tasks."""
    spark = reports.orders.sparkSession
    rows = reports.by_slot()
    if where is not None:
        rows = rows.withColumn("path", reports.path(F.col("d"))).where(where).drop("path")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-orders // ORDERS_PER_TASK))
    lines = reports.lines(rows.repartitionByRange(tasks, *by))
    _write_ordered(renamed(lines) if renamed else lines, folder, staging, also)


def write_lines_as_csv(lines: DataFrame, out_dir: str, partition_col: str) -> None:
    """Write pre-joined text lines unquoted as ``.csv`` files (fixtures with bad rows)."""
    (
        lines.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("quote", "")
        .option("header", "true")
        .partitionBy(partition_col)
        .csv(out_dir)
    )


def report_folder(spark: SparkSession, sf: str, which: str = "st1", where=None, also=None) -> str:
    """Rendered reports written as files into a fresh folder; returns the folder.
    ``where`` chooses reports by ``path``."""
    folder = scratch_path(spark, f"reports_{which}")
    add_report_files(spark, sf, folder, which, where, also)
    return folder


def add_report_files(spark: SparkSession, sf: str, folder: str, which: str, where=None, also=None) -> None:
    reports = st1_reports(spark, sf) if which == "st1" else st49_reports(spark, sf)
    write_reports(reports, folder, scratch_path(spark, "render_staging"), load(spark, sf, "orders").count(), also, where)


def csv_folder(spark: SparkSession, sf: str, records: DataFrame = None, damaged: bool = False) -> str:
    records = records if records is not None else parsed_st1(spark, sf).records
    out = scratch_path(spark, "csv")
    if damaged:
        records = stage(records, "records")  # written twice
    write_report_csv(records, out, "st1")
    if damaged:
        short = records.where(F.dayofmonth(F.to_date("date")) == 5)
        text = F.concat_ws("|", *[F.col(c) for c in ST1.columns[:-2]])
        bad = short.select(text.alias("value"), F.concat(report_key(ST1), F.lit("_short")).alias("report"))
        write_lines_as_csv(bad, out, "report")
    return out


def _zip_one(name: str, content: bytes, dom: int, mmdd: str, yyyy: str):
    member = f"WELLS{mmdd}.TXT"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        if dom == 28:
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as zi:
                zi.writestr(member, content)
            z.writestr(f"WELLS{mmdd}.zip", inner.getvalue())
        else:
            z.writestr(member, content)
        if dom == 30:
            z.writestr("README", b"report archive")
            z.writestr(zipfile.ZipInfo("docs/"), b"")
        if dom == 31:
            z.writestr("../evil.TXT", b"outside")
    return f"WELLS{mmdd}_{yyyy}.zip", buf.getvalue()


def _zip_batches(batches):
    for pdf in batches:
        names, blobs = [], []
        for name, content, dom, mmdd, yyyy in zip(pdf["report"], pdf["content"], pdf["dom"], pdf["mmdd"], pdf["yyyy"]):
            n, b = _zip_one(name, bytes(content), int(dom), mmdd, yyyy)
            names.append(n)
            blobs.append(b)
        yield pd.DataFrame({"name": names, "content": blobs})


def zip_folder(spark: SparkSession, sf: str) -> str:
    """One zip per rendered ST1 report (see module rules)."""
    reports = report_folder(spark, sf, "st1")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.TXT").load(reports)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    d = F.to_date(F.regexp_extract(name, r"(\d{8})", 1), "MMddyyyy")
    staged = files.select(
        name.alias("report"), "content", F.dayofmonth(d).alias("dom"),
        F.date_format(d, "MMdd").alias("mmdd"), F.date_format(d, "yyyy").alias("yyyy"),
    )
    zips = staged.mapInPandas(_zip_batches, "name string, content binary")
    out = scratch_path(spark, "zips")
    write_named_files(zips, out).count()
    return out


def ledger_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    csv_file = F.concat(F.lit("/data/csv/"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit("_WELLS.csv"))
    ts = F.lit("2025-01-02T03:04:05+00:00")
    full = F.to_json(F.struct(csv_file.alias("csv_file"), ts.alias("timestamp")))
    line = (
        F.when(F.col("lang") == "de", F.concat(F.lit('{"csv_file": "'), csv_file, F.lit('", "timestamp": ')))
        .when(F.col("lang") == "es", F.to_json(F.struct(csv_file.alias("csv_file"))))
        .otherwise(full)
    )
    return docs.select(line.alias("value"))


def candidate_listing(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    kind = F.when(F.length("source") == 4, F.lit("WELLS")).otherwise(F.lit("SPUD"))
    ext = F.when(F.col("lang") == "de", F.lit(".CSV")).when(F.col("lang") == "es", F.lit(".txt")).otherwise(F.lit(".csv"))
    path = F.concat(F.lit("file:/data/csv/"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit("_"), kind, ext)
    return docs.select(path.alias("path"), F.col("n_chars").cast("long").alias("length"), "lang")
