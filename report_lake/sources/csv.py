"""Pipe-delimited report CSV: the sink of parsed records and the load-side scan.

Layout of a CSV folder: one directory per report, ``report=<yyyymmdd>_<PREFIX>``,
holding ``part-*.csv`` files with a header line. Re-parsing a day replaces that
day's directory only (dynamic partition overwrite); a day with no records writes
nothing. The directory is the report's identity: part names change with every
write, so the load side keys on the directory (:func:`report_unit`).
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_col, plain_path
from ..session import stage
from ..spec import ReportSpec, get_spec
from .files import list_files

CORRUPT = "_corrupt_record"

# CSV dialect of the report files (pipe, header, RFC 4180 quoting).
CSV_WRITE_OPTIONS = {
    "sep": "|",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ_OPTIONS = {
    "sep": "|",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "enforceSchema": "true",
}

# Records per CSV file at most; a day with more records is written by several
# tasks into several part files of the same report directory.
RECORDS_PER_FILE = 1_000_000


def report_key(spec: ReportSpec, date_col="date"):
    """``yyyymmdd_PREFIX`` from the ISO date of a record."""
    return F.concat(F.regexp_replace(F.col(date_col), "-", ""), F.lit("_" + spec.prefix))


def report_unit(path):
    """What the ledger knows a CSV file by: its ``report=`` directory, or itself."""
    return F.regexp_replace(as_col(path), r"(/report=[^/]+)/[^/]*$", "$1")


def write_report_csv(records: DataFrame, out_dir: str, report_type, records_per_file: int = RECORDS_PER_FILE,
                     ordered: bool = False) -> None:
    """Write parsed records as pipe CSV, one directory per report day.

    Rows of a day are spread by ``record_no // records_per_file`` so that a day
    with very many records is written in parallel, and sorted by ``record_no``
    inside each file so that files keep report order. Records without a number
    have no order; Spark rebalances them by day and size. ``ordered`` also brings the
    files of a day into report order by name: the rows are partitioned by range of
    day and part instead of by hash (see :func:`read_report_order`).
    """
    spec = get_spec(report_type)
    out = records.withColumn("report", report_key(spec))
    if "record_no" in records.columns:
        part = F.floor(F.col("record_no") / records_per_file)
        out = out.repartitionByRange("report", part.alias("_part")) if ordered else out.repartition("report", part)
        out = out.sortWithinPartitions("report", "record_no")
    else:
        out = out.hint("rebalance", "report")
    (
        out.select(*spec.columns, "report")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**CSV_WRITE_OPTIONS)
        .partitionBy("report")
        .csv(out_dir)
    )


def _reader(spark: SparkSession, spec: ReportSpec, *more):
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType(), True), *more])
    return spark.read.schema(schema).options(**CSV_READ_OPTIONS)


def _checked(raw: DataFrame, spec: ReportSpec, *more) -> DataFrame:
    return raw.select(*spec.columns, F.col(CORRUPT).isNotNull().alias("malformed"), plain_path(F.col("_metadata.file_path")).alias("csv_file"), *more)


def report_partitions(spark: SparkSession, folder: str, report_type) -> DataFrame:
    """The rows of a folder of ``report=`` directories, as written (malformed ones
    marked), with the directory as a discovered partition column: ``report`` and
    the typed ``report_day``. Filters on either, and joins with a filtered relation
    of reports or days, choose directories before anything is read."""
    spec = get_spec(report_type)
    reader = _reader(spark, spec, T.StructField("report", T.StringType(), True)).option("basePath", folder)
    raw = reader.option("pathGlobFilter", "*.csv").option("ignoreMissingFiles", "true").csv(folder)
    return _checked(raw, spec, "report", F.expr("try_to_date(substr(report, 1, 8), 'yyyyMMdd')").alias("report_day"))


def read_report_days(spark: SparkSession, folder: str, report_type, days: Optional[DataFrame] = None, start=None, end=None) -> DataFrame:
    """Well-formed rows of the reports of some days, with ``report_day``: a range
    (inclusive), or those in the column ``day`` of ``days``. Only the directories
    of these days are read. A report with a malformed row is left out whole."""
    spec = get_spec(report_type)
    rows = report_partitions(spark, folder, spec)
    if start is not None:
        rows = rows.where(F.col("report_day") >= F.to_date(F.lit(str(start))))
    if end is not None:
        rows = rows.where(F.col("report_day") <= F.to_date(F.lit(str(end))))
    if days is not None:
        rows = rows.join(days.select(F.col("day").alias("report_day")).distinct(), "report_day", "left_semi")
    rows = stage(rows, "csv_days")
    bad = rows.where("malformed").select("report").distinct()
    return rows.join(bad, "report", "left_anti").select(*spec.columns, "report_day")


def read_report_order(spark: SparkSession, folder: str, report_type) -> DataFrame:
    """The rows of a folder of ``report=`` directories with their ``report`` and
    ``place`` in it (from 1), as its files hold them: by the number of the part, then by row.

    A row's place is the number of rows in the report's earlier blocks (files, or
    splits of a large file) plus its rank in its own block, which the scan gives; the
    window runs over one row a block, and no row is sorted or shuffled by report.
    Malformed rows keep their place and have null fields where Spark found none.
    """
    spec = get_spec(report_type)
    reader = _reader(spark, spec, T.StructField("report", T.StringType(), True)).option("basePath", folder)
    raw = reader.option("pathGlobFilter", "*.csv").csv(folder)
    block = ["report", "_file", "_start"]
    rows = raw.select(*spec.columns, "report", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    rows = stage(rows, "csv_order")
    blocks = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    task = F.regexp_extract("_file", r"^part-(\d+)", 1).try_cast("long")  # as a number: names have five digits or more
    before = W.partitionBy("report").orderBy(task, "_file", "_start").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    place = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return rows.join(blocks, block).select(*spec.columns, "report", place.alias("place"))


def scan_report_csv(spark: SparkSession, paths, report_type, recursive: bool = True, listing: Optional[DataFrame] = None):
    """Read report CSVs with the table's schema, binding columns by position.

    The files are parsed once, into a staged table that keeps each row's file and
    whether it was malformed (a wrong number of fields); the per-file check and
    the rows both read that table. A file with any malformed row is dropped
    whole and reported; other files are kept. Returns ``(rows, files)`` where
    ``rows`` carries ``csv_file`` and ``files`` is ``csv_file, rows, bad_rows,
    status``, with one row for every listed file (a file with a header alone has
    0 rows and is ``ok``).
    """
    spec = get_spec(report_type)
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = _reader(spark, spec)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    raw = stage(_checked(reader.csv(paths), spec), "csv_rows")
    if listing is None:
        listing = list_files(spark, paths, glob="*.csv" if recursive else None, recursive=recursive)
    files = file_status(raw, listing.select(F.col("path").alias("csv_file")).distinct())
    bad = raw.where("malformed").select("csv_file").distinct()
    rows = raw.join(bad, "csv_file", "left_anti").drop("malformed")
    return rows, files


def file_status(raw: DataFrame, files: DataFrame) -> DataFrame:
    """``files`` (``csv_file``, ...) with ``rows, bad_rows, status`` as found among the rows read."""
    per_file = raw.groupBy("csv_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if("malformed").alias("bad_rows"))
    return files.join(per_file, "csv_file", "left").select(
        *files.columns,
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"),
        F.when(F.col("bad_rows") > 0, F.lit("malformed")).otherwise(F.lit("ok")).alias("status"),
    )


def scan_candidates(spark: SparkSession, cands: DataFrame, report_type, folder: Optional[str], in_layout: int, plain: int, since, until, named: list) -> DataFrame:
    """Rows of the candidate files (``csv_file, unit, batch, slices, report, kind``,
    one row a file), as written, with the candidate's ``unit``, ``batch`` and ``slices``.

    Reports of ``folder`` are read as partitions joined with the candidates, so
    only their directories are opened; plain files of the folder by the time
    range in which the candidates were written, then by path; ``named`` files as
    given. Which kinds there are (``in_layout``, ``plain``) the caller has counted."""
    spec = get_spec(report_type)
    carried, parts = ["unit", "batch", "slices"], []
    if in_layout:
        # the glob keeps plain files beside the directories out of partition discovery
        base = f"{folder.rstrip('/')}/report=*" if plain else folder
        reader = _reader(spark, spec, T.StructField("report", T.StringType(), True)).option("basePath", folder)
        raw = _checked(reader.option("pathGlobFilter", "*.csv").option("ignoreMissingFiles", "true").csv(base), spec, "report")
        reports = cands.where("kind = 'layout'").select("report", *carried).distinct()
        parts.append(raw.join(reports, "report").drop("report"))
    files = cands.select("csv_file", "kind", *carried)
    if plain:
        reader = _reader(spark, spec).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").option("ignoreMissingFiles", "true")
        written = F.col("_metadata.file_modification_time")
        raw = _checked(reader.csv(folder).where((written >= F.lit(since)) & (written <= F.lit(until))), spec)
        parts.append(raw.join(files.where("kind = 'plain'").drop("kind"), "csv_file"))
    if named:
        parts.append(_checked(_reader(spark, spec).option("ignoreMissingFiles", "true").csv(named), spec).join(files.where("kind = 'named'").drop("kind"), "csv_file"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_report_csv(spark: SparkSession, paths, report_type, recursive: bool = True) -> DataFrame:
    """Rows of the well-formed report CSVs (empty fields read back as NULL)."""
    rows, _ = scan_report_csv(spark, paths, report_type, recursive)
    return rows.select(*get_spec(report_type).columns)


def csv_glob_view(spark: SparkSession, pattern: str, report_type, view: str) -> DataFrame:
    """Ad-hoc scan by glob, registered as a temp view (``SELECT ... FROM view``)."""
    df = read_report_csv(spark, pattern, report_type, recursive=False)
    df.createOrReplaceTempView(view)
    return df
