"""Report tables: create/open, incremental append through the ledger,
quarantine, compaction and superseded files.

A table is a folder of data files in ``fmt`` (``parquet`` by default; ``delta``
passes through to the Delta source where its jar is installed). Every stored
column is a nullable string, in the order of the report spec. Data lies in
partitions ``report_month=<first day>/load=<batch>``: the typed month prunes scans
(and files sorted by date skip row groups), and the batch makes a repeated append
replace what it wrote before, by dynamic partition overwrite, without a look into
the table. A hidden column holds a hash of the report a row came from.
:func:`read_table` gives the spec's columns.

The driver holds no list of reports or files: candidates are a staged frame.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_name
from ..session import drop_path, path_exists, qualified, stage
from ..sources.csv import file_status, report_unit, scan_candidates
from ..sources.files import list_files
from ..sources.ledger import LEDGER_SCHEMA, append_ledger, open_batches, read_ledger
from ..spec import get_spec
from .parse import STATUS_FILE_FORMAT

# Fixed value: target size of a written table file (1 GiB).
TARGET_FILE_BYTES = 1 << 30
# Retention of superseded files: 7 days.
DEFAULT_RETENTION_HOURS = 168
#: Partition columns of a table's folder.
PARTITIONS = ("report_month", "load")
#: Stored beside the spec's columns: the report (CSV file or directory) of a row.
ORIGIN = "origin"
STATUS_MISSING = "missing"


def default_ledger_path(table_path: str) -> str:
    """The ledger sits beside the table (``<table>_load_log``), never inside it."""
    return table_path.rstrip("/") + "_load_log"


def _stored_schema(spec) -> T.StructType:
    return T.StructType([*spec.schema.fields, T.StructField(ORIGIN, T.LongType(), True)])


def create_or_open_table(spark: SparkSession, path: str, report_type, fmt: str = "parquet",
                         overwrite: bool = False) -> DataFrame:
    """Create the table with the spec's schema if absent, else open it; an existing
    table whose schema differs from the spec is an error."""
    spec = get_spec(report_type)
    if overwrite and path_exists(spark, fingerprint_path(path)):
        drop_path(spark, fingerprint_path(path))
    # an empty file in the folder itself holds the schema until partitions exist
    spark.createDataFrame([], _stored_schema(spec)).write.format(fmt).mode("overwrite" if overwrite else "ignore").save(path)
    df = spark.read.format(fmt).load(path)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in (*PARTITIONS, ORIGIN)]
    want = [(f.name, f.dataType.simpleString()) for f in spec.schema.fields]
    if got != want:
        raise ValueError(f"table at {path} has schema {got}, expected {want} for report type {spec.name}")
    return df


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def read_table(spark: SparkSession, path: str, report_type, fmt: str = "parquet", start=None, end=None,
               days: Optional[DataFrame] = None) -> DataFrame:
    """The spec's columns of a table; of a range of report days (inclusive), or of
    those in the column ``day`` of ``days``: other months' folders are not read."""
    df = create_or_open_table(spark, path, report_type, fmt)
    kept = "report_month" in df.columns
    for bound, low in ((start, True), (end, False)):
        if bound is not None:
            day, text = F.to_date(F.lit(str(bound))), F.date_format(F.to_date(F.lit(str(bound))), "yyyy-MM-dd")
            df = df.where(F.col("date") >= text if low else F.col("date") <= text)
            if kept:
                df = df.where(F.col("report_month") >= month_of(day) if low else F.col("report_month") <= day)
    if days is not None:
        day = F.to_date(F.col("day"))
        wanted = days.select(F.date_format(day, "yyyy-MM-dd").alias("date"), *([month_of(day).alias("report_month")] if kept else [])).distinct()
        df = df.join(wanted, wanted.columns, "left_semi")
    return df.select(*get_spec(report_type).columns)


def fingerprint(df: DataFrame, by, columns) -> DataFrame:
    """One row a group: ``n`` and two sums of 64-bit row hashes over ``columns``.

    Equal multisets of rows have equal fingerprints in any order, and fingerprints of
    disjoint parts add up. Different ones agree with a chance of about 2^-128; the
    rows themselves are never shuffled, only one partial sum a task and group."""
    h = [F.xxhash64(F.lit(seed), *[F.coalesce(F.col(c), F.lit("\x00null")) for c in columns]).cast("decimal(20,0)") for seed in (1, 2)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(h[0]).alias("h1"), F.sum(h[1]).alias("h2"))


def fingerprint_path(table_path: str) -> str:
    return table_path.rstrip("/") + "_fingerprints"


PRINT_SCHEMA = "date string, n bigint, h1 decimal(30,0), h2 decimal(30,0), load string"


def keep_fingerprints(spark: SparkSession, table_path: str, report_type, loads: DataFrame, fmt: str = "parquet") -> None:
    """Fingerprint the given batches (``load``) by day, from what lies in the table, and
    keep the result beside it; a batch that is written again replaces its own."""
    stored = spark.read.format(fmt).load(table_path)
    if "load" not in stored.columns:
        return
    rows = stored.join(loads.select("load").distinct(), "load", "left_semi")
    prints = fingerprint(rows, ["load", "date"], get_spec(report_type).columns)
    prints.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(fingerprint_path(table_path))


def table_fingerprints(spark: SparkSession, table_path: str, report_type, fmt: str = "parquet") -> DataFrame:
    """``date, n, h1, h2`` by batch: kept ones, and those of batches that have none, computed now."""
    stored = spark.read.format(fmt).load(table_path)
    spec = get_spec(report_type)
    if "load" not in stored.columns:
        return fingerprint(stored, ["date"], spec.columns)
    at = fingerprint_path(table_path)
    kept = spark.read.schema(PRINT_SCHEMA).parquet(at) if path_exists(spark, at) else spark.createDataFrame([], PRINT_SCHEMA)
    known = kept.select("load").distinct()
    live = stage(stored.select("load").distinct(), "live_loads")
    kept = kept.join(live, "load", "left_semi")
    rest = stored.join(live.join(known, "load", "left_anti"), "load", "left_semi")
    return kept.drop("load").unionByName(fingerprint(rest, ["date"], spec.columns))


def write_rows(rows: DataFrame, table_path: str, report_type, batch: Column, unit: Column, fmt: str = "parquet",
               n_tasks: Optional[int] = None, spread: Optional[Column] = None, more: Optional[DataFrame] = None) -> None:
    """Write rows to the partitions of their month and batch, replacing these
    partitions and no others. ``spread`` splits a large report over several tasks;
    ``more`` are stored rows (with partition columns) to write along."""
    spec = get_spec(report_type)
    month = month_of(F.expr("try_cast(date as date)"))
    out = rows.select(*spec.columns, F.xxhash64(unit).alias(ORIGIN), month.alias("report_month"), batch.alias("load"), (F.lit(0) if spread is None else spread).cast("long").alias("_s"))
    if more is not None:
        out = out.unionByName(more.select(*out.columns[:-1], F.lit(0).cast("long").alias("_s")))
    n = n_tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(n, *PARTITIONS, "_s").sortWithinPartitions(*PARTITIONS, "date").drop("_s")
    out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).save(table_path)


def load_candidates(spark: SparkSession, report_type, ledger_path: str, csv_folder: Optional[str] = None,
                    csv_paths=None, listing: Optional[DataFrame] = None, retry_skipped: bool = False) -> DataFrame:
    """CSV files to load, as ``path, length, written, unit, kind``.

    Files found by folder (or in ``listing``) must end with ``.csv`` and carry the
    spec's prefix in their name, or in their ``report=`` directory where they lie
    in one. Paths given explicitly are taken as they are. Neither is a candidate
    if the ledger knows its unit; a file offered twice is a candidate once. ``kind``
    is ``layout`` for files of the folder's own ``report=`` directories, ``plain`` for
    its other files and ``named`` for files given otherwise.
    """
    spec = get_spec(report_type)
    report = F.regexp_extract("path", r"/report=([^/]+)/[^/]*$", 1)
    name = F.when(report != "", report).otherwise(file_name("path"))
    fits, written = name.contains(spec.prefix) & F.col("path").endswith(".csv"), F.col("modificationTime").alias("written")
    parts = []
    if csv_folder:
        own = F.col("path").startswith(qualified(spark, csv_folder) + "/report=") & F.regexp_replace("path", r"/report=[^/]+/[^/]*$", "").eqNullSafe(F.lit(qualified(spark, csv_folder)))
        kind = F.when(own, F.lit("layout")).otherwise(F.lit("plain")).alias("kind")
        parts.append(list_files(spark, csv_folder, glob="*.csv", recursive=True).where(fits).select("path", "length", written, kind))
    if listing is not None:
        parts.append(listing.where(fits).select("path", "length", F.lit(None).cast("timestamp").alias("written"), F.lit("named").alias("kind")))
    if csv_paths:
        parts.append(list_files(spark, csv_paths).select("path", "length", written, F.lit("named").alias("kind")))
    if not parts:
        raise ValueError("give csv_folder, csv_paths or listing")
    cands = reduce(DataFrame.unionByName, parts)
    done = read_ledger(spark, ledger_path, include_skipped=not retry_skipped)
    cands = cands.groupBy("path").agg(F.max("length").alias("length"), F.max("written").alias("written"), F.min("kind").alias("kind"))
    return cands.withColumn("unit", report_unit("path")).join(done, F.col("unit") == F.col("csv_file"), "left_anti")


@dataclass
class AppendResult:
    rows: int
    files: DataFrame  # csv_file, unit, batch, rows, bad_rows, status
    candidates: int = 0


def append_candidates(spark: SparkSession, table_path: str, cands: DataFrame, report_type, csv_folder: Optional[str] = None,
                      named=(), fmt: str = "parquet", target_file_bytes: int = TARGET_FILE_BYTES, kept: Optional[DataFrame] = None) -> AppendResult:
    """Append the files of a candidate frame (see :func:`load_candidates`, plus
    ``batch``) to the table as one write; a repeat with the same batches replaces
    the first. ``kept`` are stored rows of these batches whose files have gone.

    The CSV is parsed once, into a staged table. A report with a malformed row is
    skipped whole. A large report is written by several tasks, about
    ``target_file_bytes`` of input each. Of the candidates the driver sees one row
    of counts; files that have gone since the listing get the status ``missing``.
    """
    spec = get_spec(report_type)
    report = F.regexp_extract("path", r"/report=([^/]+)/[^/]*$", 1)
    size = F.ceil(F.sum("length").over(W.partitionBy("unit", "batch")) / target_file_bytes)
    cands = cands.select(F.col("path").alias("csv_file"), "unit", "batch", "kind", "written", "length", F.greatest(size, F.lit(1)).cast("long").alias("slices"), report.alias("report"))
    cands = stage(cands, "candidates")
    plain = F.col("kind") == "plain"
    n = cands.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "layout").alias("layout"), F.count_if(plain).alias("plain"),
        F.min(F.when(plain, F.col("written"))).alias("since"), F.max(F.when(plain, F.col("written"))).alias("until"), F.sum("length").alias("bytes"),
    ).first()
    if not n["n"]:
        return AppendResult(0, file_status(cands.select("csv_file", F.lit(False).alias("malformed")), cands.select("csv_file", "unit", "batch")))
    raw = scan_candidates(spark, cands, spec, csv_folder, n["layout"], n["plain"], n["since"], n["until"], list(named))
    raw = stage(raw.withColumn("at", F.monotonically_increasing_id()), "csv_rows")
    files = stage(file_status(raw, cands.select("csv_file", "unit", "batch")), "csv_files")
    files = _gone(spark, files, csv_folder, list(named))
    bad = files.where("bad_rows > 0").select("unit", "batch").distinct()
    rows = raw.join(bad, ["unit", "batch"], "left_anti")
    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n["bytes"] or 0) // target_file_bytes))
    write_rows(rows, table_path, spec, F.col("batch"), F.col("unit"), fmt, n_tasks, F.col("at") % F.col("slices"), kept)
    keep_fingerprints(spark, table_path, spec, cands.select(F.col("batch").alias("load")), fmt)
    written = files.join(bad, ["unit", "batch"], "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return AppendResult(int(written), files, int(n["n"]))


def _gone(spark: SparkSession, files: DataFrame, csv_folder: Optional[str], named: list) -> DataFrame:
    """``files`` with the status ``missing`` for those without rows that are not there any more."""
    empty = files.where("rows = 0")
    if empty.isEmpty():
        return files
    there = [list_files(spark, csv_folder, glob="*.csv", recursive=True).select("path")] if csv_folder else []
    left = [p for p in named if path_exists(spark, p)]
    there += [list_files(spark, left).select("path")] if left else []
    if not there:
        return files.withColumn("status", F.when(F.col("rows") == 0, F.lit(STATUS_MISSING)).otherwise(F.col("status")))
    there = reduce(DataFrame.unionByName, there).select(F.col("path").alias("csv_file"), F.lit(True).alias("there")).distinct()
    lost = (F.col("rows") == 0) & F.col("there").isNull()
    return files.join(there, "csv_file", "left").withColumn("status", F.when(lost, F.lit(STATUS_MISSING)).otherwise(F.col("status"))).drop("there")


def append_batch(spark: SparkSession, table_path: str, csv_paths, report_type, fmt: str = "parquet",
                 target_file_bytes: int = TARGET_FILE_BYTES, batch: Optional[str] = None) -> AppendResult:
    """Append the CSV files at the given paths (files or report directories) to the
    table as one write. With ``batch``, a repeat of that batch replaces it. Paths
    that do not exist are left out."""
    paths = [csv_paths] if isinstance(csv_paths, str) else list(csv_paths)
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        raise ValueError("none of the given paths exists")
    found = list_files(spark, paths, recursive=True).select("path", "length", F.col("modificationTime").alias("written"))
    cands = found.select("*", report_unit("path").alias("unit"), F.lit("named").alias("kind"), F.lit(batch or uuid.uuid4().hex).alias("batch"))
    return append_candidates(spark, table_path, cands, report_type, None, paths, fmt, target_file_bytes)


@dataclass
class LoadResult:
    rows: int
    candidates: int
    files: Optional[DataFrame]


def unit_status(files: DataFrame) -> DataFrame:
    """One ledger entry per report and batch: ``skipped`` if one of its files was
    malformed, ``missing`` if all of them had gone."""
    bad, there = F.max(F.col("status") == "malformed"), F.max(F.col("status") != STATUS_MISSING)
    status = F.when(bad, F.lit("skipped")).when(there, F.lit("loaded")).otherwise(F.lit(STATUS_MISSING))
    return files.groupBy(F.col("unit").alias("csv_file"), "batch").agg(status.alias("status"))


def announce(cands: DataFrame, ledger_path: str) -> None:
    """Write the reports of a batch to the ledger before anything is appended."""
    append_ledger(cands.select(F.col("unit").alias("csv_file"), "batch").distinct(), ledger_path, "pending")


def _vanished(spark: SparkSession, table_path: str, open_: DataFrame, cands: DataFrame, fmt: str):
    """Announced reports that no listing offers now: ``(paths that still exist,
    statuses of the others, stored rows of the others)``. Of the others those with
    rows in the table are ``loaded``, the rest ``missing``; all staged, as the
    append replaces files of the table."""
    left = open_.join(cands.select(F.col("unit").alias("csv_file")).distinct(), "csv_file", "left_anti")
    left = [(r["csv_file"], r["batch"]) for r in left.collect()]  # reports of a stopped batch that were named one by one, or have gone
    here = [(p, b) for p, b in left if path_exists(spark, p)]
    if len(here) == len(left):
        return here, None, None
    gone = spark.createDataFrame([x for x in left if x not in here], "csv_file string, batch string").withColumn(ORIGIN, F.xxhash64("csv_file"))
    stored = spark.read.format(fmt).load(table_path)
    if "load" not in stored.columns:
        return here, stage(gone.select("csv_file", "batch", F.lit(STATUS_MISSING).alias("status")), "gone"), None
    rows = stage(stored.join(gone.select(F.col("batch").alias("load"), ORIGIN), ["load", ORIGIN]), "kept")
    there = rows.select(F.col("load").alias("batch"), ORIGIN, F.lit(True).alias("there")).distinct()
    status = F.when(F.col("there"), F.lit("loaded")).otherwise(F.lit(STATUS_MISSING)).alias("status")
    return here, stage(gone.join(there, ["batch", ORIGIN], "left").select("csv_file", "batch", status), "gone"), rows


def load_table(spark: SparkSession, table_path: str, report_type, csv_folder: Optional[str] = None,
               csv_paths=None, ledger_path: Optional[str] = None, recreate: bool = False, fmt: str = "parquet",
               target_file_bytes: int = TARGET_FILE_BYTES, retry_skipped: bool = False,
               quarantine_path: Optional[str] = None) -> LoadResult:
    """Incremental load: candidates not in the ledger -> one append -> ledger entries.

    ``recreate`` replaces the table and the ledger first. Files skipped as
    malformed are logged with status ``skipped``, go to ``quarantine_path`` if
    given, and are offered again only with ``retry_skipped``. The batch is
    announced in the ledger before the append. After a crash at any point the next
    load offers the announced reports again under their old batch, and what the
    stopped load had written is replaced: no row is lost or loaded twice. Announced
    files that have gone stop nothing; they are ``missing``.
    """
    spec = get_spec(report_type)
    ledger_path = ledger_path or default_ledger_path(table_path)
    named = [csv_paths] if isinstance(csv_paths, str) else list(csv_paths or [])
    if recreate:
        spark.createDataFrame([], LEDGER_SCHEMA).write.mode("overwrite").json(ledger_path)
    create_or_open_table(spark, table_path, spec, fmt, overwrite=recreate)
    cands = load_candidates(spark, spec, ledger_path, csv_folder, csv_paths, retry_skipped=retry_skipped)
    open_ = open_batches(spark, ledger_path)
    batch = uuid.uuid4().hex
    cands = cands.join(open_.select(F.col("csv_file").alias("unit"), F.col("batch").alias("old")), "unit", "left")
    cands = stage(cands.select("*", F.coalesce("old", F.lit(batch)).alias("batch")).drop("old"), "load")
    here, gone, kept = _vanished(spark, table_path, open_, cands, fmt)
    if here:
        more = list_files(spark, [p for p, _ in here], recursive=True).select("path", "length", F.col("modificationTime").alias("written"), report_unit("path").alias("unit"), F.lit("named").alias("kind"))
        cands = cands.unionByName(more.join(spark.createDataFrame(here, "unit string, batch string"), "unit"))
        named += [p for p, _ in here]
    new = cands.where(F.col("batch") == batch)
    if not new.isEmpty():
        announce(new, ledger_path)
    res = append_candidates(spark, table_path, cands, spec, csv_folder, named, fmt, target_file_bytes, kept)
    files, entries = res.files, unit_status(res.files)
    if gone is not None:
        files = files.unionByName(gone.withColumn("unit", F.col("csv_file")), allowMissingColumns=True)
        entries = entries.unionByName(gone)
    if quarantine_path:
        quarantine(_file_errors(files, spec), quarantine_path)
    append_ledger(entries, ledger_path)
    return LoadResult(rows=res.rows, candidates=res.candidates, files=files if res.candidates else None)


def _file_errors(files: DataFrame, spec) -> DataFrame:
    """Files of a load as rows for the quarantine."""
    error = F.when(F.col("status") == STATUS_MISSING, F.lit("announced, but gone")).otherwise(F.concat(F.lit("rows with a wrong number of fields: "), F.col("bad_rows").cast("string")))
    status = F.when(F.col("status") == "malformed", F.lit(STATUS_FILE_FORMAT)).when(F.col("status") == STATUS_MISSING, F.col("status")).otherwise(F.lit("ok"))
    return files.select(
        F.col("csv_file").alias("path"), F.lit(spec.name).alias("report_type"), F.lit(None).cast("date").alias("report_date"),
        status.alias("status"), error.alias("error"), F.lit(True).alias("recoverable"), "batch",
    )


QUARANTINE_SCHEMA = "path string, report_type string, report_date date, status string, error string, recoverable boolean, quarantined_at timestamp, batch string"


def quarantine(status: DataFrame, quarantine_path: str) -> DataFrame:
    """Put the non-``ok`` file statuses into the quarantine table; source files are
    never moved. Rows that carry a ``batch`` replace those of that batch, so a
    replayed batch is there once. Returns the quarantine table."""
    batch = F.coalesce("batch", F.lit("none")) if "batch" in status.columns else F.lit(uuid.uuid4().hex)
    bad = status.where(F.col("status") != "ok").select(
        "path", "report_type", "report_date", "status", "error", "recoverable",
        F.current_timestamp().alias("quarantined_at"), batch.alias("batch"),
    )
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(quarantine_path)
    return read_quarantine(status.sparkSession, quarantine_path)


def read_quarantine(spark: SparkSession, quarantine_path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(quarantine_path)


@dataclass
class CompactResult:
    files_before: int
    files_after: int
    bytes_before: int


def compact(spark: SparkSession, table_path: str, target_path: str, fmt: str = "parquet",
            target_file_bytes: int = TARGET_FILE_BYTES) -> CompactResult:
    """Rewrite a table at ``target_path``, each month into files of about ``target_file_bytes``.

    The old folder stays as it is until its readers have moved on;
    :func:`stale_files` lists what of it may go. A plain Spark rewrite, for plain
    file formats only: formats with a transaction log compact themselves.
    """
    if fmt not in ("parquet", "orc", "json", "csv"):
        raise ValueError(f"{fmt} keeps a log of its files; use its own compaction")
    stats = list_files(spark, table_path, recursive=True).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    df = spark.read.format(fmt).load(table_path)
    if "load" in df.columns:
        own = [c for c in df.columns if c not in PARTITIONS]
        spark.createDataFrame([], df.select(*own).schema).write.format(fmt).mode("ignore").save(target_path)
        # a month in as many files as its share of the bytes asks for
        per_file = max(1, df.count() * target_file_bytes // max(1, int(stats["bytes"])))
        months = df.groupBy(F.col("report_month").alias("_m")).agg(F.ceil(F.count(F.lit(1)) / per_file).alias("_n"))
        rows = df.withColumn("_at", F.monotonically_increasing_id()).join(months, F.col("report_month").eqNullSafe(F.col("_m")))
        n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(int(stats["bytes"]) / target_file_bytes))
        rows = rows.withColumn("_s", F.col("_at") % F.col("_n")).repartition(n_tasks, "report_month", "_s").sortWithinPartitions("report_month", "date")
        rows.select(*own, "report_month", F.lit("compact").alias("load")).write.format(fmt).mode("append").partitionBy(*PARTITIONS).save(target_path)
    else:
        n_target = max(1, math.ceil(int(stats["bytes"]) / target_file_bytes))
        df.repartition(n_target).write.format(fmt).save(target_path)
    return CompactResult(int(stats["n"]), list_files(spark, target_path, recursive=True).count(), int(stats["bytes"]))


def stale_files(spark: SparkSession, replaced_path: str, retention_hours: float = DEFAULT_RETENTION_HOURS,
                live_tables=()) -> DataFrame:
    """Files below a folder that no live table holds and that were last written
    before the retention window: ``path, length, modificationTime``.

    ``replaced_path`` may be a replaced table or a folder of several versions;
    files of the tables in ``live_tables`` are never offered, however old. The
    listings are joined by path; nothing of them is collected."""
    cutoff = F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(retention_hours) * 3600))
    found = list_files(spark, replaced_path, recursive=True).where(F.col("modificationTime") <= cutoff)
    live = [p for p in ([live_tables] if isinstance(live_tables, str) else live_tables) if path_exists(spark, p)]
    if live:
        found = found.join(list_files(spark, live, recursive=True).select("path"), "path", "left_anti")
    return found.select("path", "length", "modificationTime")
