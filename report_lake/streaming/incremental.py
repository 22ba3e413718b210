"""Incremental loading as a Structured Streaming query.

``readStream.format('binaryFile')`` discovers report files (their bodies are not
read by the stream). A stateful ``dropDuplicates`` keeps every path that was ever
offered, so a path comes once whatever the listing does. Each micro-batch is a
small frame of paths; its files are read as lines by the batch operators, chosen
by the time range in which they were written and then by path, without a path list
on the driver.

The sink is keyed by the epoch: a batch id (query and epoch) is part of the
partitions that an epoch writes, and of its quarantine rows. A replayed epoch
replaces what its first try wrote and records the same statuses again, so it may
stop at any point. Files that the ledger knows as loaded or skipped are left out;
files that were announced earlier, by a load or an epoch that stopped, keep their
old batch. Files that have gone are ``missing`` in the quarantine; others go on.
"""

from __future__ import annotations

import uuid
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import ingest_listing
from ..operators.parse import STATUS_OK
from ..operators.table import STATUS_MISSING, announce, create_or_open_table, default_ledger_path, keep_fingerprints, quarantine, write_rows
from ..session import stage
from ..sources.files import any_of, list_files
from ..sources.ledger import append_ledger, open_batches, read_ledger, settled
from ..spec import get_spec

#: Records of one report that one task writes.
RECORDS_PER_TASK = 4_000_000
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stored_form(report_type) -> list:
    """Columns as the table keeps them (no CSV hop): empty fields become NULL, as
    they would after the CSV round trip."""
    return [F.when(F.col(c) == "", F.lit(None)).otherwise(F.col(c)).alias(c) for c in get_spec(report_type).columns]


def records_to_table(records: DataFrame, table_path: str, report_type, fmt: str = "parquet", batch: Optional[str] = None,
                     spread: Optional[Column] = None) -> None:
    """Append parsed records straight to the table. With ``batch``, the days of that
    batch that come again are replaced; ``spread`` writes a day by several tasks."""
    batch = batch or uuid.uuid4().hex
    rows = records.select("*", spread.alias("_spread")) if spread is not None else records.withColumn("_spread", F.lit(0))
    write_rows(rows.select("_spread", *stored_form(report_type)), table_path, report_type, F.lit(batch), F.lit(""), fmt, spread=F.col("_spread"))
    keep_fingerprints(records.sparkSession, table_path, report_type, records.sparkSession.range(1).select(F.lit(batch).alias("load")), fmt)


def load_batch(spark: SparkSession, listing: DataFrame, report_type, table_path: str, ledger_path: str,
               quarantine_path: str, batch: str, source_folder: str, glob: Optional[str] = None, fmt: str = "parquet") -> None:
    """Parse and append the report files of one micro-batch (``path, modificationTime,
    length``), whatever became of earlier tries."""
    spec = get_spec(report_type)
    known = read_ledger(spark, ledger_path).union(settled(spark, ledger_path, batch)).toDF("path")
    fresh = listing.join(known, "path", "left_anti")
    old = open_batches(spark, ledger_path).select(F.col("csv_file").alias("path"), F.col("batch").alias("old"))
    fresh = stage(fresh.join(old, "path", "left").select(*listing.columns, F.coalesce("old", F.lit(batch)).alias("batch")), "epoch")
    if fresh.isEmpty():
        return
    announce(fresh.select(F.col("path").alias("unit"), "batch"), ledger_path)
    res = ingest_listing(spark, source_folder, spec, fresh, glob)
    units = fresh.select("path", "batch")
    spread = F.expr(f"record_no div {RECORDS_PER_TASK}").alias("_spread")
    rows = res.records.select("path", spread, *stored_form(spec)).join(units, "path")
    write_rows(rows, table_path, spec, F.col("batch"), F.col("path"), fmt, spread=F.col("_spread"))
    keep_fingerprints(spark, table_path, spec, units.select(F.col("batch").alias("load")), fmt)
    status = res.status.join(units, "path")
    status = stage(_missing(spark, status, source_folder, glob), "epoch_status")
    quarantine(status, quarantine_path)
    ok, lost = F.col("status") == STATUS_OK, F.col("status") == STATUS_MISSING
    entry = F.when(ok, F.lit("loaded")).when(lost, F.col("status")).otherwise(F.lit("skipped"))
    append_ledger(status.select(F.col("path").alias("csv_file"), entry.alias("status"), "batch"), ledger_path)


def _missing(spark: SparkSession, status: DataFrame, folder: str, glob: Optional[str]) -> DataFrame:
    """Files that gave no line are ``missing`` if they are not in the folder any more."""
    there = list_files(spark, folder, glob).select("path", F.lit(True).alias("there"))
    lost = (F.col("status") != STATUS_OK) & (F.col("records") == 0) & F.col("there").isNull()
    out = status.join(there, "path", "left")
    out = out.withColumn("error", F.when(lost, F.lit("offered, but gone")).otherwise(F.col("error")))
    return out.withColumn("status", F.when(lost, F.lit(STATUS_MISSING)).otherwise(F.col("status"))).drop("there")


def incremental_stream(spark: SparkSession, source_folder: str, report_type, table_path: str,
                       checkpoint: str, ledger_path: Optional[str] = None, quarantine_path: Optional[str] = None,
                       glob: Optional[str] = None, fmt: str = "parquet", available_now: bool = True,
                       processing_time: Optional[str] = None, max_files: int = 100_000):
    """Start the stream; with ``available_now`` it processes every file present
    and stops (returns after termination), else it keeps running on a trigger.

    ``max_files`` bounds a micro-batch; failed files go to ``quarantine_path``
    (default: beside the table)."""
    spec = get_spec(report_type)
    ledger_path = ledger_path or default_ledger_path(table_path)
    quarantine_path = quarantine_path or table_path.rstrip("/") + "_quarantine"
    glob = glob or any_of(f"*.{e}" for e in spec.extensions)
    create_or_open_table(spark, table_path, spec, fmt)
    stream = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .load(source_folder)
        .select("path", "modificationTime", "length")
        .dropDuplicates(["path"])
    )

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        load_batch(spark, stage(batch, "epoch_listing"), spec, table_path, ledger_path, quarantine_path, f"{query}-{epoch_id}", source_folder, glob, fmt)

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 minute").start()
