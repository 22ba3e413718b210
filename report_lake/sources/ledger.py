"""The load ledger: which CSV files are already in the table.

A folder of JSON-lines files, one object per report:
``{"csv_file": ..., "timestamp": <RFC 3339 UTC>, "status": ..., "batch": ...}``.
``csv_file`` is the report's directory, or the file where there is none, in the
form listings give. ``status`` is ``pending`` (written before the append),
``loaded``, ``skipped`` (malformed) or ``missing`` (announced, then gone); entries
without a status count as loaded. ``batch`` names the load that wrote the entry.
The ledger lives beside the table, never inside it, so table upkeep never
removes it.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

LEDGER_SCHEMA = T.StructType([
    T.StructField("csv_file", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("batch", T.StringType(), True),
])

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_ledger_entries(spark: SparkSession, ledger_path: str) -> DataFrame:
    """All well-formed ledger entries; a missing ledger is empty, malformed lines
    and lines lacking a field are ignored."""
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    df = spark.read.schema(LEDGER_SCHEMA).option("mode", "DROPMALFORMED").json(ledger_path)
    return df.where(F.col("csv_file").isNotNull() & F.col("timestamp").isNotNull())


def read_ledger(spark: SparkSession, ledger_path: str, include_skipped: bool = True) -> DataFrame:
    """Distinct ``csv_file`` values of the ledger (the 'already processed' set)."""
    known = ("loaded", "skipped") if include_skipped else ("loaded",)
    e = read_ledger_entries(spark, ledger_path)
    return e.where(F.coalesce(F.col("status"), F.lit("loaded")).isin(*known)).select("csv_file").distinct()


def settled(spark: SparkSession, ledger_path: str, batch: str) -> DataFrame:
    """``csv_file`` of the reports that a batch has come to an end with, well or not."""
    e = read_ledger_entries(spark, ledger_path)
    return e.where((F.col("batch") == batch) & (F.col("status") != "pending")).select("csv_file").distinct()


def open_batches(spark: SparkSession, ledger_path: str) -> DataFrame:
    """``csv_file, batch`` of reports that were announced and never settled. A load
    that takes one up again uses its old batch, so what it wrote before is replaced."""
    e = read_ledger_entries(spark, ledger_path).where(F.col("status").isNotNull()).withColumn("batch", F.coalesce("batch", F.lit("none")))
    settled = e.where("status <> 'pending'").select("csv_file", "batch").distinct()
    left = e.where("status = 'pending'").join(settled, ["csv_file", "batch"], "left_anti")
    left = left.join(read_ledger(spark, ledger_path), "csv_file", "left_anti")
    return left.groupBy("csv_file").agg(F.min_by("batch", F.struct("timestamp", "batch")).alias("batch"))


def append_ledger(files: DataFrame, ledger_path: str, status: str = "loaded", overwrite: bool = False, batch: Optional[str] = None) -> None:
    """Append one entry per row of ``files`` (column ``csv_file``, perhaps ``status`` and ``batch``) in one write."""
    entries = files.select(
        "csv_file",
        F.date_format(F.current_timestamp(), RFC3339).alias("timestamp"),
        (F.col("status") if "status" in files.columns else F.lit(status)).alias("status"),
        (F.col("batch") if batch is None and "batch" in files.columns else F.lit(batch)).cast("string").alias("batch"),
    )
    entries.write.mode("overwrite" if overwrite else "append").json(ledger_path)
