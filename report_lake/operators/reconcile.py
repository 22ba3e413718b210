"""Reconciliation of source CSVs against loaded tables: count, head, EXCEPT and
symmetric difference.

``EXCEPT`` and the symmetric difference are computed with one aggregation over
the union of both sides instead of two anti-joins: each side is tagged, rows
are grouped by all columns (NULLs compare equal, as in ``EXCEPT``), and
map-side partial aggregation collapses duplicates before the shuffle, so a row
repeated a billion times costs one row per task, not a hot join key.

:func:`reconcile_days` avoids even that for days that agree: it compares one
fingerprint a day, which the table keeps from its loads, and reads row by row only
the days whose fingerprints differ.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from ..sources.csv import report_partitions
from ..spec import get_spec
from .table import fingerprint, read_table, table_fingerprints


def _tagged(a: DataFrame, b: DataFrame):
    cols = a.columns
    if sorted(cols) != sorted(b.columns):
        raise ValueError(f"column mismatch: {cols} vs {b.columns}")
    u = a.select(*cols, F.lit(1).alias("_in_a"), F.lit(0).alias("_in_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_in_a"), F.lit(1).alias("_in_b"))
    )
    return u.groupBy(*cols).agg(F.sum("_in_a").alias("_na"), F.sum("_in_b").alias("_nb")), cols


def except_rows(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    """``a EXCEPT b`` (distinct). With ``all``, ``a EXCEPT ALL b`` in counted form:
    each row once, with ``copies``, how often it is left."""
    g, cols = _tagged(a, b)
    if not all:
        return g.where((F.col("_na") > 0) & (F.col("_nb") == 0)).select(*cols)
    return g.where(F.col("_na") > F.col("_nb")).select(*cols, (F.col("_na") - F.col("_nb")).alias("copies"))


def sym_diff(a: DataFrame, b: DataFrame, all: bool = False, side: Optional[str] = "side") -> DataFrame:
    """``(a EXCEPT b) UNION ALL (b EXCEPT a)``; empty when the two agree.

    With ``side`` set, a column names where each row was found (``left_only`` /
    ``right_only``). ``all=True`` compares multisets: ``copies`` counts by how
    much a row is more frequent on its side.
    """
    g, cols = _tagged(a, b)
    if not all:
        d = g.where((F.col("_na") > 0) != (F.col("_nb") > 0))
        label, extra = F.when(F.col("_na") > 0, F.lit("left_only")).otherwise(F.lit("right_only")), []
    else:
        d = g.where(F.col("_na") != F.col("_nb"))
        label = F.when(F.col("_na") > F.col("_nb"), F.lit("left_only")).otherwise(F.lit("right_only"))
        extra = [F.abs(F.col("_na") - F.col("_nb")).alias("copies")]
    return d.select(*cols, *([label.alias(side)] if side else []), *extra)


def differing_days(a: DataFrame, b: DataFrame) -> DataFrame:
    """``day, state`` of the days whose fingerprints (``date, n, h1, h2``, perhaps several rows a day) differ."""
    cols = ["n", "h1", "h2"]
    a, b = (x.groupBy("date").agg(*[F.sum(c).cast("decimal(38,0)").alias(f"{s}{c}") for c in cols]) for x, s in ((a, "a_"), (b, "b_")))
    both = a.join(b, "date", "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return both.where(~same).select(F.col("date").alias("day"), F.lit("differs").alias("state"))


def reconcile_days(spark: SparkSession, csv_folder: str, table_path: str, report_type, fmt: str = "parquet"):
    """The CSV folder's reports against the table as multisets: ``(differences as of
    sym_diff(all=True), days that were read row by row)``.

    The CSV side is fingerprinted in one scan; the table's fingerprints were kept
    when its batches were written. Only the directories of differing days are read
    again, on both sides. Rows without a date are always compared."""
    spec = get_spec(report_type)
    rows = report_partitions(spark, csv_folder, spec)
    prints = stage(fingerprint(rows, ["report", "date", "malformed"], spec.columns), "csv_prints")
    bad = prints.where("malformed").select("report").distinct()
    ours = prints.join(bad, "report", "left_anti")
    days = stage(differing_days(ours, table_fingerprints(spark, table_path, spec, fmt)).where("day is not null"), "days")
    wanted = days.where("state = 'differs'").select(F.col("day").alias("date"), "state")
    reports = stage(ours.join(wanted, "date").select("report", "state").distinct(), "reports").where("state = 'differs'")
    left = rows.join(reports.select("report"), "report", "left_semi").join(wanted.select("date"), "date", "left_semi")
    nameless = ours.where("date is null").select("report").distinct()
    left = left.unionByName(rows.join(nameless, "report", "left_semi").where("date is null"))
    table = read_table(spark, table_path, spec, fmt)
    right = read_table(spark, table_path, spec, fmt, days=days.where("state = 'differs'")).unionByName(table.where("date is null"))
    return sym_diff(left.select(*spec.columns), right, all=True), days.select("day")


def table_count(df: DataFrame) -> DataFrame:
    """``SELECT COUNT(*)``, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def table_head(df: DataFrame, n: int = 10, order_by: Optional[Sequence[str]] = None) -> DataFrame:
    """``SELECT * ... LIMIT n``; with ``order_by`` it is a top-n (deterministic)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)
