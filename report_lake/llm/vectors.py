"""Shared by the two vector searches: valid rows, bounded samples, block pairing, top-k merge."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage


def valid(vector: Column, zero: bool) -> Column:
    """Not null, not empty, all components finite; if ``zero`` is false, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(vector, bad), F.lit(True))
    return ok if zero else ok & F.exists(vector, lambda x: x != 0)


def numbered(table: DataFrame, id_col: str, vec_col: str, zero: bool) -> DataFrame:
    """Staged valid rows: n (a row number, unique), id, v. Vectors shorter or
    longer than most have no inner product with them and take no part."""
    rows = table.filter(valid(F.col(vec_col), zero)).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = stage(rows.withColumn("n", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "d").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["d"] if sizes else 0))


def sample(rows: DataFrame, size: int) -> np.ndarray:
    """At most ``size`` vectors, in hash order of the row number."""
    got = rows.orderBy(F.xxhash64("n"), "n").limit(size).select("v").collect()
    return np.array([r["v"] for r in got], float) if got else np.empty((0, 1))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def places(column) -> np.ndarray:
    """The order of the ids of an Arrow column, of any type: equal ids share a place, nulls are last."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty(0)
    return pc.rank(column, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(float)


def spread(column: Column, n: int) -> Column:
    """A hash of the row number in 0 .. n - 1."""
    return F.pmod(F.xxhash64(F.lit(29), column), F.lit(n)).cast("int")


def every(n: int) -> Column:
    """One row for each of 0 .. n - 1."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, highest score first, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of (q, query_id, vec_id, score) for each query, with their ranks.
    A query has at most k rows from each block."""
    order = W.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
