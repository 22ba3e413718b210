"""Exact top-k inner-product join over Voronoi groups.

Vectors are integers (each component scaled by ``scale`` and rounded down), so
scores are exact. Pivots (k-means centres of a bounded sample) divide the space
into Voronoi cells:

1. every query belongs to its nearest pivot's cell; cells with many queries are
   split, so a *query group* holds at most about ``group_rows`` queries;
2. summaries: a group's radius (the largest distance of a query from the pivot)
   and its threshold, the least of its queries' k-th best scores against the
   sample, which no final k-th score can fall below;
3. a row x can matter to a group with pivot p and radius r only if
   p.x + r |x| reaches the threshold (the largest score any query of the group
   can have with x). Rows are first tested by their own cell: for a cell with
   pivot c, radius s and longest row m the bound is p.c + |p| s + r m. Only what
   passes is replicated to the group;
4. each group solves its queries locally against what it got, in blocks of about
   ``block_rows`` rows, and the blocks' k best are merged.

Bounds are rounded towards keeping a row, so the result is exact whatever the
sample. On data without clusters little can be pruned and the join is a blocked
comparison of all queries with all rows; on clustered data most cells drop out.

Null vectors and those with null or non-finite components take no part; zero
vectors do. A query is a row; its own row is no candidate, equal rows are. Ties
go to the smaller id (of any type), null ids last. Scores are exact integers; one
beyond 64 bits has no place in the result and ends the query. Vectors of another
length than most take no part. Empty tables give an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .vectors import best, every, matrix, merged, numbered, sample, spread
from .vectors import places as ids_in_order

K = 20


def pivots_of(x: np.ndarray, n: int, rounds: int = 6, seed: int = 5) -> np.ndarray:
    """At most ``n`` k-means centres of the sample."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:n]].astype(float)
    for _ in range(rounds):
        own = nearest(x, centres)[0]
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = x[own == c].mean(axis=0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row and a distance that is not below the true one."""
    d = (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)
    own = d.argmin(axis=1)
    return own, np.sqrt(((x - centres[own]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-9


def products(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles while no sum can pass 2^53,
    else as 64-bit integers, else as Python integers."""
    top = float(np.sqrt((y**2).sum(axis=1)).max(initial=0) * np.sqrt((x**2).sum(axis=1)).max(initial=0)) * (1 + 1e-9) + x.shape[1]
    # partial sums stay below the product of the norms as well
    if top < 2**53:
        return y @ x.T
    if top < 2**63 and max(np.abs(y).max(initial=0), np.abs(x).max(initial=0)) < 2**62:
        return y.astype(np.int64) @ x.astype(np.int64).T
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
    return whole(y) @ whole(x).T


def scaled(rows: DataFrame, scale: int) -> DataFrame:
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def join(
    table: DataFrame, queries, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, sample_rows: int = 4096, rows_per_pivot: int = 4096,
    max_pivots: int = 256, group_rows: int = 2048, block_rows: int = 16384,
) -> DataFrame:
    """query_id, rank, vec_id, score (long): the k best rows of each query row,
    the rows where the condition ``queries`` (on the column named ``id``) holds."""
    rows = scaled(numbered(table, id_col, vec_col, zero=True), scale)
    total = rows.count()
    n_blocks = max(1, -(-total // block_rows))
    known = sample(rows, sample_rows)
    pivots = pivots_of(known, int(min(max_pivots, max(2, total // rows_per_pivot)))) if len(known) else np.empty((0, 1))
    kind = table.schema[id_col].dataType.simpleString()

    def assign(with_threshold: bool):
        def run(batches):
            for batch in batches:
                x = matrix(batch.column("v"))
                if not len(x):
                    continue
                own, far = nearest(x, pivots)
                out = [*batch.columns, pa.array(own.astype(np.int32)), pa.array(far), pa.array(np.sqrt((x**2).sum(axis=1)))]
                names = [*batch.schema.names, "cell", "far", "norm"]
                if with_threshold:  # the query's own row may be in the sample: one more than k
                    least = np.full(len(x), -np.inf)
                    if len(known) > k:
                        for i in range(0, len(x), 512):
                            s = x[i : i + 512] @ known.T
                            least[i : i + 512] = np.partition(s, len(known) - k - 1, axis=1)[:, len(known) - k - 1]
                    out.append(pa.array(least))
                    names.append("least")
                yield pa.RecordBatch.from_arrays(out, names=names)

        return run

    base = f"id {kind}, v array<double>, n bigint, cell int, far double, norm double"
    data = stage(rows.select("id", "v", "n").mapInArrow(assign(False), base), "voronoi-cells")
    asked = stage(rows.filter(queries).select("id", "v", "n").mapInArrow(assign(True), base + ", least double"), "voronoi-queries")

    # summaries: one row a cell, and one a query group (a group for each group_rows queries)
    cells = {r["cell"]: (r["s"], r["m"]) for r in data.groupBy("cell").agg(F.max("far").alias("s"), F.max("norm").alias("m")).collect()}
    split = {r["cell"]: max(1, -(-r["c"] // group_rows)) for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).collect()}
    parts = F.create_map(*[F.lit(x) for kv in split.items() for x in kv]) if split else F.create_map(F.lit(0), F.lit(1))
    asked = asked.withColumn("part", F.pmod(F.xxhash64(F.lit(31), "n"), parts[F.col("cell")]).cast("int"))
    groups = asked.groupBy("cell", "part").agg(F.max("far").alias("r"), F.min("least").alias("least")).orderBy("cell", "part").collect()
    p = pivots[[g["cell"] for g in groups]] if groups else np.empty((0, pivots.shape[1]))
    r = np.array([g["r"] for g in groups], float)
    least = np.array([g["least"] for g in groups], float)
    # what doubles may be off in products of the longest rows
    longest = max([m for _, m in cells.values()], default=0.0)
    slack = 1e-6 + 1e-12 * longest * longest
    length = np.sqrt((p**2).sum(axis=1))
    reach = {c: p @ pivots[c] + length * s + r * m + slack for c, (s, m) in cells.items()}

    def replicate(batches):
        names = ["id", "v", "n", "group", "block"]
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x, cell = matrix(batch.column("v")), batch.column("cell").to_numpy()
                norm, n = batch.column("norm").to_numpy(), batch.column("n").to_numpy()
                by_cell = np.array([reach[c] for c in cell]) >= least[None, :] - slack
                by_row = x @ p.T + norm[:, None] * r[None, :] + 2 * slack >= least[None, :]
                row, group = np.nonzero(by_cell & by_row)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("v").take(take), batch.column("n").take(take), pa.array(group.astype(np.int32)), batch.column("block").take(take)], names=names)

    number = {(g["cell"], g["part"]): i for i, g in enumerate(groups)}
    key = F.col("cell") * 1_000_000 + F.col("part")
    numbers = F.create_map(*[F.lit(x) for (c, q), i in number.items() for x in (c * 1_000_000 + q, i)]) if number else F.create_map(F.lit(0), F.lit(0))
    near = data.withColumn("block", spread(F.col("n"), n_blocks)).mapInArrow(replicate, f"id {kind}, v array<double>, n bigint, group int, block int")
    asked = asked.select("id", "v", "n", numbers[key].alias("group"), every(n_blocks).alias("block"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q", "query_id", "vec_id", "score"]
        x, n = matrix(left.column("v")), left.column("n").to_numpy()
        ids = ids_in_order(left.column("id"))
        y, own = matrix(right.column("v")), right.column("n").to_numpy()
        rows_, places, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in range(0, len(y) if len(x) else 0, 256):
            s = products(y[i : i + 256], x)
            for j in range(len(s)):
                some = np.flatnonzero(n != own[i + j]) if (n == own[i + j]).any() else np.arange(len(x))
                first = some[best(s[j][some], ids[some], k)]
                rows_.append(np.full(len(first), i + j))
                places.append(first)
                scores.append(s[j][first].astype(np.int64))
        row, place = pa.array(np.concatenate(rows_)), pa.array(np.concatenate(places))
        return pa.table([right.column("n").take(row), right.column("id").take(row), left.column("id").take(place), pa.array(np.concatenate(scores))], names=names)

    found = near.groupBy("group", "block").cogroup(asked.groupBy("group", "block")).applyInArrow(solve, f"q bigint, query_id {kind}, vec_id {kind}, score bigint")
    return merged(found, k)
