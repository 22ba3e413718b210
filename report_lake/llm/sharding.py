"""Uniform sharding by a hypergeometric communication matrix.

A uniformly random permutation cut into shards of exact sizes, without one
global sort:

1. the rows are staged once with their input block (partition and row number in
   it, in runs of ``block_rows``), so every later read sees the same blocks;
2. the *communication matrix* says how many rows each block sends to each
   shard. Given the block and shard sizes it follows the multivariate
   hypergeometric law, drawn exactly, block after block, from the block counts
   alone (one small row a block);
3. each block is permuted locally by a hash order and cut at its matrix row;
4. the shards are exchanged and permuted again: a hash order over sub-ranges of
   a shard, whose counts give the offsets, so no task sorts a whole shard.

Only DataFrame functions touch rows; the matrix is drawn from counts on the
driver. Sizes: shard counts differ by one at most. Rows that are equal, null or
empty are rows like all others. An empty table gives an empty table. Extra
columns are kept; one with the name of an output column is replaced.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, stage


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good: exact inversion,
    summed outwards from the mode (about a standard deviation of steps)."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    log = math.lgamma
    x = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    p = math.exp(
        log(good + 1) - log(x + 1) - log(good - x + 1)
        + log(bad + 1) - log(n - x + 1) - log(bad - n + x + 1)
        - log(good + bad + 1) + log(n + 1) + log(good + bad - n + 1)
    )
    left = rng.random()
    up, down, pu, pd = x, x, p, p
    left -= p
    while left > 0:
        moved = False
        if up < high:
            pu *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            left -= pu
            moved = pu > 0
            if left <= 0:
                return up
        if down > low:
            pd *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            left -= pd
            moved = moved or pd > 0
            if left <= 0:
                return down
        if not moved:
            return x  # rounding left a crumb of probability
    return x


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Rows each block sends to each shard, as a uniform permutation would."""
    rng, left, out = random.Random(seed), list(shard_sizes), []
    for size in block_sizes:
        row, rest, total = [], size, sum(left)
        for i, k in enumerate(left):
            x = rest if i == len(left) - 1 else hypergeometric(rng, k, total - k, rest)
            row.append(x)
            rest -= x
            total -= k
        left = [k - x for k, x in zip(left, row)]
        out.append(row)
    return out


def literal_frame(spark, rows: list, schema: str) -> DataFrame:
    """A small driver-side table as a DataFrame, through one JSON literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def shard(df: DataFrame, n_shards: int, seed: int = 17, block_rows: int = 1 << 20, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in its shard)."""
    spark, c = df.sparkSession, fresh(df, "part", "row", "block", "rank", "cuts", "draw", "sub", "base")
    part, row, block, rank, cuts, draw, sub, base = (c[x] for x in ("part", "row", "block", "rank", "cuts", "draw", "sub", "base"))
    number = F.monotonically_increasing_id()
    rows = stage(
        df.withColumn(row, number)
        .withColumn(part, F.shiftright(row, 33))
        .withColumn(row, F.col(row) % F.lit(1 << 33))
        .withColumn(block, F.expr(f"`{row}` div {block_rows}")),
        "shard-blocks",
    )
    key = [part, block]
    sizes = [(r[part], r[block], r["n"]) for r in rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).orderBy(*key).collect()]
    total = sum(n for *_, n in sizes)
    targets = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([n for *_, n in sizes], targets, seed)
    plan = []
    for (p, b, _), counts in zip(sizes, matrix):
        ends, at = [], 0
        for x in counts:
            at += x
            ends.append(at)
        plan.append({part: p, block: b, cuts: ends})
    plan = literal_frame(spark, plan, f"`{part}` bigint, `{block}` bigint, `{cuts}` array<bigint>")
    local = F.xxhash64(F.lit(seed), part, row)
    first = (
        rows.join(plan, key)
        .withColumn(rank, F.row_number().over(W.partitionBy(*key).orderBy(local, row)).cast("long") - 1)
        .withColumn(shard_col, F.expr(f"size(filter(`{cuts}`, x -> x <= `{rank}`))"))
        .drop(cuts, rank, block)
    )
    n_sub = max(1, -(-max(targets, default=0) // block_rows))
    moved = (
        first.withColumn(draw, F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), part, row), 1))
        .withColumn(sub, F.expr(f"cast(shiftright(`{draw}`, 32) * {n_sub} div {1 << 31} as int)"))
    )
    order = W.partitionBy(shard_col, sub).orderBy(draw, part, row)
    out = moved.withColumn(slot_col, F.row_number().over(order).cast("long") - 1)
    if n_sub > 1:
        before = W.partitionBy(shard_col).orderBy(sub).rowsBetween(W.unboundedPreceding, -1)
        offsets = moved.groupBy(shard_col, sub).agg(F.count(F.lit(1)).alias(base)).withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
        out = out.join(offsets, [shard_col, sub]).withColumn(slot_col, F.col(slot_col) + F.col(base)).drop(base)
    return out.drop(part, row, draw, sub)
