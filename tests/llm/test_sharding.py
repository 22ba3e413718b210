import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_helpers import docs_of, python_nodes  # noqa: F401
from report_lake.llm import sharding as S


def test_hypergeometric_law():
    rng = random.Random(5)
    from math import comb

    for good, bad, n in ((5, 7, 4), (30, 2, 20), (1, 40, 3), (0, 5, 3), (6, 0, 4), (8, 8, 16)):
        draws = Counter(S.hypergeometric(rng, good, bad, n) for _ in range(8000))
        for x in range(0, n + 1):
            want = comb(good, x) * comb(bad, n - x) / comb(good + bad, n)
            assert abs(draws[x] / 8000 - want) < 0.025
    assert abs(S.hypergeometric(rng, 10**12, 10**12, 10**6) - 500_000) < 5_000


def test_matrix_sums():
    blocks, shards = [10, 0, 7, 33, 1], [17, 17, 17]
    m = S.communication_matrix(blocks, shards, 9)
    assert [sum(r) for r in m] == blocks and [sum(c) for c in zip(*m)] == shards


@pytest.mark.parametrize("block_rows", [7, 100, 1 << 20])
def test_whole_and_gapless(spark, block_rows):
    df = spark.range(1003).select("id", (F.col("id") % 5).alias("g")).repartition(4)
    out = S.shard(df, 24, block_rows=block_rows)
    assert not python_nodes(out)
    got = out.collect()
    assert sorted(r["id"] for r in got) == list(range(1003))
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(24)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted((r["id"], r["shard"], r["slot"]) for r in out.collect()) == sorted((r["id"], r["shard"], r["slot"]) for r in got)


def test_uniform(spark):
    df = spark.range(4000).repartitionByRange(4, "id")
    got = S.shard(df, 4, seed=3).collect()
    cells = Counter((r["id"] // 1000, r["shard"]) for r in got)
    assert all(abs(n - 250) < 75 for n in cells.values()) and len(cells) == 16
    first = [r["id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(sum(a < b for a, b in zip(first, first[1:])) - 2000) < 200


def test_edges(docs_of):
    rows = [(1, None), (1, None), (2, ""), (None, "x"), (3, "y" * 100000)] * 3
    docs = docs_of(rows).withColumn("Slot", F.lit("s")).withColumn("_part", F.lit(1)).withColumn("_row", F.lit(1))
    out = S.shard(docs, 4)
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "_part", "_row", "slot", "shard"} or "Slot" in out.columns
    got = Counter(r["shard"] for r in out.collect())
    assert sorted(got.values()) == [3, 4, 4, 4]
    assert S.shard(docs_of([]), 24).count() == 0
    few = S.shard(docs_of([(1, "a"), (2, "b")]), 24).collect()
    assert sorted(r["shard"] for r in few) == [0, 1] and all(r["slot"] == 0 for r in few)
