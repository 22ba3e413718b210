import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF
from report_lake.llm import mih, voronoi

SCHEMA = "vec_id long, embedding array<float>, label int"
QUERIES = lambda: F.col("id") % 20 == 0


def brute(rows, k, ints):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    if ints:
        ok = [(i, np.floor(64 * v)) for i, v in ok]
    else:
        ok = [(i, v) for i, v in ok if v.any()]
    out = []
    for n, (i, v) in enumerate(ok):
        if i is not None and i % 20 == 0:
            scored = sorted((-(float((x * v).sum())), j) for m, (j, x) in enumerate(ok) if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], SCHEMA).repartition(parts)


def test_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 8)).astype(np.uint8)
    codes[100:200] = codes[0] ^ (rng.random((100, 8)) < 0.2).astype(np.uint8)
    index = mih.Index(codes)
    for q in range(5):
        for r in (0, 1, 5, 8, 13, 24, 30, 64):
            want = np.flatnonzero(np.unpackbits(codes ^ codes[q], axis=1).sum(1) <= r)
            assert index.within(codes[q], r).tolist() == want.tolist()


def test_mih_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in mih.search(df, QUERIES(), block_rows=200).collect()}
    want = brute(rows, 20, False)
    assert len(got) == len(want)
    hits = [(i, j, s) for i, _, j, s in want if (i, j) in got]
    assert len(hits) >= 0.9 * len(want) and all(got[i, j] == pytest.approx(s, abs=1e-12) for i, j, s in hits)


def test_mih_unequal_lengths_and_ranks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16) * rng.uniform(0.2, 3)) for i in range(800)]
    got = mih.search(frame(spark, rows), QUERIES(), k=10, block_rows=300, chunk_rows=20).collect()
    want = brute(rows, 10, False)
    pairs = {(i, j) for i, _, j, _ in want}
    assert len(got) == len(want) and len(pairs & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.9 * len(pairs)
    for q in {r["query_id"] for r in got}:
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_voronoi_is_exact(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12)) * 2
    rows = [(i, centres[i % 6] + rng.normal(size=12) * 0.2) for i in range(900)]
    rows += [(2000 + i, np.ones(12)) for i in range(300)]  # a hot vector: ties
    got = voronoi.join(frame(spark, rows), QUERIES(), k=7, sample_rows=200, rows_per_pivot=100, group_rows=10, block_rows=250).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], float(r["score"])) for r in got) == brute(rows, 7, True)


@pytest.mark.parametrize("ints", [False, True])
def test_edges(spark, ints):
    run = (lambda d, k: voronoi.join(d, QUERIES(), k=k)) if ints else (lambda d, k: mih.search(d, QUERIES(), k=k))
    rows = [(0, [1, 0]), (1, None), (2, []), (20, [float("nan"), 1]), (40, [float("inf"), 1]), (60, [None, 1]), (80, [0, 0]), (3, [0.5, 0.5]), (3, [0.5, 0.5]), (100, [0, 1]), (None, [0.2, 0.1]), (7, [1, 1, 1])]
    df = frame(spark, rows).withColumn("n", F.lit("x")).withColumn("v", F.lit(1)).withColumn("q", F.lit(0)).withColumn("block", F.lit(1))
    got = sorted((r["query_id"], r["rank"], r["vec_id"] if r["vec_id"] is not None else 10**9, float(r["score"])) for r in run(df, 20).collect())
    usable = [(i if i is not None else 10**9, v) for i, v in rows if not (v and len(v) == 3)]
    want = [(i, r, j, s) for i, r, j, s in brute(usable, 20, ints) if i != 10**9]
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])
    assert run(frame(spark, [], 1), 5).count() == 0
    assert run(frame(spark, [(20, [1.0, 2.0])]), 5).count() == 0
    assert run(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), 5).count() == 0


def test_large_components_and_ids_of_any_type(spark):
    """Products beyond 2^53 are exact; ids beyond 2^53 and text ids break ties rightly."""
    import random

    rng = random.Random(1)
    big = [(2**60 + i, [rng.uniform(-1, 1) * 3e6 for _ in range(8)]) for i in range(120)]
    df = spark.createDataFrame(big + [(2**60 + 500 + i, big[7][1]) for i in range(3)], "vec_id long, embedding array<double>")
    rows = [(r["vec_id"], [math.floor(64 * x) for x in r["embedding"]]) for r in df.collect()]
    got = {}
    for r in voronoi.join(df, F.col("id") % 20 == 0, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, v in rows:
        if q % 20 == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q))[:5]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    text, q = df.select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("vec_id"), "embedding"), f"v{2**60 + 500}"
    vectors = {f"v{i}": v for i, v in rows}
    best = sorted((-sum(a * b for a, b in zip(vectors[q], w)), i) for i, w in vectors.items() if i != q)[:9]
    assert [(-r["score"], r["vec_id"]) for r in voronoi.join(text, F.col("id") == q, k=9).orderBy("rank").collect()] == best
    near = [(-r["score"], r["vec_id"]) for r in mih.search(text, F.col("id") == q, k=9).orderBy("rank").collect()]
    assert len(near) == 9 and near == sorted(near)
