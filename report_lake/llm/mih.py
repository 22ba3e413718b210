"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors get one more component that makes their lengths equal, so that a
larger inner product is a smaller angle; several rotations, learned by
iterative quantisation on a bounded sample, give one bit a component. The code
is cut into 8-bit substrings; each is indexed by the rows' bitmaps of its 256
values.

Search within Hamming radius r, by the pigeonhole principle: with m substrings
and r = m a + b, a code within r of the query is within a in one of the first
b + 1 substrings or within a - 1 in one of the others. The union of these
bitmaps holds every code within r; its rows' full distances are checked, and
those within r are reranked by exact inner products on the original vectors.
A query with too few rows within r gets the next larger radius.

The radius is learned too: on the sample, a share ``cover`` of the true
neighbours lies within it. Larger tables have closer neighbours, so the share
found there is not less. Rotations and radius come from ``sample_rows`` rows;
every row is indexed and every query answered.

Rows are dealt into blocks of about ``block_rows``, queries into chunks of
``chunk_rows``; each pair (block, chunk) is one bounded task: the block's index
is built there and the chunk's queries probe it. Only k rows a query leave it.

Null and zero vectors and those with null or non-finite components take no
part. A query is a row; its own row is no candidate, equal rows are. Ties go to
the smaller id, null ids last. Empty tables give an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import best, every, matrix, merged, numbered, sample, spread
from .vectors import places as ids_in_order

K, BITS = 20, 256


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """With one more component, all of length ``longest``."""
    return np.column_stack([x, np.sqrt(np.maximum(0, longest**2 - (x**2).sum(axis=1)))])


def learn_rotations(x: np.ndarray, bits: int, rounds: int = 25, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Centre and (components, bits) projections by iterative quantisation."""
    rng, d = np.random.default_rng(seed), x.shape[1]
    centre = x.mean(axis=0)
    v, out = x - centre, []
    while sum(r.shape[1] for r in out) < bits:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(r)
    return centre, np.concatenate(out, axis=1)[:, :bits]


def encode(x: np.ndarray, model) -> np.ndarray:
    """(rows, bytes) codes: one byte a substring."""
    longest, centre, projections = model
    return np.packbits((lengthened(x, longest) - centre) @ projections >= 0, axis=1)


def distances(codes: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ query).sum(axis=1, dtype=np.int64)


_NEAR = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


class Index:
    """A block's multi-index: for each substring, radius and value a bitmap of rows."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.m, self.maps = codes, codes.shape[1], {}

    def bitmap(self, s: int, value: int, a: int) -> np.ndarray:
        """Rows whose substring ``s`` is within ``a`` of ``value``, eight to a byte."""
        key = (s, int(value), a)
        if key not in self.maps:
            if (s, -1, 0) not in self.maps:  # the rows of each value
                self.maps[s, -1, 0] = np.packbits(self.codes[:, s][None, :] == np.arange(256, dtype=np.uint8)[:, None], axis=1)
            rows = self.maps[s, -1, 0][_NEAR[value] <= a]
            self.maps[key] = np.bitwise_or.reduce(rows, axis=0)
        return self.maps[key]

    def within(self, query: np.ndarray, r: int) -> np.ndarray:
        """All rows within Hamming distance ``r`` of the query code."""
        a, b = divmod(r, self.m)
        union = None
        for s in range(self.m):
            reach = a if s <= b else a - 1
            if reach >= 0:
                bits = self.bitmap(s, query[s], reach)
                union = bits.copy() if union is None else np.bitwise_or(union, bits, out=union)
        some = np.flatnonzero(np.unpackbits(union, count=len(self.codes)))
        return some[distances(self.codes[some], query) <= r]


def learn(rows: DataFrame, k: int, bits: int, sample_rows: int, cover: float):
    """(longest, centre, projections) and the radius."""
    longest = rows.select(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0] or 0.0
    x = sample(rows, sample_rows)
    if not len(x):
        return None, 0
    centre, projections = learn_rotations(lengthened(x, longest), bits)
    model = (longest, centre, projections)
    codes = encode(x, model)
    far = []
    for i in range(0, len(x), max(1, len(x) // 200)):
        scores = x @ x[i]
        scores[i] = -np.inf
        near = np.argsort(-scores)[: min(k, len(x) - 1)]
        far += distances(codes[near], codes[i]).tolist()
    return model, int(np.quantile(far, cover)) if far else bits


def search(
    table: DataFrame, queries, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", bits: int = BITS, sample_rows: int = 8192, cover: float = 0.97,
    block_rows: int = 8192, chunk_rows: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row where the
    condition ``queries`` (on the column named ``id``) holds."""
    rows = numbered(table, id_col, vec_col, zero=False)
    model, radius = learn(rows, k, bits, sample_rows, cover)
    asked = rows.filter(queries)
    n_blocks = max(1, -(-rows.count() // block_rows))
    n_chunks = max(1, -(-asked.count() // chunk_rows))
    data = rows.withColumn("block", spread(F.col("n"), n_blocks)).withColumn("chunk", every(n_chunks))
    # aliased: both sides of the cogroup come from the same rows, and column pruning confuses them otherwise
    asked = asked.select(*(F.col(c).alias(c) for c in ("id", "v", "n")), spread(F.col("n"), n_chunks).alias("chunk")).withColumn("block", every(n_blocks))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q", "query_id", "vec_id", "score"]
        empty = [left.column("n").slice(0, 0), left.column("id").slice(0, 0), left.column("id").slice(0, 0), pa.array([], pa.float64())]
        if not left.num_rows or not right.num_rows or model is None:
            return pa.table(empty, names=names)
        x, n, ids = matrix(left.column("v")), left.column("n").to_numpy(), ids_in_order(left.column("id"))
        index, asked_codes = Index(encode(x, model)), None
        y, own = matrix(right.column("v")), right.column("n").to_numpy()
        asked_codes = encode(y, model)
        rows_, places, scores = [], [], []
        for i in range(len(y)):
            r, least = radius, min(k, len(x) - int((n == own[i]).any()))
            while True:
                some = index.within(asked_codes[i], r)
                some = some[n[some] != own[i]]
                if len(some) >= least or r >= bits:
                    break
                r = min(bits, r + index.m)
            got = (x[some] * y[i]).sum(axis=1)
            first = best(got, ids[some], k)
            rows_ += [i] * len(first)
            places.append(some[first])
            scores.append(got[first])
        place = pa.array(np.concatenate(places))
        row = pa.array(rows_, pa.int64())
        return pa.table([right.column("n").take(row), right.column("id").take(row), left.column("id").take(place), pa.array(np.concatenate(scores))], names=names)

    kind = table.schema[id_col].dataType.simpleString()
    found = data.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk")).applyInArrow(run, f"q bigint, query_id {kind}, vec_id {kind}, score double")
    return merged(found, k)
