"""Helpers shared by the operators: table reading, staging, vectorised byte hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts lineage: executors lost later re-read these files instead of
    recomputing what led to them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Lower the session's Arrow batch size to ``rows`` where it is larger.

    Batches are counted in rows, so with the default of 10,000 a run of long
    texts makes batches of gigabytes, in the JVM and in Python. Operators that
    send whole texts to Python call this first.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (null ids: fold of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def fresh(df: DataFrame, *names: str) -> dict[str, str]:
    """Working column names that clash with none of ``df``'s (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for n in names:
        c = f"_{n}"
        while c.lower() in taken:
            c = "_" + c
        taken.add(c.lower())
        out[n] = c
    return out


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    p = _POW.get(base)
    if p is None or len(p) < n:
        size = 1 << max(16, (n - 1).bit_length())
        p = np.ones(size, np.uint64)
        k, f = 1, base
        while k < size:
            p[k : 2 * k] = p[:k] * U64(f)
            f = f * f % (1 << 64)
            k *= 2
        _POW[base] = p
    return p


def token_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the white-space separated tokens of
    ``buf`` (UTF-8 bytes; A-Z lower-cased), without a Python loop over tokens.

    A token's hash is a polynomial over its bytes, taken from one running sum
    over the whole buffer, so every token costs a subtraction and a product.
    """
    if not len(buf):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    b = _LOWER[buf]
    edge = np.diff(np.concatenate(([True], _SPACE[b], [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    run = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * _powers(_BASE, len(b))[: len(b)], out=run[1:])
    return mix64((run[end] - run[start]) * _powers(_BASE_INV, len(b))[start]), start


def text_blocks(texts: list[bytes], limit: int = 2 << 20):
    """Cut a batch of texts into runs of at most about ``limit`` bytes (a longer
    text makes a run of its own): yields (first, last, joined bytes, text starts)."""
    i, n = 0, len(texts)
    while i < n:
        j, size = i, 0
        while j < n and (j == i or size + len(texts[j]) < limit):
            size += len(texts[j]) + 1
            j += 1
        part = texts[i:j]
        starts = np.cumsum([0] + [len(t) + 1 for t in part])[:-1]
        yield i, j, np.frombuffer(b"\n".join(part), np.uint8), starts
        i = j


def utf8_list(column) -> list[bytes]:
    """An Arrow string column as UTF-8 byte strings, null as empty."""
    import pyarrow as pa

    return [x if x is not None else b"" for x in column.cast(pa.large_binary()).to_pylist()]
