import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, docs_of  # noqa: F401
from report_lake.llm import runs as R
from report_lake.llm.queries import QUERIES


def brute_runs(x, least=12):
    """Maximal stretches by every period, the smallest period of each alone."""
    n, out, seen = len(x), [], set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            # a multiple of a smaller period has the same stretch
            if length >= 2 * q and not any(q % d == 0 and (i, length, d) in seen for d in range(1, q)):
                seen.add((i, length, q))
                if length >= least:
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


def brute_lyndon(x):
    n, out = len(x), []
    for i in range(n):
        best = 1
        for j in range(i + 2, n + 1):
            w = x[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


def test_lyndon_array():
    rng = random.Random(3)
    for _ in range(250):
        x = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(0, 26))]
        assert R.lyndon(x) == brute_lyndon(x) and R.lyndon([-v for v in x]) == brute_lyndon([-v for v in x])


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("least", [1, 12])
def test_runs_of(least):
    rng = random.Random(8)
    cases = [thue_morse(200), fibonacci(200), [0] * 50, [0, 1] * 30, list(range(40)) * 3, [], [1]]
    for _ in range(150):
        k = rng.choice([1, 2, 3, 12])
        x = [rng.randrange(k) for _ in range(rng.randrange(0, 90))]
        a = rng.randrange(len(x) + 1)
        cases.append(x + x[a:] * rng.randrange(4) + [rng.randrange(k) for _ in range(rng.randrange(9))])
    for x in cases:
        assert sorted(R.runs_of(np.array(x, np.int64), least)) == brute_runs(x, least) if x else True
        assert R.document_runs(np.array(x, np.int64)) == brute_runs(x)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_runs"](spark, SF).select(*COLUMNS).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 50
    for doc_id, text in docs:
        if len(text) < 12_000:  # brute force takes a square of the words; the query ran on all
            assert got[doc_id] == expected(doc_id, text), doc_id


def test_edges(spark, docs_of, tmp_path):
    assert R.find_runs(docs_of([])).count() == 0
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 30), (4, "a b " * 40 + "\x1c c"), (5, "x y z " * 20000), (5, "x y z " * 20000), (6, "w " + "é🙂 " * 13), (7, "one " * 11)]
    df = docs_of(rows).withColumn("id", F.lit(1)).withColumn("Runs", F.lit("r")).withColumn("N_WORDS", F.lit(2))
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.find_runs(df).collect()), key=repr)
    want = [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 30, [(0, 30, 1)], "a"), (4, 42, [(0, 40, 1)], "a b \x1c c"),
        (5, 60000, [(0, 60000, 3)], "x y z"), (5, 60000, [(0, 60000, 3)], "x y z"), (6, 14, [(1, 13, 1)], "w é🙂"), (7, 11, [], " ".join(["one"] * 11)),
    ]
    assert got == sorted(want, key=repr)
    same = spark.createDataFrame([(None, "a " * 30)], "doc_id long, text string")
    assert R.find_runs(same, rewrite=R.periodic).first()["runs"][0]["length"] == 30
