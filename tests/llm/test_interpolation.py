import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm_helpers import docs_of, fold_of  # noqa: F401
from report_lake.llm import interpolation as I
from report_lake.llm.common import fold


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0d]+", low) if w] + ["</s>"]


def brute(rows, training, held):
    """The model from plain dictionaries, the EM over single events."""
    c1, c2, h1, h2 = Counter(), Counter(), Counter(), Counter()
    for i, t in rows:
        if training(i):
            k = ["<s>", *tokens(t)]
            for c, h in ((c1, k), (c2, list(zip(k, k[1:])))):
                c.update(h)
            if held(i):
                h1.update(k)
                h2.update(zip(k, k[1:]))
    n = sum(v for k, v in c1.items() if k != "<s>")
    nh = sum(v for k, v in h1.items() if k != "<s>")
    v = len(c1) - 1

    def parts(a, b, own):
        x1, x2 = (c1[a] - own * h1[a], c2[a, b] - own * h2[a, b])
        f1 = (c1[b] - own * h1[b]) / max(1, n - own * nh)
        return (min(47, int(math.log2(x1)) + 1) if x1 else 0), 1 / (v + 1), f1, x2 / x1 if x1 else 0.0

    events = {}
    for (a, b), k in h2.items():
        bucket, f0, f1, f2 = parts(a, b, 1)
        events.setdefault(bucket, []).append((k, f0, f1, f2))
    weights = {}
    for bucket, got in events.items():
        e = np.array(got)
        ok = np.array([1, 1, 0 if bucket == 0 else 1.0])
        w = ok / ok.sum()
        for _ in range(60):
            s = e[:, 1:] * w
            s /= s.sum(1, keepdims=True)
            w = (s * e[:, :1]).sum(0) + ok
            w /= w.sum()
        weights[bucket] = w
    def weight(b):
        w = weights[min(sorted(weights), key=lambda x: abs(x - b))].copy()
        if b == 0:
            w[:2] += w[2] / 2
            w[2] = 0
        return w
    out = {}
    for i, t in rows:
        k = ["<s>", *tokens(t)]
        s = 0.0
        for a, b in zip(k, k[1:]):
            bucket, *f = parts(a, b, 0)
            s += math.log10(float(weight(bucket) @ np.array(f)))
        base = sum(math.log10((c1[b] + 0.5) / (n + 0.5 * (v + 1))) for b in k[1:])
        out[i] = (len(k) - 1, sum(c1[b] > 0 for b in k[1:]), n, base, s)
    return out


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in I.score(docs, fold(F.col("doc_id")) != 1, held=F.col("doc_id") % 7 == 0, part_rows=64, n_ranges=5).collect()}
    want = brute(rows, lambda i: fold_of(i) != 1, lambda i: i % 7 == 0)
    assert len(got) == len(rows)
    for i, (n, known, total, base, s) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(s, rel=5e-3)  # the EM bins its events
    held = [i for i in want if fold_of(i) == 1]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_weights_are_distributions():
    table = pd.DataFrame({"bucket": [0, 3, 3, 5], "n": [5, 10, 2, 7], "r0": [4.0, 2.0, 0.0, 9.0], "r1": [0.0, 50.0, 0.0, 80.0]})
    w = I.expectation_maximisation(table, 2)
    assert np.allclose(w.sum(1), 1) and (w >= 0).all() and w[0, 2] == 0 and (w[:, 0] > 0).all()
    assert w[5, 2] > w[3, 2]  # frequent contexts trust their bigrams more
    assert np.allclose(I.expectation_maximisation(table.iloc[:0], 2)[1:], 1 / 3)


def test_trigrams_and_edges(docs_of):
    rows = [(1, None), (2, ""), (3, "a b c a b c"), (3, "a b c a b c"), (4, "x " * 30000), (None, "a B\tc"), (5, " \n ")]
    docs = docs_of(rows, 1).withColumn("part", F.lit("clash")).withColumn("role", F.lit(9)).withColumn("id", F.lit(2))
    from report_lake.llm.common import stage

    docs = stage(docs, "t")
    for order in (1, 2, 3):
        got = I.score(docs, F.lit(True), held=F.col("doc_id") == 3, order=order, n_ranges=3).collect()
        assert len(got) == 7 and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
        by = {r["doc_id"]: r for r in got}
        assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[5]["n_tokens"] == 1 and by[4]["n_tokens"] == 30001
        assert by[None]["n_known"] == 4 and by[3]["train_tokens"] == 3 + 14 + 30001 + 4
    assert I.score(docs.limit(0), F.lit(True)).count() == 0
    none = I.score(docs, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == r["score"] == 0 for r in none)
