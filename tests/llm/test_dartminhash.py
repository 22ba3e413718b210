import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import docs_of, sf_docs  # noqa: F401
from report_lake.llm import dartminhash as D
from report_lake.llm.common import text_blocks


def multiset(text, width=5):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode().split()
    return Counter(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else Counter()


def jaccard(a, b):
    either = sum((a | b).values())
    return sum((a & b).values()) / either if either else 0.0


def classes(texts, least=0.8):
    """Brute force: components over all pairs at ``least`` or more, and equal texts."""
    ids = [i for i, t in texts if t is not None]
    counted = {i: multiset(t) for i, t in texts if t is not None}
    raw = {i: t for i, t in texts if t is not None}
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (raw[a] == raw[b] or jaccard(counted[a], counted[b]) >= least):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids} | {i: i for i, t in texts if t is None}


def test_similarities_are_exact():
    texts = ["a b c d e f", "A B c d E f", "a b c d e g", "one two", "one three", "x x x x x x x", "x x x x x x x x", "", " ", "w " * 5000, "é b c d e f"]
    left, right = zip(*[(a, b) for a in texts for b in texts])
    got = D.similarities([t.encode() for t in left], [t.encode() for t in right], limit=64)
    assert np.allclose(got, [jaccard(multiset(a), multiset(b)) for a, b in zip(left, right)])
    assert jaccard(multiset(texts[5]), multiset(texts[6])) == 3 / 4  # occurrences count


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(1)
    words = [f"w{rng.randrange(300)}" for _ in range(600)]
    other = words[:450] + [f"v{i}" for i in range(150)]
    a, b = " ".join(words).encode(), " ".join(other).encode()
    _, _, buf, starts = next(text_blocks([a, b, b"short one"]))
    s, total = D.signatures(buf, starts, 1024)
    assert total.tolist() == [596, 596, 1]
    assert abs((s[0] == s[1]).mean() - D.similarities([a], [b])[0]) < 0.05
    assert np.array_equal(D.signatures(*next(text_blocks([b]))[2:], 64)[0][0], D.signatures(*next(text_blocks([b"pad", b]))[2:], 64)[0][1])


def test_classes_equal_brute_force(sf_docs):
    docs = sf_docs.limit(300)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rng = random.Random(2)
    for n, (_, t) in enumerate(rows[:40]):  # planted near copies, and copies of copies
        w = t.split()
        for j in range(3):
            if len(w) > 60:
                w = list(w)
                w[rng.randrange(len(w))] = f"new{n}{j}"
                rows.append((10_000 + 10 * n + j, " ".join(w)))
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in D.near_duplicates(df).collect()}
    assert got == classes(rows)


def test_large_group_and_components(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(200)]
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert len(got) == 600 and {r["class_id"] for r in got} == {0} and {r["class_size"] for r in got} == {600}
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(0, 60) if i != 30], "a binary, b binary")
    got = {r["node"][0]: r["label"][0] for r in D.components(edges).collect()}
    assert all(got.get(i, 0) == 0 for i in range(31)) and all(got.get(i, 31) == 31 for i in range(31, 61))


def test_scattered_pairs_in_a_large_bucket(spark):
    """1,200 texts with a long passage in common (0.77) and ten pairs among them, against brute force."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(150)]
    rows = [(i, " ".join(passage + [f"o{i}x{j}" for j in range(22)])) for i in range(1200)]
    for n, i in enumerate(rng.sample(range(1200), 10)):
        own = rows[i][1].split()
        own[-(n + 1) :] = [f"changed{n}x{j}" for j in range(n + 1)]
        rows.append((5000 + i, " ".join(own)))
    counted = {i: set(multiset(t)) for i, t in rows}
    everywhere = set.intersection(*counted.values())
    holders = {}
    for i, x in counted.items():
        for y in x - everywhere:
            holders.setdefault(y, []).append(i)
    shared = Counter((a, b) for h in holders.values() for a in h for b in h if a < b)
    near = {p for p, n in shared.items() if (n + len(everywhere)) / (len(counted[p[0]] | counted[p[1]])) >= 0.8}
    assert len(near) == 10 and len(everywhere) / (2 * 168 - len(everywhere)) < 0.8
    got = D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).filter("class_id <> doc_id").collect()
    assert {(r["class_id"], r["doc_id"]) for r in got} == near


def test_prefix_pairs_miss_none(spark, sf_docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    for t in texts[:30]:
        w = t.split()
        w[rng.randrange(len(w))] = "new"
        texts += [" ".join(w), " ".join(t.split()[:-1] or ["z"]), t + " more"]
    texts = sorted(set(texts))
    for least, width in ((0.8, 5), (0.8, 1), (0.5, 2)):
        rows = [(t.encode(), t.encode(), t) for t in texts]
        df = spark.createDataFrame(rows, "node binary, label binary, text string")
        got = {(bytes(r["a"]), bytes(r["b"])) for r in D.prefix_pairs(df, least, width).collect()}
        want = {(a.encode(), b.encode()) for a in texts for b in texts if a < b and jaccard(multiset(a, width), multiset(b, width)) >= least}
        assert want and want <= got


def test_prefix_pairs_of_a_group_below_the_limit(spark):
    """Near copies of one text that are no links of each other: few pairs leave the join, all links among them."""
    rng = random.Random(10)
    base = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(240):  # one changed word, in the middle: 51 of 61 shingles in common at most
        w = list(base)
        w[6 + i % 48] = f"own{i}"
        texts.append(" ".join(w))
    for i in range(6):  # links: another last word
        texts.append(texts[40 * i].rsplit(" ", 1)[0] + f" end{i}")
    counted = {t: multiset(t) for t in texts}
    want = {(a.encode(), b.encode()) for a in texts for b in texts if a < b and jaccard(counted[a], counted[b]) >= 0.8}
    df = spark.createDataFrame([(t.encode(), t.encode(), t) for t in rng.sample(texts, len(texts))], "node binary, label binary, text string")
    got = {(bytes(r["a"]), bytes(r["b"])) for r in D.prefix_pairs(df, 0.8, 5).collect()}
    every = len(texts) * (len(texts) - 1) // 2
    assert want and want <= got and len(want) < every / 10
    assert len(got) < 1.5 * len(want)


def test_edges(docs_of):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "  "), (6, "hello"), (7, "hello"), (7, "hello"), (8, "Hello"), (9, "w " * 30000), (None, "alone in here")]
    docs = docs_of(rows).withColumn("node", F.lit(1)).withColumn("label", F.lit(2)).withColumn("key", F.lit(3)).withColumn("id", F.lit(4))
    got = sorted(((r["doc_id"] or 0, r["class_id"] or 0, r["class_size"]) for r in D.near_duplicates(docs).collect()))
    assert got == [(0, 0, 1), (1, 1, 1), (2, 2, 1), (3, 3, 2), (4, 3, 2), (5, 5, 1), (6, 6, 4), (7, 6, 4), (7, 6, 4), (8, 6, 4), (9, 9, 1)]
    assert D.near_duplicates(docs_of([])).count() == 0
