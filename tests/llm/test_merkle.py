import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_helpers import DOCS, SF
from report_lake.llm import merkle as M
from report_lake.llm.queries import ORACLES, QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))


def tree_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    out = []
    for level in tree[:-1]:
        j = i ^ 1
        out.append((j < i, level[j] if j < len(level) else None))
        i >>= 1
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified), whole trees in memory."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in langs}
    trees = {g: tree_of([leaf_of(r) for r in groups[g]]) for g in langs}
    top = tree_of([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            steps = way(trees[g], i) + way(top, k)
            n = r[4]
            if r[0] is not None and n is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                n += 1
            node = leaf_of((*r[:4], n))
            for left, s in steps:
                node = h(node if s is None else s + node if left else node + s)
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[g][-1][0], root, h("".join(s for _, s in steps if s)), node, node == root))
    return sorted(out, key=repr)


def run(df, height):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    claimed = [F.when(tampered, F.col(c) + 1).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in FIELDS]
    return M.manifest(df, "lang", ["doc_id"], FIELDS, claimed, keep=["doc_id"], height=height)


def rows_of(n):
    hot = [(i, f"text {i} é", "en", None if i % 5 == 0 else f"s{i % 3}", None if i % 11 == 0 else i) for i in range(n)]
    cold = [(2**60 + i, "", ("de", "fr", None, "", "ß", "zz")[i % 6], "x", i) for i in range(13)]
    return hot + cold


@pytest.mark.parametrize("n,height", [(70, 1), (37, 2), (64, 3), (65, 12)])
def test_against_whole_trees(spark, n, height):
    rows = rows_of(n)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = sorted((tuple(r) for r in run(df, height).collect()), key=repr)
    want = brute(rows)
    assert got == want and {r[-1] for r in got} == {True, False}


def test_edges(spark):
    assert run(spark.createDataFrame([], DOCS), 3).count() == 0
    one = [(5, None, None, None, None)]
    got = [tuple(r) for r in run(spark.createDataFrame(one, DOCS), 3).collect()]
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    rows = [(None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (3, "x" * 200000, "en", "s", 2), (3, "y", "en", "s", 2)] + [(9, "same", "en", None, 4)] * 5
    df = spark.createDataFrame(rows, DOCS).withColumn("rank", F.lit(7)).withColumn("NODE", F.lit("q")).withColumn("known", F.lit(0))
    assert sorted((tuple(r) for r in run(df, 1).collect()), key=repr) == brute(rows)


def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    rel = con.sql(ORACLES["op12_merkle"])
    got = sorted(map(tuple, QUERIES["op12_merkle"](spark, SF).select(*rel.columns).collect()))
    assert got == sorted(rel.fetchall())
    docs = con.sql("select doc_id, text, lang, source, n_chars from documents").fetchall()
    assert sorted(got, key=repr) == brute(docs)
