import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, python_nodes
from report_lake.llm import reply_trees as R
from report_lake.llm.queries import ORACLES, QUERIES

MSGS = "tree long, id long, parent long, role string, text string, score double"


def chats(spark, rows, top=None):
    df = spark.createDataFrame(rows, MSGS)
    m = R.messages(df, *(F.col(c) for c in ("tree", "id", "parent", "role", "text", "score")))
    return R.chats(m, top)


def brute(rows, top=None):
    """{(tree, leaf): ids from the root} by walking up from every leaf."""
    by = {(t, i): (p, s) for t, i, p, _, _, s in rows}
    answered = {(t, p) for (t, _), (p, _) in by.items() if (t, p) in by}
    found = {}
    for t, i in by:
        if (t, i) in answered:
            continue
        ids, total, at = [], 0.0, i
        while (t, at) in by and at is not None and len(ids) <= len(by):
            ids.append(at)
            total += by[t, at][1] or 0.0
            at = by[t, at][0]
        found.setdefault(t, []).append((-total / len(ids), i, ids[::-1]))
    return {(t, i): ids for t, leaves in found.items() for _, i, ids in sorted(leaves)[:top]}


def random_trees(seed):
    rng, rows = random.Random(seed), []
    for tree, n in ((0, 1), (1, 40), (2, 40), (3, 90)):
        for i in range(n):
            parent = None if i == 0 else (i - 1 if tree == 3 else rng.randrange(max(0, i - 6), i))
            rows.append((tree, i, parent, rng.choice(["user", "assistant", "tool"]), f"t{tree} m{i} \\ </s>", float(rng.randrange(4))))
    return rows


@pytest.mark.parametrize("top", [None, 1, 3])
def test_paths_against_brute_force(spark, top):
    rows = random_trees(4)
    text = {(t, i): (role, x) for t, i, _, role, x, _ in rows}
    out = chats(spark, rows, top)
    assert not python_nodes(out.select("formatted"))
    got = out.withColumn("turns", R.read_back(F.col("formatted"))).withColumn("learned", R.loss_text(F.col("formatted"), F.col("loss"))).collect()
    want = brute(rows, top)
    assert len(got) == len(want)
    for r in got:
        turns = [text[r["tree"], i] for i in want[r["tree"], r["leaf"]]]
        assert [tuple(x) for x in r["turns"]] == turns and r["n_turns"] == len(turns)
        assert r["learned"] == "".join(x for role, x in turns if role == "assistant")


def test_long_conversation_and_spans(spark):
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else "user", "é" * (i % 7) + "🙂", 0.0) for i in range(700)]
    r = chats(spark, rows).collect()[0]
    assert r["n_turns"] == 700 and len(r["loss"]) == 350
    assert [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss"]] == [x[4] for x in rows if x[3] == "assistant"]


def test_control_strings(spark):
    t = R.Template()
    texts = ["", "\\", "\\\\n", "<s", "</s>[INST] ok [/INST]", "[[INST]]", "<<s>", "<|eot_id|><|eot_id|>", "\\<s>", "<|start_header_id|>user<|end_header_id|>x", "a\n\r b", "$1 \\$", "x" * 300000]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = df.select("i", R.escape(F.col("x"), t).alias("e"), R.unescape(R.escape(F.col("x"), t)).alias("u")).orderBy("i").collect()
    assert [r["u"] for r in got] == texts
    assert not any(c in r["e"] for r in got for c in t.controls)
    out = chats(spark, [(9, i, i - 1 if i else None, x, x, 0.0) for i, x in enumerate(texts)])
    turns = out.select(R.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert [tuple(x) for x in turns] == [(x, x) for x in texts]


def test_edges(spark):
    rows = [
        (None, 1, None, None, None, None), (None, 2, 1, "user", "", 1.0),  # a null tree, null role and text
        (5, 1, 77, "user", "orphan", 0.0),  # answers nothing that is there
        (6, 1, None, "user", "b", 0.0), (6, 1, None, "user", "a", 0.0),  # one id twice
        (7, 1, 2, "user", "x", 0.0), (7, 2, 1, "user", "y", 0.0), (7, 3, 1, "user", "z", 0.0), (7, 9, None, "user", "root", 0.0),  # a cycle
    ]
    got = {(r["tree"], r["leaf"]): [tuple(x) for x in r["t"]] for r in chats(spark, rows).withColumn("t", R.read_back(F.col("formatted"))).collect()}
    assert got == {(None, 2): [("", ""), ("user", "")], (5, 1): [("user", "orphan")], (6, 1): [("user", "a")], (7, 9): [("user", "root")]}
    assert chats(spark, []).count() == 0


def test_from_turns_ties_and_clashing_columns(spark):
    rows = [(1, 5, "user", "b"), (1, 5, "user", "a"), (1, None, "system", "s"), (1, 5, "user", "a"), (1, 3000, None, None), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("k")).withColumn("ID", F.lit(1)).withColumn("block", F.lit(2))
    m = R.from_turns(df, *map(F.col, ("conv_id", "turn", "role", "text")))
    got = {r["tree"]: [tuple(x) for x in r["t"]] for r in R.chats(m).withColumn("t", R.read_back(F.col("formatted"))).collect()}
    assert got == {1: [("system", "s"), ("user", "a"), ("user", "a"), ("user", "b"), ("", "")], None: [("user", "n")]}
    empty = R.from_turns(df.limit(0), *map(F.col, ("conv_id", "turn", "role", "text")))
    assert R.chats(empty).count() == 0


def test_registered_query(spark):
    got = {r["conv_id"]: r.asDict() for r in QUERIES["op11_reply_trees"](spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    rel = con.sql(ORACLES["op11_reply_trees"])
    want = {r[0]: dict(zip(rel.columns, r)) for r in rel.fetchall()}
    assert got == want
    both = "</s>[INST] ok [/INST]"
    assert got[-7]["loss_sha256"] == hashlib.sha256(both.encode()).hexdigest() and got[-7]["n_turns"] == 2
