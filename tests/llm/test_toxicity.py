from pyspark.sql import functions as F

from llm_helpers import SF, docs_of  # noqa: F401
from report_lake.llm import toxicity as T
from report_lake.llm.common import fold


def kinds(text):
    return {k for k, v in zip(T.CONTEXTS, T.Grammar().features(text)) if v}


def test_grammar_contexts():
    assert kinds("What an idiot.") == {"plain"}
    assert kinds("You are such an idiot!") == {"targeted"}
    assert kinds("He is not an idiot.") == {"negated"}
    assert kinds("She said the idiot left.") == {"reported"}
    assert kinds('the word "idiot" is old') == {"reported"}
    assert kinds("I will kill you") == {"threat"}
    assert kinds("I will not kill you") == {"negated"}  # the negation reaches the target
    assert kinds("They kill time. The idiotic plan") == set()
    assert kinds("") == kinds(None) == set()


def test_clauses_are_scored_apart():
    g = T.Grammar()
    assert g.features("You left. An idiot came.")[T.CONTEXTS.index("plain")] == 1.0
    assert g.features("idiot. idiot. idiot")[0] == 3.0
    assert g.features("idiot moron")[0] == 1.0  # one clause counts once
    assert g.score(g.features("nice day")) < 0.5 < g.score(g.features("you idiot"))
    assert g.score(g.features("he is not an idiot")) < g.score(g.features("he is an idiot"))


def test_choose_arcs_prefers_shared_stems_and_drops_chance_words():
    rows = {i: {"blor" + s, "the"} for i, s in enumerate("abcdefghij")}
    supports = {}
    for i, words in rows.items():
        for w in words - {"the"}:
            for c in (w, *(w[:k] + "*" for k in range(3, len(w)))):
                supports.setdefault(c, set()).add(i)
    arcs, dense = T.choose_arcs({c: frozenset(s) for c, s in supports.items()}, {}, 10, 100)
    assert list(arcs) == ["blor*"] and not dense


def test_dense_arcs_need_company():
    g = T.Grammar(dense=("zor*", "mik"))
    at = T.CONTEXTS.index("dense")
    assert [g.features(t)[at] for t in ("zorba came", "zorba came, mik left", "mik " + "word " * 500 + "zorg", "miko zo")] == [0, 1, 0, 0]
    assert "zorba*+" not in T._candidates("zorbas " + "word " * 10, 4, 7) and "zorb*+" in T._candidates("zorba zorbi", 4, 7)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    g = T.fit(docs, labels, train=lambda i: fold(i) != 0)
    held = T.score(docs.filter(fold(F.col("doc_id")) == 0), g).join(labels, "doc_id")
    got = {(r["toxic"], r["predicted"]): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert got.get((0, 1), 0) <= 0.01 * sum(got.values())
    # some labelled rows hold no toxic word at all
    assert got[1, 1] >= 0.9 * (got[1, 1] + got.get((1, 0), 0))


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "You idiot"), (3, "You idiot"), (4, "word " * 50000 + "you moron."), (None, "fine")]
    docs = docs_of(rows).withColumn("score", F.lit("mine")).withColumn("Predicted", F.lit(7))
    got = sorted((r["doc_id"] or 0, r["predicted"], 0 <= r["score"] <= 1) for r in T.score(docs.drop("Predicted"), T.Grammar()).collect())
    assert got == [(0, 0, True), (1, 0, True), (2, 0, True), (3, 1, True), (3, 1, True), (4, 1, True)]
    assert T.score(docs_of([]), T.Grammar()).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.fit(docs_of(rows), labels).words == T.Grammar().words
    labels = spark.createDataFrame([(3, None, 1), (1, 1, None), (None, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert T.score(docs_of(rows), T.fit(docs_of(rows), labels)).count() == 6
    assert spark.read.parquet(f"{SF}/labels.parquet").count() > 0
