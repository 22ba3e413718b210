import numpy as np
from pyspark.sql import functions as F

from llm_helpers import docs_of, sf_docs  # noqa: F401
from report_lake.llm import langid as L
from report_lake.llm.common import fold


def small_network(seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(97, 123, (40, L.LENGTH)).astype(np.uint8)
    x[:20, ::3] = 97
    return x, L.train(x, np.repeat([0, 1], 20), ["aa", "bb"], epochs=60)


def test_windows_read_every_byte_group_once():
    for n in (0, 1, 3, 4, 255, 256, 257, 509, 510, 2000):
        data = bytes(np.random.default_rng(n).integers(1, 60, n).astype(np.uint8))
        x, owner, left = L.cut([b"first", data])
        mine = x[owner == 1]
        got = [bytes(w[i : i + 4]) for w, k in zip(mine, left[owner == 1]) for i in range(max(0, k - 3))]
        assert got == [data[i : i + 4] for i in range(max(0, n - 3))]


def test_tables_equal_direct_convolutions():
    x, net = small_network()
    e = net.embed[x[:3]]
    pooled = []
    for w in L.WIDTHS:
        act = sum(e[:, j : j + L.LENGTH - 3] @ net.filters[w][j] for j in range(w)) + net.bias[w]
        pooled.append(act.max(axis=1))
    z = np.maximum(np.concatenate(pooled, 1), 0) @ net.out + net.out_bias
    want = z - z.max(1, keepdims=True) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True))
    assert np.allclose(net.log_probs(x[:3]), want, atol=1e-4)


def test_training_separates():
    x, net = small_network()
    assert (net.log_probs(x).argmax(1) == np.repeat([0, 1], 20)).mean() > 0.9


def test_held_out_accuracy(sf_docs):
    net = L.fit(sf_docs, fold(F.col("doc_id")) != 0)
    assert net.langs == ["de", "en", "es", "fr"]
    held = L.predict(sf_docs.filter(fold(F.col("doc_id")) == 0), net)
    right, n = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.96 * n


def test_edges(docs_of):
    rows = [(1, None, "aa"), (2, "", "aa"), (3, "123 !!", "bb"), (4, "aza" * 90000, "aa"), (5, "²", None), (5, "²", None), (6, "Über", "")]
    docs = docs_of(rows).withColumn("_language", F.lit(1)).withColumn("score", F.lit("x"))
    _, net = small_network()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(docs, net).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 5))
    assert got[4][0] in net.langs and got[6][0] in net.langs and 0 < got[4][1] <= 1
    assert L.predict(docs_of([]), net).count() == 0
    untaught = L.fit(docs_of([(1, "text", None)]))
    assert untaught.langs == [] and L.predict(docs, untaught).filter("lang_pred <> 'und'").count() == 0
    one = L.fit(docs_of([(1, "some text in one language only", "xx"), (1, "some text in one language only", "xx")]))
    assert [r["lang_pred"] for r in L.predict(docs.filter("doc_id = 4"), one).collect()] == ["xx"]


def test_languages_without_a_long_enough_text_are_not_learned(spark):
    short = [(i, lang, "hello you") for i, lang in enumerate(("en", "de", None, ""))]
    docs = spark.createDataFrame(short, "doc_id long, lang string, text string")
    net = L.fit(docs)
    assert net.langs == []
    assert {(r["lang_pred"], r["score"]) for r in L.predict(docs, net).collect()} == {("und", 0.0)}
    both = docs.unionByName(spark.createDataFrame([(9, "fr", "une phrase assez longue pour apprendre"), (9, "fr", "une phrase assez longue pour apprendre")], docs.schema))
    net = L.fit(both)
    assert net.langs == ["fr"]
    assert {r["lang_pred"] for r in L.predict(both, net).collect()} == {"fr"}
    assert L.predict(both.limit(0), net).count() == 0 and L.fit(both.limit(0)).langs == []
