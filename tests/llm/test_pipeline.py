import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as C
from llm_helpers import SF, docs_of  # noqa: F401
from report_lake.llm import dartminhash, langid, packing, toxicity


def corpus():
    rng = random.Random(7)
    words = {"en": [f"en{i}the" for i in range(400)], "fr": [f"éle{i}que" for i in range(400)]}
    rows, labels = [], []
    for i in range(160):
        lang = "en" if i % 2 else "fr"
        text = " ".join(rng.choice(words[lang]) for _ in range(180 if i == 6 else rng.randrange(30, 90))) + "."
        if i % 8 == 3:
            text += " You are a zorgling."
        rows.append([i, text, lang, f"src{min(3, i % 9)}"])
        if i % 3 or i % 8 == 3:
            labels.append((i, 1, int(i % 8 == 3)))
    for n in range(12):
        rows.append([200 + n, rows[5][1], "en", "src0"])  # exact copies
        w = rows[6][1].split()
        w[3 + n] = f"changed{n}"
        rows.append([300 + n, " ".join(w), "fr", "src1"])  # near copies
    rows += [[400, None, "en", "src0"], [401, "", "en", None], [402, "123 456", "en", "src0"], [403, rows[9][1], None, None], [403, rows[9][1], None, None]]
    return [(*r, len(r[1] or "")) for r in rows], labels


def test_stages_against_brute_force(spark, tmp_shared):
    sf = tmp_shared("sf")
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "near_dups", "mixing", "packing"]
    docs, at = spark.read.parquet(f"{sf}/documents.parquet"), {}
    from report_lake.llm.common import stage

    for name, f in C.STAGES:
        docs = stage(f(spark, docs, sf), f"test-{name}")
        at[name] = docs
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(at[n].columns == columns for n, _ in C.STAGES[:-1])
    clean = {r[0] for r in rows if not (r[1] or "").endswith("zorgling.")}
    assert {r["doc_id"] for r in at["toxicity"].collect()} == clean and at["toxicity"].count() == len([r for r in rows if r[0] in clean])
    kept = [r for r in rows if r[0] in clean and r[1] is not None and langid.LETTER.search(r[1])]
    assert sorted(r["doc_id"] for r in at["language"].collect()) == sorted(r[0] for r in kept)
    # brute force over all pairs
    texts = {r[0]: r[1] for r in kept}
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and dartminhash.similarities([texts[a].encode()], [texts[b].encode()])[0] >= 0.8:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    want = sorted({root(i) for i in texts})
    assert sorted(r["doc_id"] for r in at["near_dups"].collect()) == want
    assert not {200, 205, 300, 311, 403} & set(want) and {5, 6, 9} <= set(want)
    assert sorted(r["doc_id"] for r in at["mixing"].collect()) == want
    pieces = at["packing"].collect()
    t = Tokenizer.from_file(packing.vocabulary()["json"])
    for i in want:
        ids = t.encode(texts[i], add_special_tokens=False).ids + [0]
        mine = sorted((p["start"], p["length"], p["ids_crc32"]) for p in pieces if p["doc_id"] == i)
        assert mine[0][0] == 0 and sum(p[1] for p in mine) == len(ids)
        assert all(zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) == c for s, n, c in mine)
    assert sum(p["length"] for p in pieces) == sum(len(t.encode(texts[i], add_special_tokens=False).ids) + 1 for i in want)
    same = lambda df: sorted(tuple(r) for r in df.collect())
    assert same(C.run(spark, sf)) == same(at["packing"])


def test_language_stage_rejects_by_the_prediction(spark, docs_of):
    rng = random.Random(3)
    words = {"en": ["the", "house", "with", "which", "thing", "would", "they"], "xx": ["zqok", "qzuu", "kkzoq", "uuqkz", "qoqo", "zukk"]}
    text = lambda k: " ".join(rng.choice(words[k]) for _ in range(400))
    rows = [(i, text(k), k) for i, k in enumerate(["en", "xx"] * 200)]
    rows += [(500, text("xx"), None), (501, text("xx"), "en"), (502, text("en"), None), (503, text("en"), "xx"), (504, "12 34", "en"), (505, None, "en")]
    got = {r["doc_id"] for r in C.language_stage(spark, docs_of(rows), "").collect()}
    assert got == {r[0] for r in rows[:400] if r[2] == "en"} | {502, 503}
    untaught = [(1, "clean text", None), (2, "more text", ""), (3, "42", None), (4, None, None)]
    assert {r["doc_id"] for r in C.language_stage(spark, docs_of(untaught), "").collect()} == {1, 2}


def test_repeated_ids_with_different_texts_stay(spark):
    rows = [(5, "alpha beta gamma delta epsilon", "en", "a", 1), (5, "one two three four five six", "en", "a", 1), (6, "alpha beta gamma delta epsilon", "en", "a", 1), (None, None, "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in C.near_dups_stage(spark, df, "").collect())
    assert got == [(0, ""), (5, "alpha beta gamma delta epsilon"), (5, "one two three four five six")]


def test_empty_tables(spark, tmp_shared):
    sf = tmp_shared("empty")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, f in C.STAGES:
        docs = f(spark, docs, sf)
        assert docs.count() == 0
    assert toxicity.Grammar().words


def test_language_stage_on_the_given_tables(spark):
    """Spanish is not wanted: its rows go by the prediction, the others stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text rlike '[a-z]'")
    kept = {r["doc_id"] for r in C.language_stage(spark, docs, "").select("doc_id").collect()}
    rows = docs.select("doc_id", "lang", "n_chars").where("n_chars >= 200").collect()
    gone = {lang: sum(r["doc_id"] not in kept for r in rows if r["lang"] == lang) / max(1, sum(r["lang"] == lang for r in rows)) for lang in ("de", "en", "es", "fr")}
    assert gone["es"] > 0.9 and max(gone["de"], gone["en"], gone["fr"]) < 0.02, gone
