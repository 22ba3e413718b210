"""The corpus pipeline: toxicity, language, near-duplicates, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet below the shared
checkpoint folder and read again as the next stage's ``docs``. All stages but
the last return the columns of documents. Each stage works on every row its
predecessor kept.

- toxicity: rows whose text scores 0.5 or more go. Learned from all labelled
  rows among the stage's own documents.
- language: rows whose text has no letter (or is null) go, as no language can
  be told, and rows predicted with a score of ``SURE`` or more to be in a
  language outside ``WANTED``, whatever their label says. Without a labelled row
  nothing is learned, and all rows with a letter stay.
- near_dups: of each class one row stays: the one with the least id, and of
  equal rows one.
- mixing: no row goes; the rows come out in the order of the mixture.
- packing: the rows in that order as windows of token ids.

Null and empty texts survive toxicity (nothing matches) and go at language.
Empty tables pass through all stages. Extra columns are kept up to packing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from report_lake.llm import dartminhash, langid, mixing, packing, toxicity
from report_lake.llm.common import fresh, read_table, stage


#: Languages the corpus is to hold, and the score from which another one is believed.
WANTED, SURE = ("de", "en", "fr"), 0.9


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the rows whose whole text is predicted toxic."""
    grammar = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    c = fresh(docs, "score", "toxic")
    scored = toxicity.score(docs, grammar, score_col=c["score"], predicted_col=c["toxic"])
    return scored.filter(F.col(c["toxic"]) == 0).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the rows in which no language can be told or that are in none of ``WANTED``."""
    network = langid.fit(docs)
    if not network.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    c = fresh(docs, "lang", "score")
    found = langid.predict(docs, network, lang_col=c["lang"], score_col=c["score"])
    unwanted = ~F.col(c["lang"]).isin(*WANTED) & (F.col(c["score"]) >= SURE)
    return found.filter((F.col(c["lang"]) != langid.UNDETERMINED) & ~unwanted).select(*docs.columns)


def near_dups_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near-duplicates; null texts all stay."""
    c = fresh(docs, "node", "id")
    node, rid = c["node"], c["id"]
    found = dartminhash.near_duplicates(docs)
    # the row that stays carries the class's least id; its text tells it from others with that id
    least = F.min(F.struct("doc_id", "node")).alias("x")
    kept = found.filter(F.col("label").isNotNull()).groupBy("label").agg(least).select(F.col("x.doc_id").alias(rid), F.col("x.node").alias(f"{node}_kept"))
    rows = docs.filter(F.col("text").isNotNull()).withColumn(node, F.unhex(F.md5("text")))
    rows = rows.join(kept, (F.col(node) == F.col(f"{node}_kept")) & F.col("doc_id").eqNullSafe(F.col(rid)), "left_semi")
    copies = found.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and node is not null").limit(1)
    if not copies.isEmpty():
        rows = rows.dropDuplicates(["doc_id", node])
    return rows.select(*docs.columns).unionByName(docs.filter(F.col("text").isNull()))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, written in the order of the mixture of sources."""
    mixed = mixing.mix(docs)
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of token ids over the documents, as boundary records with the ids' digests."""
    try:
        rows = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:  # docs were not read from files
        return packing.pack(docs, payload="crc32")
    return packing.pack(rows, payload="crc32", runs=("file", "row"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_dups", near_dups_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No stage but the reading is expressible in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
