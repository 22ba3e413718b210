import zlib

import pytest

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fold_of(doc_id, folds=5):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text[, lang[, source]]) as a documents table."""

    def make(rows, partitions=3):
        full = [(*r, *([None] * (4 - len(r))), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions) if rows else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("Python", "Pandas", "Arrow", "ExistingRDD") if w in plan]
