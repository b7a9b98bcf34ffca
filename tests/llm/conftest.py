import pytest
from pyspark.sql import functions as F

NAMES = ["h", "h1", "h2", "n", "k", "th", "doc", "pos", "fp", "key", "size", "bucket", "edges", "items", "spans", "kept", "v", "dim", "shard", "score", "rank", "node", "root", "copies", "words", "rejected", "p", "row"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text[, lang, source]) with columns whose names the operators use inside."""

    def make(rows, clash=True):
        rows = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        df = df.withColumn("n_chars", F.length("text").cast("long"))
        return df.select("*", *[F.lit("x").alias(c) for c in NAMES]) if clash else df

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
