"""The corpus pipeline: five operators, each working on all that the one before kept.

``run`` writes each stage's result as Parquet in the shared folder and reads it again for
the next. All stages but the last return the columns of ``documents``.

Defined results: a document without text or letters is rejected by the first stage; of
near-duplicates the one with the smallest doc_id stays, and rows that repeat it with the same
text are one document; documents without a doc_id are told apart by their texts; an empty table
stays empty; columns beyond those of documents, whatever their names, are carried along by the
stages that filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import arrow_tokens, entropy_mix, lang_embed, simhash_ball, suffix_decontam
from quire.llm.common import materialise, release


def _rows(docs: DataFrame) -> DataFrame:
    """Every row as one struct, so that no column of the input clashes with those of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told. Learns from three quarters of the labelled documents."""
    model = lang_embed.train(docs.where(F.coalesce(lang_embed.remainder() != 2, F.lit(True))))
    return lang_embed.keep_known(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near-duplicates: copies, and texts whose five-word shingles are 0.8 alike."""
    found = simhash_ball.similar_documents(docs)
    # The representative is told by its text too: null doc_ids are many documents.
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.struct("doc_id", "c1", "c2").alias("first")).distinct()
    t = F.coalesce(F.col("row.text"), F.lit(""))
    own = F.struct(F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("c1"), F.xxhash64(F.lit("copy"), t).alias("c2"))
    kept = _rows(docs).join(first, own.eqNullSafe(F.col("first")), "left_semi")
    return kept.withColumns({"id": F.col("row.doc_id"), "text": t}).dropDuplicates(["id", "text"]).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the contamination rule finds against the benchmark. Rows that share a doc_id are told apart by their texts."""
    key = lambda d, t: F.concat_ws(":", F.coalesce(F.col(d).cast("string"), F.lit("")), F.xxhash64(F.coalesce(F.col(t), F.lit(""))), F.xxhash64(F.lit("copy"), F.coalesce(F.col(t), F.lit(""))))
    judged = docs.select(key("doc_id", "text").alias("key"), F.col("text").alias("text"))
    found = suffix_decontam.contamination(judged, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="key", places=False)
    bad = found.where("contaminated").select(F.col("doc_id").alias("bad"))
    return _rows(docs).withColumn("key", key("row.doc_id", "row.text")).join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their targets."""
    plan = entropy_mix.mix(docs).where("copies > 0").groupBy("doc_id", "h").agg(F.max("copies").alias("copies"))
    plan = plan.select(F.col("doc_id").alias("mix_id"), F.col("h").alias("mix_h"), "copies")
    own = _rows(docs).withColumn("mix_key", F.xxhash64(F.lit("mix"), F.col("row.doc_id"), F.col("row.text")))
    both = own.join(plan, F.expr("row.doc_id <=> mix_id and mix_key = mix_h"))
    return both.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids as Arrow sequence files and return what was written for each document."""
    return arrow_tokens.tokens(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("tokenise", tokenise),
]
#: SQL cannot express the first stage's model; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
