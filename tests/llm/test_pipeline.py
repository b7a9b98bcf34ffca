"""Each stage of the pipeline on its own input, and the whole."""

import corpus_pipeline as C
from pyspark.sql import functions as F

from quire.llm import simhash_ball, suffix_decontam
from quire.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir, documents):
    assert [n for n, _ in C.STAGES] == ["language", "near_dedup", "decontaminate", "mixture", "tokenise"]
    stage = dict(C.STAGES)
    odd = spark.createDataFrame([(10**6, None, "en", "src0", 0), (10**6 + 1, "12 34", "en", "src0", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = materialise(stage["language"](spark, documents.unionByName(odd), sf_dir), "t")
    assert docs.columns == COLUMNS
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in documents.collect()}

    kept = materialise(stage["near_dedup"](spark, docs, sf_dir), "t")
    groups = {}
    for r in simhash_ball.similar_documents(docs).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == COLUMNS and sorted(ids) == sorted(groups)
    assert len({r.text for r in kept.collect()}) == len(ids)

    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = {r.doc_id for r in suffix_decontam.contamination(kept, bench).where("contaminated").collect()}
    clean = materialise(stage["decontaminate"](spark, kept, sf_dir), "t")
    assert clean.columns == COLUMNS and {r.doc_id for r in clean.collect()} == set(ids) - bad

    mixed = materialise(stage["mixture"](spark, clean, sf_dir), "t")
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == COLUMNS and max(counts.values()) <= 2 and set(counts) <= {r.doc_id for r in clean.collect()}

    out = stage["tokenise"](spark, mixed, sf_dir).collect()
    assert len(out) == mixed.count() and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_planted(spark, sf_dir, documents):
    text = documents.where("doc_id = 1").first().text
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(10**6, text, "en", "src0", 1), (10**6 + 1, item, "en", "src0", 1)]
    docs = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    stage = dict(C.STAGES)
    assert 10**6 not in {r.doc_id for r in stage["near_dedup"](spark, docs, sf_dir).collect()}
    assert 10**6 + 1 not in {r.doc_id for r in stage["decontaminate"](spark, docs, sf_dir).collect()}


def test_clashing_columns_and_missing_ids(spark, sf_dir, documents):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    text = documents.where("doc_id = 1").first().text
    rows = [(None, text, "en", "src0", 1), (None, "one of its kind " * 9, "en", "src0", 1), (None, "another of some kind " * 9, "en", None, 1), (None, item, "en", "src0", 1), (7 * 10**6, item + " x", "en", "src0", 1), (7 * 10**6, "nothing of that sort here " * 9, "en", "src0", 1)]
    docs = documents.where("doc_id < 40").unionByName(spark.createDataFrame(rows + rows[1:2], documents.schema))
    names = ["copies", "mix_key", "mix_h", "mix_id", "mix_copy", "h", "c1", "c2", "key", "bad", "id", "row", "col", "first", "component_id", "rejected", "rate"]
    docs = docs.select("*", *[F.lit(7).alias(c) for c in names])
    for name, f in C.STAGES[:-1]:
        out = materialise(f(spark, docs, sf_dir), name)
        assert out.columns == docs.columns and {tuple(r[c] for c in names) for r in out.collect()} == {(7,) * len(names)}
        if name == "near_dedup":
            assert sorted(r.text[:7] for r in out.where("doc_id is null").collect()) == sorted(["one of ", "another", item[:7]])
        if name == "decontaminate":
            assert sorted(r.text[:7] for r in out.where("doc_id is null").collect()) == ["another", "one of "]
            assert [r.text[:7] for r in out.where("doc_id = 7000000").collect()] == ["nothing"]
        docs = out
    assert C.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_empty_and_whole(spark, sf_dir, documents):
    docs = documents.limit(0)
    for name, f in C.STAGES:
        docs = materialise(f(spark, docs, sf_dir), name)
        assert docs.count() == 0
    first = sorted(map(tuple, C.run(spark, sf_dir).collect()))
    assert first and first == sorted(map(tuple, C.run(spark, sf_dir).collect()))
