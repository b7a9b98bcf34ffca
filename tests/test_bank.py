import re
import shutil

import pytest
from pyspark.sql import functions as F

from quire.operators import fts, merge, topics
from quire.plans.bank import Bank, BankMissingError
from quire.sources import adapters
from quire.sources.files import STAGES, find_pdfs, read_stage, write_stage
from quire.streaming.ingest import ingest

BOX = {"x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0}


def built(spark, rows):
    base = {"images": [], "tables": [], "formulas": [], "question_images": [], "options": [], "topics": [], "page": 1, "marks": 1}
    return spark.createDataFrame([{**base, **r} for r in rows], STAGES["classified_questions"])


def test_upsert_replaces(spark, tmp_path):
    bank = Bank.of(spark).upsert(built(spark, [{"paper": "9702/12/O/N/25", "question": 1, "text": "a", "topics": ["X"]}, {"paper": "9702/12/O/N/25", "question": 2, "text": "kept"}]))
    bank.save(str(tmp_path / "b"))
    bank = Bank.load(spark, str(tmp_path / "b")).upsert(built(spark, [{"paper": "9702/12/O/N/25", "question": 1, "text": "b", "topics": ["Y", "Y"]}]))
    got = {r.question: (r.text, r.topics) for r in bank.all().collect()}
    assert got == {1: ("b", ["Y"]), 2: ("kept", [])}
    assert bank.counts().first() == (1, 2)
    assert bank.by_reference("9702/12/O/N/25", 2).first().text == "kept"
    assert bank.find(topic="y").first().question == 1
    assert bank.random(count=1, seed=3, subject="9702", variant="12", min_marks=1).count() == 1
    bank.check()
    with pytest.raises(BankMissingError, match="nothing"):
        Bank.load(spark, str(tmp_path / "nothing"))
    with pytest.raises(BankMissingError):
        Bank.of(spark).check()


def test_formula_is_stored_once(spark):
    f = {"latex": "x", "bbox": BOX}
    other = {"latex": "y", "bbox": {**BOX, "x1": 2.0}}
    bank = Bank.of(spark).upsert(built(spark, [{"paper": "p", "question": 1, "text": "t", "formulas": [f, other], "options": [{"label": "B", "text": "", "formulas": [f]}]}]))
    assert sorted((r.label or "", r.latex) for r in bank.t["formulas"].collect()) == [("", "y"), ("B", "x")]
    out = bank.export().first()
    assert [x.latex for x in out.formulas] == ["y"] and [x.latex for x in out.options[0].formulas] == ["x"]


def test_parts_keep_their_order(spark):
    f = lambda x, k: {"latex": x, "bbox": {**BOX, "x1": float(k)}}
    images = [{"file": x, "bbox": BOX} for x in ("z.png", "a.png", "m.png")]
    opts = [{"label": x, "text": "", "formulas": [f("q", 7), f("p", 8)] if x == "B" else []} for x in "BA"]
    bank = Bank.of(spark).upsert(built(spark, [{"paper": "p", "question": 1, "text": "t", "images": images, "formulas": [f("y", 3), f("x", 2)], "options": opts}]))
    got, out = bank.all().first(), bank.export().first()
    assert [x.file for x in got.images] == ["z.png", "a.png", "m.png"] and [x.latex for x in got.formulas] == ["y", "x", "q", "p"] and [x.label for x in got.options] == ["B", "A"]
    assert [x.latex for x in out.formulas] == ["y", "x"] and [x.latex for x in out.options[0].formulas] == ["q", "p"]


def test_equal_loads_take_one_row(spark):
    rows = [{"paper": "p", "question": 1, "text": t, "topics": [t]} for t in "bca"]
    got = Bank.of(spark).upsert(built(spark, rows)).all().first()
    assert got.topics == [got.text] == ["c"]


def test_unreadable_bank_is_not_missing(spark, tmp_path):
    path = tmp_path / "b"
    bank = Bank.of(spark).upsert(built(spark, [{"paper": "p", "question": 1, "text": "t"}]))
    bank.save(str(path))
    bank.save(str(path))
    assert sorted(x.name for x in path.iterdir() if x.name.startswith("current-")) == ["current-000000000000", "current-000000000001"]
    (path / "questions").rename(path / "gone")
    with pytest.raises(Exception) as e:
        Bank.load(spark, str(path)).counts().first()
    assert not isinstance(e.value, BankMissingError)
    write_stage(built(spark, [{"paper": "p", "question": 1, "text": "new"}]).coalesce(1), str(tmp_path / "in"))
    with pytest.raises(Exception):
        ingest(spark, str(tmp_path / "in"), str(path), str(tmp_path / "cp")).awaitTermination(60)
    shutil.rmtree(path / "questions", ignore_errors=True)
    (path / "gone").rename(path / "questions")
    assert Bank.load(spark, str(path)).counts().first().questions == 1


def test_last_source_wins(spark):
    a = built(spark, [{"paper": "p", "question": 1, "text": "a"}])
    b = built(spark, [{"paper": "p", "question": 1, "text": "b"}, {"paper": "p", "question": 2, "text": "b2"}])
    assert {r.question: r.text for r in Bank.merged(spark, [a, b]).all().collect()} == {1: "b", 2: "b2"}
    rows = merge.union_sources([a.select("paper", "question"), b.select("paper", "question")]).withColumn("source", F.col("load_seq")).withColumn("row_seq", F.lit(0))
    assert merge.overrides(rows, ["paper", "question"]).count() == 1


def test_stream(spark, tmp_path):
    write_stage(built(spark, [{"paper": "p", "question": 1, "text": "momentum"}]).coalesce(1), str(tmp_path / "in"))
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "bank"), str(tmp_path / "cp")).awaitTermination(60)
    assert Bank.load(spark, str(tmp_path / "bank")).search("momentum").first().question == 1


def test_topics(spark):
    q = spark.createDataFrame([(1, "velocity and momentum", "x/1"), (2, "nothing here", "9702/1")], "id int, text string, paper string")
    got = {r.id: r.topics for r in topics.classify(q, topics.lexicon(spark), ["id"]).collect()}
    assert got == {1: ["Mechanics", "Momentum"], 2: []}
    scored = topics.score(q.withColumn("subject", F.lit(None).cast("string")), topics.lexicon(spark), ["id"]).where("topic = 'Mechanics'").first()
    assert scored.score == 3


def ids(spark, docs, query):
    df = spark.createDataFrame(list(enumerate(docs, 1)), "id int, text string")
    index = fts.postings(df, ["id"])
    return {r.id: r.score for r in fts.search(index, query, ["id"], len(docs), sum(len(re.findall(r"\w+", d)) for d in docs), None).collect()}


def test_search(spark):
    docs = ["alpha beta", "alpha gamma gamma delta", "alpha", "beta alpha alpha"]
    got = ids(spark, docs, "beta")
    assert got[1] == pytest.approx(-1.0891e-6, rel=1e-4) and got[4] == pytest.approx(-9.2437e-7, rel=1e-4)
    assert set(ids(spark, docs, "alpha NOT beta OR delta")) == {2, 3}
    docs = ["a1 b1", "c1", "a1 c1", "b1", "a1", "a1 b1 c1"]
    for query, want in (("a1 b1 OR c1", {1, 2, 3, 6}), ("a1 NOT b1 c1", {1, 3, 5}), ("a1 NOT b1 AND c1", {3}), ("a1 NOT b1 NOT c1", {5}), ('"b1 c1"', {6}), ("b1 + c1", {6}), ("^c1", {2}), ("a*", {1, 3, 5, 6}), ("Á1 (", None), ("a1 (b1 OR c1)", None), ("", None), ("newton's", None)):
        if want is None:
            with pytest.raises(fts.QuerySyntaxError):
                fts.parse(query)
        else:
            assert set(ids(spark, docs, query)) == want, query
    assert set(ids(spark, ["Éa ballon", "ball"], "ea BALLON")) == {1}


def test_adapters(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\n- p"), (2, "bb")], "id int, prompt string")
    out = adapters.apply_model(df, "prompt", lambda: adapters.stub_tutor("grade"), "grade", "struct<marks_awarded:int,max_marks:int,feedback:string>")
    assert [r.grade.max_marks for r in out.orderBy("id").collect()] == [1, 0]
    with pytest.raises(adapters.UnknownProviderError):
        adapters.stub_tutor("chat", "nobody")

    def shaky(items):
        if len(items) > 1 or items[0] == "bad":
            raise ValueError
        return [items[0].upper()]

    assert adapters.batched(lambda: shaky, ["a", "bad", "c"], 2) == ["A", None, "C"]
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "b.PDF").write_bytes(b"1")
    (tmp_path / "a.pdf").write_bytes(b"22")
    (tmp_path / "a.txt").write_bytes(b"")
    assert sorted(r.stem for r in find_pdfs(spark, str(tmp_path)).collect()) == ["a", "b"]
    d = tmp_path / "paper" / "layout"
    d.mkdir(parents=True)
    (d / "layout.json").write_text('[{"page": 1, "width": 5.0, "height": 6.0, "regions": []}]')
    assert read_stage(spark, str(d / "layout.json"), "layout").first().paper_key == "paper"
