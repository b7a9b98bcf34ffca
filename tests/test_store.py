"""The stored bank: batches, deletes, merging, expiry and the search index."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quire.plans.bank import CHILDREN, Bank, BankChangedError, BankMissingError
from quire.plans.scratch import written
from quire.plans.store import BankStore
from quire.sources.files import STAGES

BOX = {"x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0}
WORDS = [f"w{k}" for k in range(60)]


def batch(spark, keys, tag, seed=0, words=20):
    rnd = random.Random(f"{tag}{seed}")
    rows = []
    for paper, question in keys:
        text = " ".join(rnd.choice(WORDS) for _ in range(words))
        f = lambda k: {"latex": f"{tag}{k}", "bbox": {**BOX, "x1": float(k)}}
        rows.append({
            "paper": paper, "question": question, "page": 1, "marks": rnd.randrange(9), "text": None if question % 13 == 5 else f"{tag} {text}", "topics": [rnd.choice("XYZ"), tag],
            "images": [{"file": f"{tag}.png", "bbox": BOX}], "tables": [{"headers": ["h"], "rows": [[tag], []], "bbox": BOX}], "formulas": [f(1), f(2)],
            "question_images": [{"page": 1, "file": "q.png", "bbox": BOX}], "options": [{"label": "A", "text": tag, "formulas": [f(2)]}],
        })
    return spark.createDataFrame(rows, STAGES["classified_questions"])


def same(a: Bank, b: Bank):
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    for t in ("papers", "questions", *CHILDREN):
        assert rows(a.t[t]) == rows(b.t[t]), t
    for query in ('w1 w2 OR "w3 w4" OR ^second', "w1* NOT w2"):
        x, y = ({(r.paper_code, r.question): r.score for r in bank.hits(query, None).collect()} for bank in (a, b))
        assert x == pytest.approx(y), query


def kept(bank):
    return Bank(bank.spark, {t: written(df) for t, df in bank.t.items()})


def written_files(path):
    return {(os.path.join(d, f), os.path.getmtime(os.path.join(d, f))) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def old_commit(state):
    return min(p[0] for p in state["parts"]["questions"])


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_batches_with_a_reader_between(spark, tmp_path):
    path, first = str(tmp_path / "b"), [(f"p{k % 10}", k) for k in range(400)]
    store = BankStore(spark, path, buckets=4, term_buckets=4)
    plain = kept(Bank.of(spark).upsert(a := batch(spark, first, "first")))
    assert store.upsert(a)["docs"] == 400
    reader, files = store.snapshot(), written_files(path)
    old = sorted(map(str, reader.t["questions"].collect()))
    plain = kept(plain.upsert(b := batch(spark, [("p3", 3), ("new", 1), ("p3", 13)], "second")))
    state = store.upsert(b)
    assert files <= written_files(path), "nothing that is there is written again"
    own = {t: [p for p in parts if p[0] > old_commit(state)] for t, parts in state["parts"].items()}
    assert {t: store._read(t, own[t]).count() for t in own} == {"papers": 1, "questions": 3, "question_topics": 6, "images": 3, "question_images": 3, "formulas": 6, "tables": 3, "options": 3, "touched": 3, "retired": 3, "postings": store._read("postings", own["postings"]).count()}
    assert store._read("postings", own["postings"]).select("question").distinct().count() == 3
    plain = plain.upsert(c := batch(spark, [("p3", 3), ("p4", 4), ("new", 2)], "third"))
    store.upsert(c)
    same(store.snapshot(), plain)
    # The reader keeps the state that it opened, in tables and index.
    assert sorted(map(str, reader.t["questions"].collect())) == old
    assert reader.hits("third", None).count() == 0 and store.snapshot().hits("third", None).count() == 3
    assert [r.paper_id for r in store.snapshot().t["papers"].where("paper_code = 'new'").collect()] == [11]


def test_delete_compact_expire(spark, tmp_path):
    path = str(tmp_path / "b")
    store = BankStore(spark, path, buckets=3, term_buckets=3)
    plain = Bank.of(spark)
    for k, tag in enumerate(["first", "second", "third", "fourth"]):
        rows = batch(spark, [(f"p{j % 4}", j) for j in range(k, 60 if k == 0 else k + 8)], tag)
        plain = kept(plain.upsert(rows))
        store.upsert(rows)
    gone = spark.createDataFrame([("p1", 1), ("p2", 2), ("nobody", 7), (None, 1)], "paper_code string, question long")
    state = store.delete(gone)
    left = lambda t: written(plain.t[t].join(gone, ["paper_code", "question"], "left_anti"))
    want = Bank(spark, {"papers": plain.t["papers"], **{t: left(t) for t in ("questions", *CHILDREN)}})
    assert state["docs"] == want.t["questions"].count()
    before, n = size(path), len(state["parts"]["questions"])
    state = store.compact(fanout=2)
    assert len(state["parts"]["questions"]) < n and size(path) > before
    same(store.snapshot(), want)
    for _ in range(4):
        state = store.compact(fanout=1)
    assert all(len({p[0] for p in state["parts"][t] if p[1] == b}) <= 1 for t in state["parts"] for b in range(3) if t not in ("touched", "retired"))
    assert not state["parts"]["touched"] and not state["parts"]["retired"]
    assert store.expire(keep=1) > 0 and store.expire(keep=1) == 0
    assert size(path) < before
    again = batch(spark, [("p1", 1), ("p9", 1)], "seventh")
    store.upsert(again)
    same(store.snapshot(), want.upsert(again))


def test_old_states_are_merged_in_steps(spark, tmp_path):
    """The oldest and largest part is left alone while the newer ones are small."""
    store = BankStore(spark, str(tmp_path / "b"), buckets=1, term_buckets=1)
    store.upsert(batch(spark, [("p", k) for k in range(3000)], "base", words=60))
    for k in range(4):
        store.upsert(batch(spark, [("p", k)], f"t{k}"))
    base = store.manifest()["parts"]["questions"][0]
    state = store.compact(fanout=3)
    assert base in state["parts"]["questions"] and len(state["parts"]["questions"]) == 2
    assert store.snapshot().counts().first().questions == 3000


def test_a_query_reads_its_buckets_only(spark, tmp_path):
    store = BankStore(spark, str(tmp_path / "b"), term_buckets=16)
    store.upsert(batch(spark, [("p", k) for k in range(50)], "first"))
    index = store.snapshot().index
    buckets = lambda df: {f.split("/")[-2] for f in df.inputFiles()}
    one = buckets(index.postings(["w1"]))
    assert len(one) == 1 and one | buckets(index.postings(["w2"])) == buckets(index.postings(["w1", "w2"]))
    assert len(buckets(index.postings(None))) == 16
    plan = store.snapshot().hits("w1 w2", 5)._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in plan and "text#" not in plan


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "b")
    BankStore(spark, path).upsert(batch(spark, [("p", 1)], "first"))
    slow = BankStore(spark, path)
    begun = slow._begin
    slow._begin = lambda: (begun(), BankStore(spark, path).upsert(batch(spark, [("p", 2)], "second")))[0]
    with pytest.raises(BankChangedError):
        slow.upsert(batch(spark, [("p", 3)], "third"))
    assert sorted(r.question for r in Bank.load(spark, path).t["questions"].collect()) == [1, 2]
    # A manifest whose writer has died is passed over.
    (tmp_path / "b" / "current-000000000002").write_text('{"number": 2, "par')
    BankStore(spark, path).upsert(batch(spark, [("p", 4)], "fourth"))
    assert Bank.load(spark, path).counts().first().questions == 3


def test_empty(spark, tmp_path):
    store = BankStore(spark, str(tmp_path / "b"))
    with pytest.raises(BankMissingError):
        store.snapshot()
    store.upsert(batch(spark, [("p", 1)], "first").limit(0))
    assert store.snapshot().counts().first() == (0, 0)
    assert store.snapshot().search("anything").count() == 0
    store.delete(spark.createDataFrame([("p", 1)], "paper_code string, question long"))
    assert store.snapshot().t["questions"].agg(F.count("*")).first()[0] == 0
