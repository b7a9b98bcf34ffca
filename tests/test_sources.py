"""Listings, batches, quarantine, report lists and the library's small functions on golden cases."""

import pytest
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as X
from quire.operators import assemble, audit, quarantine
from quire.plans.bank import Bank
from quire.sources import adapters, files, listing


def touch(path, text="{}"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_output_trees(spark, tmp_path):
    batch, single = tmp_path / "batch", tmp_path / "single"
    touch(batch / "9702_s03_qp_1" / "topics" / "classified_questions.json")
    touch(batch / "9702_s03_qp_2" / "images" / "a.png")
    touch(batch / "notes" / "readme.txt")
    touch(batch / "deep" / "sub" / "images" / "a.png")
    touch(single / "images" / "a.png")
    touch(single / "inner" / "images" / "a.png")
    table = listing.listing(spark, {"batch": str(batch), "single": str(single)})
    assert {(r.source, r.path) for r in table.collect()} >= {("batch", "notes/readme.txt"), ("single", "images/a.png")}
    assert {tuple(r) for r in listing.paper_dirs(table).collect()} == {("batch", "9702_s03_qp_1", "9702_s03_qp_1"), ("batch", "9702_s03_qp_2", "9702_s03_qp_2"), ("single", "single", "")}
    assert {tuple(r) for r in listing.expected_stems(table).collect()} == {("batch", x) for x in ("9702_s03_qp_1", "9702_s03_qp_2", "notes", "deep")} | {("single", "images"), ("single", "inner")}
    touch(batch / "deep" / "x.pdf")
    touch(batch / "y.pdf")
    table = listing.listing(spark, {"batch": str(batch)})
    assert sorted(r.stem for r in listing.expected_stems(table).collect()) == ["x", "y"]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("Schema", 1)[-1]


def test_assets_by_priority(spark):
    there = spark.createDataFrame([(p,) for p in ["out/a.png", "out/9702_w09_qp_2/images/a.png", "9702_w09_qp_21/images/b.png", "out/9702_w09_qp_2/images/b.png", "9702_w03_qp_5/images/c.png"]], "path string")
    wanted = spark.createDataFrame([("9702/21/O/N/09", f) for f in ("a.png", "b.png", "z.png")] + [("9702/05/O/N/03", "c.png"), ("odd", "a.png"), ("odd", "b.png"), (None, "a.png")], "paper_code string, file string")
    got = {(r.paper_code, r.file): r.path for r in listing.locate(wanted, there, "out", "images").collect()}
    assert got == {
        ("9702/21/O/N/09", "a.png"): "out/a.png", ("9702/21/O/N/09", "b.png"): "out/9702_w09_qp_2/images/b.png", ("9702/21/O/N/09", "z.png"): None,
        ("9702/05/O/N/03", "c.png"): "9702_w03_qp_5/images/c.png", ("odd", "a.png"): "out/a.png", ("odd", "b.png"): None, (None, "a.png"): None,
    }


def test_stored_code_of_a_stem(spark):
    stems = spark.createDataFrame([(s,) for s in ("9702_s03_qp_1", "9702_w25_qp_12", "9702_w25_qp_13", "notes")], "stem string")
    codes = spark.createDataFrame([("9702/01/M/J/03", 2), ("9702/1/M/J/03", 1), ("9702/12/O/N/25", 3), ("9702/012/O/N/25", 4)], "paper_code string, ord int")
    assert dict(map(tuple, listing.stored_code(stems, codes).collect())) == {"9702_s03_qp_1": "9702/1/M/J/03", "9702_w25_qp_12": "9702/12/O/N/25", "9702_w25_qp_13": None, "notes": None}


def test_shape_batches_of_a_hot_shape(spark):
    crops = spark.range(5000).select(F.col("id").alias("ord"), F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 10 == 1, 32).otherwise(64).alias("height"), F.lit(96).alias("width"))
    out = adapters.shape_batches(crops, ["height", "width"], "ord", 16, 100)
    rows = {}
    for r in sorted(out.collect(), key=lambda r: r.ord):
        rows.setdefault(r.height, []).append((r.batch, r.place))
    assert {h: len(v) for h, v in rows.items()} == {None: 100, 32: 500, 64: 4400}
    assert all(v == [(k // 16, k % 16) for k in range(len(v))] for v in rows.values())
    # No task sorts more of a shape than a chunk holds.
    assert "hashpartitioning(height" in out._jdf.queryExecution().toString() and crops.withColumn("c", F.floor(F.col("ord") / 100)).groupBy("height", "c").count().agg(F.max("count")).first()[0] <= 100


def test_phases(spark):
    live = spark.createDataFrame([(f"/in/{k}.pdf",) for k in range(6)], "paper string")
    say = lambda *lines: lambda _: spark.createDataFrame([(x,) for x in lines], "line string")
    bad = lambda phase, paper: f"{quarantine.PREFIX}\t{phase}\t{paper}"
    done, failed = quarantine.run_phases(live, [
        ("a", say("=== fine ===", bad("a", "/in/1.pdf"), bad("a", "/in/1.pdf"), bad("a", "/else.pdf"), f"{quarantine.PREFIX}\tonly two")),
        ("b", say(bad("b", "/in/1.pdf"), bad("b", "/in/2.pdf"))),
    ])
    assert sorted(r.paper for r in done.collect()) == [f"/in/{k}.pdf" for k in (0, 3, 4, 5)]
    assert {(r.paper, r.phase) for r in failed.collect()} == {("/in/1.pdf", "a"), ("/in/2.pdf", "b")}
    done, failed = quarantine.run_phases(live, [("a", say(bad("a", "/in/0.pdf"))), ("b", lambda _: None), ("c", say(bad("c", "/in/3.pdf")))])
    assert done.count() == 0 and {(r.phase, r.reason) for r in failed.collect()} == {("a", None), ("b", "the batch failed")}


def test_model_errors_are_kept(spark):
    def model():
        def run(items):
            if any(x < 0 for x in items):
                raise ValueError("negative")
            return [{"v": x * 2} for x in items]

        return run

    df = spark.createDataFrame([(1, 4), (2, -1), (3, 5)], "id int, n int")
    got = {r.id: (r.twice, r.why) for r in adapters.apply_model(df, "n", model, "twice", "int", error="why").collect()}
    assert got == {1: (8, None), 2: (None, "ValueError: negative"), 3: (10, None)}


def test_shown(spark):
    report = spark.createDataFrame([("long", f"{k:02d}", "d") for k in range(25)] + [("short", "a", None)], "category string, key string, detail string")
    got = sorted(tuple(r) for r in audit.shown(report).collect())
    assert len(got) == 22 and got[0] == ("long", 1, "00 d") and got[20] == ("long", 21, "... and 5 more") and got[21] == ("short", 1, "a")
    assert audit.shown(report, None).count() == 26


BOX = {"x0": 1.5, "y0": 0.0, "x1": 2.0, "y1": 3.25}


def test_json_round_trip(spark):
    kind = f"array<struct<headers:array<string>,rows:array<array<string>>,bbox:{assemble.BOX}>>"
    df = spark.createDataFrame([([(["h", None], [["é", '"'], []], (1.5, 0.0, 2.0, 3.25))],), ([],), (None,), ([(None, None, None)],)], f"tables {kind}")
    out = df.withColumn("t", X.json_of(F.col("tables"))).withColumn("back", X.json_to(F.col("t"), kind))
    assert all(r.tables == r.back for r in out.collect())
    bad = spark.createDataFrame([("",), ("  ",), ("{",), (None,)], "t string")
    assert [r[0] for r in bad.select(X.json_to(F.col("t"), "array<string>")).collect()] == [None] * 4


def test_build(spark):
    box = lambda y: (0.0, y, 5.0, y + 5)
    parsed = spark.createDataFrame([("s", 1, 1, "stem [2] A one B two C D [1]"), ("s", 2, 1, "")], "paper string, question long, page long, text string")
    words = ["A", "one", "B", " two ", "C", "D", "four"]
    spans = spark.createDataFrame([("s", 1, 1, k, w, 10.0 * k, 100.0 + 20 * k) for k, w in enumerate(words)] + [("s", 9, 1, 9, "of no question", 0.0, 0.0)], "paper string, question long, page int, ord int, text string, x0 double, y0 double")
    refs = spark.createDataFrame([("s", 1, k, f"p1_r{k}", t, 1, box(y)) for k, t, y in [(0, "image", 0.0), (1, "formula", 151.0), (2, "formula", 10.0), (3, "table", 5.0), (4, "formula", 300.0), (5, "image", 1.0)]], f"paper string, question long, ord int, region_id string, type string, page int, bbox {assemble.BOX}")
    assets = spark.createDataFrame([("s", "p1_r0", "0.png", None, None, None), ("s", "p1_r1", None, "in B", None, None), ("s", "p1_r2", None, "in stem", None, None), ("s", "p1_r3", None, None, ["h"], [["c"], []]), ("t", "p1_r5", "other.png", None, None, None)], "paper string, region_id string, file string, latex string, headers array<string>, rows array<array<string>>")
    crops = spark.createDataFrame([("s", 1, 2, "b.png", box(1.0)), ("s", 1, 1, "a.png", box(0.0))], f"paper string, question long, page int, file string, bbox {assemble.BOX}")
    codes = spark.createDataFrame([("s", "9702/12/O/N/25")], "paper string, code string")
    out = assemble.build(parsed, spans, refs, assets, crops, codes)
    got = {r.question: r for r in out.collect()}
    assert set(got) == {1, 2} and got[2].options == got[2].images == got[2].formulas == [] and got[2].marks == 1
    one = got[1]
    assert (one.paper, one.marks, [i.file for i in one.images], [f.latex for f in one.formulas], [c.file for c in one.question_images]) == ("9702/12/O/N/25", 3, ["0.png"], ["in B", "in stem"], ["a.png", "b.png"])
    assert [(o.label, o.text, [f.latex for f in o.formulas]) for o in one.options] == [("A", "one", []), ("B", "two", ["in B"]), ("C", "", []), ("D", "four", [])]
    assert one.tables[0].headers == ["h"] and one.tables[0].rows == [["c"], []]
    plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "Exchange hashpartitioning(paper" in plan
    bank = Bank.of(spark).upsert(out)
    assert sorted((r.label or "", r.latex) for r in bank.t["formulas"].collect()) == [("", "in stem"), ("B", "in B")]
    again = Bank.of(spark).upsert(Bank.imported(bank.exported()))
    for t in bank.t:
        assert sorted(map(str, bank.t[t].collect())) == sorted(map(str, again.t[t].collect())), t


def test_small_functions(spark):
    df = spark.createDataFrame([(1.005, 2.345, 3.0, 4.125, "a \t b", "s")], "x0 double, y0 double, x1 double, y1 double, t string, stem string")
    b = G.box("x0", "y0", "x1", "y1")
    r = df.select(G.rounded(b).alias("b"), G.contains_point(b, F.lit(2.0), F.lit(4.125)).alias("inside"), G.contains_point(b, F.lit(0.0), F.lit(3.0)).alias("out"), X.squeeze(F.col("t")).alias("t"), G.region_id(F.lit(3), F.lit(7)).alias("id")).first()
    assert (r.b.y1, r.inside, r.out, r.t, r.id) == (4.12, True, False, "a b", "p3_r7")
    assert files.paper_dirs(df, "/out", ["extracted", "topics"]).first().asDict() == {"stem": "s", "extracted": "/out/s/extracted", "topics": "/out/s/topics"}
    assert files.to_json_lines(df.select("stem")).collect() == ['{"stem":"s"}']
    pages = spark.createDataFrame([(1, 5.0, 6.0, [("t", (0.0, 1.0, 2.0, 3.0), ("F", 9.0, 0, False, False))], [])], files.STAGES["extraction"]).withColumn("paper_key", F.lit("p"))
    assert files.explode_spans(pages).first().asDict() == {"paper_key": "p", "page": 1, "width": 5.0, "height": 6.0, "ord": 0, "text": "t", "x0": 0.0, "y0": 1.0, "x1": 2.0, "y1": 3.0, "font": "F", "size": 9.0}
    regions = spark.createDataFrame([(1, 5.0, 6.0, [("p1_r0", "text", (0.0, 1.0, 2.0, 3.0), 0.5, "raw")])], files.STAGES["layout"]).withColumn("paper_key", F.lit("p"))
    assert files.explode_regions(regions).first().region_id == "p1_r0"


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty_tables(spark, rows):
    report = spark.createDataFrame([(None, *r) for r in rows], "category string, key string, detail string")
    assert audit.shown(report).count() == len(rows)
    table = spark.createDataFrame([], "source string, path string, size long")
    assert listing.paper_dirs(table).count() == listing.expected_stems(table).count() == 0
