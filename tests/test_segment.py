from pyspark.sql import functions as F

from quire.operators import segment, spatial


def test_assignment(spark):
    regions = spark.createDataFrame([(1, 1, k, *b) for k, b in enumerate([(0.0, 0.0, 100.0, 100.0), (5.0, 5.0, 25.0, 25.0), (15.0, 10.0, 30.0, 20.0), (16.0, 10.0, 30.0, 20.0)])], "paper int, page int, region_ord int, x0 double, y0 double, x1 double, y1 double")
    items = spark.createDataFrame([(1, 1, 0, 10.0, 10.0, 20.0, 20.0), (1, 1, 1, 10.0, 10.0, 10.0, 20.0), (1, 2, 0, 1.0, 1.0, 2.0, 2.0)], "paper int, page int, ord int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.page, r.ord): r.region_ord for r in spatial.assign_regions(items, regions, ["paper", "page"]).collect()}
    assert got == {(1, 0): 2, (1, 1): None, (2, 0): None}


def block(page, ord_, kind, x, y, *texts):
    return (1, page, ord_, ord_, kind, float(x), float(y), [(k, t, float(x + 30 * k), float(y), float(x + 30 * k + 20), float(y + 10)) for k, t in enumerate(texts)])


SCHEMA = "paper int, page int, block_ord int, region_ord int, type string, x0 double, y0 double, content array<struct<ord:int,text:string,x0:double,y0:double,x1:double,y1:double>>"


def test_paper(spark):
    rows = [
        block(1, 0, "text", 300, 30, "2"), block(1, 1, "header", 50, 10, "header"), block(1, 2, "text", 50, 100, "1", "First question"),
        block(1, 3, "text", 50, 130, "A", "one"), block(1, 4, "image", 50, 160), block(2, 5, "text", 50, 96, "carved"), block(2, 6, "text", 50, 100, "3", "Second"),
        block(2, 7, "text", 500, 150, "For Examiner’s Use"), block(3, 8, "text", 50, 50, "4.", "Third"), block(3, 9, "text", 50, 400, "Permission to reproduce items"), block(3, 10, "text", 50, 500, "5", "never"),
    ]
    got = segment.parse_blocks(spark.createDataFrame(rows, SCHEMA)).orderBy("question").collect()
    assert [(r.question, r.page, r.end_page, r.text) for r in got] == [(1, 1, 1, "1 First question A one"), (3, 2, 2, "carved 3 Second"), (4, 3, 3, "4. Third")]
    assert got[0].lines == ["1 First question", "A one"]
    assert [(x.type, x.region_ord) for x in got[0].regions] == [("image", 4)]
    assert segment.parse_blocks(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plain_spans(spark):
    rows = [(1, 1, 0, "header", 50.0, 20.0), (1, 1, 1, "1", 50.0, 100.0), (1, 1, 2, "Find x", 80.0, 101.0), (1, 1, 3, "and y", 80.0, 120.0), (1, 2, 0, "2.", 50.5, 100.0), (1, 2, 1, "Draw", 80.0, 95.0), (1, 2, 2, "7", 300.0, 200.0)]
    df = spark.createDataFrame(rows, "paper int, page int, ord int, text string, x0 double, y0 double").withColumn("y1", F.col("y0") + 10).withColumn("height", F.lit(842.0))
    got = segment.group_spans(df).orderBy("question").collect()
    assert [(r.question, r.text) for r in got] == [(1, "1Find x and y"), (2, "2.Draw 7")]
