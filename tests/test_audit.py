from pyspark.sql import functions as F

from quire.operators import audit, tutor


def test_reconciliation(spark):
    def fate(stored):
        papers = spark.createDataFrame([(c, k) for k, c in enumerate(stored)], "paper_code string, paper_id int")
        q = spark.createDataFrame([(c, 1, "t") for c in stored], "paper_code string, question int, text string")
        stems = spark.createDataFrame([("9702_w09_qp_2",), ("readme",)], "stem string")
        return {(r.category, r.key): r.detail for r in audit.audit(papers, q, stems).collect()}

    assert fate(["9702/21/O/N/09"])[("reconciled", "9702_w09_qp_2")] == "9702/21/O/N/09"
    two = fate(["9702/21/O/N/09", "9702/22/O/N/09"])
    assert ("missing", "9702_w09_qp_2") in two and ("orphan", "9702/22/O/N/09") in two and ("unmappable", "readme") in two


def test_spellings_and_verdict(spark):
    papers = spark.createDataFrame([("9702/1/M/J/03", 1), ("9702/01/M/J/03", 2), ("junk", 3)], "paper_code string, paper_id int")
    q = spark.createDataFrame([("9702/01/M/J/03", 1, " "), ("9702/01/M/J/03", 2, None)], "paper_code string, question int, text string")
    report = audit.audit(papers, q, spark.createDataFrame([("9702_s03_qp_1",)], "stem string"))
    got = {(r.category, r.key): r.detail for r in report.collect()}
    assert got[("duplicate", "9702/01/M/J/03")] == "9702/1/M/J/03, 9702/01/M/J/03"
    assert got[("unparsable", "junk")] == "0" and got[("textless", "9702/01/M/J/03")] == "2"
    # Its number does not begin with 1, so two questions are not too few.
    assert ("short", "9702/01/M/J/03") not in got
    q = spark.createDataFrame([("9702/12/M/J/03", 1, "t")], "paper_code string, question int, text string")
    one = audit.audit(spark.createDataFrame([("9702/12/M/J/03", 1)], "paper_code string, paper_id int"), q, spark.createDataFrame([("9702_s03_qp_12",)], "stem string"))
    assert {(r.category, r.key): r.detail for r in one.collect()}[("short", "9702/12/M/J/03")] == "1"
    assert not audit.verdict(report)
    assert audit.verdict(report.where("severity = 'WARN'")) and not audit.verdict(report.where("severity = 'WARN'"), strict=True)


def test_context(spark):
    row = spark.sql("SELECT 'p' AS paper, 3 AS question, 2 AS marks, 'stem' AS text, array(named_struct('label','A','text','one')) AS options, array(named_struct('latex','x^2'), named_struct('latex', cast(null as string))) AS formulas, array(named_struct('headers', array('h'), 'rows', array(array('c')))) AS tables")
    got = row.select(tutor.context_text(*[F.col(c) for c in ("paper", "question", "marks", "text", "options", "formulas", "tables")]).alias("t")).first().t
    assert got.split("\n") == ["Paper p, Question 3 (2 mark(s)):", "stem", "Options:", "  A. one", "Formulas/expressions in this question (OCR'd from the page):", "  x^2", "Tables in this question:", '  headers: ["h"]', '  row: ["c"]']
    grade = spark.range(1).select(tutor.parse_grade(F.lit('{"marks_awarded": 1, "max_marks": 2, "point_results": [], "feedback": "ok"}')).alias("g")).first().g
    assert (grade.marks_awarded, grade.max_marks, grade.feedback) == (1, 2, "ok")
