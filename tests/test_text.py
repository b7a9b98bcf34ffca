import pytest
from pyspark.sql import functions as F

from quire.functions import text as X


def one(spark, col, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(col.alias("r")).first().r


@pytest.mark.parametrize("text, want", [
    ("For Examiner’s Use", True), ("For Examiner’s Use State the principle of moments", False), ("For Examiner's Use 5 m s per second", True), ("State", False),
])
def test_examiner_column(spark, text, want):
    assert one(spark, X.is_examiner_column(F.col("t")), t=text) is want


@pytest.mark.parametrize("text, want", [("(a) x [3] (b) y [12]", 15), ("no marks", 1), ("[0]", 0), ("[123]", 1)])
def test_marks(spark, text, want):
    assert one(spark, X.marks(F.col("t")), t=text) == want


def test_codes(spark):
    assert one(spark, X.stem_code(F.col("t")), t="9702_s03_qp_1") == "9702/1/M/J/03"
    assert one(spark, X.stem_code(F.col("t")), t="notes") is None
    assert one(spark, X.normalise_code(F.col("t")), t=" 9702/1/m/j/03 ") == "9702/01/M/J/03"
    assert one(spark, X.normalise_code(F.col("t")), t="9702/123/M/J/03") == "9702/123/M/J/03"
    assert one(spark, X.normalise_code(F.col("t")), t="x") is None
    assert tuple(one(spark, X.parse_code(F.col("t")), t="9702/12/O/N/25")) == ("9702", "12", "October/November", 2025)
    assert tuple(one(spark, X.parse_code(F.col("t")), t="9702/12/X/Y/25"))[2] == "X/Y"
    assert one(spark, X.code_stems(F.col("t")), t="9702/21/O/N/09") == ["9702_w09_qp_21", "9702_w09_qp_2"]
    assert one(spark, X.code_stems(F.col("t")), t="9702/05/O/N/03") == ["9702_w03_qp_05", "9702_w03_qp_5"]
    assert one(spark, X.unpadded_code(F.col("t")), t="9702/05/O/N/03") == "9702/5/O/N/03"


@pytest.mark.parametrize("text, want", [
    ("explain q.7 in 9702/12/o/n/25", ("9702/12/O/N/25", 7)), ("9702/12/O/N/25 Question # 12", ("9702/12/O/N/25", 12)), ("q123 of 9702/12/O/N/25", None), ("q7 please", None),
])
def test_reference(spark, text, want):
    got = one(spark, X.find_reference(F.col("t")), t=text)
    assert (tuple(got) if got else None) == want


def test_symbols_and_strip(spark):
    raw = "".join(chr(0xF000 + ord(c)) for c in "abW") + chr(0xF0B4)
    assert one(spark, X.symbol_remap(F.col("t"), F.lit("Symbol")), t=raw) == "αβΩ×"
    assert one(spark, X.symbol_remap(F.col("t"), F.lit("Times")), t=raw) == raw
    assert one(spark, X.strip(F.col("t")), t="  a b \n") == "a b"
    assert one(spark, X.nocase(F.col("t")), t="ÉA") == "Éa"
    assert one(spark, X.question_number(F.col("t")), t=" 12. ") == 12
    assert one(spark, X.question_number(F.col("t")), t="123") is None


def test_cards_and_media(spark):
    assert one(spark, X.card_text(F.col("t")), t="x" * 221) == "x" * 220 + "…"
    assert one(spark, X.media_type(F.col("t")), t="a/b.JPG") == "image/jpeg"
    assert one(spark, X.data_url(F.lit(b"ab"), F.col("t")), t="x.png") == "data:image/png;base64,YWI="
    assert tuple(one(spark, X.failure_line(F.col("t"), "FAILED"), t="FAILED\tlayout\tx.pdf")) == ("layout", "x.pdf")
    assert one(spark, X.failure_line(F.col("t"), "FAILED"), t="other\tlayout\tx.pdf") is None
    assert one(spark, X.or_default(F.col("t"), "d"), t="") == "d"
