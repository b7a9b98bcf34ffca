"""Column functions for codes, marks, references, boilerplate and white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of sittings, their letters in file names and in codes.
SESSION_NAMES = {"F/M": "February/March", "M/J": "May/June", "O/N": "October/November"}
SEASON_LETTERS = {"s": "M/J", "w": "O/N", "m": "F/M"}
# Patterns of codes, marks, question numbers and notices.
CODE = r"^(\d{4})/(\d+)/([A-Z])/([A-Z])/(\d{2})$"
CODE_IN_TEXT = r"\b\d{4}/\d{1,2}/[A-Z]/[A-Z]/\d{2}\b"
CODE_IN_CHAT = r"\b(\d{4}/\d{1,2}/[A-Za-z]/[A-Za-z]/\d{2})\b"
NUMBER_IN_CHAT = r"(?i)\b(?:question|q)\.?\s*#?\s*(\d{1,2})\b"
STEM = r"^(\d{4})_([smw])(\d{2})_qp_(\d{1,2})$"
MARK = r"\[(\d{1,2})\]"
QUESTION_NUMBER = r"^(\d{1,2})[.):]?$"
NOTICE = r"(?i)©\s*UCLES|\bturn over\b|\d{4}/\d{2}/[A-Z]/[A-Z]/\d{2}"
COLOPHON = r"(?i)permission to reproduce items"
EXAMINER = r"(?i)For\s+Examiner"
EXAMINER_LETTERS = 15
# The Symbol font's private code points 0xF000 + ASCII, and raised and lowered signs.
SYMBOL_FROM = "abcdefghiklmnopqrstuwxyz" + "DFGLPQSWXY"
SYMBOL_TO = "αβχδεφγηικλμνοπθρστυωξψζ" + "ΔΦΓΛΠΘΣΩΞΨ"
SYMBOL_SIGNS = {0xF0B4: "×", 0xF0D7: "·", 0xF0B1: "±"}
LIFTABLE = "0123456789+-–()n"
RAISED = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁻⁽⁾ⁿ"
LOWERED_FROM = "0123456789+-–()"
LOWERED = "₀₁₂₃₄₅₆₇₈₉₊₋₋₍₎"
# Subjects by the first part of a code.
SUBJECTS = {"9702": "Physics", "9709": "Mathematics", "9701": "Chemistry"}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lookup(key: Column, table: dict[str, str]) -> Column:
    """The table's value, null where there is none."""
    return F.get(F.array(*[F.lit(v) for v in table.values()]), F.array_position(F.array(*[F.lit(k) for k in table]), key).cast("int") - 1)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; plain nesting would repeat its code at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def nocase(col: Column) -> Column:
    """Fold A-Z only, as a case-insensitive ASCII collation does."""
    return F.translate(col, UPPER, UPPER.lower())


def squeeze(col: Column) -> Column:
    return F.regexp_replace(col, r"[ \t]+", " ")


def stem_code(stem: Column) -> Column:
    """Code of a file stem, null if the stem does not follow the convention."""

    def code(s: Column) -> Column:
        part = [F.regexp_extract(s, STEM, k) for k in range(1, 5)]
        return F.when(s.rlike(STEM), F.concat_ws("/", part[0], part[3], lookup(part[1], SEASON_LETTERS), part[2]))

    return let(stem, code)


def parse_code(code: Column) -> Column:
    """Struct subject, variant, session, year; all null if the code does not parse."""
    part = [F.regexp_extract(code, CODE, k) for k in range(1, 6)]
    months = F.concat_ws("/", part[2], part[3])
    fits = code.rlike(CODE)
    return F.struct(
        F.when(fits, part[0]).alias("subject"), F.when(fits, part[1]).alias("variant"),
        F.when(fits, F.coalesce(lookup(months, SESSION_NAMES), months)).alias("session"),
        F.when(fits, 2000 + F.expr("0") + part[4].try_cast("int")).alias("year"),
    )


def normalise_code(code: Column) -> Column:
    """Trimmed, upper-cased, variant padded to two digits; null if it does not parse."""

    def padded(c: Column) -> Column:
        part = F.split(c, "/")
        number = F.regexp_replace(part[1], "^0+(?=.)", "")
        return F.when(c.rlike(CODE), F.concat_ws("/", part[0], F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number), part[2], part[3], part[4]))

    return let(F.upper(strip(code)), padded)


def unpadded_code(code: Column) -> Column:
    """The code with no leading zeros in its variant, for comparing spellings."""
    return F.regexp_replace(code, r"^(\d{4})/0+(?=\d*/)", "$1/")


def find_code(text: Column) -> Column:
    return F.when(text.rlike(CODE_IN_TEXT), F.regexp_extract(text, CODE_IN_TEXT, 0))


def find_reference(text: Column) -> Column:
    """Struct (code, number) of the question that a text asks for, null unless both are there."""
    code, number = F.regexp_extract(text, CODE_IN_CHAT, 1), F.regexp_extract(text, NUMBER_IN_CHAT, 1)
    return F.when((code != "") & (number != ""), F.struct(F.upper(code).alias("code"), number.try_cast("int").alias("number")))


def marks(text: Column, default: int = 1) -> Column:
    """Sum of the marks in brackets; the default only where there are none."""
    found = F.regexp_extract_all(text, F.lit(MARK), F.lit(1))
    return F.when(F.size(found) > 0, F.aggregate(found, F.lit(0), lambda a, x: a + x.cast("int"))).otherwise(default)


def subject_of(code: Column) -> Column:
    return lookup(F.split(code, "/")[0], SUBJECTS)


def symbol_remap(text: Column, font: Column) -> Column:
    """Greek letters and signs for the Symbol font's private code points."""
    source = "".join(chr(0xF000 + ord(c)) for c in SYMBOL_FROM) + "".join(map(chr, SYMBOL_SIGNS))
    return F.when(font == "Symbol", F.translate(text, source, SYMBOL_TO + "".join(SYMBOL_SIGNS.values()))).otherwise(text)


def is_bold(flags: Column) -> Column:
    """Bit 4 of a span's flags."""
    return F.getbit(flags, F.lit(4)) == 1


def is_italic(flags: Column) -> Column:
    """Bit 1 of a span's flags."""
    return F.getbit(flags, F.lit(1)) == 1


def question_number(text: Column) -> Column:
    """The bare number of one or two digits that a text is, else null."""
    t = strip(text)
    return F.when(t.rlike(QUESTION_NUMBER), F.regexp_extract(t, QUESTION_NUMBER, 1).try_cast("int"))


def is_notice(text: Column) -> Column:
    return text.rlike(NOTICE)


def is_examiner_column(text: Column) -> Column:
    """True for the examiner's margin column: the phrase, and under 15 letters besides."""
    rest = F.regexp_replace(F.regexp_replace(text, EXAMINER, " "), r"['’]s|\bUse\b|\bTotal\b", " ")
    return text.rlike(EXAMINER) & (F.regexp_count(rest, F.lit("[A-Za-z]")) < EXAMINER_LETTERS)


def card_text(text: Column, most: int = 220) -> Column:
    return F.concat(F.substring(text, 1, most), F.when(F.length(text) > most, "…").otherwise(""))


def card_marks(n: Column) -> Column:
    return F.concat(n.cast("string"), F.when(n == 1, " mark").otherwise(" marks"))


def media_type(file: Column) -> Column:
    ext = F.lower(F.regexp_extract(file, r"\.([^./]+)$", 1))
    return F.when(ext.isin("jpg", "jpeg"), "image/jpeg").when(ext == "", None).otherwise(F.concat(F.lit("image/"), ext))


def data_url(content: Column, file: Column) -> Column:
    return F.concat(F.lit("data:"), media_type(file), F.lit(";base64,"), F.base64(content))


def code_stems(code: Column) -> Column:
    """File stems under which a code's paper may have been filed, best first."""
    part = [F.regexp_extract(code, CODE, k) for k in range(1, 6)]
    season = lookup(F.concat_ws("/", part[2], part[3]), {v: k for k, v in SEASON_LETTERS.items()})
    bare = F.regexp_replace(part[1], "^0+", "")
    numbers = F.array_distinct(F.array_compact(F.array(part[1], F.when(bare != "", bare), F.when((F.length(part[1]) == 2) & ~part[1].startswith("0"), F.left(part[1], F.lit(1))))))
    return F.when(code.rlike(CODE) & season.isNotNull(), F.transform(numbers, lambda n: F.concat(part[0], F.lit("_"), season, part[4], F.lit("_qp_"), n))).otherwise(F.array().cast("array<string>"))


def failure_line(line: Column, prefix: str) -> Column:
    """Struct (phase, paper) of a tab-separated failure line, null for other lines."""
    f = F.split(line, "\t")
    return F.when((F.size(f) == 3) & (f[0] == prefix), F.struct(f[1].alias("phase"), f[2].alias("paper")))


def or_default(col: Column, default: str) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def json_of(col: Column) -> Column:
    """A box, list of cells or other nested value as JSON with all its fields, null staying null."""
    return F.to_json(col, {"ignoreNullFields": "false"})


def json_to(text: Column, kind: str) -> Column:
    """The value of type ``kind`` that a JSON text holds; null for null, empty and unreadable texts."""
    return F.when(F.trim(text) != "", F.from_json(text, kind))
