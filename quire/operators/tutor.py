"""Question context for language models: references in chats, rendered questions, grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X

GRADE = "struct<marks_awarded:int,max_marks:int,point_results:array<struct<point:string,earned:boolean,justification:string>>,feedback:string>"
# Wording that surrounds a rendered question.
OPTIONS_HEAD = "Options:"
FORMULAS_HEAD = "Formulas/expressions in this question (OCR'd from the page):"
TABLES_HEAD = "Tables in this question:"


def context_text(paper: Column, question: Column, marks: Column, text: Column, options: Column, formulas: Column, tables: Column) -> Column:
    """The question as plain text. Options are (label, text), formulas (latex), tables (headers, rows); lists of cells are written as JSON."""
    head = F.concat(F.lit("Paper "), paper, F.lit(", Question "), question.cast("string"), F.lit(" ("), marks.cast("string"), F.lit(" mark(s)):"))
    section = lambda test, title, lines: F.when(test, F.concat(F.array(F.lit(title)), lines)).otherwise(F.array().cast("array<string>"))
    parts = F.concat(
        F.array(head, F.coalesce(text, F.lit(""))),
        section(F.size(options) > 0, OPTIONS_HEAD, F.transform(options, lambda o: F.concat(F.lit("  "), o["label"], F.lit(". "), o["text"]))),
        section(F.size(formulas) > 0, FORMULAS_HEAD, F.transform(F.filter(formulas, lambda f: f["latex"] != ""), lambda f: F.concat(F.lit("  "), f["latex"]))),
        section(F.size(tables) > 0, TABLES_HEAD, F.flatten(F.transform(tables, lambda t: F.concat(
            F.array(F.concat(F.lit("  headers: "), F.to_json(t["headers"]))), F.transform(t["rows"], lambda r: F.concat(F.lit("  row: "), F.to_json(r))),
        )))),
    )
    return F.array_join(parts, "\n")


def grade_prompt(context: Column, answer: Column, points: Column) -> Column:
    return F.concat(
        context, F.lit("\n\nMarking points:\n"), F.array_join(F.transform(points, lambda p: F.concat(F.lit("- "), p)), "\n"),
        F.lit("\n\nStudent's answer:\n"), answer, F.lit("\n\nGrade the answer against each marking point independently."),
    )


def parse_grade(reply: Column) -> Column:
    return F.from_json(reply, GRADE, {"mode": "PERMISSIVE"})


def last_turns(chats: DataFrame, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last turn of each conversation: (key, turn, role, text)."""
    last = F.max_by(F.struct(turn, "role", "text"), turn)
    return chats.groupBy(key).agg(last.alias("l")).select(key, "l.*")


def splice(last: DataFrame, contexts: DataFrame, key: str = "conv_id") -> DataFrame:
    """Last user turns with the question they refer to: (key, code, number, message). ``contexts``: code, number, context.

    Turns without a reference or of another role stay as they are; an unknown question leaves a note.
    """
    ref = F.when(F.col("role") == "user", X.find_reference(F.col("text")))
    own = last.withColumn("_r", ref).withColumns({"code": F.col("_r.code"), "number": F.col("_r.number")})
    known = contexts.select(F.col("code").alias("_c"), F.col("number").alias("_n"), "context")
    both = own.join(known, (F.col("code") == F.col("_c")) & (F.col("number") == F.col("_n")), "left")
    note = F.concat(F.lit("(No stored question "), F.col("number").cast("string"), F.lit(" in paper "), F.col("code"), F.lit(")"))
    message = F.when(F.col("_r").isNull(), F.col("text")).otherwise(F.concat(F.coalesce("context", note), F.lit("\n\n"), F.col("text")))
    return both.select(key, "code", "number", message.alias("message"))
