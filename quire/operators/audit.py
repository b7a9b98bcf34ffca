"""Completeness audit of a stored bank against the papers that should be in it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X


def stored_papers(papers: DataFrame, questions: DataFrame) -> DataFrame:
    """(paper_code, paper_id, n, code): papers with their number of questions, which may be 0."""
    n = questions.groupBy("paper_code").agg(F.count("*").alias("n"))
    return papers.join(n, "paper_code", "left").select("paper_code", "paper_id", F.coalesce("n", F.lit(0)).alias("n"), X.normalise_code(F.col("paper_code")).alias("code"))


def by_code(stored: DataFrame) -> DataFrame:
    """(code, paper_code, n, spellings): of several spellings the row with most questions, the earlier of equals."""
    return stored.where("code is not null").groupBy("code").agg(
        F.max_by("paper_code", F.struct(F.col("n"), -F.col("paper_id"))).alias("paper_code"), F.max("n").alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("paper_id", "paper_code"))), lambda s: s["paper_code"]).alias("spellings"),
    )


def match(stems: DataFrame, rows: DataFrame) -> DataFrame:
    """Each distinct stem with its fate: (stem, raw, code, state, found); state is unmappable, matched, reconciled or missing.

    A stem with a one-digit number that finds nothing is matched to a stored code of its sitting that begins with
    this digit and that no stem claims, if there is just one.
    """
    s = stems.select("stem").distinct().withColumn("raw", X.stem_code(F.col("stem"))).withColumn("code", X.normalise_code(F.col("raw")))
    s = s.join(rows.select(F.col("code").alias("hit")), F.col("code") == F.col("hit"), "left")
    orphans = rows.join(s.where("hit is not null").select("code").distinct(), "code", "left_anti").select(F.col("code").alias("orphan"))
    sitting = lambda c: F.regexp_replace(c, r"^(\d{4})/\d+/", "$1/")
    open_ = s.where("raw is not null and hit is null").withColumn("digit", F.regexp_extract("stem", X.STEM, 4)).where("length(digit) = 1")
    near = open_.select("stem", "digit", sitting(F.col("code")).alias("sit")).join(orphans.withColumn("sit", sitting(F.col("orphan"))), "sit")
    near = near.where(F.split("orphan", "/")[1].startswith(F.col("digit")))
    one = near.groupBy("stem").agg(F.count("*").alias("k"), F.min("orphan").alias("found")).where("k = 1").select("stem", "found")
    out = s.join(one, "stem", "left")
    state = F.when(F.col("raw").isNull(), "unmappable").when(F.col("hit").isNotNull(), "matched").when(F.col("found").isNotNull(), "reconciled").otherwise("missing")
    return out.select("stem", "raw", "code", state.alias("state"), F.coalesce("hit", "found").alias("found"))


def textless(questions: DataFrame) -> DataFrame:
    """(paper_code, n): questions without text."""
    return questions.where(F.col("text").isNull() | (F.trim("text") == "")).groupBy("paper_code").agg(F.count("*").alias("n"))


def audit(papers: DataFrame, questions: DataFrame, stems: DataFrame, processed: DataFrame | None = None, full_paper: int = 40) -> DataFrame:
    """(category, severity, key, detail). ``processed``: stems that reached the last phase; ``full_paper`` 0 turns the short-paper check off."""
    stored = stored_papers(papers, questions)
    rows = by_code(stored)
    fate = match(stems, rows)
    if processed is not None:
        fate = fate.join(processed.select(F.col("stem").alias("_done")).distinct(), F.col("stem") == F.col("_done"), "left")
    else:
        fate = fate.withColumn("_done", F.lit(None).cast("string"))
    held = rows.join(fate.where("found is not null").select(F.col("found").alias("code")).distinct(), "code", "left_semi")
    short = F.split("code", "/")[1].startswith("1") & (F.col("n") > 0) & (F.col("n") < full_paper)
    row = lambda df, cat, sev, key, detail: df.select(F.lit(cat).alias("category"), F.lit(sev).alias("severity"), key.alias("key"), detail.cast("string").alias("detail"))
    c = F.col
    return reduce(DataFrame.unionByName, [
        row(fate.where("state = 'missing'"), "missing", "FAIL", c("stem"), F.when(c("_done").isNotNull(), "reached phase 9 but never loaded").otherwise("no phase 9 output")),
        row(held.where("n = 0"), "empty", "FAIL", c("code"), c("paper_code")),
        row(rows.where(F.size("spellings") > 1), "duplicate", "FAIL", c("code"), F.array_join("spellings", ", ")),
        row(stored.where("code is null"), "unparsable", "FAIL", c("paper_code"), c("n")),
        row(held.where(short), "short", "WARN", c("code"), c("n")),
        row(textless(questions), "textless", "WARN", c("paper_code"), c("n")),
        row(rows.join(fate.where("found is not null").select(c("found").alias("code")), "code", "left_anti"), "orphan", "WARN", c("code"), c("paper_code")),
        row(fate.where("state = 'unmappable'"), "unmappable", "WARN", c("stem"), F.lit(None)),
        row(fate.where("state = 'reconciled'"), "reconciled", "NOTE", c("stem"), c("found")),
    ])


def verdict(report: DataFrame, strict: bool = False) -> bool:
    """Whether the audit passed; with ``strict`` warnings fail it as well."""
    bad = report.where(F.col("severity").isin("FAIL", "WARN") if strict else F.col("severity") == "FAIL")
    return bad.limit(1).count() == 0


def shown(report: DataFrame, limit: int | None = 20, by: str = "category", order: tuple[str, ...] = ("key", "detail")) -> DataFrame:
    """(by, place, line): the first ``limit`` entries of each category and, where there are more, a line that says how many; all without a limit.

    Spark keeps ``limit`` rows of a category in each task before it shuffles; the totals are counts that are combined before.
    """
    line = F.concat_ws(" ", *order)
    w = Window.partitionBy(by).orderBy(*order)
    rows = report.withColumn("_place", F.row_number().over(w))
    if limit is not None:
        rows = rows.where(F.col("_place") <= limit)
    out = rows.select(by, F.col("_place").cast("long").alias("place"), line.alias("line"))
    if limit is None:
        return out
    more = report.groupBy(by).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    return out.unionByName(more.select(by, F.lit(limit + 1).cast("long").alias("place"), F.concat(F.lit("... and "), (F.col("_n") - limit).cast("string"), F.lit(" more")).alias("line")))


def tally(rows: DataFrame, status: str) -> DataFrame:
    """(status, n)."""
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def papers_failed(live: DataFrame, quarantine: DataFrame, key: str = "paper") -> DataFrame:
    """Papers still in the batch after a phase."""
    return live.join(quarantine.select(key).distinct(), key, "left_anti")


def sittings(subjects: DataFrame, years: DataFrame, seasons: DataFrame, codes: DataFrame) -> DataFrame:
    """Every (subject, season, yy, code) that may exist: March sittings have only codes that end in 2. The sides are short parameter lists."""
    plan = subjects.join(years).join(seasons).join(codes)
    return plan.where((F.col("season") != "m") | F.col("code").endswith("2"))

