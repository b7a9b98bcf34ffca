"""The bank: normalised tables of papers, questions and their parts, with retrieval.

Tables are keyed by (paper_code, question); ``paper_id`` keeps the order of loading, by which
results are sorted, and the parts of a question keep their place in ``ord``. A bank is a set of DataFrames; it is stored,
kept up and indexed by ``quire.plans.store``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import fts, merge

KEY = ["paper_code", "question"]
SCHEMAS = {
    "papers": "paper_code string, paper_id bigint",
    "questions": "paper_code string, paper_id bigint, question bigint, page bigint, text string, marks bigint",
    "question_topics": "paper_code string, question bigint, topic string, rank int",
    "images": "paper_code string, question bigint, ord int, file string, bbox struct<x0:double,y0:double,x1:double,y1:double>",
    "question_images": "paper_code string, question bigint, ord int, page bigint, file string, bbox struct<x0:double,y0:double,x1:double,y1:double>",
    "formulas": "paper_code string, question bigint, ord int, label string, latex string, bbox struct<x0:double,y0:double,x1:double,y1:double>",
    "tables": "paper_code string, question bigint, ord int, headers array<string>, rows array<array<string>>, bbox struct<x0:double,y0:double,x1:double,y1:double>",
    "options": "paper_code string, question bigint, ord int, label string, text string",
}
CHILDREN = ("images", "question_images", "formulas", "tables", "options", "question_topics")


class BankMissingError(FileNotFoundError):
    """There is no bank at the path."""


class BankChangedError(RuntimeError):
    """Another writer has saved the bank in the meantime."""


def folder(spark: SparkSession, path: str):
    """The path's file system, as Spark takes it, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def newest(built: DataFrame) -> DataFrame:
    """One row of a batch for each question.

    Of a key that the batch has twice, the row with the higher ``load_seq`` counts, if there is such a column; of equal ones
    the one whose content comes last as JSON, so that all tables take the same row at every run.
    """
    own = built.withColumnRenamed("paper", "paper_code")
    if "load_seq" not in own.columns:
        own = own.withColumn("load_seq", F.lit(0))
    return merge.latest(own.withColumn("_content", F.to_json(F.struct(*own.columns))), KEY, tie=["_content"]).drop("_content")


def parts_of(spark: SparkSession, own: DataFrame, papers: DataFrame) -> dict[str, DataFrame]:
    """The tables, but for papers, of a batch with one row for each question; ``papers`` are the ids of its papers."""
    rows = own.join(papers, "paper_code")
    new = {"questions": rows.select("paper_code", "paper_id", "question", "page", "text", "marks")}
    for name, col in (("images", "images"), ("question_images", "question_images"), ("tables", "tables")):
        if col in own.columns:
            new[name] = own.select(*KEY, F.posexplode(col).alias("ord", "e")).select(*KEY, "ord", "e.*")
    if "options" in own.columns:
        opts = own.select(*KEY, F.posexplode("options").alias("ord", "o"))
        new["options"] = opts.select(*KEY, "ord", "o.label", "o.text")
    if "formulas" in own.columns:
        loose = own.select(*KEY, F.posexplode("formulas").alias("ord", "f")).select(*KEY, "ord", "f.*")
        tied = None
        if "options" in own.columns and "formulas" in own.schema["options"].dataType.elementType.names:
            tied = opts.select(*KEY, "o.label", F.posexplode("o.formulas").alias("ord", "f")).select(*KEY, "ord", "label", "f.*")
        if tied is None:
            tied = loose.limit(0).withColumn("label", F.lit(None).cast("string"))
        new["formulas"] = merge.split_formulas(tied, loose, KEY)
    if "topics" in own.columns:
        new["question_topics"] = own.select(*KEY, F.posexplode("topics").alias("rank", "topic")).select(*KEY, "topic", (F.col("rank") + 1).alias("rank")).dropDuplicates([*KEY, "topic"])
    return Bank.of(spark, **new).t


class Bank:
    """``index`` is the stored search index of the tables, if there is one."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], index=None):
        self.spark, self.t, self.index = spark, tables, index

    @classmethod
    def of(cls, spark: SparkSession, **given: DataFrame) -> Bank:
        """From some tables, the rest empty; columns are cast to the bank's types."""
        from pyspark.sql.types import StructType

        out = {}
        for name, ddl in SCHEMAS.items():
            df, fields = given.get(name), StructType.fromDDL(ddl).fields
            if df is None:
                out[name] = spark.createDataFrame([], ddl)
            else:
                out[name] = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        return cls(spark, out)

    # Storage

    def save(self, path: str) -> int:
        """Store the bank in place of what is at the path; returns the number of the new state."""
        from quire.plans.store import BankStore

        return BankStore(self.spark, path).replace(self)["number"]

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bank:
        """The current state. Only where there is none is it missing; a store that cannot be read raises its own error."""
        from quire.plans.store import BankStore

        return BankStore(spark, path).snapshot()

    def check(self) -> None:
        """Raise if the bank has no papers or no questions."""
        if not self.t["papers"].limit(1).count():
            raise BankMissingError("the bank has no papers")
        if not self.t["questions"].limit(1).count():
            raise BankMissingError("the bank has no questions")

    def upsert(self, built: DataFrame) -> Bank:
        """Load classified questions (paper, question, page, marks, text and lists of parts; see ``newest``).

        A question that is there is replaced with all its parts; others stay.
        """
        own = newest(built)
        papers = merge.with_ids(self.t["papers"].select("paper_id", "paper_code"), own.select("paper_code"), "paper_id", "paper_code").select("paper_code", "paper_id")
        batch = parts_of(self.spark, own, papers)
        out = {name: merge.replace_children(self.t[name], batch[name], own, KEY) for name in ("questions", *CHILDREN)}
        return Bank.of(self.spark, papers=papers, **out)

    @classmethod
    def merged(cls, spark: SparkSession, sources: list[DataFrame]) -> Bank:
        """One bank of several sources of classified questions; later sources win."""
        return cls.of(spark).upsert(merge.union_sources(sources))

    # Retrieval: parts are gathered once for the chosen questions, after the limit.

    def hydrate(self, questions: DataFrame) -> DataFrame:
        out = questions.select(F.col("paper_code").alias("paper"), "paper_id", "question", "page", "marks", "text")
        keys = ["paper", "question"]

        def child(name: str, entry, order: list[str]) -> DataFrame:
            part = self.t[name].withColumnRenamed("paper_code", "paper").join(questions.select(F.col("paper_code").alias("paper"), "question"), keys, "left_semi")
            lists = F.transform(F.array_sort(F.collect_list(F.struct(*order, entry.alias("_e")))), lambda s: s["_e"])
            return part.groupBy(*keys).agg(lists.alias(name))

        c = F.col
        for name, entry, order in (
            ("images", F.struct("file", "bbox"), ["ord"]), ("question_images", F.struct("page", "file", "bbox"), ["ord"]), ("tables", F.struct("headers", "rows", "bbox"), ["ord"]),
            ("formulas", F.struct("latex", "bbox"), ["label", "ord"]), ("options", F.struct("label", "text"), ["ord", "label"]), ("question_topics", c("topic"), ["rank"]),
        ):
            lists = child(name, entry, order)
            out = out.join(lists, keys, "left").withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))
        return out.withColumnRenamed("question_topics", "topics").drop("paper_id")

    def _top(self, df: DataFrame, limit: int | None) -> DataFrame:
        return df if limit is None else df.orderBy("paper_id", "question").limit(limit)

    def _with_topic(self, topic: str) -> DataFrame:
        hit = self.t["question_topics"].where(X.nocase(F.col("topic")) == X.nocase(F.lit(topic)))
        return self.t["questions"].join(hit.select(*KEY), KEY, "left_semi")

    def by_topic(self, topic: str, limit: int | None = None) -> DataFrame:
        return self.hydrate(self._top(self._with_topic(topic), limit))

    def by_marks(self, least: int, most: int, limit: int | None = None) -> DataFrame:
        return self.hydrate(self._top(self.t["questions"].where(F.col("marks").between(least, most)), limit))

    def by_reference(self, paper_code: str, question: int) -> DataFrame:
        return self.hydrate(self.t["questions"].where((F.col("paper_code") == paper_code) & (F.col("question") == question)).limit(1))

    def _filtered(self, subject=None, variant=None, topic=None, min_marks=None, max_marks=None) -> DataFrame:
        q = self._with_topic(topic) if topic else self.t["questions"]
        code = X.parse_code(F.col("paper_code"))
        for value, test in (
            (subject, lambda v: code["subject"] == v), (variant, lambda v: code["variant"] == v),
            (min_marks, lambda v: F.col("marks") >= v), (max_marks, lambda v: F.col("marks") <= v),
        ):
            if value is not None:
                q = q.where(test(value))
        return q

    def filtered(self, **filters) -> DataFrame:
        """All questions that pass the filters subject, variant, topic, min_marks, max_marks."""
        return self.hydrate(self._filtered(**filters))

    def random(self, count: int = 1, seed: int | None = None, **filters) -> DataFrame:
        return self.hydrate(self._filtered(**filters).orderBy(F.rand(seed)).limit(count))

    def hits(self, text: str, limit: int | None = 20) -> DataFrame:
        """(paper_code, question, score) of a full-text search, from the stored index if there is one."""
        terms = fts.terms_of(fts.parse(text)[1])
        if self.index:
            return fts.search(self.index.postings(terms), text, KEY, self.index.docs, self.index.words, limit)
        q = self.t["questions"]
        n, total = q.agg(F.count("*"), F.sum(F.size(fts.words(F.coalesce("text", F.lit("")))))).first()
        return fts.search(fts.postings(q, KEY), text, KEY, n, total or 0, limit)

    def search(self, text: str, limit: int | None = 20) -> DataFrame:
        """Full-text search, best first, with ``score``."""
        hits = self.hits(text, limit)
        found = self.hydrate(self.t["questions"].join(hits.select(*KEY), KEY, "left_semi"))
        scored = found.join(hits.withColumnRenamed("paper_code", "paper"), ["paper", "question"])
        return scored.orderBy("score", "paper", "question")

    def first(self, limit: int = 30) -> DataFrame:
        return self.hydrate(self._top(self.t["questions"], limit))

    def all(self) -> DataFrame:
        return self.hydrate(self.t["questions"])

    def topic_names(self) -> DataFrame:
        return self.t["question_topics"].select(F.col("topic").alias("name")).distinct().orderBy("name")

    def counts(self) -> DataFrame:
        papers = self.t["papers"].agg(F.count("*").alias("papers")).withColumn("_one", F.lit(1))
        questions = self.t["questions"].agg(F.count("*").alias("questions")).withColumn("_one", F.lit(1))
        return papers.join(questions, "_one").drop("_one")

    def find(self, q: str | None = None, topic: str | None = None) -> DataFrame:
        """Text beats topic beats the plain listing."""
        return self.search(q) if q else self.by_topic(topic) if topic else self.first()

    def export(self) -> DataFrame:
        """Question objects as they were loaded: option formulas under their options, the rest under the question."""
        base = self.hydrate(self.t["questions"])
        keys = ["paper", "question"]
        in_order = lambda *entry: F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*entry).alias("_e")))), lambda s: s["_e"])
        f = self.t["formulas"].withColumnRenamed("paper_code", "paper")
        loose = f.where("label is null").groupBy(*keys).agg(in_order("latex", "bbox").alias("formulas"))
        tied = f.where("label is not null").groupBy(*keys, "label").agg(in_order("latex", "bbox").alias("formulas"))
        opts = self.t["options"].withColumnRenamed("paper_code", "paper").join(tied, [*keys, "label"], "left")
        kind = loose.schema["formulas"].dataType
        opts = opts.groupBy(*keys).agg(in_order("label", "text", F.coalesce("formulas", F.array().cast(kind)).alias("formulas")).alias("options"))
        out = base.drop("formulas", "options").join(loose, keys, "left").join(opts, keys, "left")
        return out.withColumns({"formulas": F.coalesce("formulas", F.array().cast(kind)), "options": F.coalesce("options", F.array().cast(opts.schema["options"].dataType))}).orderBy(*keys)

    def exported(self) -> DataFrame:
        """``export`` with the nested lists as JSON texts, one row for each question."""
        out = self.export()
        return out.select(*[X.json_of(F.col(c)).alias(c) if out.schema[c].dataType.typeName() == "array" else F.col(c) for c in out.columns])

    @staticmethod
    def imported(rows: DataFrame) -> DataFrame:
        """Question objects, as ``upsert`` takes them, from rows of ``exported``; lists that are null or empty texts are empty."""
        from quire.operators.assemble import PARTS

        kinds = {**PARTS, "topics": "array<string>"}
        return rows.select(*[F.coalesce(X.json_to(F.col(c), kinds[c]), F.array().cast(kinds[c])).alias(c) if c in kinds else F.col(c) for c in rows.columns])
