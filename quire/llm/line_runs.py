"""Line dedup with levelled sorted runs of line hashes.

A run holds, for the lines of a batch of documents, one row for each line key: two 64-bit
hashes and the number of documents that have it, sorted by the hashes. A batch's run is first
anti-joined with the runs before it: keys that one of those has in ``min_docs`` documents are
settled and not counted again. What is left joins level 0; when a level holds ``fanout`` runs
they are merged into one run of the next level. Documents are judged by the keys that reach the
threshold over all runs.

Everything is DataFrame code. Where the frequent keys are few (``IN_PLACE_KEYS``), every task gets
them as a table in which a key is looked up by its hash, and texts are not moved; more of
them are joined by a shuffle. Both ways give the same rows.

Defined results: null text is one empty line; empty keys are never dropped; a key counts once
for each document that has it, a document being all rows of one doc_id in the call (a row with
a null doc_id is a document of its own); each row is judged by its own text and gives one row;
an empty table gives an empty result; other columns of the input are never read. The two
hashes give 128 bits, so keys do not collide in practice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import BLANKS, ascii_lower, discard, materialise, scratch_path

#: Frequent keys up to which each task gets them all, 16 bytes a key.
IN_PLACE_KEYS = 100_000


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """Array with a struct of two hashes for each line; null where the key is shorter than one character."""
    lines = split_lines(text)
    # Each step is a transform of its own, so that no lambda computes its argument twice.
    other = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in BLANKS if c not in " \n"])
    bare = F.when(other, F.transform(lines, lambda x: F.btrim(x, F.lit(BLANKS)))).otherwise(F.transform(lines, F.trim))
    return F.transform(F.transform(bare, ascii_lower), lambda k: F.when(k != "", F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2"))))


class LineRuns:
    """The levelled store. ``fanout`` runs of one level are merged into one of the next.

    A key that a run has ``min_docs`` times is settled: its count may stop there.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, min_docs: int = 10):
        self.spark, self.fanout, self.min_docs = spark, fanout, min_docs
        self.levels: list[list[DataFrame]] = [[]]

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = 1) -> None:
        """Add the lines of ``docs`` in ``batches`` batches, whose runs are written in one pass over the texts."""
        own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        again = own.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("doc_id").alias("again_id"))
        split = lambda d: d.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"), F.sort_array(F.filter(line_keys(F.col("text")), lambda k: k.isNotNull())).alias("keys"))
        first = lambda d: d.select("doc_id", "batch", F.explode(F.filter(F.transform("keys", lambda k, i: F.when((i == 0) | (k != F.get("keys", i - 1)), k)), lambda k: k.isNotNull())).alias("k")).select("doc_id", "batch", "k.*")
        if again.limit(1).count():
            repeated = own.doc_id == F.col("again_id")
            keys = first(split(own.join(again, repeated, "left_anti"))).unionAll(first(split(own.join(again, repeated, "left_semi"))).distinct())
        else:
            keys = first(split(own))
        runs = keys.groupBy("batch", "h1", "h2").agg(F.count("*").alias("n")).sortWithinPartitions("batch", "h1", "h2")
        path = scratch_path(self.spark, "runs")
        runs.write.partitionBy("batch").option("compression", "snappy").parquet(path)
        table = self.spark.read.schema("h1 long, h2 long, n long, batch int").parquet(path)
        for b in range(batches):
            self._push(table.where(F.col("batch") == b).select("h1", "h2", "n"))

    def _push(self, run: DataFrame) -> None:
        settled = [r.where(F.col("n") >= self.min_docs).select("h1", "h2") for level in self.levels for r in level]
        if settled:
            run = run.join(reduce(DataFrame.unionAll, settled), ["h1", "h2"], "left_anti")
        self.levels[0].append(run)
        for level in range(64):
            if level >= len(self.levels) or len(self.levels[level]) < self.fanout:
                return
            merged = materialise(self._merge(self.levels[level]).sortWithinPartitions("h1", "h2"), f"level{level + 1}")
            discard(*self.levels[level])
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionAll, runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def counts(self) -> DataFrame:
        """All runs merged: h1, h2, n."""
        runs = [r for level in self.levels for r in level]
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long")
        return runs[0] if len(runs) == 1 else self._merge(runs)

    def judge(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", in_place: int = IN_PLACE_KEYS) -> DataFrame:
        """Columns doc_id, n_lines, kept (the lines left, joined by newlines), n_dropped."""
        frequent = materialise(self.counts().where(F.col("n") >= self.min_docs).select("h1", "h2"), "frequent", "snappy")
        n = frequent.count()
        own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        if not n:
            left = own.select("doc_id", split_lines(F.col("text")).alias("lines")).withColumn("kept", F.col("lines"))
        elif n <= in_place:
            left = self._by_table(own, frequent, n)
        else:
            left = self._by_shuffle(own, frequent)
        return left.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.array_join("kept", "\n").alias("kept"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))

    def _by_table(self, own: DataFrame, frequent: DataFrame, n: int) -> DataFrame:
        """(doc_id, lines, kept): the keys stand in ``n`` lists by the first hash, one list is read for each line."""
        lists = frequent.groupBy(F.pmod("h1", F.lit(n)).alias("at")).agg(F.collect_list(F.struct("h1", "h2")).alias("keys"))
        none = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
        full = self.spark.range(n).withColumnRenamed("id", "at").join(lists, "at", "left").select("at", F.coalesce("keys", none).alias("keys"))
        table = full.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "keys"))), lambda x: x["keys"]).alias("table"))
        rows = own.select("doc_id", split_lines(F.col("text")).alias("lines"), line_keys(F.col("text")).alias("keys"), table.scalar().alias("table"))
        hot = lambda k: F.array_contains(F.get("table", F.pmod(k["h1"], F.lit(n)).cast("int")), k)
        kept = F.filter(F.arrays_zip("lines", "keys"), lambda x: x["keys"].isNull() | ~hot(x["keys"]))
        return rows.select("doc_id", "lines", F.transform(kept, lambda x: x["lines"]).alias("kept"))

    @staticmethod
    def _by_shuffle(own: DataFrame, frequent: DataFrame) -> DataFrame:
        """(doc_id, lines, kept): line hashes meet the frequent keys, and the places that hit meet their texts."""
        own = own.withColumn("th", F.xxhash64("text"))
        lines = own.select("doc_id", "th", F.posexplode(line_keys(F.col("text"))).alias("at", "k")).where("k is not null").select("doc_id", "th", "at", "k.*")
        hits = lines.join(frequent, ["h1", "h2"], "left_semi").groupBy("doc_id", "th").agg(F.collect_set("at").alias("hot"))
        hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th"), "hot")
        both = own.join(hits, F.expr("doc_id <=> hit_id and th = hit_th"), "left").select("doc_id", split_lines(F.col("text")).alias("lines"), "hot")
        rest = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("hot"))
        return both.select("doc_id", "lines", F.when(F.col("hot").isNull(), F.col("lines")).otherwise(F.transform(rest, lambda i: F.get("lines", i))).alias("kept"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, batches: int = 8, fanout: int = 4, in_place: int = IN_PLACE_KEYS) -> DataFrame:
    """Add all documents to a new store, then judge each by the whole of it: lines whose key is in at least ``min_docs`` documents go."""
    runs = LineRuns(docs.sparkSession, fanout, min_docs)
    runs.add(docs, doc_id, text, batches)
    return runs.judge(docs, doc_id, text, in_place)


def add_batch(runs: LineRuns, batch: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Streaming form: add one batch's run, then judge that batch by all runs so far."""
    runs.add(batch, doc_id, text)
    return runs.judge(batch, doc_id, text)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE f.k IS NOT NULL)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.k = f.k
GROUP BY doc_id
"""
