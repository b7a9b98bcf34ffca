"""Folders of papers and their files, as joins over one listing table.

A listing has a row for each file: (source, path, size), the path relative to its source's root. It is metadata
only; no file is opened. What a folder holds is an aggregate over the listing, and looking for a file is a join with it, so
nothing is asked of the store file by file. Empty folders and files without a byte do not
occur in a listing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X

# What makes a folder that of a paper.
CLASSIFIED = "topics/classified_questions.json"
IMAGES = "images"


def listing(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Files under each root, by the root's label; listed by Spark's reader, which leaves the contents alone."""

    def one(label: str, root: str) -> DataFrame:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        full = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toUri().getPath().rstrip("/")
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        path = F.regexp_replace("path", r"^[a-zA-Z0-9+.-]+:(//[^/]*)?", "")
        return files.select(F.lit(label).alias("source"), F.substr(path, F.lit(len(full) + 2)).alias("path"), F.col("length").alias("size"))

    return reduce(DataFrame.unionAll, [one(label, root) for label, root in roots.items()])


def _top(path: Column) -> Column:
    """The first folder of a path, null for a file of the root itself."""
    return F.when(path.contains("/"), F.substring_index(path, "/", 1))


def paper_dirs(files: DataFrame) -> DataFrame:
    """(source, stem, dir): the folders of papers under each source.

    A root that holds the phases' folders itself is one paper's, named after the source, and its children are not looked
    at; else each child that holds them is a paper's.
    """
    path = F.col("path")
    holds = lambda p: (p == CLASSIFIED) | p.startswith(f"{IMAGES}/")
    rest = F.when(path.contains("/"), F.substr(path, F.instr(path, "/") + 1))
    found = files.select("source", F.explode(F.array_compact(F.array(F.when(holds(path), F.lit("")), F.when(holds(rest), _top(path))))).alias("dir")).distinct()
    flat = found.where("dir = ''").select("source")
    child = found.where("dir <> ''").join(flat, "source", "left_anti")
    return child.select("source", F.col("dir").alias("stem"), "dir").unionByName(flat.select("source", F.col("source").alias("stem"), F.lit("").alias("dir")))


def expected_stems(files: DataFrame) -> DataFrame:
    """(source, stem): the stems of all PDFs under a source; the names of its folders where it has no PDF."""
    pdf = files.where(F.col("path").endswith(".pdf")).select("source", F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("stem"))
    dirs = files.select("source", _top(F.col("path")).alias("stem")).where("stem is not null").distinct()
    return pdf.unionByName(dirs.join(pdf.select("source").distinct(), "source", "left_anti"))


def asset_paths(code: Column, root: str, subfolder: str) -> Column:
    """Folders in which a paper's assets may lie, relative to the root's parent, best first: the root, then the paper's folder under the root or beside it."""
    stems = X.code_stems(code)
    under = lambda base: F.transform(stems, lambda s: F.concat(F.lit(base), s, F.lit(f"/{subfolder}")))
    return F.array_distinct(F.concat(F.array(F.lit(root)), under(f"{root}/"), under("")))


def locate(wanted: DataFrame, files: DataFrame, root: str, subfolder: str) -> DataFrame:
    """``wanted`` (paper_code, file, ...) with ``path``, the first place in which the file is; null where there is none.

    ``files`` has the paths (path) under the root's parent. Each row asks for seven places at most.
    """
    asked = wanted.select("paper_code", "file").distinct().select("paper_code", "file", F.posexplode(asset_paths(F.col("paper_code"), root, subfolder)).alias("_pos", "_dir"))
    there = asked.withColumn("path", F.concat_ws("/", "_dir", "file")).join(files.select("path").distinct(), "path")
    best = there.groupBy("paper_code", "file").agg(F.min_by("path", "_pos").alias("path"))
    return wanted.join(best, ["paper_code", "file"], "left")


def stored_code(papers: DataFrame, codes: DataFrame) -> DataFrame:
    """(stem, paper_code): the stored code of each paper's stem, whatever zeros its number has in front; null where there is none.

    ``codes`` are (paper_code, ord); of several spellings the one stored first counts.
    """
    own = papers.select("stem").distinct().withColumn("_key", X.unpadded_code(X.stem_code(F.col("stem"))))
    stored = codes.select(X.unpadded_code(F.col("paper_code")).alias("_key"), "paper_code", "ord")
    first = stored.groupBy("_key").agg(F.min_by("paper_code", F.struct("ord", "paper_code")).alias("paper_code"))
    return own.join(first, "_key", "left").select("stem", "paper_code")
