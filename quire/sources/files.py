"""Files: papers, JSON stage outputs, stored trees. All reading goes through Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
SPAN = f"struct<text:string,bbox:{BOX},font:struct<name:string,size:double,color:int,bold:boolean,italic:boolean>>"
IMAGE = f"struct<id:int,bbox:{BOX},file:string,width:int,height:int,ext:string>"
REGION = f"struct<id:string,type:string,bbox:{BOX},score:double,raw_label:string>"
REF = f"struct<id:string,page:int,bbox:{BOX}>"
STAGES = {
    "extraction": f"page int, width double, height double, spans array<{SPAN}>, images array<{IMAGE}>",
    "layout": f"page int, width double, height double, regions array<{REGION}>",
    "questions": f"question int, page int, end_page int, lines array<string>, spans array<struct<page:int,text:string,bbox:{BOX}>>, text string, images array<{REF}>, tables array<{REF}>, formulas array<{REF}>",
    "classified_questions": f"paper string, page int, question int, marks int, text string, images array<struct<file:string,bbox:{BOX}>>, tables array<struct<headers:array<string>,rows:array<array<string>>,bbox:{BOX}>>, "
    f"formulas array<struct<latex:string,bbox:{BOX}>>, question_images array<struct<page:int,file:string,bbox:{BOX}>>, options array<struct<label:string,text:string,formulas:array<struct<latex:string,bbox:{BOX}>>>>, topics array<string>",
}


def find_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """(path, stem, length) of PDFs under a folder, any case of the suffix, ordered by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][dD][fF]").load(root)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select("path", stem.alias("stem"), "length").orderBy("path")


def clashes(pdfs: DataFrame) -> DataFrame:
    """Stems that more than one file has."""
    return pdfs.groupBy("stem").agg(F.count("*").alias("n")).where("n > 1")


def read_stage(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """JSON files of a stage (an array or lines), with the paper's folder as ``paper_key``; bad files raise."""
    df = spark.read.schema(STAGES[stage]).option("multiLine", True).option("mode", "FAILFAST").option("encoding", "UTF-8").json(path)
    return df.withColumn("paper_key", F.element_at(F.split(F.input_file_name(), "/"), -3))


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def explode_spans(pages: DataFrame, key: str = "paper_key") -> DataFrame:
    """One row for each span of extracted pages, with its ordinal."""
    s = pages.select(F.col(key), "page", "width", "height", F.posexplode("spans").alias("ord", "s"))
    return s.select(key, "page", "width", "height", "ord", "s.text", *[F.col(f"s.bbox.{n}").alias(n) for n in ("x0", "y0", "x1", "y1")], F.col("s.font.name").alias("font"), F.col("s.font.size").alias("size"))


def explode_regions(pages: DataFrame, key: str = "paper_key") -> DataFrame:
    r = pages.select(F.col(key), "page", F.posexplode("regions").alias("region_ord", "r"))
    return r.select(key, "page", F.col("region_ord").cast("long"), F.col("r.id").alias("region_id"), "r.type", "r.score", *[F.col(f"r.bbox.{n}").alias(n) for n in ("x0", "y0", "x1", "y1")])


def paper_dirs(papers: DataFrame, root: str, subdirs: list[str]) -> DataFrame:
    """(stem, and a folder for each phase): <root>/<stem>/<phase>."""
    return papers.select("stem", *[F.concat_ws("/", F.lit(root), "stem", F.lit(s)).alias(s) for s in subdirs])


def to_json_lines(df: DataFrame):
    """Results as JSON, one object a row."""
    return df.toJSON()
