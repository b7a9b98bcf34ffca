"""Nested question objects from their parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as X
from quire.operators import order as O
from quire.operators.options import options_of

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def resolve(refs: DataFrame, assets: DataFrame, keys: list[str], refs_col: str, asset_key: str, value: Column, name: str) -> DataFrame:
    """(keys, name): values of the assets that an array of reference ids points at, in order; unknown ids fall out.

    ``keys`` begin with the paper, which assets share.
    """
    paper = keys[0]
    each = refs.select(*keys, F.posexplode(refs_col).alias("_pos", "_id"))
    own = assets.select(F.col(paper).alias("_paper"), F.col(asset_key).alias("_asset"), value.alias("_value"))
    hit = each.join(own, (F.col(paper) == F.col("_paper")) & (F.col("_id") == F.col("_asset")))
    return hit.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_value"))), lambda x: x["_value"]).alias(name))


def with_default(left: DataFrame, right: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Left join of a list column, empty where there is none."""
    out = left.join(right.select(*keys, name), keys, "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(out.schema[name].dataType)))


def first_code(spans: DataFrame, keys: list[str], fallback: Column | None = None) -> DataFrame:
    """(keys, code): the first code printed in page and span order, else the fallback."""
    code = X.find_code(F.col("text"))
    first = F.min_by(code, F.when(code.isNotNull(), F.struct("page", "ord")))
    return spans.groupBy(*keys).agg(F.coalesce(first, fallback if fallback is not None else F.lit("unknown")).alias("code"))


def crop_ranges(parts: DataFrame, keys: list[str], pages: DataFrame, margin: float = 6.0) -> DataFrame:
    """(keys, page, crop): the strip of each page that a question covers. ``parts``: keys, page, y0, y1 of all spans and regions; ``pages``: paper, page, width, height."""
    paper = keys[0]
    span = parts.groupBy(*keys, "page").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return span.join(pages, [paper, "page"]).select(*keys, "page", G.strip_crop(F.col("y0"), F.col("y1"), F.col("width"), F.col("height"), margin).alias("crop"))


def export_name(images: Column, region_id: Column) -> Column:
    """File of an exported image: the first embedded raster, else a crop named after the region."""
    return F.when(F.size(images) > 0, F.get(images, F.lit(0))).otherwise(F.concat(region_id, F.lit(".png")))


FORMULA = f"struct<latex:string,bbox:{BOX}>"
PARTS = {
    "images": f"array<struct<file:string,bbox:{BOX}>>", "tables": f"array<struct<headers:array<string>,rows:array<array<string>>,bbox:{BOX}>>", "formulas": f"array<{FORMULA}>",
    "question_images": f"array<struct<page:bigint,file:string,bbox:{BOX}>>", "options": f"array<struct<label:string,text:string,formulas:array<{FORMULA}>>>",
}


def build(parsed: DataFrame, spans: DataFrame, refs: DataFrame, assets: DataFrame, crops: DataFrame, codes: DataFrame) -> DataFrame:
    """Built questions: paper (its code), page, question, marks, text, images, tables, formulas, question_images, options.

    ``parsed``: paper, question, page, text, one row for each question; ``spans``: paper, question, page, ord, text, x0, y0; ``refs``: paper,
    question, ord, region_id, type (image, table or formula), page, bbox; ``assets``: paper, region_id and the columns file, latex, headers, rows
    (those that a type has); ``crops``: paper, question, page, file, bbox of whole questions; ``codes``: paper, code.

    All that belongs to a question meets in one shuffle by (paper, question): spans and a placeholder without text for each formula in reading
    order, by which options get their formulas, and the assets that references find by region id; references that find none fall out.
    Parts of unknown questions fall out, questions without parts stay.
    """
    keys = ["paper", "question"]
    have = [c for c in ("file", "latex", "headers", "rows") if c in assets.columns]
    own = assets.select(F.col("paper").alias("_paper"), F.col("region_id").alias("_id"), *have)
    found = refs.join(own, (F.col("paper") == F.col("_paper")) & (F.col("region_id") == F.col("_id")))
    for name, kind in (("file", "string"), ("latex", "string"), ("headers", "array<string>"), ("rows", "array<array<string>>")):
        if name not in have:
            found = found.withColumn(name, F.lit(None).cast(kind))
    c, box = F.col, stored_box(F.col("bbox"))
    long = lambda n: c(n).cast("long").alias(n)
    rows = [
        parsed.select("paper", long("question"), F.lit("question").alias("kind"), long("page"), "text"),
        spans.select("paper", long("question"), F.lit("span").alias("kind"), long("page"), long("ord"), "text", c("x0").cast("double").alias("x0"), c("y0").cast("double").alias("y0")),
        found.select("paper", long("question"), c("type").alias("kind"), long("page"), long("ord"), F.lit("").alias("text"), c("bbox.x0").cast("double").alias("x0"), c("bbox.y0").cast("double").alias("y0"), box.alias("bbox"), "file", "latex", "headers", "rows"),
        crops.select("paper", long("question"), F.lit("crop").alias("kind"), long("page"), "file", box.alias("bbox")),
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).repartition(*keys)
    # Windows over (paper, question, item or not) and the aggregate all work on that one partitioning.
    both = both.withColumns({"_item": c("kind").isin("span", "formula"), "_at": F.struct((c("kind") == "formula").alias("late"), "ord")})
    group = [*keys, "_item"]
    placed = O.reading_rank(O.cluster_rows(both, group, "y0", 9.0, ordinal="_at", page="page"), group, ordinal="_at")
    formula = F.when(c("kind") == "formula", F.struct("latex", "bbox").cast(FORMULA))
    listed = lambda kind, order, *entry: F.transform(F.array_sort(F.collect_list(F.when(c("kind") == kind, F.struct(*order, F.struct(*entry).alias("_e"))))), lambda s: s["_e"]).cast(PARTS[f"{kind}s" if kind != "crop" else "question_images"])
    whole = placed.groupBy(*keys).agg(
        F.max(F.when(c("kind") == "question", F.struct("page", "text"))).alias("_q"),
        F.array_sort(F.collect_list(F.when(c("_item"), F.struct("place", X.strip(c("text")).alias("t"), formula.alias("formula"))))).alias("_items"),
        listed("image", ["ord"], "file", "bbox").alias("images"), listed("table", ["ord"], "headers", "rows", "bbox").alias("tables"), listed("formula", ["ord"], "latex", "bbox").alias("formulas"),
        listed("crop", ["page"], "page", "file", "bbox").alias("question_images"),
    )
    out = whole.where("_q is not null").join(codes.select("paper", "code"), "paper", "left")
    text = c("_q.text")
    return out.select(F.coalesce("code", c("paper").cast("string")).alias("paper"), c("_q.page").alias("page"), "question", X.marks(F.coalesce(text, F.lit(""))).alias("marks"), text.alias("text"), "images", "tables", "formulas", "question_images", options_of(c("_items"), PARTS["options"]).alias("options"))


def stored_box(b: Column) -> Column:
    """A box as it is stored."""
    return F.struct(*[b[n].cast("double").alias(n) for n in ("x0", "y0", "x1", "y1")])
