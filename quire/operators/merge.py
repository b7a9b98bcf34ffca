"""Keyed upsert and merging of sources; the last load of a key wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], load: str = "load_seq", tie: list[str] = ()) -> DataFrame:
    """The row of each key with the highest load; Spark keeps one row for each key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(load).desc(), *[F.col(t).desc() for t in tie])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def union_sources(sources: list[DataFrame], load: str = "load_seq") -> DataFrame:
    """All sources with their place in the argument order."""
    return reduce(DataFrame.unionByName, [s.withColumn(load, F.lit(k)) for k, s in enumerate(sources)])


def overrides(rows: DataFrame, keys: list[str], source: str = "source", load: str = "load_seq", tie: str = "row_seq", any_source: bool = False) -> DataFrame:
    """Rows that replace an earlier one of the key: from another source, or from any (as for bare stores)."""
    w = Window.partitionBy(*keys).orderBy(load, tie)
    before = F.lag(source).over(w)
    return rows.withColumn("_before", before).where(F.col("_before").isNotNull() if any_source else F.col("_before") != F.col(source)).drop("_before")


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], load: str = "load_seq") -> DataFrame:
    """Parents of the batch replace stored ones of the same key; stored keys that the batch lacks stay."""
    fresh = latest(batch, keys, load)
    return stored.join(fresh, keys, "left_anti").unionByName(fresh)


def replace_children(stored: DataFrame, batch_children: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """All children of touched parents go; the batch's come in their place."""
    return stored.join(touched.select(*keys).distinct(), keys, "left_anti").unionByName(batch_children)


def split_formulas(options: DataFrame, formulas: DataFrame, keys: list[str], box: str = "bbox") -> DataFrame:
    """Formulas of options, tied to their label, and those of the question whose box no option has."""
    order = ["ord"] if "ord" in options.columns and "ord" in formulas.columns else []
    tied = options.select(*keys, *order, "label", "latex", box)
    loose = formulas.join(tied.select(*keys, box), [*keys, box], "left_anti").select(*keys, *order, F.lit(None).cast("string").alias("label"), "latex", box)
    return tied.unionByName(loose)


def with_ids(known: DataFrame, names: DataFrame, id_col: str, name_col: str, top: int | None = None) -> DataFrame:
    """``known`` (id, name) with new names added under the next ids, in name order. ``top`` is the highest id given so far, if ``known`` need not have it.

    Only names that are new are numbered, in ranges, so the whole table is never sorted in one task.
    """
    new = names.select(name_col).where(F.col(name_col).isNotNull()).distinct().join(known, name_col, "left_anti")
    if top is None:
        top = known.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    parts = new.sort(name_col).withColumn("_part", F.spark_partition_id())
    counts = parts.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = parts.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(name_col))).join(F.broadcast(counts.select("_part", "_before")), "_part")
    return known.select(id_col, name_col).unionByName(ranked.select((F.lit(top) + F.col("_before") + F.col("_n")).cast("long").alias(id_col), name_col))


def place_assets(candidates: DataFrame, path: str = "path", priority: str = "priority", overwrite: bool = False) -> DataFrame:
    """The source of each target path: the first placed, or the last if assets are overwritten."""
    w = Window.partitionBy(path).orderBy(F.col(priority).desc() if overwrite else F.col(priority))
    return candidates.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
