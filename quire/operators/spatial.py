"""Spatial assignment: each item to the smallest region that holds half of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import geometry as G


def assign_regions(items: DataFrame, regions: DataFrame, keys: list[str], item: str = "ord", region: str = "region_ord", share: float = 0.5) -> DataFrame:
    """``items`` with ``region`` added, null where no region qualifies.

    Both sides have x0, y0, x1, y1. The page keys make this a hash or merge join with the
    overlap as a residual condition; the smallest region wins, then the first detected. Items
    without area match nothing. Empty or missing regions leave all items unassigned.
    """
    own = items.withColumn("_item", G.box("x0", "y0", "x1", "y1"))
    other = regions.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(region).alias(region), G.box("x0", "y0", "x1", "y1").alias("_region"))
    size = G.area(F.col("_item"))
    holds = (size > 0) & (G.intersection(F.col("_item"), F.col("_region")) >= share * size)
    on = holds
    for k in keys:
        on = (F.col(k) == F.col(f"_r_{k}")) & on
    both = own.join(other, on, "left")
    best = F.min_by(region, F.when(F.col(region).isNotNull(), F.struct(G.area(F.col("_region")), F.col(region))))
    names = [c for c in items.columns if c not in (*keys, item)]
    return both.groupBy(*keys, item).agg(*[F.first(c).alias(c) for c in names], best.alias(region))


def blocks(assigned: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each region with its items, reading order ``block_ord``; leftovers in one block of type other at the page's top, last."""
    content = assigned.groupBy(*keys, "region_ord").agg(F.array_sort(F.collect_list(F.struct("ord", "text", "x0", "y0", "x1", "y1"))).alias("content"))
    empty = F.array().cast(content.schema["content"].dataType)
    held = regions.join(content.where("region_ord is not null"), [*keys, "region_ord"], "left").select(*keys, "region_ord", "type", "x0", "y0", F.coalesce("content", empty).alias("content"), F.lit(0).alias("_last"))
    left = content.where("region_ord is null").select(*keys, F.lit(None).cast("long").alias("region_ord"), F.lit("other").alias("type"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), "content", F.lit(1).alias("_last"))
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy("_last", "y0", "x0", "region_ord")
    return held.unionByName(left).withColumn("block_ord", F.row_number().over(order)).drop("_last")
