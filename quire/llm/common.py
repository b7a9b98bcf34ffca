"""Helpers shared by the corpus operators: shared scratch tables, text classes, global ranks.

Nothing here keeps data on one machine: intermediate tables are Parquet files
in the folder that the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import gc
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.plans.scratch import remove, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space of the corpus contracts: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"

def materialise(df: DataFrame, tag: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write the rows as Parquet in the shared folder and read them back.

    Writers of zstd hold native memory outside the heap; many small files are better off with snappy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that no later step reads."""
    for t in tables:
        path = getattr(t, "_quire_path", None)
        if path:
            remove(t.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that have been written out."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is the fast way wherever it changes no other character."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain | ~col.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}\p{Cn}&&[^\x00-\x7F]]"), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def global_rank(df: DataFrame, *order: Column, name: str = "rank", rows_per_part: int = 100_000) -> DataFrame:
    """Add ranks from 1 in the given order without sorting all rows in one task.

    Rows are dealt by range, ranked inside their range, and moved up by the
    counts of the ranges before (one number for each range).
    """
    n = max(1, math.ceil(df.count() / rows_per_part))
    parts = materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "rank")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(F.broadcast(sums.select("_part", "_before")), "_part").withColumn(name, F.col("_before") + inside).drop("_part", "_before")
