"""Failures of phases: papers that a phase reports leave all later phases.

The quarantine table has the phase that each failed paper fell out of first: (paper, phase, reason).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X

QUARANTINE = "paper string, phase string, reason string"
# Fixed value: what a line begins with that reports a paper.
PREFIX = "!!! PAPER-FAILED"


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], QUARANTINE)


def reported(lines: DataFrame, live: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(paper, phase): papers of the batch that lines of output (line) report; other lines and strange papers do not count."""
    found = lines.select(X.failure_line(F.col("line"), prefix).alias("f")).where("f is not null").select("f.paper", "f.phase")
    return found.join(live.select("paper"), "paper", "left_semi").distinct()


def fall_out(live: DataFrame, quarantine: DataFrame, failed: DataFrame, phase: str) -> tuple[DataFrame, DataFrame]:
    """The batch and the quarantine after a phase; ``failed`` has paper and, if known, reason.

    A paper in quarantine keeps the phase of its first failure.
    """
    reason = F.col("reason") if "reason" in failed.columns else F.lit(None)
    own = failed.select("paper", reason.cast("string").alias("reason")).where("paper is not null").groupBy("paper").agg(F.min("reason").alias("reason"))
    new = own.join(live.select("paper"), "paper", "left_semi").join(quarantine.select("paper"), "paper", "left_anti").select("paper", F.lit(phase).alias("phase"), "reason")
    return live.join(own.select("paper"), "paper", "left_anti"), quarantine.unionByName(new)


def run_phases(live: DataFrame, phases: list[tuple[str, Callable[[DataFrame], DataFrame | None]]], keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The papers (paper, ...) that got through all phases, and the quarantine.

    Each phase gets what is left of the batch and returns the lines of its output (line), or None if the whole of it failed. ``keep``
    is put around the state after each phase, to cut lineage (a checkpoint, a written table).
    """
    quarantine = empty(live.sparkSession)
    for name, run in phases:
        lines = run(live)
        failed = live.select("paper", F.lit("the batch failed").alias("reason")) if lines is None else reported(lines, live).select("paper")
        live, quarantine = fall_out(live, quarantine, failed, name)
        if keep:
            live, quarantine = keep(live), keep(quarantine)
    return live, quarantine
