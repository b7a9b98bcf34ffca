"""Arriving question files into a stored bank, one commit for each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.plans.store import BankStore
from quire.sources.files import STAGES


def ingest(spark: SparkSession, source: str, bank_path: str, checkpoint: str, available_now: bool = True, fanout: int = 8, keep: int = 4):
    """Stream JSON-lines files of classified questions into the bank; returns the running query.

    A batch writes its own questions and their index only; parts are merged once a bucket has more than ``fanout``, and
    states before the last ``keep`` go. A batch that is run again replaces the same keys, so the bank comes out the same. Only where there
    is no bank yet does a batch begin one; a bank that cannot be read stops the query.
    """

    def load(batch: DataFrame, _: int) -> None:
        store = BankStore(batch.sparkSession, bank_path)
        store.upsert(batch)
        store.compact(fanout)
        store.expire(keep)

    stream = spark.readStream.schema(STAGES["classified_questions"]).json(source)
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
