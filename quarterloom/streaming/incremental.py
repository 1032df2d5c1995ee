"""Incremental load as a stream: landed filings are appended once.

The ledger of visited filings is the state: a batch that is replayed after a
failure finds its filings there and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarterloom.operators.store import LEDGER, Store, absent


def load_batch(store: Store, batch: DataFrame) -> None:
    """Adds the filings of a batch that the ledger does not know."""
    store.create("ledger", LEDGER)
    store.append("ledger", absent(store.read("ledger"), batch.select(*LEDGER.fieldNames())))


def follow(spark: SparkSession, landing: str, store: Store, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Reads ledger rows landed as Parquet and loads every batch."""
    stream = spark.readStream.schema(LEDGER).parquet(landing)
    writer = stream.writeStream.foreachBatch(lambda df, _: load_batch(store, df)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
