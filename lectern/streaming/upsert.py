"""A ledger kept up to date from a stream of bibliography entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.ledger_table import LedgerTable


def keep_ledger(entries: DataFrame, table: LedgerTable, checkpoint: str, name: str = "entries") -> StreamingQuery:
    """Upsert what the stream has so far (citekey, pdf_hash), batch by batch, each exactly once.

    ``name`` stands for the stream in the table's manifest; a stream that starts
    from a new checkpoint needs another one.
    """

    def merge(batch: DataFrame, number: int) -> None:
        own = LedgerTable(batch.sparkSession, table.versions.path, table.slices)
        own.upsert(batch.persist(), batch=(name, number))
        batch.unpersist()

    return entries.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
