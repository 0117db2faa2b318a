"""Topic vocabulary that grows with a stream of extraction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from voxtally.operators.joins import new_only
from voxtally.operators.rollup import vocabulary
from voxtally.sources.files import read_folder_or_empty
from voxtally.streaming.ingest import batch_folder


def start_vocabulary(
    stream: DataFrame, col: str, store: str, checkpoint: str,
) -> StreamingQuery:
    """Append the unseen values of `col` per micro-batch; a repeated batch overwrites itself."""
    stored = StructType().add(col, StringType()).add("batch", "string")

    def merge(batch: DataFrame, number: int) -> None:
        seen = read_folder_or_empty(batch.sparkSession, store, stored)
        folder = batch_folder(batch.sparkSession, number)
        fresh = new_only(vocabulary(col, batch), seen.where(F.col("batch") != folder), col)
        fresh.select(col).write.mode("overwrite").parquet(f"{store}/batch={folder}")

    return (stream.writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
