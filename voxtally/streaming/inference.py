"""Extraction over a stream that survives restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from voxtally.operators.dedup import keep_first
from voxtally.operators.infer import infer_resumable
from voxtally.schemas import EXTRACTION


def start_inference(
    stream: DataFrame, id_col: str, infer: Callable[[DataFrame], DataFrame], store: str,
    checkpoint: str, slices: int | None = None,
) -> StreamingQuery:
    """Send unseen records of a stream through `infer` and keep the answers in `store`.

    `infer` gives rows of the extraction schema. Answers are keyed by record id: a micro-batch that
    is repeated after a crash only asks for what the store lacks. Of copies of an id in a micro-batch the
    first in the order of the other columns is asked.
    """
    order = [F.col(f"`{c}`").asc_nulls_last() for c in stream.columns if c != id_col]

    def answer(batch: DataFrame, number: int) -> None:
        records = keep_first(batch, id_col, order or [F.lit(1)]).withColumnRenamed(id_col, "review_id")
        infer_resumable(records, "review_id", infer, store, EXTRACTION, slices)

    return (stream.writeStream.foreachBatch(answer)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
