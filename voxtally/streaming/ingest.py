"""New exports as a stream: drop known ids, classify, detect and translate, append."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from voxtally.constants import KEYWORD_RULES
from voxtally.operators.classify import keyword_classify
from voxtally.operators.dedup import keep_first
from voxtally.operators.idstore import BUCKETS, IdStore
from voxtally.operators.language import LANGUAGE_COLUMNS, enrich_language
from voxtally.session import shared_path


def batch_folder(spark: SparkSession, number: int) -> str:
    """Name of a micro-batch. The stream id is kept in the checkpoint: it survives a restart, and a
    new checkpoint never writes over the folders of an old one.
    """
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"


def start_ingest(
    spark: SparkSession, source: str, sink: str, checkpoint: str, schema: StructType,
    id_col: str, text_col: str, fmt: str = "parquet", rules=KEYWORD_RULES, languages: bool = True,
    translator: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS, **options,
) -> StreamingQuery:
    """Read every new file of `source` once and append its unseen posts to `sink`.

    Posts get `label` and `main_entity` and, with `languages`, `Original Review Language` and `Translated
    Review`, for which `translator` is given the posts that are not English (see `enrich_language`).

    The ids of a micro-batch meet the stored ones each once, and what is new is reduced to one row per id with a
    limit before the shuffle, so copies of one id never gather in a task, and no state grows with the history. Stored ids are kept in buckets beside
    the rows (`IdStore`): a micro-batch reads the buckets in which a filter finds its ids, and no stored row.
    The batch is written to a folder of its own, named by stream and batch, and its ids are compared
    with those of other folders only: a repeated batch after a crash overwrites itself with the same rows.
    """
    ids = IdStore(spark, f"{sink}/_ids", id_col, schema[id_col].dataType.simpleString(), buckets)
    ids.catch_up(sink, "ingest")
    order = [F.col(f"`{c}`").asc_nulls_last() for c in schema.names if c != id_col]

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        store = IdStore(session, ids.root, ids.key, ids.kind, buckets)
        folder = batch_folder(session, number)
        store.merge(without=folder)
        fresh = keyword_classify(keep_first(store.unseen(batch, folder), id_col, order), text_col, rules)
        if languages and translator is not None:
            # Written once: the model's answers, the English and the other rows are all read from it.
            path = shared_path(session, "fresh")
            fresh.write.parquet(path)
            fresh = session.read.schema(fresh.schema).parquet(path)
        if languages:
            fresh = enrich_language(fresh, text_col, translator)
        added = ["label", "main_entity", *(LANGUAGE_COLUMNS if languages else ())]
        fresh.select(*[f"`{c}`" for c in (*schema.names, *added)]).write.mode("overwrite").parquet(f"{sink}/ingest={folder}")
        store.add(session.read.schema(schema).parquet(f"{sink}/ingest={folder}").select(f"`{id_col}`"), folder)

    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(source)
    return (stream.writeStream.foreachBatch(append)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
