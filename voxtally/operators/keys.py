"""Running numbers and batch numbers without a one-partition window.

Rows are range-partitioned, numbered inside their partition and written once to the shared folder;
the offset of a partition is the number of rows before it. The written table pins the partition of
each row, so both readers of it agree even when an executor is lost.
"""

from __future__ import annotations

from itertools import accumulate
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxtally.session import shared_path

# monotonically_increasing_id holds the partition above this bit and the position below it.
_SLOT_BITS = 33


def _slotted(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    path = shared_path(df.sparkSession, "numbered")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .withColumn("_slot", F.monotonically_increasing_id())
       .write.parquet(path))
    return df.sparkSession.read.parquet(path).withColumn(
        "_part", F.shiftright("_slot", _SLOT_BITS))


def dense_id(
    df: DataFrame, order: Sequence[Column | str], start: int = 1, name: str = "row_id",
) -> DataFrame:
    """Running number from `start` in `order`, which must end with a unique column."""
    rows = _slotted(df, order)
    # One row per partition of the written table, so the collected list is small by construction.
    sizes = sorted(rows.groupBy("_part").agg(F.count("*")).collect())
    before = accumulate((n for _, n in sizes), initial=start)
    offsets = df.sparkSession.createDataFrame(
        [(part, offset) for (part, _), offset in zip(sizes, before)], "_part bigint, _offset bigint")
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1))
            .drop("_part", "_slot", "_offset"))


def dense_id_within(
    df: DataFrame, group: str, order: Sequence[Column | str], name: str = "row_id",
) -> DataFrame:
    """Running number from 1 inside each group. A hot group spans many partitions: only its
    per-partition counts meet in one place.
    """
    rows = _slotted(df, [group, *order])
    runs = rows.groupBy("_part", group).agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col("_part").alias("_p"), F.col(group).alias("_g"), "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return (rows.join(offsets, same)
            .withColumn(name, F.col("_slot") - F.col("_first") + F.col("_before") + 1)
            .drop("_part", "_slot", "_p", "_g", "_first", "_before"))


def batch_id(df: DataFrame, order: Sequence[Column | str], size: int, name: str = "batch") -> DataFrame:
    """Batch number from 1 in `order`, `size` rows per batch."""
    numbered = dense_id(df, order, 0, "_row")
    return numbered.withColumn(name, F.floor(F.col("_row") / size) + 1).drop("_row")


def batch_id_within(
    df: DataFrame, group: str, order: Sequence[Column | str], size: int, name: str = "batch",
) -> DataFrame:
    """Batch number from 0 inside each group."""
    numbered = dense_id_within(df, group, order, "_row")
    return numbered.withColumn(name, F.floor((F.col("_row") - 1) / size)).drop("_row")


def phrase_key(record: Column, topic_pos: Column, kind: Column, phrase_pos: Column) -> Column:
    """Stable phrase id, built from where the phrase stands and not from a running index."""
    return F.concat_ws("-", record.cast("string"), topic_pos.cast("string"),
                       F.when(kind == "Pain Point", "p").otherwise("d"), phrase_pos.cast("string"))


def global_phrase_key(
    phrases: DataFrame, order: Sequence[Column | str], name: str = "phrase_id",
) -> DataFrame:
    """`<record id>-<running index>` over all phrases in `order`, for tables that were keyed so.
    A late record shifts the ids behind it; prefer the stable key.
    """
    numbered = dense_id(phrases, order, 0, "_index")
    return numbered.withColumn(
        name, F.concat_ws("-", F.col("Review_No"), F.col("_index"))).drop("_index")
