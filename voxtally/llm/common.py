"""Helpers that several operators share."""

from __future__ import annotations

from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxtally.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and go on from there: cuts the lineage, survives lost
    executors, and pins what a second reader sees.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_order(df: DataFrame, name: str) -> DataFrame:
    """`df` with `name`, the place of each row in its Parquet files, from 0 on: file after file, row after row.

    Files are read in any order, but a sorted table is written one partition after the other, so its
    files and their rows have its order. A table that was not read from Parquet files is written first.
    """
    try:
        stored = _in_files(df)
    except AnalysisException:
        stored = _in_files(settle(df, "stored"))
    # One row per file. Of parts above 99,999 the names are longer.
    sizes = sorted(stored.groupBy("_file").agg(F.max("_row")).collect(), key=lambda r: (len(r[0]), r[0]))
    before = accumulate((last + 1 for _, last in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame([(file, n) for (file, _), n in zip(sizes, before)], "_file string, _before bigint")
    return stored.join(F.broadcast(offsets), "_file").withColumn(name, F.col("_before") + F.col("_row")).drop("_file", "_before", "_row")


def _in_files(df: DataFrame) -> DataFrame:
    at = df.metadataColumn("_metadata")
    return df.select("*", at["file_path"].alias("_file"), at["row_index"].alias("_row"))


def crc_of_id(doc_id: str | Column) -> Column:
    """crc32 of the id as text, the hash by which rows are held out."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))


def bounded_sample(df: DataFrame, doc_id: str, rows: int) -> DataFrame:
    """About `rows` rows, chosen by a hash of the id, or all when there are no more.

    The share follows from a count, so the sample does not grow with the table. Rows without an id
    are left out.
    """
    total = df.count()
    if total <= rows:
        return df.where(F.col(doc_id).isNotNull())
    share = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return df.where(share < rows / total)
