"""File sources and sinks."""

from __future__ import annotations

import csv
import logging
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

log = logging.getLogger(__name__)

CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False}


def matching_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths a glob pattern stands for, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of `schema` by name; missing ones are NULL, unreadable values become NULL."""
    return df.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def by_header(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """The files of each header, found by one job over all files. A file without a line has none and is left out."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("n"))
    # A line per file comes to the driver, which has the list of paths already.
    heads = lines.where(F.col("_metadata.file_block_start") == 0).groupBy("path").agg(F.min_by("value", "n").alias("head")).collect()
    given = {unquote(urlsplit(path).path): path for path in paths}
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(heads):
        names = tuple(next(csv.reader([row["head"].lstrip("\ufeff").rstrip("\r")], delimiter=sep)))
        found.setdefault(names, []).append(given[unquote(urlsplit(row["path"]).path)])
    return found


def read_many(
    spark: SparkSession, patterns: Iterable[str], schema: StructType,
    columns: Sequence[str] | None = None, fmt: str = "csv", per_file: bool = False, **options,
) -> DataFrame:
    """Every file of every pattern as one frame of `schema`.

    A pattern without files is warned about and skipped; no file at all gives an empty frame. CSV
    headers must agree with `schema`, else the read fails. Exports whose headers differ from file
    to file are read with `per_file`: one reader for all files of the same header, whose columns are matched by name.
    """
    paths = []
    for pattern in patterns:
        found = matching_files(spark, pattern)
        if not found:
            log.warning("no files match %s", pattern)
        paths.extend(found)
    if not paths:
        df = spark.createDataFrame([], schema)
    elif fmt != "csv":
        df = spark.read.format(fmt).options(**options).schema(schema).load(paths)
    elif per_file:
        reader = spark.read.options(**{**CSV_OPTIONS, **options})
        df = union_all([
            conform(reader.schema(StructType([StructField(name, StringType()) for name in header])).csv(files), schema)
            for header, files in by_header(spark, paths, options.get("sep", ",")).items()])
    else:
        df = spark.read.options(**{**CSV_OPTIONS, **options}).schema(schema).csv(paths)
    return df.select(*columns) if columns else df


def read_folder_or_empty(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
) -> DataFrame:
    """All files of a folder; a missing or empty folder is an empty frame of the same schema."""
    if matching_files(spark, f"{path}/*.{fmt}") or matching_files(spark, f"{path}/*=*"):
        reader = spark.read.schema(schema)
        stored = reader.options(**CSV_OPTIONS).csv(path) if fmt == "csv" else reader.format(
            fmt).load(path)
        return stored.select(*[f"`{name}`" for name in schema.names])
    return spark.createDataFrame([], schema)


def append_if_exists(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet",
) -> DataFrame:
    """Append a stored table in the column order of `columns`; without one, `df` is unchanged."""
    base = df.select(*[f"`{c}`" for c in columns])
    spark = df.sparkSession
    if not matching_files(spark, f"{path}/*.{fmt}"):
        log.warning("nothing to append at %s", path)
        return base
    return base.unionByName(read_folder_or_empty(spark, path, base.schema, fmt))


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Parquet by default. CSV gets a header and joined lists, as CSV has no list type."""
    writer = df
    if fmt == "csv":
        writer = df.select(*[
            F.array_join(f"`{name}`", ", ").alias(name) if kind.startswith("array") else F.col(f"`{name}`")
            for name, kind in df.dtypes])
    writer = writer.write.mode(mode).partitionBy(*partition_by) if partition_by \
        else writer.write.mode(mode)
    if fmt == "csv":
        writer.options(header=True, escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def contiguous_batches(df: DataFrame, batch: str, stop: int | None = None) -> DataFrame:
    """Rows of batches 1, 2, … up to the first missing number, and below `stop` if there is one."""
    wanted = (F.col(batch) >= 1) if stop is None else F.col(batch).between(1, stop - 1)
    present = df.where(wanted).select(F.col(batch).alias("n")).distinct()
    start = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("n"))
    following = start.unionByName(present.select(F.col("n").cast("bigint"))).select(
        (F.col("n") + 1).alias("n"))
    gap = following.join(present, "n", "left_anti").agg(F.min("n"))
    return df.where(wanted & (F.col(batch) < gap.scalar()))
