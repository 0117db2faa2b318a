"""Model runs that commit slice by slice, with their answers and failures as tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from voxtally.operators.infer import REPLY_SCHEMA, SLICE_ROWS
from voxtally.session import shared_path
from voxtally.sources.files import matching_files, read_folder_or_empty

#: Records a task should have at least, so that small runs use several tasks and no task is empty.
TASK_ROWS = 50
#: Slices of a run at most, unless the number of records per slice is given, so that the jobs of a run stay as many.
SLICES = 8
#: Files of open records per slice, at least.
SLICE_FILES = 4
FAILURE = (
    StructField("reason", StringType()), StructField("error", StringType()),
    StructField("attempts", IntegerType()), StructField("asked_at", TimestampType()))


class RunLog:
    """What a model was asked and what came of it, in a folder.

    `replies/slice=…` holds the replies of a slice as they came, `outcomes/slice=…` what was read from
    them: a row per answer (`ok=true`) and a row per record without one (`ok=false`, with the reason).
    Each is one Spark write, so a slice is there as a whole or not at all, and a reader sees only slices
    that ended. A run that dies between two slices loses the one it was at, and where its replies are written
    they are read again and not paid twice.

    Records are skipped by key and not by position. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType):
        self.spark, self.path, self.key, self.schema = spark, path, key, schema
        self._outcome = StructType([*schema.fields, *FAILURE])

    def _ended(self, kind: str) -> set[str]:
        marks = matching_files(self.spark, f"{self.path}/{kind}/slice=*/_SUCCESS")
        return {mark.rsplit("/", 2)[1].removeprefix("slice=") for mark in marks}

    def _table(self, kind: str, schema: StructType, *parts: tuple[str, str]) -> DataFrame:
        begun = {p.rsplit("=", 1)[1] for p in matching_files(self.spark, f"{self.path}/{kind}/slice=*")}
        stored = StructType([*schema.fields, StructField("slice", StringType()), *[StructField(n, StringType()) for n, _ in parts]])
        if not begun:
            return self.spark.createDataFrame([], stored)
        rows = read_folder_or_empty(self.spark, f"{self.path}/{kind}", stored)
        for name, value in parts:
            rows = rows.where(F.col(name) == value)
        broken = begun - self._ended(kind)
        return rows.where(~F.col("slice").isin(*broken)) if broken else rows

    def ended(self) -> set[str]:
        """The names of the slices whose outcomes are there."""
        return self._ended("outcomes")

    def answers(self, but: Collection[str] = ()) -> DataFrame:
        """All answers so far, without those of the slices `but`."""
        rows = self._table("outcomes", self._outcome, ("ok", "true"))
        return (rows.where(~F.col("slice").isin(*but)) if but else rows).select(*self.schema.names)

    def replies(self) -> DataFrame:
        """The replies as they came, a row per batch."""
        return self._table("replies", StructType.fromDDL(REPLY_SCHEMA)).drop("slice")

    def failures(self) -> DataFrame:
        """Records that were asked and have no answer yet, with what went wrong the last time.

        `reason` is `call` (the model failed, see `error`), `truncated`, `malformed`, `missing` or `invalid` (the
        reply could not be read) or `unanswered` (the reply left the record out).
        """
        failed = self._table("outcomes", self._outcome, ("ok", "false"))
        last = failed.groupBy(self.key).agg(F.max(F.struct("asked_at", "reason", "error", "attempts")).alias("last"))
        return last.select(self.key, "last.reason", "last.error", "last.attempts", "last.asked_at").join(
            self.answers().select(self.key), self.key, "left_anti")

    def run(
        self, records: DataFrame, ask: Callable[[DataFrame], DataFrame],
        read: Callable[[DataFrame], tuple[DataFrame, DataFrame] | DataFrame], slice_rows: int | None = None,
    ) -> DataFrame:
        """Ask for the records without an answer, and return all answers.

        `ask` sends records to the model (`infer_batches`), `read` turns its rows into answers with the columns of
        the schema and rejects (`parse_reply`: the same rows with `reject_reason`), or into one table of both, a row per
        record that was asked, with `reason` (NULL for an answer), `error` and `attempts` (`by_record`). Records without a key are left out.
        The open records are written once, in files of a part of a slice; a slice is some of these files. It has at most
        `slice_rows` records, by default SLICE_ROWS, or more where there would be more than SLICES of them.
        """
        for name in sorted(self._ended("replies") - self._ended("outcomes")):
            self._settle(name, read, self.spark.read.parquet(f"{self.path}/replies/slice={name}").schema)
        path = shared_path(self.spark, "open")
        todo = records.where(F.col(self.key).isNotNull())
        if self._ended("outcomes"):
            todo = todo.join(self.answers().select(self.key).distinct(), self.key, "left_anti")
        todo.write.option("maxRecordsPerFile", max(1, (slice_rows or SLICE_ROWS) // SLICE_FILES)).parquet(path)
        run = uuid.uuid4().hex
        for i, (files, rows) in enumerate(self._slices(path, todo.schema, slice_rows)):
            name = f"{run}-{i}"
            part = self.spark.read.schema(todo.schema).parquet(*files)
            tasks = min(self.spark.sparkContext.defaultParallelism, 1 + rows // TASK_ROWS)
            asked = ask(part.repartition(tasks) if len(files) < tasks else part)
            asked.write.parquet(f"{self.path}/replies/slice={name}")
            self._settle(name, read, asked.schema)
        return self.answers()

    def _slices(self, path: str, schema: StructType, slice_rows: int | None) -> list[tuple[list[str], int]]:
        """The files of each slice of the open records, and how many records they have."""
        # A row per file comes to the driver, which lists them anyway.
        counts = self.spark.read.schema(schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("name")).count().collect()
        most = slice_rows or max(SLICE_ROWS, -(-sum(r["count"] for r in counts) // SLICES))
        slices: list[tuple[list[str], int]] = []
        for name, n in sorted(counts):
            files, rows = slices[-1] if slices else ([], 0)
            if not files or rows + n > most:
                slices.append(([f"{path}/{name}"], n))
            else:
                slices[-1] = ([*files, f"{path}/{name}"], rows + n)
        return slices

    def _settle(self, name: str, read: Callable, schema: StructType) -> None:
        """Write the outcomes of a slice from its replies, which have this schema."""
        replies = self.spark.read.schema(schema).parquet(f"{self.path}/replies/slice={name}")
        found = read(replies)
        both = found if isinstance(found, DataFrame) else self._with_failures(replies, *found)
        typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self._outcome.fields if f.name != "asked_at"]
        ok = F.when(F.col("reason").isNull(), "true").otherwise("false").alias("ok")
        both.select(*typed, F.current_timestamp().alias("asked_at"), ok).write.mode("overwrite").partitionBy("ok").parquet(
            f"{self.path}/outcomes/slice={name}")

    def _with_failures(self, replies: DataFrame, answers: DataFrame, rejects: DataFrame) -> DataFrame:
        """The answers, and a row with its reason for each record that was asked and has none."""
        answers = answers.select(*self.schema.names)
        refused = rejects.select(F.explode("record_ids").alias(self.key), "reject_reason").groupBy(self.key).agg(
            F.min("reject_reason").alias("_why"))
        asked = replies.select(F.explode("record_ids").alias(self.key), "ok", "error", "attempts")
        reason = F.when(~F.col("ok"), "call").otherwise(F.coalesce("_why", F.lit("unanswered")))
        # Merged and not broadcast: what reaches the driver must not grow with the records.
        answered = answers.select(self.key).distinct().hint("merge")
        failed = asked.join(answered, self.key, "left_anti").join(refused.hint("merge"), self.key, "left").select(
            self.key, reason.alias("reason"), "error", "attempts")
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in FAILURE[:3]]
        return answers.select("*", *none).unionByName(failed, allowMissingColumns=True)


def open_log(spark: SparkSession, store: str | None, label: str, key: str, schema: StructType) -> RunLog:
    """The log in `store`, or one of its own in the shared folder."""
    return RunLog(spark, store or shared_path(spark, label), key, schema)
