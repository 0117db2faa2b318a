"""Model calls as a partition-wise operator, and resumable runs of it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from voxtally.constants import BACKOFF_SECONDS, EXTRACTION_BATCH, FENCE, RETRIES
from voxtally.operators.idstore import IdStore
from voxtally.session import shared_path
from voxtally.sources.files import read_folder_or_empty

#: Records per commit.
SLICE_ROWS = 100_000
REPLY_SCHEMA = "record_ids array<string>, ok boolean, attempts int, reply string, error string"


def infer_batches(
    df: DataFrame, id_col: str, message_col: str, predict: Callable,
    instruction: str | Column | Mapping[tuple, str] = "",
    group_cols: Sequence[str] = (), size: int = EXTRACTION_BATCH, retries: int = RETRIES,
    backoff: float = BACKOFF_SECONDS, parallelism: int | None = None, factory: bool = False,
    json_reply: bool = True,
) -> DataFrame:
    """Send records in batches to a model and return one row per batch.

    `predict(instruction, messages) -> str` runs on the executors; with `factory` it is
    `predict() -> callable`, made once per task (for clients that cannot be pickled). Batches are
    cut from the rows of a task as they stream by, so no batch is gathered by a shuffle and memory
    holds one batch. With `group_cols` a batch never mixes groups; the rows are range-partitioned
    by group and id, which spreads a hot group over many tasks.

    An instruction as text, or as a mapping from group values to text, goes to the tasks once and not
    with every row; records of a group that the mapping lacks are not asked. Only an instruction
    that is a column travels with the rows.

    A failing call is retried, as is a JSON reply cut off in the middle. What still fails is a row
    with `ok = false` and the error; the run goes on.
    """
    carried = [instruction.alias("_prompt")] if isinstance(instruction, Column) else []
    rows = df.select(
        *group_cols, F.col(f"`{id_col}`").cast("string").alias("_id"),
        F.col(f"`{message_col}`").alias("_message"), *carried)
    by_column = bool(carried)
    constant = instruction if isinstance(instruction, str) else None
    shared = None if by_column or constant is not None else df.sparkSession.sparkContext.broadcast(
        dict(instruction))
    if group_cols:
        count = [parallelism] if parallelism else []
        rows = rows.repartitionByRange(*count, *group_cols, "_id").sortWithinPartitions(
            *group_cols, "_id")
    elif parallelism:
        rows = rows.repartition(parallelism)
    groups = list(group_cols)
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{g}` {kinds[g]}" for g in groups] + [REPLY_SCHEMA])

    def run(parts):
        import json
        import re
        import time

        import pandas as pd

        call = predict() if factory else predict
        prompts = shared.value if shared else {}

        def cut_off(text):
            bare = re.sub(FENCE, "", text.strip()).strip()
            try:
                json.loads(bare)
            except json.JSONDecodeError as err:
                return err.pos >= len(bare) or err.msg.startswith("Unterminated")
            return False

        def ask(prompt_text, messages):
            error = None
            for attempt in range(1, retries + 1):
                try:
                    reply = call(prompt_text, messages)
                    if not (json_reply and cut_off(reply or "")):
                        return True, attempt, reply, None
                    error = "reply cut off"
                except Exception as err:  # any client error counts as a failed call
                    error = f"{type(err).__name__}: {err}"
                if attempt < retries:
                    time.sleep(backoff)
            return False, retries, None, error

        def answer(batch):
            first = batch[0]
            outcome = ask(first[-1], [row[-2] for row in batch])
            return [*first[:-3], [row[-3] for row in batch], *outcome]

        names = [*groups, "record_ids", "ok", "attempts", "reply", "error"]
        batch = []
        for part in parts:
            done = []
            for row in part.itertuples(index=False, name=None):
                if not by_column:
                    text = constant if shared is None else prompts.get(row[:-2])
                    if text is None:
                        continue
                    row = (*row, text)
                if batch and (len(batch) == size or row[:-3] != batch[0][:-3]
                              or row[-1] != batch[0][-1]):
                    done.append(answer(batch))
                    batch = []
                batch.append(row)
            if done:
                yield pd.DataFrame(done, columns=names)
        if batch:
            yield pd.DataFrame([answer(batch)], columns=names)

    return rows.mapInPandas(run, schema)


def infer_resumable(
    df: DataFrame, key: str, infer: Callable[[DataFrame], DataFrame], store: str,
    schema: StructType, slices: int | None = None,
) -> DataFrame:
    """Run `infer` on the records whose key is not stored yet and return all stored rows.

    Work is skipped by record key and not by batch position, so new or reordered input never takes
    over an old answer. Stored keys are found through an id store beside the answers, so a run reads the
    buckets its known keys are in and not the answers. Each slice of the keys, one per SLICE_ROWS
    records unless told otherwise, is committed on its own: a crash loses at most one.
    """
    spark = df.sparkSession
    ids = IdStore(spark, f"{store}/_ids", key, df.schema[key].dataType.simpleString())
    ids.catch_up(store, "run", "parquet")
    ids.merge()
    path = shared_path(spark, "open")
    todo = ids.unseen(df)
    todo.write.parquet(path)
    todo = spark.read.schema(todo.schema).parquet(path)
    slices = slices or max(1, -(-todo.count() // SLICE_ROWS))
    run_id = uuid.uuid4().hex
    for i in range(slices):
        part = todo if slices == 1 else todo.where(F.pmod(F.xxhash64(key), F.lit(slices)) == i)
        infer(part).select(*schema.names).write.parquet(f"{store}/run={run_id}-{i}")
    ids.catch_up(store, "run", "parquet")
    return read_folder_or_empty(spark, store, schema)
