"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh32_intdigest

from voxtally.llm.shingles import mix

#: Length of the anchors and of the substrings that choose them, in code points.
K = 12
S = 5
#: Texts below this length also get short anchors, of which an edit leaves some.
SHORT = 96
SHORT_K = 4
SHORT_S = 2

#: Characters of fingerprints after which a task hands its rows on.
OUT_CHARS = 4_000_000
#: Text of a range of ids that is compared in one task, about.
TASK_BYTES = 1 << 25

_PRIME = np.uint64(0x100000001B3)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def closed_syncmers(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 32-bit hashes) of the k-mers whose least s-mer is their first or last one.

    Whether a k-mer is chosen depends on its own characters only, so the same passage gives the
    same anchors wherever it stands.
    """
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    wide = codes.astype(np.uint64)
    smers = np.zeros(len(codes) - s + 1, np.uint64)
    for i in range(s):
        smers *= _PRIME
        smers += wide[i : len(codes) - s + 1 + i]
    smers = mix(smers)
    span = k - s + 1
    least, covered = smers, 1
    while covered < span:
        step = min(covered, span - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    at = np.flatnonzero((smers[:n] == least[:n]) | (smers[span - 1 : span - 1 + n] == least[:n]))
    # The s-mers from the front, and one at the end, cover the whole k-mer.
    hashed = np.zeros(len(at), np.uint64)
    for i in [*range(0, k - s, s), k - s]:
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + smers[at + i]
    return at, (mix(hashed) >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions): all distinct anchor hashes, ascending, with their first places.

    A text without any anchor (tiny ones) is one anchor as a whole; an empty text has none.
    """
    if not text:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    codes = code_points(text)
    at, hashed = closed_syncmers(codes, k, s)
    if len(codes) < SHORT:
        more, short = closed_syncmers(codes, SHORT_K, SHORT_S)
        at, hashed = np.concatenate([at, more]), np.concatenate([hashed, short])
    if not len(at):
        return np.array([xxh32_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint32), np.zeros(1, np.int64)
    kept, first = np.unique(hashed, return_index=True)
    return kept, at[first]


def as_text(mark: tuple[np.ndarray, np.ndarray]) -> str:
    """Base64 of a byte w, then by place: the hashes (4 bytes each), the steps from place to place (w bytes each).

    All little-endian; w is 1, 2, 4 or 8 and the first step is from 0. See `from_text`.
    """
    if not len(mark[0]):
        return ""
    order = np.argsort(mark[1], kind="stable")
    steps = np.diff(mark[1][order], prepend=0)
    width = next(w for w in (1, 2, 4, 8) if int(steps.max()) < 1 << 8 * w)
    packed = bytes([width]) + mark[0][order].astype("<u4").tobytes() + steps.astype(f"<u{width}").tobytes()
    return b64encode(packed).decode("ascii")


def from_text(packed: str) -> tuple[np.ndarray, np.ndarray]:
    """The (hashes, positions) that `as_text` packed."""
    if not packed:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    data = b64decode(packed)
    n = (len(data) - 1) // (4 + data[0])
    hashes, steps = np.frombuffer(data, "<u4", n, 1), np.frombuffer(data, f"<u{data[0]}", n, 1 + 4 * n)
    order = np.argsort(hashes, kind="stable")
    return hashes[order].astype(np.uint32), np.cumsum(steps.astype(np.int64))[order]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard of two whole anchor sets; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def matched_places(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Places of the anchors that two fingerprints share: (in the first text, in the second)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return sorted(zip(a[1][i].tolist(), b[1][j].tolist()))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """(id, n_chars, fingerprint) per row; a null text counts as empty. Row by row, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                texts = [t.as_py() or "" for t in batch.column(1)]
                yield pa.record_batch([
                    batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([as_text(fingerprint(t, **how)) for t in texts], pa.string())], ["id", "n_chars", "fingerprint"])

    return (docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
                .mapInArrow(run, "id bigint, n_chars bigint, fingerprint string").withColumnRenamed("id", doc_id))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COMPARED = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(how: dict[str, int]) -> Callable:
    """Compare each document with the next in a stream that is sorted by bucket, copy, id, text."""
    names = [part.split()[0] for part in _COMPARED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rows, held = None, [], 0

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                bucket, copy, key, body = (batch.column(c)[i].as_py() for c in range(4))
                mark = fingerprint(body, **how)
                if before is not None and before[0] == bucket:
                    _, old_key, old_body, old_mark = before
                    changed = edited(old_body, body)
                    other = fingerprint(changed, **how)
                    rows.append((
                        old_key, len(old_body), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(old_mark),
                        as_text(other), likeness(old_mark[0], other[0]), likeness(old_mark[0], mark[0])))
                    held += len(rows[-1][3]) + len(rows[-1][4])
                    if len(rows) >= 1000 or held >= OUT_CHARS:
                        yield out()
                        rows.clear()
                        held = 0
                before = None if copy else (bucket, key, body, mark)
        if rows:
            yield out()

    return run


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one that follows by ascending id, then text; after the last comes the
    first, and a lone row follows itself. Rows without an id come first. A null text counts as empty.

    Ids are cut into ranges of about equal size, whose lower ends are the only thing on the driver
    (one per TASK_BYTES of text, or per shuffle partition where those are more). The first row of a
    range is copied to the end of the range before it, so every range is a stream and a task of its
    own and no window spans the table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    ends = (rows.where("id IS NOT NULL").select("id").repartitionByRange(n, "id").groupBy(F.spark_partition_id().alias("p"))
                .agg(F.min("id").alias("low")).select("low"))
    lows = np.array(sorted(r.low for r in ends.collect()), dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        # Rows without an id stand before all others, in the first range.
        filled = ids.fillna(-(1 << 63)).astype(np.int64) if ids.hasnans else ids.astype(np.int64)
        return pd.Series(np.maximum(np.searchsorted(lows, filled, side="right") - 1, 0), dtype="int32")

    placed = rows.withColumn("bucket", bucket_of("id"))
    last = max(len(lows) - 1, 0)
    has_null = rows.where("id IS NULL").limit(1).count() > 0
    head = F.when(F.col("bucket") == 0, F.col("id").isNull() if has_null else F.col("id") == F.lit(int(lows[0]) if len(lows) else 0))
    head = head.otherwise(F.col("id") == F.get(F.lit(lows.tolist() or [0]).cast("array<bigint>"), F.col("bucket")))
    before = F.when(F.col("bucket") == 0, last).otherwise(F.col("bucket") - 1)
    own = F.struct("bucket", F.lit(0).alias("copy"))
    spots = F.when(head, F.array(own, F.struct(before.alias("bucket"), F.lit(1).alias("copy")))).otherwise(F.array(own))
    streams = (placed.select(F.inline(spots), "id", "text").repartitionById(n, "bucket")
                     .sortWithinPartitions("bucket", "copy", F.asc_nulls_first("id"), "text"))
    return streams.select("bucket", "copy", "id", "text").mapInArrow(_walk(how), _COMPARED).withColumnRenamed("id", doc_id)
