"""Passages that repeat across documents: paragraph MinHash banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from voxtally.llm.common import settle
from voxtally.llm.components import connected_components
from voxtally.llm.near_duplicates import BROADCAST_IDS, _lists, untested_pairs, verify
from voxtally.llm.shingles import WIDTH, mix

PERCENT = 80
RECALL = 0.99
ROWS = 3
#: Words in a row of repeated paragraphs from which they count as a passage.
LEAST_WORDS = 24
#: A line is cut behind one of so many sentence ends, chosen by its last two words.
CUT = 4
#: Words of the runs that are compared wherever they stand in a line, and how many follow each other
#: until one is chosen: a copy of RUN + STEP - 1 words always holds a chosen one.
RUN = 24
STEP = 12

#: Bits of the filter of repeated runs per run, places a run has in it, and the size up to which it is broadcast.
FILTER_BITS = 16
FILTER_PROBES = 3
FILTER_BYTES = 64 << 20
#: Bits of one row of Spark's bitmap functions.
_BITMAP = 1 << 15

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def tune_bands(percent: int = PERCENT, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands of `rows` components that catch a pair at the least similarity with this probability."""
    miss, bands = 1.0, 0
    while miss > 1 - recall:
        miss, bands = miss * (1 - (percent / 100) ** rows), bands + 1
    return bands


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _MULTIPLIER)]), dtype=np.uint64)
    return _powers


def _sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """pick (minimum or maximum) over every n values that follow each other."""
    covered = 1
    while covered < n:
        step = min(covered, n - covered)
        values = pick(values[:-step], values[step:])
        covered += step
    return values


def _winnowed(hashed: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first words, hashes) of the chosen runs of RUN words; no run spans two texts."""
    m = len(hashed) - RUN + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    powers = _power_table(RUN)
    whole = np.zeros(m, np.uint64)
    for i in range(RUN):
        whole += hashed[i : i + m] * powers[i]
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    valid = owner[RUN - 1 :] == owner[:m]
    # The last runs of a text are not valid, more than STEP of them, so no stretch reaches into the next.
    padded = np.full(m + 2 * (STEP - 1), last)
    padded[STEP - 1 : STEP - 1 + m] = np.where(valid, mix(whole), last)
    # A run is least in some stretch when the greatest of the minima around it is its own.
    top = _sliding(_sliding(padded, STEP, np.minimum), STEP, np.maximum)
    own = padded[STEP - 1 : STEP - 1 + m]
    at = np.flatnonzero(valid & (top == own))
    return at, own[at].view(np.int64)


class Paragraphs:
    """Paragraphs of a few texts, as arrays.

    A paragraph is a line, or a part of one: lines are also cut behind sentence ends that their last
    two words pick. The choice looks at nothing else, so a passage has the same inner paragraphs
    wherever it stands. `text`, `position`, `start`, `end` (code points), `words` and `unit` (a
    64-bit hash of the words, in order) have one entry per paragraph; `shingles` are grouped by
    paragraph from `first` on. `word` is the number of its first word in the text.
    """

    def __init__(self, texts: list[str | None], width: int = WIDTH) -> None:
        texts = [t or "" for t in texts]
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        low = "\n".join(texts).encode("utf-8", "surrogatepass").lower().split()
        n = len(low)
        hashed = np.fromiter(map(xxh64_intdigest, low), np.uint64, n)
        stops = np.fromiter((w[-1] in b".!?" for w in low), bool, n)
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        edge = np.diff(np.concatenate([[1], blank, [1]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        lines = np.concatenate([[0], np.cumsum(codes == 10)])[starts]
        opens = np.ones(n, bool)
        if n:
            opens[1:] = lines[1:] != lines[:-1]
            picked = mix(hashed[1:] + hashed[:-1] * _MULTIPLIER) % np.uint64(CUT) == 0
            # The first word of a line has no word before it that belongs to the passage.
            opens[2:] |= (stops[1:] & picked & (lines[1:] == lines[:-1]))[:-1]
        a = np.flatnonzero(opens)
        b = np.append(a[1:], n)[: len(a)]
        self.words = b - a
        text_starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.text = np.searchsorted(text_starts, starts[a], side="right") - 1 if n else a
        self.start, self.end = starts[a] - text_starts[self.text], ends[b - 1] - text_starts[self.text]
        if not n:
            self.position, self.unit, self.first, self.shingles = a, np.empty(0, np.int64), a, hashed
            self.word = a
            return
        owner = np.searchsorted(text_starts, starts, side="right") - 1
        before = np.searchsorted(owner, np.arange(len(texts)))
        self.word = a - before[self.text]
        _, at, count = np.unique(self.text, return_index=True, return_counts=True)
        self.position = np.arange(len(a)) - np.repeat(at, count)
        rank = np.arange(n) - np.repeat(a, self.words)
        whole = np.add.reduceat(hashed * _power_table(int(self.words.max()) + 1)[rank], a)
        self.unit = mix(whole + self.words.astype(np.uint64)).view(np.int64)
        # Shingles inside paragraphs; a short paragraph is one shingle, its own hash.
        padded = np.concatenate([hashed, np.zeros(width, np.uint64)])
        runs = np.zeros(n, np.uint64)
        for i in range(width):
            runs = runs * _MULTIPLIER + padded[i : n + i]
        runs = mix(runs)
        short = self.words < width
        runs[a[short]] = mix(self.unit[short].view(np.uint64))
        kept = rank <= np.repeat(np.maximum(self.words - width, 0), self.words)
        self.shingles = runs[kept]
        self.first = np.concatenate([[0], np.cumsum(np.maximum(self.words - width, 0) + 1)])[:-1]

    def band_keys(self, bands: int, rows: int) -> np.ndarray:
        """(paragraph, band) keys of MinHash signatures; all paragraphs at once."""
        out = np.empty((len(self.unit), bands), np.int64)
        seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * _MULTIPLIER).reshape(-1, 2)
        for band in range(bands):
            key = np.full(len(self.unit), band + 1, np.uint64)
            for times, plus in seeds[band * rows : (band + 1) * rows]:
                least = np.minimum.reduceat(self.shingles * (times | np.uint64(1)) + plus, self.first)
                key = mix(key * _MULTIPLIER + least)
            out[:, band] = key.view(np.int64)
        return out


def _grouped(batch: pa.RecordBatch, chars: int = 200_000) -> Iterator[tuple[list, list[str | None]]]:
    ids, texts, size = [], [], 0
    for key, text in zip(batch.column(0), batch.column(1)):
        ids.append(key.as_py())
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_PARAGRAPHS = "id bigint, position int, start bigint, end bigint, words int, unit bigint, keys array<bigint>, word int"
_RUNS = "id bigint, start bigint, end bigint, words int, cluster bigint, word int"


def _signer(bands: int, rows: int, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _PARAGRAPHS.split(", ")]
        seen: set[int] = set()
        for batch in batches:
            for ids, texts in _grouped(batch):
                found = Paragraphs(texts, width)
                if not len(found.unit):
                    continue
                # Copies within a task send their keys once, so a very common paragraph stays cheap.
                if len(seen) > 200_000:
                    seen.clear()
                fresh = []
                for u in found.unit.tolist():
                    fresh.append(u not in seen)
                    seen.add(u)
                offsets = np.concatenate([[0], np.cumsum(np.array(fresh) * bands)]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.band_keys(bands, rows)[fresh].ravel()))
                yield pa.record_batch([
                    pa.array([ids[t] for t in found.text.tolist()], pa.int64()), pa.array(found.position, pa.int32()),
                    pa.array(found.start, pa.int64()), pa.array(found.end, pa.int64()), pa.array(found.words, pa.int32()),
                    pa.array(found.unit), keys, pa.array(found.word, pa.int32())], names)

    return run


def _chosen(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number of the first word in it, hash) of runs of RUN words of a few texts, chosen by winnowing: the least
    hash of every STEP that follow each other. Whether a run is chosen depends on the words around it only, so
    the same passage has the same runs in the middle of any line.
    """
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    hashed = np.fromiter(map(xxh64_intdigest, chain.from_iterable(words)), np.uint64, counts.sum())
    owner = np.repeat(np.arange(len(texts)), counts)
    at, chosen = _winnowed(hashed, owner)
    return owner[at], at - (np.cumsum(counts) - counts)[owner[at]], chosen


def _places(texts: list[str | None], owner: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in code points of the runs that begin at these words; texts without one are not looked at."""
    held, which = np.unique(owner, return_inverse=True)
    starts, ends = [], []
    for t in held.tolist():
        codes = np.frombuffer(texts[t].encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        edge = np.diff(np.concatenate([[1], blank, [1]]).astype(np.int8))
        starts.append(np.flatnonzero(edge == -1))
        ends.append(np.flatnonzero(edge == 1))
    if not len(held):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sizes = np.array([len(s) for s in starts])
    at = (np.cumsum(sizes) - sizes)[which] + word
    return np.concatenate(starts)[at], np.concatenate(ends)[at + RUN - 1]


def _run_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the chosen runs, each once per text."""
    for batch in batches:
        for _, texts in _grouped(batch):
            owner, _, hashed = _chosen(texts)
            order = np.lexsort((hashed, owner))
            owner, hashed = owner[order], hashed[order]
            new = np.ones(len(hashed), bool)
            new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
            yield pa.record_batch([pa.array(hashed[new], pa.int64())], ["cluster"])


def _run_rows(filter_bits: Callable[[], bytes | None]) -> Callable:
    """Rows of the chosen runs whose hash is in the filter (all runs without one)."""
    names = [part.split()[0] for part in _RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = filter_bits()
        bits = None if raw is None else np.frombuffer(raw, np.uint8)
        for batch in batches:
            for ids, texts in _grouped(batch):
                owner, word, unit = _chosen(texts)
                if bits is not None and len(unit):
                    at = _filter_places(unit, 8 * len(bits))
                    inside = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)
                    owner, word, unit = owner[inside], word[inside], unit[inside]
                start, end = _places(texts, owner, word)
                yield pa.record_batch([
                    pa.array([ids[t] for t in owner.tolist()], pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                    pa.array(np.full(len(unit), RUN), pa.int32()), pa.array(unit, pa.int64()), pa.array(word, pa.int32())], names)

    return run


def _filter_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(probe, hash) places in a filter of a power of two bits: both halves of the hash, added up."""
    whole = hashes.view(np.uint64)
    low, high = whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32)
    return np.stack([((low + np.uint64(i) * high) & np.uint64(bits - 1)).astype(np.int64) for i in range(FILTER_PROBES)])


def _run_filter(hashes: DataFrame, rows: int) -> bytes:
    """The filter of so many hashes, built by Spark; `_filter_places` says where a hash stands."""
    bits = _BITMAP
    while bits < rows * FILTER_BITS:
        bits *= 2
    low, high = F.col("cluster").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("cluster", 32)
    place = F.explode(F.array(*[(low + i * high).bitwiseAND(bits - 1) for i in range(FILTER_PROBES)]))
    parts = hashes.select(place.alias("p")).groupBy(F.expr(f"p div {_BITMAP}").alias("part")).agg(
        F.bitmap_construct_agg(F.col("p") % _BITMAP).alias("bits"))
    out = bytearray(bits // 8)
    for row in parts.collect():  # bits / 8 bytes in all, which the caller has bounded
        out[row["part"] * _BITMAP // 8 : (row["part"] + 1) * _BITMAP // 8] = row["bits"]
    return bytes(out)


def _repeated_runs(slim: DataFrame, max_bytes: int) -> DataFrame:
    """Rows of the runs that stand in two or more texts; a few others may be among them.

    Nearly all runs are unique. First only their hashes are counted. The rows are made from the texts a second
    time, for the hashes that a filter has; it grows with the repeated hashes and is broadcast up to `max_bytes`.
    Beyond that the rows of all runs are joined with those hashes.
    """
    counts = slim.mapInArrow(_run_hashes, "cluster bigint").groupBy("cluster").agg(F.count("*").alias("n"))
    several = settle(counts.where("n > 1").select("cluster"), "runs")
    rows = several.count()
    if 2 * rows * FILTER_BITS <= 8 * max_bytes:
        sent = slim.sparkSession.sparkContext.broadcast(_run_filter(several, rows))
        return settle(slim.mapInArrow(_run_rows(lambda: sent.value), _RUNS), "inline")
    return settle(slim.mapInArrow(_run_rows(lambda: None), _RUNS).join(several, "cluster", "left_semi"), "inline")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, a, b) from rows sorted by key and unit: the least unit of a key with each other one. One row is carried over."""
    key = center = None
    for batch in batches:
        keys, units = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        new = np.concatenate([[key is None or keys[0] != key], keys[1:] != keys[:-1]])
        group = np.cumsum(new)
        centers = np.concatenate([[center if center is not None else 0], units[new]])[group]
        key, center = keys[-1], centers[-1]
        kept = centers != units
        yield pa.record_batch([pa.array(keys[kept]), pa.array(centers[kept]), pa.array(units[kept])], ["key", "a", "b"])


def _sets(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _grouped(batch):
                found = Paragraphs(texts, width)
                parts = [np.unique(p).view(np.int64) for p in np.split(found.shingles, found.first[1:])] if len(found.unit) else []
                yield pa.record_batch([pa.array(found.unit, pa.int64()), _lists(parts)], ["node", "hashes"])

    return run


def _few(df: DataFrame) -> DataFrame:
    """Broadcast what was counted to be small; anything larger is joined by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, percent: int = PERCENT, recall: float = RECALL,
    rows: int = ROWS, least_words: int = LEAST_WORDS, width: int = WIDTH, max_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """One row per passage that also stands in another document: id, start, end, words, clusters, kept.

    Paragraphs (see `Paragraphs`) are compared by their shingles of `width` words. MinHash bands,
    as many as `recall` needs at `percent`, bring paragraphs together; each is paired with the least
    one of its bucket (a sorted stream, no group is held), pairs are confirmed by exact Jaccard on the
    whole paragraphs, and components of confirmed pairs are clusters; pairs of a bucket that its star
    did not try and that are in different components follow by prefix filter. Equal paragraphs are one from
    the start (64-bit hash of their words). A cluster in two or more documents repeats, and so does a
    chosen run of 24 words, by which copies in the middle of lines are found; neighbouring or
    overlapping repeated paragraphs and runs of a text form one passage, reported from `least_words` words on, so headers,
    footers and chance sentences stay. `kept` is true where no cluster of the passage stands in a
    document with a smaller id: what a removal would leave.

    Places are code points, the end exclusive. Null, empty and blank texts have no paragraph. Rows
    without an id are left out; rows that share an id are one document. An empty table gives an
    empty result; other columns are not read.
    """
    bands = tune_bands(percent, rows, recall)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    spots = settle(slim.mapInArrow(_signer(bands, rows, width), _PARAGRAPHS), "paragraphs")
    keyed = spots.where("size(keys) > 0").select(F.explode("keys").alias("key"), "unit")
    stars = settle(
        keyed.repartition("key").sortWithinPartitions("key", "unit").mapInArrow(_stars, "key bigint, a bigint, b bigint").distinct(), "stars")
    pairs = settle(stars.select("a", "b").distinct(), "pairs")
    nodes = pairs.selectExpr("a unit").union(pairs.selectExpr("b unit")).distinct()
    nodes = settle(nodes, "units")
    where = settle(spots.join(_few(nodes), "unit", "left_semi").groupBy("unit").agg(F.min("id").alias("id")).select("id").distinct(), "holders")
    sets = slim.join(_few(where), "id", "left_semi").mapInArrow(_sets(width), "node bigint, hashes array<bigint>")
    sets = settle(sets.join(_few(nodes.selectExpr("unit node")), "node", "left_semi").dropDuplicates(["node"]), "sets")
    links = settle(verify(pairs, sets, percent), "links")
    found = connected_components(links, "a", "b")
    crowded = stars.selectExpr("key", "a center", "b node").join(sets.selectExpr("node", "CAST(size(hashes) AS bigint) n"), "node")
    more = settle(verify(untested_pairs(crowded, found, sets, percent), sets, percent), "links")
    if not more.isEmpty():
        found = connected_components(links.union(more), "a", "b")
    clusters = found.withColumnRenamed("node", "unit")
    marked = (spots.drop("keys", "position").join(_few(clusters), "unit", "left")
                   .withColumn("cluster", F.coalesce("component", "unit")).drop("component", "unit"))
    marked = settle(marked, "clusters")
    whole = settle(_islands(_spans(marked, _common(marked))), "whole")
    runs = _repeated_runs(slim, max_bytes)
    inline = _spans(_uncovered(runs, whole), _common(runs))
    return (_islands(whole.unionByName(inline)).where(F.col("words") >= least_words)
            .select(F.col("id").alias(doc_id), "start", "end", "words", "clusters", "kept"))


def _common(marked: DataFrame) -> DataFrame:
    """(cluster, first) of the clusters that stand in two or more documents, with the least id of them."""
    common = (marked.groupBy("cluster").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                    .where("first < last").drop("last"))
    return settle(common, "repeated")


def _spans(marked: DataFrame, common: DataFrame) -> DataFrame:
    """The rows whose cluster is common, with kept: no document of it has a smaller id."""
    return marked.join(_few(common), "cluster").select(
        "id", "start", "end", "word", "words", F.array("cluster").alias("clusters"), (F.col("first") == F.col("id")).alias("kept"))


def _uncovered(runs: DataFrame, whole: DataFrame) -> DataFrame:
    """The runs that reach beyond the repeated paragraphs around them; the others, most of them, tell nothing new.

    They go before their clusters are looked up, so that only rows which count meet the clusters.
    """
    order = Window.partitionBy("id").orderBy("word", F.col("cluster").isNotNull())
    reach = F.max(F.when(F.col("cluster").isNull(), F.expr("word + words"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    slim = runs.select("id", "start", "end", "word", "words", "cluster")
    both = slim.unionByName(whole.select("id", "word", "words"), allowMissingColumns=True).withColumn("reach", reach)
    return settle(both.where("cluster IS NOT NULL AND (reach IS NULL OR reach < word + words)").drop("reach"), "uncovered")


def _islands(spans: DataFrame) -> DataFrame:
    """Spans of a document that overlap or follow each other without a word between become one."""
    order = Window.partitionBy("id").orderBy("word", "words", "start")
    before = F.max(F.expr("word + words")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.coalesce(F.col("word") > before, F.lit(True)).cast("int"))
    return (opened.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                  .groupBy("id", "island").agg(
                      F.min("start").alias("start"), F.max("end").alias("end"), F.min("word").alias("word"),
                      (F.max(F.expr("word + words")) - F.min("word")).cast("bigint").alias("words"),
                      F.sort_array(F.array_distinct(F.flatten(F.collect_list("clusters")))).alias("clusters"), F.min("kept").alias("kept"))
                  .drop("island"))


def without_passages(text: Column, spans: Column) -> Column:
    """The text without the (start, end) spans, which are sorted and apart."""
    pieces = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))).alias("out")),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, pieces).otherwise(text)
