"""Packing of documents into fixed windows, lexical neighbours first, by a sharded BM25 index."""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voxtally.llm.common import settle

WINDOW = 1024
END = 0
#: Ids are kept in 16 bits.
MAX_VOCABULARY = 1 << 16
#: Weighted min-hashes that order the pieces, 16 bits each.
ORDERS = 4
#: Rows are handed on after so many of them, or so many tokens.
BATCH_ROWS = 500
BATCH_TOKENS = 4_000_000
#: Pieces that share one index, at most.
SHARD = 256
#: Windows that a document can lead in a given order, at most: 17 billion tokens.
LEADS = 1 << 24
K1 = 1.2
B = 0.75

# Fixed value: the pre-tokenising pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The fast coder fails somewhere above 300,000 blanks.
LONG_BLANK = 10_000
_BLANK = re.compile(r"\s{64,}")


def _byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes bytes with: printable ones stand for themselves,
    the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Token ids of a byte-level BPE vocabulary file (the JSON of the tokenizers library).

    Where ids follow the order of the merges, a ranked coder gives the same ids faster; a file without
    that order is read by the tokenizers library alone. So are texts with a long run of white space, on
    which the coder's pattern overflows its stack. With `added`, so are texts that hold an added token of the file, such as
    <|endoftext|>, which is then one id; otherwise its letters are ordinary text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = not added
        self._added = [t.content for t in self._whole.get_added_tokens_decoder().values()] if added else []

        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        vocabulary = whole["model"]["vocab"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in whole["model"].get("merges", [])]
        places = [vocabulary.get(m.replace(" ", "", 1), -1) for m in merges]
        bytewise = (whole.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and whole.get("normalizer") is None
        self._coder = None
        if not (bytewise and merges and places[0] >= 0 and all(a < b for a, b in zip(places, places[1:]))):
            return
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if all(c in letters for c in token)}
        ranks.pop(b"<|endoftext|>", None)
        self._coder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint16)
        long = any(m.end() - m.start() >= LONG_BLANK for m in _BLANK.finditer(text))
        if self._coder is None or long or any(token in text for token in self._added):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint16)
        return np.array(self._coder.encode_ordinary(text), np.uint16)


def vocabulary_size(path: str) -> int:
    """Entries of a vocabulary file, added tokens included; more than 16 bits can tell apart is an error."""
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=-1) + 1
    if size > MAX_VOCABULARY:
        raise ValueError(f"{path} has ids up to {size - 1:,}; packing keeps ids below {MAX_VOCABULARY:,}")
    return size


@lru_cache(maxsize=2)
def _coder(path: str, added: bool) -> ByteTokens:
    """One coder per worker process, however many tasks it runs."""
    return ByteTokens(path, added)


_TOKENISED = "doc_id bigint, tokens bigint, tail binary, terms binary, counts binary, crcs array<bigint>, place bigint"


def _tokenise(path: str, window: int, added: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, added)
        names = [part.split()[0] for part in _TOKENISED.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64())
        for batch in batches:
            rows, tokens = [], 0
            for i in range(batch.num_rows):
                ids = np.append(coder.of(batch.column(1)[i].as_py() or ""), np.uint16(END))
                whole = len(ids) // window * window
                crcs = [zlib.crc32(ids[a : a + window].astype("<u4").tobytes()) for a in range(0, whole, window)]
                terms, counts = np.unique(ids, return_counts=True)
                rows.append((
                    batch.column(0)[i].as_py(), len(ids), ids[whole:].tobytes(), terms.tobytes(),
                    np.minimum(counts, 65_535).astype(np.uint16).tobytes(), crcs, batch.column(2)[i].as_py()))
                tokens += len(ids)
                if len(rows) >= BATCH_ROWS or tokens >= BATCH_TOKENS:
                    yield pa.record_batch([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names)
                    rows, tokens = [], 0
            if rows:
                yield pa.record_batch([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names)

    return run


def _frequencies(size: int) -> Callable:
    """Documents with each term, and as term -1 and -2 the documents and their tokens, of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, docs, tokens = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for terms in batch.column(0):
                sums[np.frombuffer(terms.as_buffer(), np.uint16)] += 1
            docs += batch.num_rows
            tokens += int(np.asarray(batch.column(1)).sum())
        used = np.flatnonzero(sums)
        yield pa.record_batch(
            [pa.array(np.concatenate([used, [-1, -2]]), pa.int64()), pa.array(np.concatenate([sums[used], [docs, tokens]]), pa.int64())], ["term", "n"])

    return run


def term_orders(frequency: np.ndarray, idf: np.ndarray, orders: int = ORDERS) -> np.ndarray:
    """`orders` random orders of the vocabulary, as ranks, in which rare terms tend to come first.

    Each is an exponential race: a term's chance to win over others is its squared idf, so two
    documents agree on their first term as often as their weighted term sets overlap. Terms of one
    document only can't be shared and come last.
    """
    weight = np.where(frequency > 1, idf**2, 0)
    drawn = np.random.default_rng(1).exponential(size=(orders, len(idf)))
    race = np.divide(drawn, weight, out=np.full_like(drawn, np.inf), where=weight > 0)
    return np.argsort(np.argsort(race, axis=1, kind="stable"), axis=1, kind="stable").astype(np.uint16)


def near_keys(terms: pa.Array, ranks: np.ndarray) -> np.ndarray:
    """Sort key of each term list: its least rank in every order, 16 bits each, in 63 bits."""
    lists = terms.to_pylist()
    if not lists:
        return np.empty(0, np.int64)
    flat = np.frombuffer(b"".join(lists), np.uint16)
    starts = np.cumsum([0] + [len(x) // 2 for x in lists[:-1]])
    key = np.zeros(len(lists), np.uint64)
    for order in ranks:
        key = key << np.uint64(16) | np.minimum.reduceat(order[flat], starts).astype(np.uint64)
    return (key >> np.uint64(1)).astype(np.int64)


class Shard:
    """Inverted index over the pieces at hand: term -> (pieces, BM25 weights). Placed pieces are masked."""

    def __init__(self, pieces: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray, mean: float) -> None:
        self._terms = [p[0] for p in pieces]
        self._idf = idf
        sizes = [len(t) for t in self._terms]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        terms = np.concatenate(self._terms) if pieces else np.empty(0, np.uint16)
        tf = np.concatenate([p[1] for p in pieces]).astype(np.float64) if pieces else np.empty(0)
        length = np.repeat([p[2] for p in pieces], sizes)
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        order = np.argsort(terms, kind="stable")
        self._owner, self._weight, terms = owner[order], weight[order], terms[order]
        self._first = np.searchsorted(terms, np.arange(len(idf) + 1))
        self.free = np.ones(len(pieces), bool)

    def neighbours(self, seed: int) -> np.ndarray:
        """Free pieces by falling score for the seed's terms, then by place."""
        terms = self._terms[seed]
        low, high = self._first[terms], self._first[terms.astype(np.int64) + 1]
        sizes = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        scores = np.bincount(self._owner[at], self._weight[at], minlength=len(self.free))
        free = np.flatnonzero(self.free)
        return free[np.argsort(-scores[free], kind="stable")]


class Piece:
    """What is left of a document: its tokens from `start` on, and the document's terms."""

    __slots__ = ("doc_id", "tokens", "start", "ids", "terms", "counts", "place")

    def __init__(self, doc_id, tokens, start, ids, terms, counts, place) -> None:
        self.doc_id, self.tokens, self.start, self.ids, self.terms, self.counts, self.place = doc_id, tokens, start, ids, terms, counts, place

    def cut(self, n: int) -> tuple:
        """The first n tokens, as (doc_id, start, length, crc32, tokens, place); they leave the piece."""
        taken = self.ids[:n]
        out = (self.doc_id, self.start, n, zlib.crc32(taken.astype("<u4").tobytes()), self.tokens, self.place)
        self.ids, self.start = self.ids[n:], self.start + n
        return out


def fill_windows(pieces: list[Piece], idf: np.ndarray, mean: float, window: int, last: bool) -> tuple[list[list[tuple]], list[Piece]]:
    """Full windows of the pieces, and what was left over for the next shard.

    The first free piece, by place, is the seed of a window. Its neighbours follow by score as long as they
    fit whole; if a gap stays, the best neighbour that does not fit is cut to fill it and its rest
    stays free. Without enough tokens for a full window the rest is handed on, or, as the `last`
    one, makes one short window.
    """
    pieces = sorted(pieces, key=lambda p: p.place)
    shard = Shard([(p.terms, p.counts, p.tokens) for p in pieces], idf, mean)
    left = sum(len(p.ids) for p in pieces)
    windows, seed = [], 0
    while left >= window or (last and left):
        while not shard.free[seed]:
            seed += 1
        piece, room = pieces[seed], min(window, left)
        placed = [piece.cut(min(len(piece.ids), room))]
        room -= placed[0][2]
        if not len(piece.ids):
            shard.free[seed] = False
        if room:
            too_long = []
            for i in shard.neighbours(seed):
                size = len(pieces[i].ids)
                if size <= room:
                    placed.append(pieces[i].cut(size))
                    shard.free[i] = False
                    room -= size
                    if not room:
                        break
                else:
                    too_long.append(i)
            if room:
                placed.append(pieces[too_long[0]].cut(room))
        left -= sum(p[2] for p in placed)
        windows.append(placed)
    return windows, [pieces[i] for i in np.flatnonzero(shard.free)]


_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence bigint, offset bigint, lead bigint"


def _packer(statistics, window: int, shard: int) -> Callable:
    names = [part.split()[0] for part in _PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = statistics.value
        sequence = 0
        waiting: list[Piece] = []

        def out(windows: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for placed in windows:
                offset = 0
                # The windows that a document leads start in different windows of its own.
                lead = placed[0][5] * LEADS + placed[0][1] // window
                for doc, start, length, crc, tokens, _ in placed:
                    rows.append((doc, start, length, crc, tokens, sequence, offset, lead))
                    offset += length
                sequence += 1
            return pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names)

        for batch in batches:
            columns = [batch.column(name) for name in ("doc_id", "tokens", "tail", "terms", "counts", "crcs", "place")]
            windows = []
            for i in range(batch.num_rows):
                doc, tokens, tail, terms, counts, crcs, place = (c[i] for c in columns)
                doc, tokens, crcs, place = doc.as_py(), tokens.as_py(), crcs.as_py(), place.as_py()
                windows += [[(doc, j * window, window, crc, tokens, place)] for j, crc in enumerate(crcs)]
                ids = np.frombuffer(tail.as_buffer(), np.uint16).copy()
                if len(ids):
                    waiting.append(Piece(
                        doc, tokens, len(crcs) * window, ids, np.frombuffer(terms.as_buffer(), np.uint16).copy(),
                        np.frombuffer(counts.as_buffer(), np.uint16).copy(), place))
                if len(waiting) >= shard:
                    full, waiting = fill_windows(waiting, idf, mean, window, False)
                    windows += full
            if windows:
                yield out(windows)
        if waiting:
            yield out(fill_windows(waiting, idf, mean, window, True)[0])

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, shard: int = SHARD,
    added: bool = False, order: str | None = None,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the vocabulary file, then id 0; `added` reads the file's added
    tokens in a text as their ids, as the tokenizers library does by default. Whole windows of a long document
    are sequences of their own; its rest, and every shorter document, goes to a shard of about
    `shard` pieces (a piece holds at most one entry per term of the vocabulary). The rows are
    range-partitioned by four weighted min-hashes of their terms (`term_orders`), so that documents
    which share rare terms sit close; shards follow each other in a partition, and what does not fill a window moves on to the
    next, so a partition pads one sequence at most. Each shard has a BM25 inverted index over whole
    documents, with document frequencies and the mean length of all of them (at most one row per
    vocabulary entry reaches the driver).

    `order` names a column with a number of each row below 2^39, from 0 on, no two equal. Documents
    are packed by what they share all the same, but of a shard the first one left is the next seed,
    and sequences follow each other, by their ids, as their first documents do.

    Null and empty texts have the id 0 alone. Rows with a null id and repeated ids are packed like
    others. Tokenised rows are written once to the shared folder, so a repeated task sees the same
    order. A vocabulary of more than 65,536 ids is an error. An empty table gives no pieces. Other columns are not read.
    """
    spark, size = docs.sparkSession, vocabulary_size(tokenizer_path)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), (F.col(order) if order else F.lit(0)).cast("bigint").alias("place"))
    rows = settle(slim.mapInArrow(_tokenise(tokenizer_path, window, added), _TOKENISED), "tokens")
    sums = (rows.select("terms", "tokens").mapInArrow(_frequencies(size), "term bigint, n bigint")
                .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    terms, n = sums.column("term").to_numpy(), sums.column("n").to_numpy()
    totals = defaultdict(int, {int(t): int(c) for t, c in zip(terms, n) if t < 0})
    frequency = np.zeros(size)
    frequency[terms[terms >= 0]] = n[terms >= 0]
    idf = np.log(1 + (totals[-1] - frequency + 0.5) / (frequency + 0.5))
    shared = spark.sparkContext.broadcast((idf, totals[-2] / max(totals[-1], 1)))
    orders = spark.sparkContext.broadcast(term_orders(frequency, idf))

    @F.arrow_udf("bigint")
    def near(terms: pa.Array) -> pa.Array:
        return pa.array(near_keys(terms, orders.value), pa.int64())

    packed = (rows.withColumn("near", near("terms")).repartitionByRange("near", "doc_id")
                  .sortWithinPartitions("near", "doc_id", "tokens", "tail")
                  .mapInArrow(_packer(shared, window, shard), _PIECES))
    # A sequence lies in one partition: its number there and the partition's make it unique, as does its lead in a given order.
    sequence = F.col("lead") if order else F.spark_partition_id().cast("bigint") * (1 << 40) + F.col("sequence")
    return packed.select(
        F.col("doc_id").alias(doc_id), "start", "length", "ids_crc32", "doc_tokens", sequence.alias("sequence_id"), "offset")
