"""Language spans of mixed texts: script ranges, per-word n-gram scores, Viterbi with a switching penalty."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from voxtally.llm.common import bounded_sample

#: Labelled rows that a model is fitted on, at most (about); the sample is a hash share of the ids.
FIT_ROWS = 20_000
#: Buckets of the letter trigrams.
BUCKETS = 1 << 16
#: Nats that a switch between languages costs.
SWITCH = 20.0
#: A language uses a script when so large a share of its training letters is in it.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

# Code point ranges of scripts (Unicode blocks).
SCRIPTS = (
    ("Latin", 0x0041, 0x024F), ("Latin", 0x1E00, 0x1EFF), ("Greek", 0x0370, 0x03FF), ("Greek", 0x1F00, 0x1FFF),
    ("Cyrillic", 0x0400, 0x052F), ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x06FF), ("Arabic", 0x0750, 0x077F), ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF), ("Tamil", 0x0B80, 0x0BFF), ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Hangul", 0xAC00, 0xD7AF),
    ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF), ("Han", 0x20000, 0x323AF),
)
_SCRIPT_IDS = {name: i + 1 for i, name in enumerate(dict.fromkeys(s[0] for s in SCRIPTS))}
_TOP = 0x323B0


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its lower case inside words (0 elsewhere), whether it is a letter, its script."""
    lower, letter, script = np.zeros(_TOP, np.uint32), np.zeros(_TOP, bool), np.zeros(_TOP, np.uint8)
    for i in range(_TOP):
        ch = chr(i)
        if ch.isalpha():
            low = ch.lower()
            lower[i], letter[i] = ord(low) if len(low) == 1 else i, True
        elif unicodedata.category(ch)[0] == "M":
            lower[i] = i
    for name, first, last in SCRIPTS:
        script[first : last + 1] = _SCRIPT_IDS[name]
    return lower, letter, script


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, one 0 after each; where each begins."""
    parts = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(p) // 4 + 1 for p in parts])
    codes = np.frombuffer(b"\0\0\0\0".join([*parts, b""]), np.uint32)
    return np.where(codes < _TOP, codes, 0), starts


def _trigrams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of word characters, the bucket of the trigram around each, and the first of each word."""
    low = _tables()[0][codes]
    padded = np.concatenate([[0], low, [0]]).astype(np.uint64)
    at = np.flatnonzero(low)
    h = padded[at] * np.uint64(0x9E3779B1) + padded[at + 1] * np.uint64(0x85EBCA77C2B2) + padded[at + 2] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    bucket = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    return at, bucket, np.flatnonzero(padded[at] == 0)


def _groups(texts: pa.Array, chars: int = 200_000) -> Iterator[list[str]]:
    """The texts of a column in groups of about `chars` characters, so that a worker holds little at a time."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse counts by language: trigram buckets, and scripts as negative buckets."""
    _, letter, script = _tables()
    sums: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang in batch.column(1).unique().to_pylist():
            for group in _groups(batch.column(0).filter(pc.equal(batch.column(1), lang))):
                codes, _ = _codes(group)
                _, bucket, _ = _trigrams(codes)
                sums[lang] = sums.get(lang, 0) + np.bincount(bucket, minlength=BUCKETS)
                scripts[lang] = scripts.get(lang, 0) + np.bincount(script[codes[letter[codes]]], minlength=256)
    for lang in sums:
        kept, used = np.flatnonzero(sums[lang]), np.flatnonzero(scripts[lang])
        yield pa.record_batch([
            pa.array([lang] * (len(kept) + len(used)), pa.string()), pa.array(np.concatenate([kept, -1 - used]), pa.int64()),
            pa.array(np.concatenate([sums[lang][kept], scripts[lang][used]]), pa.int64())], ["lang", "bucket", "n"])


@dataclass
class LanguageModel:
    langs: list[str]
    scores: np.ndarray  # bucket x language, log probability
    allowed: np.ndarray  # script x language
    switch: float = SWITCH


def fit_languages(
    labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", *, fit_rows: int = FIT_ROWS,
    switch: float = SWITCH,
) -> LanguageModel:
    """Trigram model of every language in `labelled`.

    Rows without text or language are left out. About `fit_rows` rows at most are counted, on the
    executors; what reaches the driver is at most BUCKETS sums per language. Without any row the
    model has no language.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("_id"))
    sample = bounded_sample(rows, "_id", fit_rows).select("text", "lang")
    sums = (sample.mapInArrow(_count, "lang string, bucket bigint, n bigint")
                  .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names = np.array(sums.column("lang").to_pylist(), dtype=object)
    buckets, counts = sums.column("bucket").to_numpy(), sums.column("n").to_numpy().astype(np.float64)
    langs = sorted(set(names))
    scores = np.zeros((BUCKETS, len(langs)), np.float32)
    allowed = np.zeros((256, len(langs)), bool)
    for i, name in enumerate(langs):
        mine = names == name
        grams, scripts = mine & (buckets >= 0), mine & (buckets < 0)
        dense = np.full(BUCKETS, 0.1)
        dense[buckets[grams]] += counts[grams]
        scores[:, i] = np.log(dense / dense.sum())
        share = counts[scripts] / max(counts[scripts].sum(), 1)
        allowed[-1 - buckets[scripts][share >= SCRIPT_SHARE], i] = True
    return LanguageModel(langs, scores, allowed, switch)


def _path(scores: np.ndarray, switch: float) -> np.ndarray | int:
    """The best path through one text: a language per word, or one for all.

    Staying with the best single language is optimal when no stretch of words gains more than half
    a switch by any other language; that is one running maximum, so the recursion is left to
    texts that do mix.
    """
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], 0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros(gain.shape[1]), gain[:-1]]), 0)
    if (gain - low).max() <= switch / 2:
        return best
    n, k = scores.shape
    back = np.empty((n, k), np.int16)
    value, stay = scores[0].astype(np.float64), np.arange(k)
    for i in range(1, n):
        top = int(value.argmax())
        moved = value[top] - switch > value
        back[i] = np.where(moved, top, stay)
        value = np.where(moved, value[top] - switch, value) + scores[i]
    path = np.empty(n, np.int16)
    path[-1] = value.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def label_texts(texts: list[str], model: LanguageModel) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) of each text; see `detect_languages`."""
    codes, starts = _codes(texts)
    _, letter, script = _tables()
    at, bucket, first = _trigrams(codes)
    spread = letter[codes[at]]
    letters = np.concatenate([[0], np.cumsum(spread)])
    if len(first) and model.langs:
        table = np.add.reduceat(model.scores[bucket], first, axis=0)
        may = model.allowed[script[codes[at[first]]]]
        # A script that no language uses tells nothing; otherwise only its languages stay.
        table = np.where(may.any(1)[:, None], np.where(may, table, table.min(1, keepdims=True) - model.switch), 0)
    ends = np.append(first[1:], len(at))
    doc_of = np.searchsorted(at[first], starts)
    for d in range(len(texts)):
        lo, hi = doc_of[d], doc_of[d + 1]
        total = letters[ends[hi - 1]] - letters[first[lo]] if hi > lo else 0
        if not total or not model.langs:
            yield UNKNOWN, 0.0, []
            continue
        path = _path(table[lo:hi], model.switch)
        if isinstance(path, int):
            bounds, labels = np.array([lo, hi]), [path]
        else:
            cut = np.flatnonzero(np.diff(path)) + 1
            bounds, labels = np.concatenate([[lo], lo + cut, [hi]]), [int(path[i]) for i in (0, *cut)]
        weight = np.zeros(len(model.langs))
        spans = []
        for i, label in enumerate(labels):
            a, b = first[bounds[i]], ends[bounds[i + 1] - 1]
            weight[label] += letters[b] - letters[a]
            spans.append((int(at[a] - starts[d]), int(at[b - 1] + 1 - starts[d]), model.langs[label]))
        main = int(weight.argmax())
        sums = table[lo:hi].sum(0, dtype=np.float64)
        sure = 1 / np.exp(np.clip(sums - sums[main], -700, 700)).sum()
        share = weight[main] / total
        yield model.langs[main], float(min(1.0, share * (sure if share == 1 else max(sure, share)))), spans


_RESULT = "id bigint, lang_pred string, score double, spans array<struct<start:bigint, end:bigint, lang:string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def detect_languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score, spans) for each row of `docs`; other columns are not read.

    Words are runs of letters and marks. The script of a word leaves the languages that use it;
    its score in a language is the sum of its letter trigrams' log probabilities; a Viterbi path
    over all words of the text, paying `model.switch` per change, gives spans of code points. The
    language with most letters on the path is `lang_pred` (ties: first by name), and `score` is its
    share of the letters, lowered when the sums over the whole text leave doubt. A null text, a text
    without letters and an empty model give `und`, 0 and no spans. Row by row, so repeated rows
    give repeated results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            done = 0
            for group in _groups(batch.column(1)):
                found = list(label_texts(group, known))
                yield pa.record_batch([
                    batch.column(0).slice(done, len(group)), pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([[{"start": a, "end": b, "lang": c} for a, b, c in x[2]] for x in found], _SPAN),
                ], ["id", "lang_pred", "score", "spans"])
                done += len(group)

    return (docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
                .mapInArrow(label, _RESULT).withColumnRenamed("id", doc_id))


def keep_known_languages(docs: DataFrame, model: LanguageModel, text: str = "text", least_score: float = 0.25) -> DataFrame:
    """The rows of `docs` whose text has a language: not `und`, and a score of `least_score` or more,
    or spans of several languages.

    A change of language pays the switching penalty, so a text of several spans is known by its
    parts, however small the share of its main language. A model without languages rejects only
    texts without letters. All columns pass unchanged; no shuffle.
    """
    if not model.langs:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                lang != UNKNOWN and (score >= least_score or len({part[2] for part in spans}) > 1)
                for group in _groups(batch.column(at)) for lang, score, spans in label_texts(group, shared.value)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
