"""Secrets in texts: fixed patterns, and character Markov models of random and ordinary strings."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.functions.staging import computed
from voxtally.llm.common import bounded_sample, settle

# The base patterns, in the order in which kinds are listed.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"  # runs AKIA[A-Z0-9]+ of 16 characters and more
HEX = "[0-9a-f]{32,}"  # runs [0-9a-f]+ of 32 characters and more
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE = 8
KINDS = ("assign", "access", "hex", "random")

_CHAR = "[A-Za-z0-9+/_=-]"
#: Runs that the Markov models judge.
CANDIDATE = f"(?<!{_CHAR}){_CHAR}{{16,}}"
_WORD = f"{_CHAR}{{3,}}"
_BOUND = 32  # a blank stands before and after a string
_CODES = 128
_SYMBOLS = 69
_PART = 4_096  # code points of a part of a text

#: Rows of each class that the models are fitted on, at most (about).
FIT_ROWS = 2_000
#: Log-likelihood ratio in nats from which a run counts as random.
THRESHOLD = 10.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of the value, which is worked out once. A column named inside a lambda is worked out per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each of some whole numbers, `merge` (sum or largest) of 0 and all before it.

    Blocks of about the root of their count are merged first, so n numbers take n * sqrt(n) steps.
    """
    def merged(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda total, x: merge(total, x))

    def scan(v: Column, step: Column) -> Column:
        block = lambda i: ((i - i % step) / step).cast("int")
        starts = F.sequence(F.lit(0), block(F.size(v)))
        blocks = F.transform(starts, lambda k: merged(F.slice(v, k * step + 1, step)))
        heads = lambda whole: F.transform(whole, lambda _, k: merged(F.slice(whole, F.lit(1), k)))
        return _let(_let(blocks, heads), lambda head: F.transform(
            v, lambda _, i: merge(F.get(head, block(i)), merged(F.slice(v, i - i % step + 1, i % step)))))

    return _let(values, lambda v: _let(F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1)), lambda step: scan(v, step)))


def _located(text: Column, pattern: str, hits: Column) -> Column:
    """(start, end) in code points of each of `hits`, all matches of the pattern in order.

    Splitting by the same pattern gives what lies between the matches, so lengths add up to places.
    """
    def placed(gaps: Column) -> Column:
        steps = F.transform(hits, lambda hit, i: F.get(gaps, i) + F.length(hit))
        start = lambda at, i: F.get(at, i) + F.get(gaps, i)
        return _let(_before(steps, lambda a, b: a + b), lambda at: F.transform(
            hits, lambda hit, i: F.struct(start(at, i).alias("start"), (start(at, i) + F.length(hit)).alias("end"))))

    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    return F.when(F.size(hits) == 0, F.expr("CAST(array() AS array<struct<start:int,end:int>>)")).otherwise(_let(gaps, placed))


def _touched(spans: Column, others: Column) -> Column:
    """Whether each of `spans` overlaps one of `others`.

    The others stand sorted in blocks of about the root of their count; a span looks into those it reaches.
    """
    def marks(blocks: Column) -> Column:
        meets = lambda s, o: (o["start"] < s["end"]) & (s["start"] < o["end"])
        return F.transform(spans, lambda s: F.exists(blocks, lambda b: meets(s, b) & F.exists(b["spans"], lambda o: meets(s, o))))

    def in_blocks(found: Column, step: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.size(found), step), lambda k: F.slice(found, k + 1, step))
        return F.transform(F.filter(parts, lambda part: F.size(part) > 0), lambda part: F.struct(
            F.array_min(F.transform(part, lambda o: o["start"])).alias("start"),
            F.array_max(F.transform(part, lambda o: o["end"])).alias("end"), part.alias("spans")))

    step = lambda found: F.greatest(F.ceil(F.sqrt(F.size(found))).cast("int"), F.lit(1))
    return _let(F.array_sort(others), lambda found: _let(_let(step(found), lambda n: in_blocks(found, n)), marks))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _none() -> Column:
    return F.expr("CAST(array() AS array<string>)")


def _has_keyword(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for word in KEYWORDS:
        found = found | low.contains(word)
    return found


def with_base_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds assign, access and hex: (start, end) spans of the base patterns, leftmost, not overlapping
    within a kind. A null text has none."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = computed(
        df, _body=body, _assign=F.when(_has_keyword(body), _matches(body, ASSIGN)).otherwise(_none()),
        access=F.when(body.contains("AKIA"), _matches(body, ACCESS)).otherwise(_none()), hex=_matches(body, HEX))
    body = F.col("_body")
    values = F.when(F.size("_assign") > 0, _matches(body, ASSIGN, 2)).otherwise(_none())
    spans = computed(
        found.withColumnRenamed("access", "_access").withColumnRenamed("hex", "_hex"),
        assign=_let(values, lambda vs: F.filter(_located(body, ASSIGN, F.col("_assign")), lambda span, i: F.length(F.get(vs, i)) >= MIN_VALUE)),
        access=_located(body, ACCESS, F.col("_access")), hex=_located(body, HEX, F.col("_hex")))
    return spans.drop("_body", "_assign", "_access", "_hex")


def base_values(docs: DataFrame, text: str) -> DataFrame:
    """(value) of every base match: labelled examples of random strings, one row per text as a list."""
    body = F.coalesce(F.col(text), F.lit(""))
    values = F.concat(
        F.when(_has_keyword(body), F.filter(_matches(body, ASSIGN, 2), lambda v: F.length(v) >= MIN_VALUE)).otherwise(_none()),
        F.when(body.contains("AKIA"), _matches(body, ACCESS)).otherwise(_none()), _matches(body, HEX))
    return docs.select(values.alias("values")).where(F.size("values") > 0)


def ordinary_strings(docs: DataFrame, text: str) -> DataFrame:
    """(values) of the identifiers and words around the base matches: labelled examples of the other class."""
    body = F.coalesce(F.col(text), F.lit(""))
    for pattern in (ASSIGN, ACCESS, HEX):
        body = F.regexp_replace(body, pattern, " ")
    return docs.select(_matches(body, _WORD).alias("values"))


@dataclass
class SecretModel:
    """Log-likelihood ratios, random over ordinary, by code * 128 + next code."""

    ratios: list[float]
    threshold: float = THRESHOLD


def _pair_counts(values: DataFrame) -> dict[int, int]:
    strings = values.select(F.explode("values").alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("v") + 1),
        lambda i: F.ascii(F.substr(F.concat(F.lit(" "), "v", F.lit(" ")), i, F.lit(1))) * _CODES
        + F.ascii(F.substr(F.concat(F.lit(" "), "v", F.lit(" ")), i + 1, F.lit(1))))
    # At most 69 * 69 rows, whatever the input.
    sums = strings.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    return {row.pair: row.n for row in sums.collect()}


def fit_secrets(random: DataFrame, ordinary: DataFrame, threshold: float = THRESHOLD, smooth: float = 0.5) -> SecretModel:
    """First-order character models of two labelled samples, as one table of log ratios.

    Both frames have `values`, lists of strings over letters, digits and + / _ = -. Without samples
    a class is uniform.
    """
    tables = []
    for sample in (random, ordinary):
        counts = _pair_counts(sample)
        sums = [0.0] * _CODES
        for pair, n in counts.items():
            sums[pair // _CODES] += n
        tables.append([
            math.log((counts.get(i, 0) + smooth) / (sums[i // _CODES] + smooth * _SYMBOLS)) for i in range(_CODES * _CODES)])
    return SecretModel([a - b for a, b in zip(*tables)], threshold)


def fit_on_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, fit_rows: int = FIT_ROWS) -> SecretModel:
    """Labels by the base patterns: their values are random, the strings around them ordinary.

    About `fit_rows` texts at most per class.
    """
    found = settle(base_values(docs, text), "secrets").withColumn("_row", F.hash("values"))
    return fit_secrets(bounded_sample(found, "_row", fit_rows), ordinary_strings(bounded_sample(docs, doc_id, fit_rows), text))


def _ratio(run: Column, model: SecretModel) -> Column:
    table = F.from_json(F.lit(str([round(r, 4) for r in model.ratios])), "array<double>")
    codes = F.concat(F.array(F.lit(_BOUND)), F.transform(F.split(run, ""), lambda c: F.ascii(c)), F.array(F.lit(_BOUND)))
    pairs = F.zip_with(codes, F.slice(codes, 2, F.size(codes)), lambda a, b: F.when(b.isNotNull(), F.get(table, a * _CODES + b)).otherwise(0.0))
    return F.aggregate(pairs, F.lit(0.0), lambda total, r: total + r)


def _tagged(n: int, kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(
        s["start"].alias("start"), F.lit(n).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def scan_secrets(docs: DataFrame, model: SecretModel, text: str = "text", into: str = "secrets") -> DataFrame:
    """`docs` with a column `into`: array of (start, kind_no, end, kind) by start, then kind.

    Kinds are those in KINDS: the three base patterns, and runs of 16 or more letters, digits and
    + / _ = - whose log-likelihood ratio under the two Markov models reaches the threshold and that
    touch no base span. Places are code points, the end exclusive. One narrow pass in SQL
    functions, no shuffle. A null text counts as empty and has no span; other columns, repeated rows
    and their order stay as they are. `docs` may not have
    a column called as `into`.
    """
    # Columns get neutral names meanwhile, so that none of theirs clashes.
    own = [f"_c{i}" for i in range(len(docs.columns))]
    body = F.coalesce(own[docs.columns.index(text)], F.lit(""))
    based = with_base_spans(docs.toDF(*own), own[docs.columns.index(text)])
    runs = computed(based, _runs=_matches(body, CANDIDATE))
    # Places are only worked out for texts that have a random run at all.
    marked = computed(runs, _random=F.transform("_runs", lambda run: _ratio(run, model) >= model.threshold))
    placed = F.filter(_located(body, CANDIDATE, F.col("_runs")), lambda s, i: F.get(F.col("_random"), i))
    apart = _let(placed, lambda spans: _let(
        _touched(spans, F.concat("assign", "access", "hex")), lambda touched: F.filter(spans, lambda s, i: ~F.get(touched, i))))
    judged = computed(marked, random=F.when(F.exists("_random", lambda r: r), apart)
                      .otherwise(F.expr("CAST(array() AS array<struct<start:int,end:int>>)")))
    tagged = [_tagged(n, kind) for n, kind in enumerate(KINDS)]
    return judged.select(*[F.col(c).alias(name) for c, name in zip(own, docs.columns)], F.array_sort(F.concat(*tagged)).alias(into))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, or union of overlapping spans, replaced by the mask.

    `spans` are sorted by start. What lies between them is read from parts of the text, so that no
    span walks through the whole of it.
    """
    def between(parts: Column, low: Column, high: Column) -> Column:
        first, last = ((at - at % _PART) / _PART for at in (low, high))
        first, last = first.cast("int"), last.cast("int")
        head = F.coalesce(F.substr(F.get(parts, first), low % _PART + 1, F.lit(_PART)), F.lit(""))
        tail = F.coalesce(F.substr(F.get(parts, last), F.lit(1), high % _PART), F.lit(""))
        return F.when(first == last, F.coalesce(F.substr(F.get(parts, first), low % _PART + 1, high - low), F.lit(""))).otherwise(
            F.concat(head, F.array_join(F.slice(parts, first + 2, last - first - 1), ""), tail))

    def whole(parts: Column, ends: Column) -> Column:
        # A span that begins before the end of an earlier one adds nothing; the gap before any other ends in a mask.
        kept = F.zip_with(spans, ends, lambda s, end: F.when(s["start"] >= end, F.concat(between(parts, end, s["start"]), F.lit(mask))).otherwise(F.lit("")))
        return F.concat(F.array_join(kept, ""), between(parts, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))

    ends = _before(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    cut = _matches(text, f"(?s).{{1,{_PART}}}")
    return F.when(F.size(spans) == 0, text).otherwise(_let(cut, lambda parts: _let(ends, lambda e: whole(parts, e))))
