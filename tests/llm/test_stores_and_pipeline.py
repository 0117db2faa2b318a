"""Archives, packing, mixing, code search and the pipeline."""

import json
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voxtally.llm.binary_search import _segments, search, sign_codes
from voxtally.llm.common import settle, stored_order
from voxtally.llm.mixing import keep_mixture, mix_sources, share_whole_sources, sort_by_mixture
from voxtally.llm.packing import ByteTokens, Shard, near_keys, pack, term_orders, vocabulary_size
from voxtally.llm.warc import (
    BadArchive, dictionary_frame, export_archives, make_record, parse_record, payload_digest, read_archive, read_archives,
    train_dictionary, write_archives)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PAGES = "page_id bigint, url string, html string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/é/{i}", h, "other") for i, h in rows], PAGES).repartition(3)


def test_archives_round_trip(spark, tmp_path):
    body = "<html>" + "some text, é😀 " * 50
    rows = [(5, body), (3, body), (9, body), (1, None), (2, ""), (7, body + "!"), (None, "lone"), (8, "a" * 500_000)]
    table = pages(spark, rows)
    archives = write_archives(table, rows_per_archive=2)
    got = {r.page_id: r for r in read_archives(archives).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), 1: ("response", None), 2: ("revisit", 1), 7: ("response", None),
        None: ("response", None), 8: ("response", None)}
    for i, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), payload_digest(data))
        assert got[i].payload == (None if got[i].record_type == "revisit" else data)
        assert got[i].url == (f"http://x/é/{i}")
    assert all(r.record_type == "response" for r in read_archives(write_archives(table, least_bytes=10**6)).collect())
    folder = f"file://{tmp_path}/out"
    names = [r.path for r in export_archives(archives, folder).collect()]
    files = spark.read.format("binaryFile").load(folder)
    assert files.count() == len(set(names)) and read_archives(files).count() == len(rows)
    assert read_archives(write_archives(table.limit(0))).count() == 0


def test_reader_takes_both_dictionary_forms_and_none():
    samples = [f"<html><p>page {i} of the site with a header and a footer</p>".encode() * 3 for i in range(300)]
    raw = zstandard.train_dictionary(4096, samples).as_bytes()
    record = make_record(1, "u", b"x" * 100, None)
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    plain = struct.pack("<II", 0x184D2A5D, len(raw)) + raw
    for lead, frames in ((plain, coder), (dictionary_frame(raw), coder), (b"", zstandard.ZstdCompressor())):
        data = lead + frames.compress(record) * 2
        assert [r.payload for r in read_archive(data)] == [b"x" * 100] * 2
        for broken in (data[:-3], data[: len(lead) + 5], data + b"tail", data + frames.compress(b"no record")):
            with pytest.raises(BadArchive):
                list(read_archive(broken))


def test_records_are_validated():
    good = make_record(4, "http://x", b"payload", None)
    assert parse_record(good).payload == b"payload"
    for old, new in (
        (b"WARC/1.1", b"WARC/0.9"), (b"payload", b"Payload"), (b"WARC-Date", b"X-Date"), (b"Content-Length: 7", b"Content-Length: 8"),
        (b"\r\n\r\n" + good[-2:], b"\r\n"), (b"WARC-Type: response", b"WARC-Type: revisit")):
        with pytest.raises(BadArchive):
            parse_record(good.replace(old, new) if old in good else good[:-2])
    with pytest.raises(BadArchive):
        parse_record(good + b"x")
    assert parse_record(make_record(4, None, b"payload", 2)).fields["warc-refers-to"] == "<urn:page:2>"


def test_dictionary_of_too_little(spark):
    assert train_dictionary(pages(spark, [(1, "a")]), "page_id", "html") == b""


TEXTS = [
    None, "", "word", "Hello  two blanks", "tab\there", "line\n\nbreak \n x", " lead", "trail ", "naïve café ß 日本語 😀", "don't I'll 123 45a !!??",
    "a" * 5000, "It's " * 700, "x y z w", "<|endoftext|> inside"] + [f"common words and item {i} " * (40 + i) for i in range(60)]


def test_tokens_equal_the_tokenizer():
    reference = Tokenizer.from_file(VOCABULARY)
    reference.encode_special_tokens = True
    coder = ByteTokens(VOCABULARY)
    for text in filter(None, TEXTS):
        assert coder.of(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_added_tokens_and_long_blanks_equal_the_tokenizer():
    reference, coder = Tokenizer.from_file(VOCABULARY), ByteTokens(VOCABULARY, added=True)
    assert coder.of("a<|endoftext|>b").tolist() == [64, 50256, 65]
    blanks = [c * n for c in (" ", "\n", "\u3000") for n in (9_999, 10_000, 1_000_000)]
    for text in ["<|endoftext|>", " <|endoftext|> x", "<|endoftext", *blanks, "x" + blanks[2] + "y", " \n\t" * 300_000 + "x"]:
        assert coder.of(text).tolist() == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("window, shard", [(1024, 256), (64, 8)])
def test_packing_is_whole_and_gapless(spark, window, shard):
    reference = Tokenizer.from_file(VOCABULARY)
    reference.encode_special_tokens = True
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 3, "b") for i, t in rows], "doc_id bigint, text string, start int, terms string").repartition(4)
    pieces = pack(docs, VOCABULARY, window=window, shard=shard).collect()
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
    short = [s for s in sequences.values() if sum(p.length for p in s) < window]
    assert len(short) <= 8  # one per partition
    for i, text in rows:
        if i == 3:
            continue
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert sum(p.length for p in by_doc[3]) == 2 * by_doc[3][0].doc_tokens
    assert pack(docs.limit(0), VOCABULARY).count() == 0


def test_index_scores_equal_the_formula():
    draw = np.random.default_rng(2)
    pieces = []
    for _ in range(20):
        terms, counts = np.unique(draw.integers(0, 40, 30), return_counts=True)
        pieces.append((terms.astype(np.uint16), counts.astype(np.uint16), int(counts.sum()) + int(draw.integers(0, 50))))
    idf, mean = draw.uniform(0, 5, 50_257), 45.0
    index = Shard(pieces, idf, mean)
    index.free[[0, 7]] = False

    def score(i):
        tf = dict(zip(pieces[i][0].tolist(), pieces[i][1].tolist()))
        return sum(idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * pieces[i][2] / mean)) for t in pieces[0][0].tolist() if t in tf)

    want = sorted((i for i in range(20) if i not in (0, 7)), key=lambda i: (-round(score(i), 9), i))
    assert index.neighbours(0).tolist() == want


def test_sort_keys_are_the_least_ranks_of_each_order():
    draw = np.random.default_rng(4)
    frequency = draw.integers(0, 50, 300).astype(float)
    ranks = term_orders(frequency, np.log(1 + (60 - frequency + 0.5) / (frequency + 0.5)))
    lists = [np.unique(np.append(draw.integers(0, 300, n), 0)).astype(np.uint16) for n in (1, 5, 40, 200)]
    keys = near_keys(pa.array([x.tobytes() for x in lists], pa.binary()), ranks)
    for x, key in zip(lists, keys.tolist()):
        assert key == sum(int(min(order[t] for t in x)) << (16 * (3 - i)) for i, order in enumerate(ranks)) >> 1
    alone = int(np.flatnonzero(frequency <= 1)[0])
    assert all(order[alone] > order[t] for order in ranks for t in np.flatnonzero(frequency > 1))
    assert len(near_keys(pa.array([], pa.binary()), ranks)) == 0


def test_near_copies_share_a_sequence(spark):
    draw = np.random.default_rng(5)
    words = [f"w{i}x{i * 7919 % 1000}" for i in range(20_000)]
    def text(n):
        return [words[int(i)] for i in draw.zipf(1.3, n) % 20_000]
    rows, pairs = [(i, " ".join(text(100))) for i in range(3_000)], []
    for i in range(60):
        whole = text(100)
        edited = whole[:40] + text(1) + whole[41:]
        rows += [(10_000 + i, " ".join(whole)), (20_000 + (i * 37) % 60, " ".join(edited))]
        pairs.append((10_000 + i, 20_000 + (i * 37) % 60))
    sequences = defaultdict(set)
    for p in pack(spark.createDataFrame(rows, "doc_id bigint, text string"), VOCABULARY).collect():
        sequences[p.doc_id].add(p.sequence_id)
    assert sum(bool(sequences[a] & sequences[b]) for a, b in pairs) >= 40


def test_other_vocabularies(tmp_path):
    assert vocabulary_size(VOCABULARY) == 50_257
    with open(VOCABULARY, encoding="utf-8") as file:
        whole = json.load(file)
    whole["model"]["merges"] = [whole["model"]["merges"][i] for i in (1, 0)] + whole["model"]["merges"][2:]
    (tmp_path / "turned.json").write_text(json.dumps(whole), encoding="utf-8")
    text = "the other theatre, then 12 Größen"
    turned = Tokenizer.from_file(str(tmp_path / "turned.json"))
    assert ByteTokens(str(tmp_path / "turned.json")).of(text).tolist() == turned.encode(text, add_special_tokens=False).ids
    whole["added_tokens"] = [{**whole["added_tokens"][0], "id": 70_000}]
    for i in range(20_000):
        whole["model"]["vocab"][f"extra{i}"] = 50_257 + i
    (tmp_path / "large.json").write_text(json.dumps(whole), encoding="utf-8")
    with pytest.raises(ValueError, match="packing keeps ids"):
        vocabulary_size(str(tmp_path / "large.json"))


def _owners(rows):
    owner = {r.slot: r.source for r in rows}
    assert sorted(owner) == list(range(len(owner))) and len({(r.slot, r.place) for r in rows}) == len(rows)
    return owner


def _worst(owner, horizon, weights):
    """The largest deviation in blocks; a slot is half a block."""
    done, total, worst = defaultdict(int), sum(weights.values()), 0
    for t in range(horizon):
        done[owner[t]] += 1
        worst = max(worst, *(abs(done[s] - w * (t + 1) / total) for s, w in weights.items()))
    return worst / 2


def test_mixture_deviates_by_less_than_a_block(spark):
    sizes = {"a": 700, "b": 150, "c": 90, "d": 30, None: 40}
    rows = [(100_000 * k + i, s, f"t{i}", 0) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, slot int").repartition(5)
    shares = {"a": 45, "b": 25, "c": 17, "d": 6, None: 7}
    weights = spark.createDataFrame(list(shares.items()), "source string, weight bigint")
    got = mix_sources(docs, weights, block_rows=4).collect()
    assert len(got) == len(rows)
    horizon = max(r.slot for r in got if r.in_mix) + 1
    assert horizon > 80 and _worst(_owners(got), horizon, shares) < 1
    kept = keep_mixture(docs, mix_sources(docs, weights, block_rows=4))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.in_mix}
    part = {r.source: r for r in mix_sources(docs, weights.where("source = 'a'"), block_rows=4).collect()}
    assert part["b"].slot is None and not part["b"].in_mix


def test_mixture_of_odd_weights_over_a_long_run(spark):
    sizes = {"a": 100_003, "b": 70_001, "c": 50_009, "d": 33_331, "e": 21_011, "f": 9_991, "g": 4_009, "one": 1, None: 2}
    docs = spark.createDataFrame(list(sizes.items()), "source string, n int").selectExpr("source", "explode(sequence(1, n)) i")
    docs = docs.selectExpr("source", "i * 16 + coalesce(ascii(source) % 16, 0) doc_id")
    shares = {s: n for s, n in sizes.items() if n > 2}
    weights = spark.createDataFrame(list(shares.items()), "source string, weight bigint")
    got = mix_sources(docs.where("length(source) = 1"), weights, block_rows=2).select("slot", "place", "source", "in_mix").collect()
    owner, horizon = _owners(got), max(r.slot for r in got if r.in_mix) + 1
    assert len(got) == sum(shares.values()) and horizon > 0.999 * len(owner) and _worst(owner, horizon, shares) < 0.75
    whole = mix_sources(docs).select("slot", "source", "place", "in_mix").collect()
    _owners(whole)
    small = [r for r in whole if r.source in ("one", None)]
    # The weight of "a" is a quarter, so only what it has beyond that is out of the mix; small sources do not end it.
    assert len(small) == 3 and all(r.in_mix for r in small) and sum(r.in_mix for r in whole) > 0.84 * len(whole)


def test_mixture_of_many_sources(spark):
    """A hot source beside 5,000 small ones."""
    docs = spark.range(60_000).selectExpr("id doc_id", "IF(id < 20000, 'hot', concat('s', id % 5000)) source")
    got = mix_sources(docs).select("slot", "source", "place", "in_mix").collect()
    owner = _owners(got)
    horizon, at = max(r.slot for r in got if r.in_mix) + 1, sorted(t for t, s in owner.items() if s == "hot")
    share = 0.25 / (0.25 + 10_000 / len(owner))
    assert len(got) == 60_000 and max(abs(k + 1 - share * (t + 1)) for k, t in enumerate(at) if t < horizon) < 2
    assert horizon > 12_000


def test_mixture_edges(spark):
    schema = "doc_id bigint, source string"
    odd = spark.createDataFrame([(None, "a"), (None, None), (1, "a"), (1, "a"), (2, None)], schema)
    assert mix_sources(odd).count() == 5 and keep_mixture(odd, mix_sources(odd)).count() > 0
    assert mix_sources(odd.limit(0)).count() == 0 and keep_mixture(odd.limit(0), mix_sources(odd.limit(0))).count() == 0


def test_small_sources_do_not_end_the_mixture(spark):
    sizes = {"hot": 30_000, **{f"s{k}": 9_000 for k in range(5)}, "one": 1, None: 3}
    rows = [(100_000 * k + i, s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string").repartition(5)
    placed = share_whole_sources(mix_sources(docs))
    assert placed.count() == len(rows)
    kept = {r.source: r["count"] for r in keep_mixture(docs, placed).groupBy("source").count().collect()}
    assert kept == {**sizes, "hot": -(-len(rows) // 4)}
    lone = docs.where("source = 's1'")
    assert keep_mixture(lone, share_whole_sources(mix_sources(lone))).count() == 9_000
    assert share_whole_sources(mix_sources(docs.limit(0))).count() == 0


def test_rows_are_written_in_the_order_of_the_mix(spark):
    sizes = {"a": 900, "b": 500, "c": 500, "d": 300, "e": 1_200, "f": 1_000, None: 400}
    rows = [(100_000 * k + i, s, i) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    odd = [(None, "a", 1), (None, "a", 2), (None, None, 3), (7, "a", 8), (7, "a", 8)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, source string, slot int").repartition(5)
    placed = settle(share_whole_sources(mix_sources(docs)), "placed")
    whole = sort_by_mixture(docs, placed)
    assert whole.columns == docs.columns and sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
    got = sorted(stored_order(settle(whole, "mix"), "at").collect(), key=lambda r: r.at)
    assert [r.at for r in got] == list(range(len(rows) + len(odd)))
    done, total = defaultdict(int), len(got)
    for k, r in enumerate(got):
        done[r.source] += 1
        assert all(abs(done[s] - n * (k + 1) / total) < 16 for s, n in sizes.items())


def test_places_in_files(spark, tmp_path):
    table = spark.range(10_000).repartition(7).orderBy(F.desc("id"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 300)
    try:
        table.write.parquet(f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    stored = stored_order(spark.read.parquet(f"{tmp_path}/t").where("id % 3 = 0"), "at")
    assert [r.id for r in sorted(stored.collect(), key=lambda r: r.at)] == list(range(9_999, -1, -3))
    # Not from files, and empty.
    made = spark.createDataFrame([(i,) for i in range(50)], "id bigint")
    assert [r.id for r in sorted(stored_order(made, "at").collect(), key=lambda r: r.at)] == list(range(50))
    assert stored_order(made.limit(0), "at").count() == 0


def _leads(pieces, places, window):
    """Places of the first documents of the sequences, by id; every sequence is gapless, and its first document the least."""
    sequences = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sum(q.length for q in sequences[p.sequence_id])
        sequences[p.sequence_id].append(p)
    assert all(sum(p.length for p in s) <= window for s in sequences.values())
    assert all(places[s[0].doc_id] == min(places[p.doc_id] for p in s) for s in sequences.values())
    return [places[s[0].doc_id] for s in sequences.values()]


def test_sequences_follow_a_given_order(spark):
    draw = np.random.default_rng(8)
    sizes = [1, 30, 30, 30, 200]
    rows = [(i, " ".join(f"w{int(w)}" for w in draw.zipf(1.4, sizes[i % 5]) % 5_000), int(p)) for i, p in enumerate(draw.permutation(2_001))]
    rows[7] = (7, None, rows[7][2])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, at int").repartition(6)
    pieces = pack(docs, VOCABULARY, window=64, shard=16, order="at").collect()
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    assert len(tokens) == 2_001 and sum(p.length for p in pieces) == sum(tokens.values())
    leads = _leads(pieces, {i: p for i, _, p in rows}, 64)
    assert leads == sorted(leads) and -(-sum(tokens.values()) // 64) <= len(leads) <= -(-sum(tokens.values()) // 64) + 8


def test_packing_follows_the_mixture(spark, tmp_path):
    """No source has a quarter, so every row stays; the order of the mix decides the sequences."""
    import corpus_pipeline

    draw = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{int(w)}" for w in draw.zipf(1.4, 100) % 5_000), "en", f"s{i // 250}", 1) for i in range(2_000)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    mixed = settle(corpus_pipeline.source_mixture(spark, docs, ""), "mixed")
    assert mixed.columns == docs.columns and sorted(mixed.collect()) == sorted(docs.collect())
    slots = sorted((r.slot, r.place, r.doc_id) for r in mix_sources(docs).collect())
    pieces = corpus_pipeline.packed_windows(spark, mixed, "").collect()
    leads = _leads(pieces, {doc: at for at, (_, _, doc) in enumerate(slots)}, 1024)
    assert leads == sorted(leads) and len({p.doc_id for p in pieces}) == 2_000


def test_near_copies_at_082_leave_the_pipeline(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(104)]
    # 100 shingles of five words each, of which the last 10 differ: 90 of 110 are shared.
    other = words[:94] + [f"v{i}" for i in range(10)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, "x y z")], "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {1, 3}


def brute_neighbours(rows, k):
    out = set()
    for q, x in rows:
        near = sorted((bin((x ^ y) & (1 << 64) - 1).count("1"), i) for i, y in set(rows) if i != q)
        out |= {(q, i, r + 1, d) for r, (d, i) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("n, k", [(200, 5), (3, 10), (1, 2)])
def test_code_search_equals_brute_force(spark, n, k):
    draw = np.random.default_rng(n)
    codes = draw.integers(-(1 << 63), 1 << 63, n).tolist()
    rows = [(i, c) for i, c in enumerate(codes)] + [(1000 + i, codes[0]) for i in range(30)] + [(5000, codes[0] ^ 1), (5000, codes[0] ^ 1)]
    table = spark.createDataFrame(rows + [(None, 3), (7777, None)], "vec_id bigint, code bigint").withColumn("rank", F.lit(1)).repartition(4)
    got = {tuple(r) for r in search(table, table, k=k).collect()}
    assert got == brute_neighbours(rows, k)
    assert search(table.limit(0), table, k=k).count() == 0 and search(table, table.limit(0), k=k).count() == 0


def test_codes_and_segments(spark):
    vector = [1.0, -1.0] * 31 + [float("nan"), 5.0]
    table = spark.createDataFrame([(vector,), (None,), ([1.0],)], "v array<float>")
    assert [r.c for r in table.select(sign_codes("v").alias("c")).collect()] == [
        sum(1 << i for i in range(64) if vector[i] > 0) - (1 << 64), None, None]
    for n in (1, 100, 10**5, 10**9):
        assert sum(width for _, width in _segments(64, n, 11)) == 64


def test_pipeline_on_planted_rows(spark, tmp_path):
    import corpus_pipeline

    en = " ".join(f"the house number {i} and its garden are old" for i in range(30))
    rows = [
        (i, f"{i} {i + 1} {' '.join(f'house{j} and garden{i * j}' for j in range(40))}", "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(900, en, "en", "s0", 1), (901, en + " extra", "en", "s1", 1), (902, None, "en", "s1", 1), (903, "12345", None, "s2", 1),
             (904, "the garden token=" + "deadbeef" * 5 + " and the house " + en[200:700], "en", "s2", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, str(tmp_path)), name)
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {902, 903}.isdisjoint(seen["language_id"]) and len(seen["language_id"]) == len(rows) - 2
    assert 900 in seen["near_dedup"] and 901 not in seen["near_dedup"] and len(seen["near_dedup"]) == len(rows) - 3
    masked = seen["mask_secrets"][904]
    assert "[SECRET]" in masked.text and "deadbeef" not in masked.text and masked.n_chars == len(masked.text)
    assert set(seen["source_mixture"]) <= set(seen["mask_secrets"]) and set(seen["packed_windows"]) == set(seen["source_mixture"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(seen["packed_windows"])
