"""Exact duplicates, Merkle manifest, centroid clusters: against brute force and on edge rows."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtally.llm.exact_duplicates import HEAD, WIDEN, drop_exact_duplicates, exact_duplicates
from voxtally.llm.hadamard import cluster_vectors, nearest, transform
from voxtally.llm.merkle import build_manifest, fold, proof_text, row_digest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, keep_id int, tree string, slot int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "t", 3) for r in rows], DOCS).repartition(parts)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact duplicates ----------------------------------------------------------------------------

def texts():
    first, second = HEAD, HEAD * (1 + WIDEN)
    shared = "ü" + "a" * 5000
    found = [None, "", " ", "\t\n ", "a b", "a  b", "a\tb", "a b", "a b ", "😀" * 40, "😀" * 40 + "x"]
    found += [shared[:n] for n in (first - 2, first - 1, first, second - 1, second, second + 1) for _ in range(2)]
    found += [shared + tail for tail in ("b", "c", "c", "\n", "  ", "")] + ["z" * 60_000 + c for c in "xyx"]
    return found + ["the same"] * 40


def duplicates(rows):
    groups = defaultdict(list)
    for i, text in rows:
        normal = re.sub("[ \t-\r]+", " ", text or "")
        groups[normal].append(i)
    result = []
    for normal, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        result += [(i, ids[0], len(ids), k == 0, sha(normal)) for k, i in enumerate(ids)]
    return sorted(result, key=str)


@pytest.mark.parametrize("max_bytes", [32 << 20, 0])
def test_exact_duplicates_match_brute_force(spark, max_bytes):
    draw = random.Random(3)
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(5, "a b"), (5, "other"), (None, "a b"), (None, "none has an id"), (None, "none has an id"), (None, None)]
    draw.shuffle(rows)
    got = exact_duplicates(frame(spark, [(i, t, "x", "s", 1) for i, t in rows], 5), max_bytes=max_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == duplicates(rows)


def test_exact_duplicates_of_nothing_and_kept_rows(spark):
    assert exact_duplicates(frame(spark, [])).count() == 0
    docs = frame(spark, [(i, t, "x", "s", 1) for i, t in enumerate(["a", "b", "a", None, ""])])
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 3]


# --- Merkle manifest -----------------------------------------------------------------------------

def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute_proofs(rows):
    trees = defaultdict(list)
    for i, text, lang, source, n in rows:
        trees[lang].append((i is not None, i or 0, leaf_of(i, source, lang, n, text), i))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    lower = {lang: levels_of([leaf for _, _, leaf, _ in sorted(trees[lang], key=lambda r: r[:3])]) for lang in order}
    upper = levels_of([lower[lang][-1][0] for lang in order])
    result = []
    for t, lang in enumerate(order):
        for at, (_, _, leaf, i) in enumerate(sorted(trees[lang], key=lambda r: r[:3])):
            proof, place = [], at
            for levels, place in ((lower[lang], at), (upper, t)):
                for level in levels[:-1]:
                    run = place // 8 * 8
                    proof += [h for k, h in enumerate(level[run : run + 8], run) if k != place]
                    place //= 8
            result.append((i, leaf, lower[lang][-1][0], upper[-1][0], "".join(proof)))
    return sorted(result, key=str)


VALUES = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 8, None: 1}, {"en": 65, "de": 9, "": 2, None: 8, "é": 17}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_manifest_matches_brute_force(spark, sizes):
    draw = random.Random(1)
    rows, i = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((i, draw.choice([None, "", "Ünï", "abc " * 30]), lang, draw.choice([None, "s"]), draw.choice([None, 5])))
            i += draw.choice([1, 7])
    if len(rows) > 60:
        rows += [rows[3], rows[3], (None, "x", "en", "s", 1), (None, None, "en", None, None), (rows[2][0], "same id", rows[2][2], "s", 2)]
    draw.shuffle(rows)
    manifest = build_manifest(frame(spark, rows, 4), VALUES)
    got = manifest.proofs().withColumn("folded", fold(F.col("leaf"), F.col("path"))).withColumn("proof", proof_text(F.col("path"))).collect()
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in got), key=str) == brute_proofs(rows)
    assert all(r["folded"] == r["root"] for r in got)
    assert {r["root"] for r in got} == {r["root"] for r in manifest.roots().collect()}
    assert manifest.subroots().count() == len({r[2] for r in rows})


def test_changed_leaves_do_not_fold_to_the_root(spark):
    rows = [(i, f"Text {i}", "en", "s", 6) for i in range(30)]
    wrong = row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text"))
    proofs = build_manifest(frame(spark, rows), VALUES, carry={"wrong": wrong}).proofs()
    folded = proofs.select((fold(F.col("wrong"), F.col("path")) == F.col("root")).alias("ok"), (fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("sure"))
    assert {tuple(r) for r in folded.collect()} == {(False, True)}


def test_manifest_of_nothing(spark):
    manifest = build_manifest(frame(spark, []), VALUES)
    assert manifest.proofs().count() == manifest.roots().count() == 0


# --- centroid clusters ---------------------------------------------------------------------------

def test_transform_is_the_hadamard_transform():
    draw = np.random.default_rng(1)
    x = draw.integers(-99, 99, (5, 64))
    y = transform(x)
    assert np.array_equal((y * y).sum(axis=1), 64 * (x * x).sum(axis=1))
    assert np.array_equal(y[:, 0], x.sum(axis=1))
    signs = (np.diff(transform(np.eye(64, dtype=np.int64)), axis=0) != 0).sum(axis=0)
    assert list(signs) == list(range(64))  # coarse to fine


@pytest.mark.parametrize("scale", [3, 1 << 22, 1 << 40])
def test_search_is_exact_with_ties(scale):
    draw = np.random.default_rng(2)
    x, c = draw.integers(-scale, scale, (300, 64)).astype(object), draw.integers(-scale, scale, (7, 64)).astype(object)
    x[:50] = c[draw.integers(0, 7, 50)]
    c[5] = c[1]
    x[50:60] = (c[2] + c[3]) // 2
    gap = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    kind = np.int64 if scale < 1 << 30 else object
    best, least = nearest(transform(x.astype(kind)), transform(c.astype(kind)))
    assert list(best) == [list(row).index(min(row)) for row in gap] and list(least) == [min(row) for row in gap]


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(((sha(f"1:{i}"), v) for i, v in kept if i is not None))[:k]
    centers = [v for _, v in start]
    find = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        mine = defaultdict(list)
        for _, v in kept:
            mine[find(v)[1]].append(v)
        centers = [[sum(col) // len(mine[n]) for col in zip(*mine[n])] if mine[n] else c for n, c in enumerate(centers)]
    ends = [(i, *find(v)) for i, v in kept] if centers else []
    total = sum(d for _, d, _ in ends)
    inner = defaultdict(int)
    for _, d, c in ends:
        inner[c] += d
    return sorted(((i, c, d, inner[c], total, sha(",".join(map(str, centers[c])))) for i, d, c in ends), key=str)


@pytest.mark.parametrize("count, scale", [(200, 1.0), (5, 1.0), (40, 1e6), (0, 1.0)])
def test_clusters_match_brute_force(spark, count, scale):
    draw = random.Random(7)
    vector = lambda: [draw.gauss(0, scale) for _ in range(64)]
    rows = [(i, vector()) for i in range(count)]
    rows += rows[:3] + [(None, vector())] if count else []
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [None] * 64), (904, [float("nan")] * 64), (905, [float("inf")] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows + odd], "vec_id bigint, embedding array<double>, cluster int, id string").repartition(3)
    got = cluster_vectors(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)
