"""Near duplicates, passages, components: against brute force and on edge rows."""

import random
from itertools import combinations

import numpy as np
import pytest

from voxtally.llm.components import connected_components
from voxtally.llm.near_duplicates import bucket_stars, drop_near_duplicates, hot_keys, join_hot, near_duplicates, new_centers, untested_pairs
from voxtally.llm.passages import Paragraphs, _uncovered, repeated_passages, tune_bands
from voxtally.llm.shingles import super_minhash

SCHEMA = "doc_id bigint, text string, lang string, n int, keys string, id int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 1, "k", 7) for i, t in rows], SCHEMA).repartition(parts)


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed=5):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    rows, i = [], 0
    for size in (40, 60, 90, 200):
        base = [word() for _ in range(size)]
        for _ in range(30):  # copies whose likeness lies around the threshold
            copy = list(base)
            for _ in range(draw.randrange(0, 5)):
                copy[draw.randrange(size)] = word()
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i + k, t) for k, t in enumerate(["", None, "  \t\n", "one two", "ONE two", "one two three four five", rows[3][1], rows[3][1].upper()])]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: r for r in near_duplicates(frame(spark, rows)).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_links_between_members_that_no_center_links(spark):
    # A bucket whose center is like neither of two members that are like each other.
    base = [f"w{i}" for i in range(100)]
    center = base[:]
    for i in (5, 20, 35, 50):
        center[i] = f"c{i}"
    twin = base[:]
    for i in (60, 75, 90, 97):
        twin[i] = f"t{i}"
    other = twin[:]
    other[98] = "o"
    rows = [(0, " ".join(center)), (1, " ".join(twin)), (2, " ".join(other))]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()} == {0: 0, 1: 1, 2: 1}


def test_prefix_filter_finds_what_stars_leave(spark):
    sets = {1: [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], 2: [1, 2, 3, 4, 5, 6, 7, 8, 9, 11], 3: [21, 22], 9: [1, 31]}
    crowded = spark.createDataFrame([(5, i, len(s), 9) for i, s in sets.items()], "key bigint, node bigint, n bigint, center bigint")
    none = spark.createDataFrame([], "node bigint, component bigint")
    table = spark.createDataFrame(list(sets.items()), "node bigint, hashes array<bigint>")
    assert [(r.a, r.b) for r in untested_pairs(crowded, none, table, 80).collect()] == [(1, 2)]


def test_near_duplicates_edges(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (8, None)]
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect())
    assert got == [(-1, None, True), (4, 4, True), (4, 4, True), (7, 4, False), (8, 8, True)]
    kept = drop_near_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "n", "keys", "id"]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 4, 8]
    empty = near_duplicates(frame(spark, []))
    assert empty.count() == 0 and drop_near_duplicates(frame(spark, [])).count() == 0


def test_super_minhash_estimates_and_stops(spark):
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 1 << 63, 3000).astype(np.uint64)
    errors = []
    for a, b in ((0, 500), (0, 1500), (1000, 1400)):
        x, y = pool[:2000], pool[b : 2000 + b]
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        errors.append(abs((super_minhash(x, 400) == super_minhash(y, 400)).mean() - true))
    assert max(errors) < 0.08
    one = super_minhash(pool[:1], 64)
    assert len(set((one >> np.uint64(40)).tolist())) == 64  # a permutation of the ranks
    assert (super_minhash(pool[::-1].copy(), 64) == super_minhash(pool, 64)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (300, 300), (7, None)] + [(1000, k) for k in range(1001, 1200)]
    table = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    got = {r.node: r.component for r in connected_components(table, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, **{k: 1000 for k in range(1000, 1200)}}
    assert connected_components(table.limit(0), "a", "b").count() == 0


LONG = " ".join(f"word{i}" for i in range(60)) + "."


def test_passages_are_found_wherever_they_stand(spark):
    near = LONG.replace("word30", "other")
    filler = lambda k: " ".join(f"f{k}x{i}" for i in range(40))
    several = "\n".join(" ".join(f"s{j}w{i}" for i in range(26)) + "." for j in range(3))
    rows = [
        (1, filler(1) + "\n" + LONG + "\n" + filler(2)), (2, LONG), (3, filler(3) + "\n" + near), (4, filler(4)),
        (5, "Header of all\n" + filler(5)), (6, "Header of all\n" + filler(6)),
        (7, filler(7) + " tail " + several), (8, several + " head " + filler(8)), (9, None), (10, ""), (None, LONG)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in repeated_passages(docs).collect()}
    texts = dict(rows)
    assert set(got) == {1, 2, 3, 7, 8}
    assert texts[1][got[1].start : got[1].end] == LONG and got[1].kept
    assert (got[2].start, got[2].end, got[2].kept) == (0, len(LONG), False)
    assert texts[3][got[3].start : got[3].end] == near and got[3].clusters == got[1].clusters
    assert "s1w10" in texts[7][got[7].start : got[7].end] and got[8].words >= 24
    assert repeated_passages(frame(spark, [])).count() == 0


def test_inline_passages_with_and_without_full_stops(spark):
    words = lambda k, n: [f"q{k}x{i}" for i in range(n)]
    rows, inside = [], {}
    for k in range(12):
        passage = words(f"p{k}", 51)
        if k % 2:
            passage = [w + "." * (i % 9 == 4) for i, w in enumerate(passage)]
        for d in (2 * k, 2 * k + 1):
            front = " ".join(words(f"a{d}", 10 + 7 * d))
            inside[d] = (len(front) + 1, len(front) + 1 + len(" ".join(passage)))
            rows.append((d, front + " " + " ".join(passage + words(f"b{d}", 30))))
    got = {r.doc_id: r for r in repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == set(inside)
    for d, (a, b) in inside.items():
        assert a <= got[d].start < got[d].end <= b and got[d].words >= 51 - 2 * 11 and got[d].kept == (d % 2 == 0)


def test_runs_inside_repeated_paragraphs_go_before_their_clusters_are_looked_up(spark):
    runs = spark.createDataFrame(
        [(1, 0, 9, 24, 7, 10), (1, 0, 9, 24, 8, 30), (1, 0, 9, 24, 9, 5), (2, 0, 9, 24, 7, 10)],
        "id bigint, start bigint, end bigint, words int, cluster bigint, word int")
    whole = spark.createDataFrame([(1, 40, 10)], "id bigint, words bigint, word int")
    left = _uncovered(runs, whole)
    # Of document 1 the run from word 10 on lies inside the paragraph; those from 5 and 30 on reach beyond it.
    assert sorted((r.id, r.word, r.cluster) for r in left.collect()) == [(1, 5, 9), (1, 30, 8), (2, 10, 7)]
    assert left.columns == ["id", "start", "end", "word", "words", "cluster"]


def test_units_hash_all_their_words():
    texts = [" ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(39)) + " end"]
    assert len(set(Paragraphs(texts).unit.tolist())) == 2


def test_near_copies_that_meet_only_under_a_foreign_centre(spark):
    # Paragraphs of one template, in twins that differ by one word.
    words = lambda t, swap: " ".join(f"u{t}v{i}" if i in swap else f"w{i}" for i in range(80))
    rows = []
    for t in range(150):
        own = {t % 3 + 4, 25 + t % 5, 60 + t % 7}
        rows += [(2 * t, words(t, own)), (2 * t + 1, words(t, own).replace("w45", f"z{t}"))]
    clusters = {r.doc_id: r.clusters for r in repeated_passages(frame(spark, rows)).collect()}
    assert sum(clusters.get(2 * t) != clusters.get(2 * t + 1, 0) for t in range(150)) <= 1


def test_paragraph_places_and_copies_in_one_document(spark):
    text = "Über a b.\n\n  c d\x0be  \n" + LONG
    found = Paragraphs([None, text, "", LONG])
    assert [(t, text[a:b] if t == 1 else LONG[a:b]) for t, a, b in zip(found.text, found.start, found.end)] == [
        (1, "Über a b."), (1, "c d\x0be"), (1, LONG), (3, LONG)]
    assert found.unit[2] == found.unit[3]
    assert repeated_passages(frame(spark, [(1, LONG + "\n" + LONG), (2, "x")])).count() == 0  # one document only


def test_bands_reach_the_recall():
    for percent, rows in ((80, 3), (80, 5), (60, 2)):
        bands = tune_bands(percent, rows, 0.99)
        assert (1 - (percent / 100) ** rows) ** bands <= 0.01 < (1 - (percent / 100) ** rows) ** (bands - 1)


@pytest.mark.parametrize("text", ["x" * 300_000, "a b " * 50_000])
def test_very_long_texts(spark, text):
    assert near_duplicates(frame(spark, [(1, text), (2, text)])).where("NOT kept").count() == 1
    assert Paragraphs([text]).words.sum() == len(text.split())


def test_runs_are_the_same_with_filter_and_by_join(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(5))
    shared = [[word() for _ in range(n)] for n in (36, 60, 150)]
    rows = []
    for i in range(60):  # passages in the middle of a line, some in a third of the documents
        words = [word() for _ in range(draw.randrange(20, 200))]
        at = draw.randrange(len(words))
        rows.append((i, " ".join(words[:at] + (shared[i % 9 % 3] if i % 9 < 3 else []) + words[at:])))
    rows += [(None, rows[0][1]), (3, rows[3][1]), (90, None), (91, "")]
    ways = [sorted(map(str, repeated_passages(frame(spark, rows), max_bytes=size).collect())) for size in (64 << 20, 0)]
    assert ways[0] == ways[1] and len(ways[0]) >= 20
    # By brute force: a document has a passage exactly where it shares 35 words in a row with another one.
    runs = {}
    for i, text in rows:
        words = (text or "").split()
        for k in range(len(words) - 34):
            runs.setdefault(tuple(words[k : k + 35]), set()).add(i)
    want = {i for ids in runs.values() if len(ids - {None}) > 1 for i in ids - {None}}
    assert {r.doc_id for r in repeated_passages(frame(spark, rows)).collect()} == want


def test_rows_of_hot_keys_join_like_all_others(spark):
    rows = spark.range(6_000).selectExpr("id", "CASE WHEN id < 3000 THEN -1 WHEN id < 3100 THEN -2 ELSE id END key")
    lookup = spark.createDataFrame([(-1, "hot"), (4_000, "one"), (9_000, "none")], "key bigint, v string")
    hot = hot_keys(rows.groupBy("key").count(), "key", "count")
    assert {r.key: r._parts for r in hot.collect()} == {-1: 500, -2: 17}
    for how in ("inner", "left", "left_semi"):
        assert sorted(map(str, join_hot(rows, lookup, "key", hot, how).collect())) == sorted(map(str, rows.join(lookup, "key", how).collect()))
    assert hot_keys(rows.limit(0).groupBy("key").count(), "key", "count").count() == 0


def test_members_outside_the_component_of_their_center_get_another(spark):
    rows = [(7, n, 10 + n) for n in range(1, 7)] + [(8, 1, 11), (8, 2, 12), (9, 5, 15)]
    stars = bucket_stars(spark.createDataFrame(rows, "key bigint, node bigint, n bigint"))
    assert {(r.key, r.center, r.m) for r in stars.collect()} == {(7, 1, 11), (8, 1, 11)}
    found = spark.createDataFrame([(1, 1), (2, 1), (4, 4), (6, 4)], "node bigint, component bigint")
    assert sorted(tuple(r) for r in new_centers(stars, found).collect()) == [(7, n, 10 + n, 3, 13) for n in (3, 4, 5, 6)]
