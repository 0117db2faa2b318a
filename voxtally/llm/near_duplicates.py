"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from voxtally.llm.common import settle
from voxtally.llm.components import connected_components
from voxtally.llm.shingles import WIDTH, band_keys, set_digest, shingle_hashes, super_minhash, words_of

BANDS = 20
ROWS = 4
PERCENT = 85
#: Up to so many candidate ids (8 bytes each) are broadcast to pick their texts; beyond, a shuffle.
BROADCAST_IDS = 1_000_000
#: A key is hot from this part of all rows on, so there are never more hot keys than that.
HOT_PART = 1_000
#: Buckets get new centres as long as a round confirms at least one in so many of the pairs it tried.
ROUND_PART = 10


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _signer(bands: int, rows: int, width: int) -> Callable:
    none = np.empty(0, np.int64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 500):
                sizes, digests, keys = [], [], []
                for text in batch.column(1):
                    hashes = shingle_hashes(words_of(text.as_py()), width)
                    sizes.append(len(hashes))
                    digests.append(set_digest(hashes))
                    keys.append(band_keys(super_minhash(hashes, bands * rows), rows) if len(hashes) else none)
                yield pa.record_batch(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists(keys)],
                    ["id", "n", "digest", "keys"])

    return sign


def _setter(width: int) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 200):
                sets = [shingle_hashes(words_of(text.as_py()), width).view(np.int64) for text in batch.column(1)]
                yield pa.record_batch([batch.column(0), _lists(sets)], ["node", "hashes"])

    return build


def _confirm(percent: int) -> Callable:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            good = []
            for i in range(batch.num_rows):
                x, y = (np.asarray(side[i].values) for side in (left, right))
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return check


def _could(percent: int, m: str = "m", n: str = "n") -> F.Column:
    """Sizes that allow the similarity at all."""
    return F.expr(f"100 * least({m}, {n}) >= {percent} * greatest({m}, {n})")


def hot_keys(counts: DataFrame, key: str, n: str) -> DataFrame:
    """The keys that hold over a thousandth of all rows, written once: fewer than 1,000, with _parts, the
    thousandths that they hold, rounded up (in all below 2,000).

    `counts` has a row per key with its number of rows.
    """
    total = counts.agg(F.sum(n)).first()[0] or 1
    parts = F.ceil(F.col(n) * HOT_PART / total).cast("int").alias("_parts")
    return settle(counts.where(F.col(n) * HOT_PART > total).select(key, parts), "hot")


def join_hot(rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` joined to a narrow lookup with unique keys. Rows of hot keys stay where they are and meet
    the fewer than 1,000 lookup rows of those keys by broadcast; all others go by shuffle.
    """
    hot = hot.select(key)
    few = lookup.join(F.broadcast(hot), key, "left_semi")
    other = rows.join(F.broadcast(hot), key, "left_anti").join(lookup, key, how)
    return other.unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(few), key, how))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a written table, whose full sets reach the similarity. A document `a` with many
    partners is dealt over tasks.
    """
    hot = hot_keys(pairs.groupBy("a").agg(F.count("*").alias("_n")), "a", "_n")
    parts = F.coalesce("_parts", F.lit(1))
    dealt = (pairs.select("a", "b").join(F.broadcast(hot), "a", "left")
                  .select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("_part")))
    firsts = (sets.selectExpr("node a", "hashes left").join(F.broadcast(hot), "a", "left")
                  .select("a", "left", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")))
    both = dealt.join(firsts, ["a", "_part"]).join(sets.selectExpr("node b", "hashes right"), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_confirm(percent), "a bigint, b bigint").distinct()


def new_centers(crowded: DataFrame, components: DataFrame) -> DataFrame:
    """The buckets without the members that are in the component of their center; the least of the rest is the center."""
    labels = components.withColumnRenamed("component", "c")
    placed = crowded.join(labels, "node", "left").withColumn("c", F.coalesce("c", "node"))
    # A center is a member of its bucket, so its component comes with one aggregate by key.
    kept = F.max(F.when(F.col("node") == F.col("center"), F.col("c"))).alias("_c")
    rest = placed.groupBy("key").agg(kept, F.min("c").alias("_low"), F.max("c").alias("_high")).where("_low < _high").select("key", "_c")
    counts = crowded.groupBy("key").agg(F.count("*").alias("_n"))
    open_rows = join_hot(placed, rest, "key", hot_keys(counts, "key", "_n")).where("c <> _c").select("key", "node", "n")
    return bucket_stars(settle(open_rows, "open"))


def bucket_stars(buckets: DataFrame) -> DataFrame:
    """(key, node, n, center, m) of the rows (key, node, n) of buckets with two or more members; the center is the
    least node and m its n.
    """
    least = buckets.groupBy("key").agg(F.min(F.struct("node", "n")).alias("_l"), F.count("*").alias("_n")).where("_n > 1")
    centers = settle(least.select("key", F.col("_l.node").alias("center"), F.col("_l.n").alias("m"), "_n"), "centers")
    hot = hot_keys(centers, "key", "_n")
    return settle(join_hot(buckets, centers.drop("_n"), "key", hot).select("key", "node", "n", "center", "m"), "buckets")


def untested_pairs(crowded: DataFrame, components: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket that its star did not try and that are not yet in one component.

    Enumerating them would be quadratic in the bucket, so they are found by prefix filter: with
    the shingles of every such document ordered from rare to common, two sets of the wanted
    similarity must share one of their first n - ceil(p n) + 1 shingles, at positions that leave
    room for the overlap. Copies that differ from each other fill that prefix with shingles of
    their own, so almost none of the impossible pairs ever meet.
    """
    hot = hot_keys(crowded.groupBy("key").agg(F.count("*").alias("_n")), "key", "_n")
    placed = (crowded.where("node <> center").join(components.withColumnRenamed("component", "c"), "node", "left")
                     .select("key", "node", "n", F.coalesce("c", "node").alias("c")))
    mixed = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    open_nodes = settle(join_hot(placed, mixed.select("key"), "key", hot, "left_semi").select("node", "n", "c").distinct(), "open")
    shingles = open_nodes.join(sets, "node").select("node", "n", "c", F.explode("hashes").alias("s"))
    shared = (shingles.groupBy("s").agg(F.count("*").alias("f"), F.min("c").alias("low"), F.max("c").alias("high"))
                      .where("f > 1"))
    common = join_hot(shingles, shared, "s", hot_keys(shared, "s", "f"))
    # Shingles of one document only come first in the order; their number is what is missing here.
    own = common.groupBy("node").agg(F.count("*").alias("k"))
    order = Window.partitionBy("node").orderBy("f", "s")
    ranked = common.withColumn("i", F.row_number().over(order)).join(own, "node").withColumn("i", F.expr("i + n - k"))
    prefix = settle(ranked.where(f"i <= n - ceil({percent} * n / 100) + 1 AND low < high").select("s", "node", "n", "c", "i"), "prefix")
    left, right = prefix.selectExpr("s", "node a", "n m", "c d", "i j"), prefix.withColumnRenamed("node", "b")
    room = F.expr(f"{100 + percent} * (1 + least(m - j, n - i)) >= {percent} * (m + n)")
    pairs = left.join(right, "s").where("a < b AND c <> d").where(_could(percent)).where(room)
    return settle(pairs.select("a", "b").distinct(), "pairs")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, bands: int = BANDS, rows: int = ROWS,
    percent: int = PERCENT, width: int = WIDTH,
) -> DataFrame:
    """One row per row of `docs`: the id, n_shingles, class_id, component_id, kept.

    The ids are bigints. A document's set is its distinct shingles of `width` words; two documents
    are linked when 100 * intersection >= `percent` * union. Equal sets form a class, of which only
    the row with the least id (class_id) goes on. SuperMinHash signatures of bands * rows
    components are banded; with 20 bands of 4, a pair at 0.85 shares no band in fewer than one of a
    million cases. In every bucket the least id is paired with each other member (a star, never all
    pairs), confirmed on the full sets and joined to components. Members outside the component of their
    center get a new center among themselves, as long as a round confirms a tenth of what it tries; what
    all stars left untested between components follows by prefix filter. No cap on buckets, partners or sizes.

    A null text and a text without words have no shingles, are linked with nothing and kept. Rows
    that share an id count as one document. A row without an id has no component and is kept. Other
    columns of `docs` are not read. An empty table gives an empty result.
    """
    slim = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    signed = settle(slim.mapInArrow(
        _signer(bands, rows, width), "id bigint, n bigint, digest binary, keys array<bigint>"), "signed")
    sizes = settle(signed.where("n > 0").groupBy("digest").agg(F.min("id").alias("class_id"), F.count("*").alias("_n")), "classes")
    classes = sizes.where("class_id IS NOT NULL").drop("_n")
    heads = (signed.join(classes, "digest").where("id = class_id")
                   .select(F.col("id").alias("node"), "n", "keys").distinct())
    crowded = bucket_stars(heads.select("node", "n", F.explode("keys").alias("key")))
    wanted = settle(crowded.select("node").distinct(), "candidates")
    picked = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    sets = settle(slim.join(picked.withColumnRenamed("node", "id"), "id", "left_semi")
                      .mapInArrow(_setter(width), "node bigint, hashes array<bigint>").distinct(), "sets")
    links, found, stars = None, None, crowded
    while True:
        tried = (stars.where("node <> center").where(_could(percent))
                      .select(F.col("center").alias("a"), F.col("node").alias("b")).distinct())
        tried = settle(tried, "stars")
        fresh = settle(verify(tried, sets, percent), "links")
        links = fresh if links is None else links.union(fresh)
        found = connected_components(links, "a", "b")
        if fresh.count() * ROUND_PART <= tried.count():
            break
        stars = new_centers(stars, found)
    more = settle(verify(untested_pairs(crowded, found, sets, percent), sets, percent), "links")
    if not more.isEmpty():
        found = connected_components(links.union(more), "a", "b")
    # Labels of classes first, so that every member, however many copies it has, meets one row by its digest.
    labels = found.withColumnRenamed("node", "class_id")
    members = join_hot(signed.where("n > 0").select("id", "n", "digest"), classes.join(labels, "class_id", "left"),
                       "digest", hot_keys(sizes, "digest", "_n"), "left").select("id", "n", "class_id", "component")
    rest = signed.where("n = 0").select("id", "n", F.col("id").alias("class_id"))
    named = rest.where("id IS NOT NULL").join(labels, "class_id", "left").select("id", "n", "class_id", "component")
    whole = members.union(named).union(rest.where("id IS NULL").withColumn("component", F.lit(None).cast("bigint")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class_id", "id"))
    return (whole.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                         F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"),
                         component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """The rows of `docs` but those that have a smaller id in their group; all columns pass unchanged.

    Rows that share an id stay or go together; rows without an id stay.
    """
    found = near_duplicates(docs, doc_id, text, **how)
    gone = settle(found.where("NOT kept").select(F.col(doc_id).alias("_gone")).distinct(), "removed")
    few = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(few, docs[doc_id] == gone["_gone"], "left_anti")
