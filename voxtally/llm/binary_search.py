"""Exact k nearest neighbours of binary codes in Hamming distance, by incremental multi-index hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxtally.llm.common import settle

BITS = 64
K = 10
#: Up to so many masks (12 bytes each) of one round are broadcast; beyond, they are joined by shuffle.
BROADCAST_MASKS = 1_000_000
#: Radii that the second round asks for together, and segments that a later round asks in.
FIRST_RADIUS = 2
STEP = 2


def sign_codes(vector: str, bits: int = BITS) -> Column:
    """A bigint whose bit i is set where element i is positive. Null for a null vector and one of another
    length; null and NaN elements count as not positive."""
    return F.expr(f"""CASE WHEN size({vector}) = {bits} THEN aggregate(transform({vector},
        (x, i) -> IF(x > 0 AND NOT isnan(x), shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b) END""")


def _expected_distance(bits: int, n: int, k: int) -> int:
    """Distance within which k of n random codes are expected."""
    within = 0.0
    for d in range(bits + 1):
        within += math.comb(bits, d) / 2.0**bits
        if n * within >= k:
            return d
    return bits


def _segments(bits: int, n: int, k: int) -> list[tuple[int, int]]:
    """(first bit, width) of the number of segments that costs least.

    The cost of a number is that of the values asked for until the expected k-th distance is
    covered, each with the codes that share it.
    """
    far = _expected_distance(bits, n, k)

    def cost(m: int) -> float:
        width = -(-bits // m)
        radius, more = divmod(far + 1, m)  # all segments up to radius - 1, then so many at `radius`
        asked = m * sum(math.comb(width, r) for r in range(min(radius, width + 1)))
        if more and radius <= width:
            asked += more * math.comb(width, radius)
        return asked * (1 + n / 2.0**width)

    m = min(range(1, bits + 1), key=cost)
    edges = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _by_segment(codes: DataFrame, code: str, segments: list[tuple[int, int]]) -> DataFrame:
    parts = [
        F.struct(F.lit(i).alias("seg"), F.shiftrightunsigned(code, at).bitwiseAND((1 << width) - 1 if width < 64 else -1).alias("val"))
        for i, (at, width) in enumerate(segments)]
    return codes.select("*", F.inline(F.array(*parts)))


def _masks(spark, segments: list[tuple[int, int]]) -> DataFrame:
    """The mask without a bit, per segment; `_wider` adds one bit."""
    rows = [(i, width, 0, 0) for i, (_, width) in enumerate(segments)]
    return spark.createDataFrame(rows, "seg int, width int, mask bigint, free int")


def _wider(masks: DataFrame) -> DataFrame:
    more = masks.where("free < width").select("seg", "width", "mask", F.explode(F.expr("sequence(free, width - 1)")).alias("b"))
    return more.select("seg", "width", F.expr("mask | shiftleft(1L, b)").alias("mask"), F.expr("b + 1").alias("free"))


def _steps(segments: int, last: int) -> Iterator[tuple[int, int, int, int]]:
    """(least radius, radius, first segment, end): equal values, small radii at once, then a few segments at a time."""
    yield 0, 0, 0, segments
    if last:
        yield 1, min(FIRST_RADIUS, last), 0, segments
    for radius in range(FIRST_RADIUS + 1, last + 1):
        for low in range(0, segments, STEP):
            yield radius, radius, low, min(low + STEP, segments)


def _nearest(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "least_id")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= keep).drop("_r")


def search(
    vectors: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", code: str = "code", k: int = K, bits: int = BITS,
) -> DataFrame:
    """(query_id, vec_id, rank, distance): the k nearest rows of `vectors` for each row of `queries`, itself left out.

    Both frames have a bigint id and a bigint code. Exact; ties go to the smaller id. Codes are cut
    into m segments, and a table by (segment, value) is the index. Every open query asks for the
    values at distance r in one segment after another, with growing r; what it finds is verified on
    the whole code. After s segments at radius r every code within m * r + s - 1 has been seen, so a
    query is closed as soon as its k-th verified distance is no more than that; the others go on, at
    most until all values were asked for, and take nothing farther than the k-th they have.

    Equal codes are searched once and only their k + 1 least ids are kept, which is all that can
    rank, so a code that a third of the rows share costs no more than another. Rows with a null id
    or code are not found and do not ask. Fewer than k other rows: all of them. Repeated rows of one
    id rank once. Empty tables give an empty result.
    """
    spark, keep = vectors.sparkSession, k + 1
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(code).alias("code")).dropna()
    asked = queries.select(F.col(vec_id).cast("bigint").alias("query_id"), F.col(code).alias("query")).dropna().distinct()
    by_code = Window.partitionBy("code").orderBy("id")
    lists = (rows.withColumn("_r", F.dense_rank().over(by_code)).where(F.col("_r") <= keep).distinct()
                 .groupBy("code").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    codes = settle(lists.select("code", "ids", F.get("ids", 0).alias("least_id"), F.size("ids").alias("n")), "codes")
    total = codes.count()
    segments = _segments(bits, total, keep)
    index = settle(_by_segment(codes.select("code", "least_id", "n"), "code", segments), "index")
    open_ = settle(asked.select("query").distinct().withColumn("bound", F.lit(bits)), "open")
    best = spark.createDataFrame([], "query bigint, code bigint, least_id bigint, n int, distance int")
    closed, masks, last = None, _masks(spark, segments), max(width for _, width in segments)
    for first, radius, low, high in _steps(len(segments), last):
        if total == 0 or open_.isEmpty():
            break
        asking = masks if radius == 0 else None
        for _ in range(first, radius + 1) if radius and low == 0 else ():
            masks = settle(_wider(masks), "masks")
            asking = masks if asking is None else asking.union(masks)
        asking = (masks if asking is None else asking).where(F.col("seg").between(low, high - 1))
        count = sum(math.comb(width, r) for _, width in segments[low:high] for r in range(first, radius + 1))
        some = F.broadcast(asking) if count <= BROADCAST_MASKS else asking
        probes = (_by_segment(open_, "query", segments).join(some.select("seg", "mask"), "seg")
                  .select("query", "bound", "seg", F.col("val").bitwiseXOR(F.col("mask")).alias("val")))
        # What is farther than the k-th distance so far never leaves the join.
        probe, entry = probes.alias("p"), index.alias("i")
        distance = F.expr("bit_count(p.query ^ i.code)")
        hits = probe.join(entry, F.expr("p.seg = i.seg AND p.val = i.val") & (distance <= F.col("p.bound"))).select(
            "p.query", "i.code", "i.least_id", "i.n", distance.alias("distance"))
        best = settle(_nearest(hits.union(best.select(hits.columns)).distinct(), keep), "nearest")
        # A code not seen yet is more than `radius` away in the segments asked, and at least that in the others.
        covered = len(segments) * radius + high - 1
        near = F.sum(F.when(F.col("distance") <= covered, F.col("n")).otherwise(0))
        state = best.groupBy("query").agg((near >= keep).alias("sure"), F.when(F.sum("n") >= keep, F.max("distance")).otherwise(bits).alias("bound"))
        state = settle(state, "state")
        sure = state.where("sure").select("query")
        done = best.join(sure, "query", "left_semi")
        closed = done if closed is None else closed.union(done)
        left = open_.select("query").join(state, "query", "left").where("NOT coalesce(sure, false)")
        open_ = settle(left.select("query", F.coalesce("bound", F.lit(bits)).alias("bound")), "open")
        best = best.join(sure, "query", "left_anti")
    result = best if closed is None else closed.union(best)
    each = (result.select("query", "code", "distance").join(codes.select("code", "ids"), "code")
                  .select("query", "distance", F.explode("ids").alias(vec_id)))
    # Queries that share a code share the k + 1 rows; each then leaves itself out.
    few = Window.partitionBy("query").orderBy("distance", vec_id)
    shortlist = each.withColumn("_r", F.row_number().over(few)).where(F.col("_r") <= keep)
    mine = asked.join(shortlist, "query").where(F.col("query_id") != F.col(vec_id))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", vec_id))
    return (mine.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k)
                .select("query_id", vec_id, "rank", F.col("distance").cast("bigint").alias("distance")))
