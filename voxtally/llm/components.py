"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voxtally.llm.common import settle


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: one edge per node, to its least local node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for lo, hi in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(lo), root(hi)
            if a != b:
                parent[max(a, b)] = min(a, b)
    edges = [(root(x), x) for x in parent]
    edges = [(lo, hi) for lo, hi in edges if lo != hi]
    yield pa.record_batch([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["lo", "hi"])


def _large_star(edges: DataFrame) -> DataFrame:
    ways = edges.selectExpr("lo u", "hi v").union(edges.selectExpr("hi u", "lo v"))
    least = ways.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) m")
    return ways.join(least, "u").where("v > u").selectExpr("m lo", "v hi").where("lo < hi").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo > m").selectExpr("m lo", "lo hi")
    return moved.union(least.selectExpr("m lo", "hi")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi") % (1 << 31))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge; component is its least node (bigint).

    Each partition is first reduced to a forest by union-find, then large-star and small-star
    rounds (minima over neighbours, joined back) hook the forests together until nothing moves.
    Edges stay in tables; only a count and a checksum per round reach the driver. Edges with a
    null end and loops are ignored; an empty table gives an empty one.
    """
    pairs = edges.select(F.least(a, b).cast("bigint").alias("lo"), F.greatest(a, b).cast("bigint").alias("hi"))
    pairs = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("lo < hi")
    forest = settle(pairs.mapInArrow(_contract, "lo bigint, hi bigint"), "forest")
    state = _state(forest)
    while state[0]:
        forest = settle(_small_star(_large_star(forest)), "forest")
        before, state = state, _state(forest)
        if state == before:
            break
    return forest.selectExpr("hi node", "lo component").union(
        forest.selectExpr("lo node", "lo component").distinct())
