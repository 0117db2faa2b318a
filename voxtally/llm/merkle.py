"""Merkle trees over a dataset: digests of rows, roots, proofs, and their check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.functions.staging import computed
from voxtally.llm.common import settle
from voxtally.operators.keys import dense_id, dense_id_within
from voxtally.session import shared_path

ARITY = 8


def row_digest(*values: Column) -> Column:
    """SHA-256, in lowercase hex, of the values in order: `-` for null, else byte count, `:`, value as text."""
    def field(value: Column) -> Column:
        plain = value.cast("string")
        return F.when(plain.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain))

    return F.sha2(F.concat(*map(field, values)), 256)


def _by_slot(df: DataFrame, arity: int, label: str) -> DataFrame:
    """Write nodes in one folder per slot of their run, so that a reader of one slot reads no other."""
    path = shared_path(df.sparkSession, label)
    slotted = df.withColumn("slot", F.expr(f"CAST(at % {arity} AS int)"))
    slotted.write.partitionBy("slot").parquet(path)
    return df.sparkSession.read.schema(slotted.schema).parquet(path)


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, at, members, node): the runs of `arity` consecutive nodes, each with its parent node.

    A self-join per sibling: the node in slot s of a run stands s places behind the one in slot zero,
    so the row of slot zero meets its siblings by equality on (tree, place - s). The slot-zero rows then
    emit the parents. All joins have the same keys, so each node is shuffled once. A run alone in its
    tree is the root already and keeps its digest.
    """
    row = nodes.where("slot = 0").select("tree", "at", F.col("node").alias("_0"))
    for s in range(1, arity):
        sibling = nodes.where(F.col("slot") == s).select("tree", (F.col("at") - s).alias("at"), F.col("node").alias(f"_{s}"))
        row = row.join(sibling, ["tree", "at"], "left")
    members = F.filter(F.array(*[f"_{s}" for s in range(arity)]), lambda m: m.isNotNull())
    run = computed(row.select("tree", F.expr(f"at div {arity}").alias("at"), members.alias("members")),
                   lone=(F.col("at") == 0) & (F.size("members") == 1))
    joined = F.sha2(F.array_join(F.transform("members", lambda m: m["digest"]), ""), 256)
    digest = F.when(F.col("lone"), F.col("members")[0]["digest"]).otherwise(joined)
    return run.select("tree", "at", "members", "lone", F.struct(digest.alias("digest")).alias("node"))


def _fold_up(nodes: DataFrame, arity: int, label: str) -> list[DataFrame]:
    """The runs of each level, until every tree has a single node."""
    levels = []
    while True:
        nodes = _by_slot(_runs(nodes, arity), arity, label)
        levels.append(nodes)
        if not (nodes.agg(F.max("at")).first()[0] or 0):
            return levels


def _paths_down(levels: Sequence[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """`above` has (tree, at = 0, path, …) of the trees' roots; gives the same of their lowest nodes, with `node`.

    A path has, per level from the node to the root, what stands left and right of it in its run.
    """
    for runs in reversed(levels):
        found = runs.select("tree", "at", "members", "lone").join(above.drop("node"), ["tree", "at"])
        member = found.select("*", F.posexplode("members").alias("pos", "node"))
        part = lambda first, count: F.array_join(
            F.transform(F.slice("members", first, count), lambda m: m["digest"]), "")
        step = F.struct(part(F.lit(1), F.col("pos")).alias("left"),
                        part(F.col("pos") + 2, F.greatest(F.size("members") - F.col("pos") - 1, F.lit(0))).alias("right"))
        steps = F.when(F.col("lone"), F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
        above = member.withColumn("path", steps).withColumn("at", F.expr(f"at * {arity} + pos")).drop("members", "lone", "pos")
    return above


class Manifest(NamedTuple):
    """The levels of the groups' trees and of the tree over their roots; all are written tables."""
    levels: list[DataFrame]
    top: list[DataFrame]
    arity: int

    def roots(self) -> DataFrame:
        """(root): one row, none for an empty dataset."""
        return self.top[-1].select(F.col("node.digest").alias("root"))

    def subroots(self) -> DataFrame:
        """(tree, subroot): `-` for the rows without a group, else `=` and the group."""
        return self.levels[-1].select("tree", F.col("node.digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """One row per leaf: its carried columns, leaf, subroot, root and path (array of left and right siblings)."""
        root = self.top[-1].select("tree", "at", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                                   F.col("node.digest").alias("root"))
        trees = _paths_down(self.top, root, self.arity).select(
            F.col("node.tree").alias("tree"), F.lit(0).cast("bigint").alias("at"), "path", "root",
            F.col("node.digest").alias("subroot"))
        rows = _paths_down(self.levels, trees, self.arity)
        return rows.select("node.carried.*", F.col("node.digest").alias("leaf"), "subroot", "root", "path")


def build_manifest(
    docs: DataFrame, values: Sequence[str], *, doc_id: str = "doc_id", group: str = "lang",
    carry: Mapping[str, Column] | None = None, arity: int = ARITY,
) -> Manifest:
    """Trees of `arity` over the rows of each group in the order of their ids, and one over the groups' roots.

    A leaf is the digest of `values` (see `row_digest`). While a tree has several nodes on a level,
    each run of `arity` of them becomes the digest of their digests; the last run may be shorter. The
    roots of the groups, null first and then by their UTF-8 bytes, are joined in the same way.
    `carry` names further columns that `proofs` returns with the leaf, beside the id.

    Rows without an id come first in their group; rows with the same id follow the order of their
    leaves, so repeated rows give one tree whatever their order. Null and empty values differ. Only
    the named columns are read, others may have any name. An empty table gives no root and no proofs.

    A group of any size is numbered by range partitions and joined by (tree, place), so a language with
    most of the rows is spread over all tasks. A level reads each node once and has an `arity`-th of the rows
    of the one below; nothing but the largest place of a level comes to the driver.
    """
    name = F.col(f"`{group}`").cast("string")
    carried = F.struct(F.col(f"`{doc_id}`").alias(doc_id), *[c.alias(k) for k, c in (carry or {}).items()])
    slim = docs.select(
        F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name)).alias("tree"),
        F.col(f"`{doc_id}`").alias("_id"), row_digest(*[F.col(f"`{v}`") for v in values]).alias("_digest"), carried.alias("_carried"))
    # Written first: finding the ranges of the places would digest every text a second time.
    numbered = dense_id_within(settle(slim, "digests"), "tree", [F.col("_id").asc_nulls_first(), "_digest"], "_number")
    leaves = numbered.select("tree", (F.col("_number") - 1).alias("at"), F.struct(
        F.col("_digest").alias("digest"), F.col("_carried").alias("carried")).alias("node"))
    levels = _fold_up(_by_slot(leaves, arity, "leaves"), arity, "level")
    trees = dense_id(levels[-1].select("tree", F.col("node.digest").alias("digest")), ["tree"], 0, "at")
    tops = trees.select(F.lit("").alias("tree"), "at", F.struct("digest", "tree").alias("node"))
    return Manifest(levels, _fold_up(_by_slot(tops, arity, "subroots"), arity, "top"), arity)


def proof_text(path: Column) -> Column:
    """All siblings of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))
