"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.llm.common import settle
from voxtally.operators.keys import dense_id_within

#: Documents per block, and the largest share of a source in per cent.
BLOCK_ROWS = 8
MOST_PERCENT = 25
#: Sources whose paths are broadcast, at most (some 20 MB); more are joined by shuffle.
BROADCAST_SOURCES = 20_000


def capped_weights(counts: DataFrame, most_percent: int = MOST_PERCENT) -> DataFrame:
    """(source, n, weight): a source weighs its n (half blocks), but no more than `most_percent` of all."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.select("source", "n", F.least(F.col("n") * 100, F.lit(total * most_percent)).alias("weight"))


def _paths(weights: DataFrame) -> DataFrame:
    """(source, n, path): for every level at which a source's group is paired, what it shares with.

    A source with a share of at least 1 / 2^d, but not 1 / 2^(d - 1), is a leaf at depth d of a binary
    tree; leaves follow each other by depth, then source (they fit, since these parts of two add up to
    one at most). So a source carries a falling part of each group above it, whatever the weights.
    A path has the level, whether the group is the second of its pair, its weight, that of both and
    the half blocks of the other: some forty entries at most.
    """
    rows = weights.where("weight > 0")
    total = rows.agg(F.sum("weight")).first()[0] or 0
    depth = F.expr(f"size(filter(sequence(0, 61), e -> CAST(weight AS decimal(18, 0)) * CAST(shiftleft(1L, e) AS decimal(20, 0)) < {total}))")
    ranked = settle(dense_id_within(rows.withColumn("d", depth), "d", ["source"], "_rank"), "ranked")
    # At most 62 depths.
    sizes = sorted((r.d, r["count"]) for r in ranked.groupBy("d").count().collect())
    deepest = sizes[-1][0] if sizes else 0
    before = list(accumulate((k << (deepest - d) for d, k in sizes), initial=0))
    first = F.create_map(*[F.lit(x).cast("bigint") for (d, _), at in zip(sizes, before) for x in (d, at)]) if sizes else F.lit(None).cast("map<bigint,bigint>")
    coded = ranked.withColumn("code", first[F.col("d").cast("bigint")] + F.expr(f"shiftleft(_rank - 1, {deepest} - d)"))
    climbs = coded.where("d > 0").select("source", "n", "weight", "code", F.explode(F.sequence(F.lit(deepest) - F.col("d"), F.lit(deepest - 1))).alias("l"))
    climbs = climbs.withColumn("node", F.expr("shiftright(code, l)"))
    groups = settle(climbs.groupBy("l", "node").agg(F.sum("weight").alias("own"), F.sum("n").alias("n")), "groups")
    other = groups.select("l", F.col("node").bitwiseXOR(F.lit(1)).alias("node"), F.col("own").alias("_w"), F.col("n").alias("_n"))
    pairs = groups.drop("n").join(other, ["l", "node"])
    step = F.struct("l", (F.col("node") % 2 == 1).alias("late"), "own", (F.col("own") + F.col("_w")).alias("both"), F.col("_n").alias("n"))
    found = climbs.select("source", "n", "l", "node").join(pairs, ["l", "node"]).groupBy("source", "n").agg(F.array_sort(F.collect_list(step)).alias("path"))
    lone = F.expr("CAST(array() AS array<struct<l:int,late:boolean,own:bigint,both:bigint,n:bigint>>)")
    return found.union(ranked.where("d = 0").select("source", "n", lone.alias("path")))


def _slot(block: str, others: str) -> Column:
    """The slot of a source's half block: its place among those of its pair, then of the pair's pair, and so on.

    Half block p of a group with a share own / both is released at floor(p * both / own) and due at
    ceil((p + 1) * both / own). The one whose window has the earliest middle runs, the first group
    on ties; by arithmetic that is place (2p + 1) * both / (2 * own), rounded. When the other group
    has run out, at `others`, the rest follows without gaps.
    """
    return F.expr(f"""aggregate(path, CAST({block} AS bigint), (p, x) -> IF(
        CAST(2 * p + 1 AS decimal(20, 0)) * CAST(x.both AS decimal(18, 0)) - IF(x.late, 0, 1)
            >= CAST({others} + p + 1 AS decimal(20, 0)) * CAST(2 * x.own AS decimal(18, 0)),
        {others} + p,
        (CAST(2 * p + 1 AS decimal(20, 0)) * CAST(x.both AS decimal(18, 0)) - IF(x.late, 0, 1)) div CAST(2 * x.own AS decimal(18, 0))))""")


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, *, doc_id: str = "doc_id", source: str = "source",
    block_rows: int = BLOCK_ROWS, most_percent: int = MOST_PERCENT,
) -> DataFrame:
    """One row per document: id, source, block, place (in the block), slot, in_mix.

    `weights` has (source, weight bigint below 10^15); by default a source weighs its blocks, at most
    `most_percent` of all. The documents of a source, in the order of their ids' hash, form blocks
    of `block_rows`; a slot runs half a block. Every half block has a release slot and a deadline
    from its source's exact share (Pfair windows), and the one due first runs. Over all sources at
    once that is a sequential job, so groups of sources are scheduled in pairs, each by the windows
    of its share in the pair: every half block then finds its slot by arithmetic, whatever comes
    before it. A pair adds half a half block, of which a source carries its share in the pair. Those
    shares fall with every level, so a source is less than 1.5 half blocks from its target in every
    prefix, however long the run: less than one block.

    A source that has run out leaves its slots to the other one of its pair. in_mix is true up to
    the first slot at which a source would need a half block it does not have: there the shares hold.
    Later rows keep their order and are marked, not dropped. Sources without a weight, or with 0,
    have a null slot and are not in the mix.

    Running numbers in a source come from range partitions, so a source with most of the rows is
    spread over many tasks. Rows without a source are a source of their own; rows without an id come
    first in theirs; repeated rows are placed one by one. Only the two columns are read. An empty
    table gives an empty result.
    """
    slim = docs.select(F.col(source).alias("source"), F.col(doc_id).cast("bigint").alias("id"))
    # The hash comes first in the order, so that a prefix of a source is a fair sample of it.
    keyed = slim.withColumn("h", F.coalesce(F.md5(F.col("id").cast("string")), F.lit("")))
    numbered = dense_id_within(keyed, "source", ["h", "id"], "_number")
    half = max(block_rows // 2, 1)
    counts = settle(slim.groupBy("source").agg(F.expr(f"(count(*) + {half - 1}) div {half}").alias("n")), "counts")
    if weights is None:
        weighted = capped_weights(counts, most_percent)
    else:
        weighted = counts.join(weights.select(F.col("source").alias("_s"), "weight"), F.col("source").eqNullSafe(F.col("_s"))).select("source", "n", "weight")
    plan = settle(_paths(weighted), "schedule")
    sources, horizon = plan.select(_slot("n", "1000000000000000000").alias("end")).agg(F.count("*"), F.min("end")).first()
    small = plan.select(F.col("source").alias("_s"), "path")
    small = F.broadcast(small) if sources <= BROADCAST_SOURCES else small
    placed = numbered.join(small, F.col("source").eqNullSafe(F.col("_s")), "left")
    placed = placed.withColumn("slot", _slot(f"((_number - 1) div {half})", "x.n"))
    return placed.select(
        F.col("id").alias(doc_id), F.col("source").alias(source), F.expr(f"(_number - 1) div {block_rows}").alias("block"),
        F.expr(f"(_number - 1) % {block_rows}").alias("place"), "slot",
        F.coalesce(F.col("slot") < F.lit(horizon), F.lit(False)).alias("in_mix"))


def share_whole_sources(placed: DataFrame, *, source: str = "source", block_rows: int = BLOCK_ROWS, most_percent: int = MOST_PERCENT) -> DataFrame:
    """`placed` with in_mix by exact integer weights: only what a source has above its capped share is out.

    in_mix of `mix_sources` ends where the first source does. Here a source that has run out leaves
    the others going: every source keeps its rows in their order up to its weight. A source of no more than `most_percent` of all rows stays whole, a larger one keeps
    that many. Where all are larger, they go on evenly until the least of them has run out.
    `block_rows` is that of `mix_sources`; rows without a slot stay out.
    """
    counts = placed.where("slot IS NOT NULL").groupBy(F.col(source).alias("_s")).agg(F.count("*").alias("_n"))
    counts = settle(counts, "shares")
    total, least = counts.agg(F.sum("_n"), F.min("_n")).first()
    if not total:
        return placed
    # Rounded up, so that no source with a weight is left without a row.
    quota = max(-(-total * most_percent // 100), least)
    small = counts.select("_s", F.least("_n", F.lit(quota)).alias("_quota"))
    small = F.broadcast(small) if counts.count() <= BROADCAST_SOURCES else small
    inside = F.col("block") * block_rows + F.col("place") < F.col("_quota")
    return (placed.join(small, F.col(source).eqNullSafe(F.col("_s")), "left")
                  .withColumn("in_mix", F.coalesce(inside, F.lit(False)) & F.col("slot").isNotNull()).drop("_s", "_quota"))


def _order_key(doc_id: str) -> Column:
    return F.struct(F.coalesce(F.md5(F.col(doc_id).cast("string")), F.lit("")).alias("h"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63))).alias("id"))


def keep_mixture(docs: DataFrame, placed: DataFrame, *, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The rows of `docs` that are in the mix.

    The rows of a source that are left out come last in its order, so one boundary per source
    (broadcast after a count) decides, and the texts are not shuffled.
    """
    ends = (placed.where("NOT in_mix").groupBy(F.col(source).alias("_s")).agg(F.min(_order_key(doc_id)).alias("_end")))
    ends = settle(ends, "boundaries")
    inside = ends["_end"].isNull() | (_order_key(doc_id) < ends["_end"])
    few = F.broadcast(ends) if ends.count() <= BROADCAST_SOURCES else ends
    return docs.join(few, docs[source].eqNullSafe(ends["_s"]), "left").where(inside).select(docs["*"])


def sort_by_mixture(docs: DataFrame, placed: DataFrame, *, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """`docs` in the order of the mix: by slot, then by place, so that every stretch of it has the sources by their shares.

    Rows of a source with the same id stand together, in the first of their slots; rows without a
    slot come last. Written as Parquet, the table keeps this order (`stored_order`).
    """
    first = (placed.where("slot IS NOT NULL").groupBy(F.col(source).alias("_s"), F.col(doc_id).alias("_i"))
                   .agg(F.min("slot").alias("_slot"), F.min("place").alias("_place")))
    same = docs[source].eqNullSafe(first["_s"]) & docs[doc_id].cast("bigint").eqNullSafe(first["_i"])
    return (docs.join(first, same, "left").orderBy(F.asc_nulls_last("_slot"), "_place", "_i")
                .select(*(docs[c] for c in docs.columns)))
