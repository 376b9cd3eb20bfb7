"""Sharding by a k-d tree over document metadata, with distributed weighted medians.

A document's point is its metadata on four axes of 4,096 steps (size, source,
language, id). A node that must hold m shards is cut along the axis on which
its points spread widest, at the weight fraction floor(m/2)/m. The cuts of all
nodes of a level are found at once: running sums over the steps of the axis
give the step in which the fraction falls, then running sums over a 20-bit
hash of the text, first in bins and then in the bin, a threshold among the
points of that step. So a source that holds a third of all rows is cut
through. Points and cuts stay tables; a level is a few jobs, whatever the
number of shards, and nothing but counts reaches the driver.

Rows of equal text are a group with the metadata of its first row: no cut goes
through it, unless it is too heavy for even shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliary.llm.common import discard, materialise

#: Steps of an axis, and of the hash that orders points within one step, and bins of that hash.
STEPS, TIES, BINS = 4096, 1 << 20, 1024
#: Rows numbered in one window task when slots are given out.
SLOT_ROWS = 50_000
#: Nodes of a level whose cuts (some 50 bytes each) are joined by broadcast; with more, Spark chooses the join.
BROADCAST_NODES = 1 << 16
#: Part of a shard that a group of equal texts may weigh and stay whole.
WHOLE_GROUP = 1 / 4
AXES = ("x_size", "x_source", "x_lang", "x_id")


def metadata(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, size, text_crc32, two hashes of the text, a tie value, and the axes; missing metadata columns count as constant."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    hashed = lambda name: F.pmod(F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(STEPS)).cast("int") if name in docs.columns else F.lit(0)
    size = F.octet_length(raw).cast("bigint") + 8
    return docs.select(
        F.col(id_col).alias("id"),
        size.alias("size"),
        F.crc32(F.encode(raw, "UTF-8")).cast("bigint").alias("text_crc32"),
        F.xxhash64(raw).alias("t1"),
        F.xxhash64(F.lit(7), raw).alias("t2"),
        F.pmod(F.xxhash64(raw, F.lit(1)), F.lit(TIES)).cast("int").alias("tie"),
        F.least(F.lit(STEPS - 1), F.floor(F.log2(size.cast("double")) * (STEPS / 48))).cast("int").alias("x_size"),
        hashed("source").alias("x_source"),
        hashed("lang").alias("x_lang"),
        F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(STEPS)).cast("int").alias("x_id"),
    )


def _crossing(rows: DataFrame, by: str) -> DataFrame:
    """(node, by, left, w): the value at which the running sum of sizes of each node passes ``left``, and what is left there."""
    sums = rows.groupBy("node", by).agg(F.sum("size").alias("w"), F.max("left").alias("left"))
    before = F.sum("w").over(Window.partitionBy("node").orderBy(by)) - F.col("w")
    return sums.withColumn("left", F.col("left") - before).where("left >= 0 and left < w").select("node", by, "left", "w")


def _on(axis: Column) -> Column:
    return F.element_at(F.array(*[F.col(a) for a in AXES]), axis)


def grow(points: DataFrame, shards: int) -> DataFrame:
    """``points`` with the number of the leaf of each, of ``shards`` leaves of near equal weight (sum of size)."""
    now = materialise(points.withColumns({"node": F.lit(0), "parts": F.lit(shards)}))
    for level in range((shards - 1).bit_length()):
        joined = F.broadcast if 1 << level <= BROADCAST_NODES else lambda x: x
        open_ = now.where("parts > 1")
        spread = open_.groupBy("node").agg(F.sum("size").alias("w"), F.max("parts").alias("m"), *[(F.max(a) - F.min(a)).alias(a) for a in AXES])
        # The widest axis by its number from 1; of equals the first.
        widest = F.array_position(F.array(*[F.col(a) for a in AXES]), F.greatest(*AXES)).cast("int")
        goals = materialise(spread.select("node", widest.alias("axis"), F.expr("w * (m div 2) div m").alias("left")))
        at = open_.join(joined(goals), "node").select("node", "size", "tie", F.floor(F.col("tie") / BINS).alias("bin"), _on(F.col("axis")).alias("x"), "axis", "left")
        steps = _crossing(at, "x").drop("w")
        inside = at.drop("left").join(joined(steps), ["node", "x"])
        bins = _crossing(inside, "bin").drop("w")
        ties = _crossing(inside.drop("left").join(joined(bins), ["node", "bin"]), "tie")
        # What is left at the last hash value is one text's weight or less: the cut goes to its nearer end.
        cut = F.col("tie") + F.when(F.col("left") * 2 > F.col("w"), 1).otherwise(0)
        cuts = materialise(ties.select("node", cut.alias("cut")).join(steps.select("node", F.col("x").alias("step")), "node").join(goals.select("node", "axis"), "node"))
        x = _on(F.col("axis"))
        right = F.col("cut").isNotNull() & ~((x < F.col("step")) | ((x == F.col("step")) & (F.col("tie") < F.col("cut"))))
        half = F.expr("parts div 2").cast("int")
        parts = F.when(F.col("cut").isNull(), F.col("parts")).when(right, F.col("parts") - half).otherwise(half)
        moved = now.join(joined(cuts), "node", "left").select(*points.columns, F.when(right, F.col("node") + half).otherwise(F.col("node")).alias("node"), parts.alias("parts"))
        before, now = now, materialise(moved)
        discard(before, goals, cuts)
    return now.drop("parts").withColumnRenamed("node", "shard")


def shard(docs: DataFrame, shards: int = 24, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): leaves of a k-d tree with near equal bytes.

    ``target_bytes`` asks for as many leaves as bring each to that size, in
    place of ``shards``. ``size`` is the bytes of the text (none if null) plus
    8. Rows of equal text share a leaf, unless together they weigh over 1/4 of
    one (WHOLE_GROUP): those are dealt out by id. Slots count from 0 without gaps in each shard; they are
    given out in windows of about SLOT_ROWS rows whose offsets are running sums
    of counts. Null ids, repeated rows and empty tables are fine.
    """
    points = materialise(metadata(docs, id_col, text_col))
    whole = points.agg(F.count("*").alias("n"), F.sum("size").alias("w")).first()
    if target_bytes:
        shards = max(1, -(-(whole["w"] or 0) // target_bytes))
    # A group of several rows too heavy to stay whole is dealt out by its rows' own metadata and ids. There are fewer
    # than shards / WHOLE_GROUP such groups, which bounds the broadcast. The others are small: their join has no hot key.
    groups = points.groupBy("t1", "t2").agg(F.sum("size").alias("group_w"), F.min(F.struct("id", *AXES)).alias("rep"))
    groups = materialise(groups)
    limit = (whole["w"] or 0) / shards * WHOLE_GROUP
    heavy = groups.where(F.col("group_w") > limit).select("t1", "t2")
    heavy = F.broadcast(heavy) if shards / WHOLE_GROUP <= BROADCAST_NODES else heavy
    by_id = F.pmod(F.xxhash64(F.col("id"), F.col("size")), F.lit(TIES)).cast("int")
    loose = points.join(heavy, ["t1", "t2"], "left_semi").withColumn("tie", by_id)
    tied = points.join(heavy, ["t1", "t2"], "left_anti").drop(*AXES).join(groups.where(F.col("group_w") <= limit).select("t1", "t2", *[F.col(f"rep.{a}").alias(a) for a in AXES]), ["t1", "t2"])
    placed = grow(loose.unionByName(tied).drop("t1", "t2"), shards)
    discard(points, groups)
    parts = max(1, -(-whole["n"] // (shards * SLOT_ROWS)))
    part = F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(parts)).cast("int")
    numbered = placed.withColumn("part", part).select("id", "size", "text_crc32", "shard", "part")
    offsets = numbered.groupBy("shard", "part").agg(F.count("*").alias("c")).selectExpr("shard", "part", "sum(c) over (partition by shard order by part) - c as before")
    ranked = numbered.selectExpr("*", "row_number() over (partition by shard, part order by id, text_crc32, size) - 1 as inner_slot")
    return ranked.join(offsets, ["shard", "part"]).select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("before") + F.col("inner_slot")).cast("bigint").alias("slot"))
