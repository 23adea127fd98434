"""Mixing sources to target weights, with DataFrame functions only.

Every source is a row of permuted blocks (documents by hash), once for each pass
over the source; the mix takes blocks in that order until the source's target
is reached, the last one in part.  A splitting tree then hands the blocks to
the output shards: at each node a random half of the node's blocks goes left,
so the counts of each source are a multivariate hypergeometric draw, and every
shard draws disjoint blocks.  Inside a shard documents lie in hash order.

Rules.  A null text has size 0.  Sources are ordered by code point, null last,
and weigh 5, 2, 1, repeating.  Rows that repeat a doc_id are rows of their own.
No document is taken more than ``most`` times.  Everything random is a hash of
ids and ``seed``, so reruns agree and the partitioning doesn't matter.  An empty
table gives an empty mix.  Documents of size 0 are taken with their block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5       # words of the mix for each word of the input
MOST = 2          # times that a document may be taken
BLOCK = 512       # documents of a block, on average
BLOCKS = 4096     # blocks of a source and pass, at most; larger sources have larger blocks
DEPTH = 5         # levels of the splitting tree: 2**DEPTH shards
SMALL = 2000      # sources whose plan is surely small enough to be broadcast

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Each source's target: shares by weight, none above ``most`` times its size.

    Water filling: with the sources in the order in which they overflow, the
    level is what the unfilled ones share of what is left.  ``sizes`` has one row
    for each source (source, source_size, n_docs).
    """
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    capped = (ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
              .withColumn("full_at", F.col("cap") / F.col("weight")))
    order = Window.orderBy("full_at", "place")
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))) / F.sum("weight").over(onward)
    filled = capped.withColumn("level", level)
    # the first source that the level does not fill sets the level for all from there on
    found = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "place", "level"))).over(whole)
    return filled.withColumn("found", found["level"]).select(
        "source", "source_size", "n_docs",
        F.least(F.col("cap"), F.coalesce(F.col("found"), F.col("full_at")) * F.col("weight")).alias("target"))


def _split(blocks: DataFrame, depth: int, seed: int) -> DataFrame:
    """Hand the blocks to 2**depth shards, halving each node's blocks at random."""
    tree = blocks.withColumn("shard", F.lit(0))
    for level in range(depth):
        node = Window.partitionBy("shard")
        mixed = node.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "source", "pass", "block"), "source", "pass", "block")
        left = F.row_number().over(mixed) * 2 <= F.count(F.lit(1)).over(node)
        tree = tree.withColumn("shard", F.col("shard") * 2 + F.when(left, 0).otherwise(1))
    return tree


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
        depth: int = DEPTH, seed: int = 42, carry: bool = True) -> DataFrame:
    """One row for each row of documents: how often the mix takes it, and where to.

    Columns: doc_id, source, size, source_size, target, takes (array of pass, shard,
    place; empty where not taken), and with ``carry`` the whole row as ``doc``.
    """
    kept = [F.struct("*").alias("doc")] if carry else []
    units = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"),
                        F.xxhash64(F.lit(seed), "doc_id").alias("draw"), *kept)
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    n_blocks = F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.ceil(F.col("n_docs") / BLOCK))).cast("bigint")
    goals = materialize(targets(sizes, weights, share, most).withColumn("n_blocks", n_blocks), "targets")
    few = goals.count() <= SMALL

    def small(table: DataFrame) -> DataFrame:
        """Hinted only where the number of sources, counted above, bounds it."""
        return F.broadcast(table) if few else table

    placed = units.join(small(goals), units["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    placed = placed.withColumn("block", F.pmod("draw", F.col("n_blocks")))
    sums = placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("target").alias("target"))
    each = sums.withColumn("pass", F.explode(F.array(*[F.lit(i) for i in range(most)])))
    order = Window.partitionBy("source").orderBy("pass", F.xxhash64(F.lit(seed), "pass", "block"), "block")  # blocks, not rows
    before = F.col("upto") - F.col("words")
    drawn = (each.withColumn("upto", F.sum("words").over(order))
             .filter((before < F.col("target")) | ((F.col("words") == 0) & (F.col("upto") <= F.col("target"))))
             .select("source", "pass", "block", (F.col("upto") > F.col("target")).alias("part"), (F.col("target") - before).alias("left")))
    quotas = materialize(_split(drawn, depth, seed), "quotas")
    plan = quotas.groupBy("source", "block").agg(
        F.collect_list(F.when(~F.col("part"), F.struct("pass", "shard"))).alias("draws"),
        F.max(F.when(F.col("part"), F.struct("pass", "shard", "left"))).alias("cut"))
    plan = materialize(plan, "plan")  # its written size lets Spark choose: broadcast under the session's threshold, else a shuffle
    planned = placed.join(plan, placed["source"].eqNullSafe(plan["source"]) & (placed["block"] == plan["block"]), "left")
    planned = planned.drop(plan["source"]).drop(plan["block"]).withColumn("draws", F.coalesce("draws", F.array().cast("array<struct<pass:int,shard:int>>")))
    whole = planned.filter(F.col("cut").isNull())
    # the block that crosses the target, one for each source, goes in part: in hash order
    # what fits, then small documents first into what is left, to the nearest
    group = Window.partitionBy("source", "block")
    first = group.orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crossing = planned.filter(F.col("cut").isNotNull()).withColumn("fits", F.sum("size").over(first) <= F.col("cut.left"))
    crossing = crossing.withColumn(
        "rest", F.col("cut.left") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))).over(group), F.lit(0)))
    then = (Window.partitionBy("source", "block", "fits").orderBy("size", "draw", "doc_id")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = F.col("fits") | (F.sum("size").over(then) - F.col("size") / 2 <= F.col("rest"))
    crossing = crossing.withColumn("draws", F.when(
        taken, F.concat("draws", F.array(F.struct("cut.pass", "cut.shard")))).otherwise(F.col("draws"))).drop("fits", "rest")
    place = F.transform("draws", lambda d: F.struct(
        d["pass"].alias("pass"), d["shard"].alias("shard"), F.xxhash64(F.lit(seed + 1), d["pass"], "doc_id").alias("place")))
    return whole.unionByName(crossing).select(
        "doc_id", "source", "size", "source_size", "target", place.alias("takes"), *(["doc"] if carry else []))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each taken row of ``docs`` as often as it is taken, shard by shard.

    Only the columns of ``docs``; a shard's rows are dealt over tasks by their place and
    lie in the shard's order within each.
    """
    taken = mix(docs, **options).select("doc", F.explode("takes").alias("take"))
    part = F.shiftrightunsigned("take.place", 56)
    return taken.repartition("take.shard", part).sortWithinPartitions("take.shard", "take.place").select("doc.*")
