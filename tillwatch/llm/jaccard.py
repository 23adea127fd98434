"""Exact Jaccard join of documents on word n-grams, as a metric-space join.

Distance is 1 - Jaccard similarity, a metric; two documents link within
``radius = 1 - similarity``.

1. Documents with equal n-gram sets are one point.  A point has a number of its own, a
   hash of its set, which all tables carry: a doc_id may hold several points.
2. First pivots are single n-grams.  A point's nearest of them are the n-grams it
   holds (all others are at distance 1), ties broken by one global order, rare
   n-grams first.  A neighbour within the radius lacks at most ``n - ceil(s n)`` of a
   point's n n-grams, so it meets the point in the regions of its first
   ``n - ceil(s n) + 1``: the point is replicated to exactly these.  Regions with one
   point end here; in prose that is almost all of them.
3. Inside a region the pivots are documents.  Everybody's exact distance to the
   region's first pivot is taken.  Points within the radius link and form the
   pivot's ball; the ball is connected, so pairs inside it need no test.  The
   others are the outside.  In further rounds outside points are pivots, 8, 128,
   2048, ... a region at a time, against those points that are not yet in the same
   component and that the triangle inequality admits: both distances to the
   region's first pivot differ by the radius at most, and sizes by the factor
   ``similarity``.  A region is done when each outside point has been a pivot.

No pair within the radius is lost: it meets in a region, and there either both
lie in one component, or one of them becomes a pivot while the other is admitted.
The n-gram order uses the frequencies of a sample; it decides only how much work
there is, not what is found.

Defined cases: words are lower-cased (A-Z only); fewer words than ``k`` count as one
n-gram; a null, empty or blank text has an empty set and links with nothing; a
null doc_id has a set but takes no part in links (null component); rows that
repeat a doc_id are one document with several texts, linked by the doc_id.  Links inside
a component that others imply are not measured: the result is components, not links.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .bitmap import bitmap, let_through
from .components import components
from .job import narrow, ship
from .words import Words, grams, mix, pieces, signed

LEVEL_BITS = 22  # the table of n-gram frequencies has 2**22 places, whatever the data
SAMPLED = 16     # one document in so many counts for the order
HEAVY = 3        # times that a sampled n-gram must occur to be ordered after the rare ones
SKETCH_BITS = 11 # a point's sketch has 2**11 parity bits; that of a larger set as many as n-grams, rounded up to a power of two


def ngram_sets(text: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending within the text, and each one's text."""
    hashes = text.hashes()
    keys, at = grams(hashes, text.doc, k)
    docs = text.doc[at]
    short = np.flatnonzero((text.count > 0) & (text.count < k))
    if len(short):
        first = text.bounds()[short]
        own = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            more = j < text.count[short]
            own[more] = mix(own[more] * np.uint64(3) + hashes[first[more] + j])
        keys = np.concatenate((keys, mix(own + text.count[short].astype(np.uint64))))
        docs = np.concatenate((docs, short))
    by = np.argsort(keys, kind="stable")
    kind = np.uint16 if text.texts < 1 << 16 else np.int64
    by = by[np.argsort(docs[by].astype(kind), kind="stable")]
    keys, docs = keys[by], docs[by]
    if len(keys):
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        keys, docs = keys[new], docs[new]
    return keys, docs


def _sampled(k: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, text in pieces(batch, "text", lower=True):
                keys, n = np.unique(ngram_sets(text, k)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n.astype(np.int64))], ["key", "n"])
    return count


def frequency_levels(docs: DataFrame, k: int) -> np.ndarray:
    """For each place of an n-gram's leading bits, the binary logarithm of how frequent it is."""
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0)
    heavy = some.mapInArrow(_sampled(k), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY)
    place = F.shiftrightunsigned("key", 64 - LEVEL_BITS).cast("int").alias("place")
    level = F.least(F.ceil(F.log2(F.max("n"))), F.lit(63)).cast("int").alias("level")
    found = heavy.groupBy(place).agg(level).toArrow()  # at most 2**22 rows
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    levels[found["place"].to_numpy()] = found["level"].to_numpy()
    return levels


def _digests(keys: np.ndarray, docs: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the n-gram sets and two hashes of each, the same in any order."""
    sizes = np.bincount(docs, minlength=texts).astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    one = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(keys), dtype=np.uint64)))
    two = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(keys ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    return sizes, signed(one[ends[1:]] - one[ends[:-1]]), signed(two[ends[1:]] - two[ends[:-1]])


def _points(k: int, percent: int, shared):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in batches:
            for at, to, text in pieces(batch, "text", lower=True):
                keys, docs = ngram_sets(text, k)
                sizes, d1, d2 = _digests(keys, docs, text.texts)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                level = levels[(keys >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)]
                # rare first, by hash within a level: a stable sort by level of what is in hash order
                by = np.lexsort((level, docs)) if level.any() else np.arange(len(keys))
                ranked = keys[by]
                short = sizes - -(-sizes * percent // 100) + (sizes > 0)
                turn = np.arange(len(keys)) - ends[docs]
                pick = ranked[turn < short[docs]]
                offsets = np.concatenate(([0], np.cumsum(short))).astype(np.int32)
                width = np.int64(1) << np.maximum(SKETCH_BITS, np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
                until = np.concatenate(([0], np.cumsum(width)))
                bit = until[docs] + (keys & (width - 1).astype(np.uint64)[docs]).astype(np.int64)
                odd = np.bincount(bit, minlength=until[-1]) & 1
                sketch = np.packbits(odd.astype(np.uint8)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), pa.array(sizes), pa.array(d1), pa.array(d2),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(pick))),
                     pa.ListArray.from_arrays(pa.array((until >> 6).astype(np.int32)), pa.array(sketch))],
                    ["doc_id", "n_shingles", "d1", "d2", "pivots", "sketch"])
    return make


def _set_rows(k: int, shared):
    """n-gram sets of the texts whose doc_id and d1 the bitmap lets through."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            some = batch.filter(pa.array(let_through(bits, batch.column("doc_id").to_numpy())))
            for at, to, text in pieces(some, "text", lower=True):
                keys, docs = ngram_sets(text, k)
                sizes, d1, d2 = _digests(keys, docs, text.texts)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(sizes), pa.array(d1), pa.array(d2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(keys)))],
                    ["n", "d1", "d2", "keys"])
                yield rows.filter(pa.array(let_through(bits, d1)))
    return make


def _in_regions(shared):
    """Points with the pivots that the bitmap lets through, one row each."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            pivots = batch.column("pivots")
            row = pivots.value_parent_indices().to_numpy()
            keys = pivots.flatten().to_numpy()
            keep = let_through(bits, keys) if len(keys) else np.zeros(0, bool)
            first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows))))
            place = (np.arange(len(row)) - first[row])[keep]
            row = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[keep]), batch.column("doc").take(row), batch.column("id").take(row), batch.column("n").take(row), pa.array(place.astype(np.int32))],
                ["region", "doc", "id", "n", "pos"])
    return make


def _in_pairs(shared):
    """Points that the bitmap lets through."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(let_through(shared.value, batch.column("doc").to_numpy())))
    return keep


def _near(percent: int):
    """Sizes of two sets, and what follows this n-gram in both, allow the similarity.

    Where the region's n-gram is a pair's first common one, all others they share
    come after it in both; a pair that is similar passes at least there.
    """
    sizes = F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent
    after = F.least(F.col("n") - F.col("pos"), F.col("pivot_n") - F.col("pivot_pos"))
    return sizes & (after * (100 + percent) >= (F.col("n") + F.col("pivot_n")) * percent)


def _paired(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The points that can be in pairs (doc, pivot); sketches do not compress, so the others are kept out of the shuffle."""
    held = pairs.sparkSession.sparkContext.broadcast(bitmap(pairs.select(F.explode(F.array("doc", "pivot")).alias("key"))))  # 4 MB
    return classes.select("doc", "sketch", "d1", "id").mapInArrow(_in_pairs(held), "doc bigint, sketch array<bigint>, d1 bigint, id bigint")


def _apart(one: str, two: str) -> Column:
    """Bits in which two sketches differ, at least; the longer one is folded to the other's length.

    A longer sketch's halves, one laid on the other, are the sketch of half the length.
    """
    def differ(a, b):
        return F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))

    def folded(a, size):
        return differ(F.slice(a, 1, size), F.slice(a, size + 1, size))

    n, m = F.size(one), F.size(two)
    bits = F.when(n == m, differ(F.col(one), F.col(two))).when(n == 2 * m, differ(folded(F.col(one), m), F.col(two))).when(
        m == 2 * n, differ(F.col(one), folded(F.col(two), n)))  # further apart in size: nothing is known
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda x, y: x + F.bit_count(y)), F.lit(0))


def _measure(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Exact intersection sizes of those pairs (doc, n, pivot, pivot_n) that can be similar enough.

    The parity sketches of two sets differ in at most as many bits as the sets do in
    n-grams; pairs whose sketches are too far apart need no text.
    """
    spark = pairs.sparkSession
    pairs = materialize(pairs, "pairs")
    classes = _paired(pairs, classes)
    own = classes.select("doc", "sketch", "d1", "id")
    other = classes.select(F.col("doc").alias("pivot"), F.col("sketch").alias("pivot_sketch"), F.col("d1").alias("pivot_d1"), F.col("id").alias("pivot_id"))
    asked = (pairs.join(own, "doc").join(other, "pivot")
             .filter(_apart("sketch", "pivot_sketch") * (100 + percent) <= (F.col("n") + F.col("pivot_n")) * (100 - percent)))
    asked = materialize(asked.select("doc", "n", "d1", "id", "pivot", "pivot_n", "pivot_d1", "pivot_id"), "asked")
    wanted = asked.select(F.explode(F.array("id", "d1", "pivot_id", "pivot_d1")).alias("key"))
    shared = spark.sparkContext.broadcast(bitmap(wanted))  # 4 MB
    sets = texts.filter("doc_id IS NOT NULL").mapInArrow(_set_rows(k, shared), "n bigint, d1 bigint, d2 bigint, keys array<bigint>")
    # sets are long: they go by point once, for both joins, and one side of a pair a second time
    sets = sets.select(F.xxhash64("n", "d1", "d2").alias("doc"), "keys").dropDuplicates(["doc"])
    right = sets.select(F.col("doc").alias("pivot"), F.col("keys").alias("pivot_keys"))
    asked = asked.select("doc", "n", "pivot", "pivot_n")
    return asked.join(sets, "doc").join(right, "pivot").select(
        "doc", "pivot", "n", "pivot_n", F.size(F.array_intersect("keys", "pivot_keys")).cast("bigint").alias("both"))


def jaccard_join(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Documents link when 100 * intersection >= percent * union of their n-gram sets;
    component_id is the smallest doc_id that links lead to.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    shared = spark.sparkContext.broadcast(frequency_levels(texts, k))  # 4 MB
    points = materialize(texts.mapInArrow(
        _points(k, percent, shared), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, pivots array<bigint>, sketch array<bigint>"), "points")
    full = points.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("n_shingles", "d1", "d2").agg(F.min(F.struct("doc_id", "pivots", "sketch")).alias("least"))
    classes = materialize(classes.select(F.xxhash64("n_shingles", "d1", "d2").alias("doc"), F.col("least.doc_id").alias("id"), F.col("n_shingles").alias("n"),
                                         "d1", "d2", F.col("least.pivots").alias("pivots"), F.col("least.sketch").alias("sketch")), "classes")
    held = materialize(full.select("doc_id", F.xxhash64("n_shingles", "d1", "d2").alias("doc")), "held")
    # a doc_id with several texts ties their points
    several = held.groupBy("doc_id").agg(F.min("doc").alias("u"), F.max("doc").alias("v")).filter("u <> v").select("doc_id", "u")
    tied = held.join(several, "doc_id").filter("u <> doc").select("u", F.col("doc").alias("v")).distinct()
    # of the regions only those of several points go on
    crowded = classes.select(F.explode("pivots").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    bits = spark.sparkContext.broadcast(bitmap(crowded))  # 4 MB
    replicas = materialize(classes.select("doc", "id", "n", "pivots").mapInArrow(_in_regions(bits), "region bigint, doc bigint, id bigint, n bigint, pos int"), "replicas")
    # the smallest doc_id is the pivot: near copies lie closer to what they were made from than to each other
    firsts = replicas.groupBy("region").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "doc", "n", "pos")).alias("p")).filter("c > 1")
    regions = materialize(replicas.join(firsts, "region").select(
        "region", "c", "doc", "n", "pos", F.col("p.doc").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.pos").alias("pivot_pos")), "regions")

    # first round: the point of the smallest doc_id is its region's pivot
    near = _near(percent)
    asked = regions.filter("doc <> pivot").filter(near).select("doc", "n", "pivot", "pivot_n").distinct()
    first = materialize(_measure(asked, classes, texts, k, percent), "measured")
    linked = F.col("both") * 100 >= (F.col("n") + F.col("pivot_n") - F.col("both")) * percent
    links = first.filter(linked).select(F.col("doc").alias("u"), F.col("pivot").alias("v")).unionByName(tied)
    links = materialize(links, "links")
    label = components(links)

    def labelled(rows: DataFrame, column: str, name: str) -> DataFrame:
        own = label.select(F.col("node").alias(column), F.col("component").alias(name))
        return rows.join(own, column, "left").withColumn(name, F.coalesce(name, column))

    # distance to the region's first pivot; unknown where sizes alone keep them apart
    similar = F.col("both") / (F.col("n") + F.col("pivot_n") - F.col("both"))
    known = first.select("doc", "pivot", (1 - similar).alias("far"))
    # a region of two points is done: its one pair has been looked at
    rows = labelled(regions.filter("c > 2"), "doc", "comp")
    mixed = rows.groupBy("region").agg((F.min("comp") != F.max("comp")).alias("open")).filter("open").select("region")
    rows = materialize(rows.join(mixed, "region", "left_semi").join(known, ["doc", "pivot"], "left")
                       .withColumn("far", F.when(F.col("doc") == F.col("pivot"), F.lit(0.0)).otherwise(F.col("far")))
                       .select("region", "doc", "n", "pos", "far", F.col("pivot").alias("center")), "open")
    turn = 8
    radius = 1 - percent / 100 + 1e-9
    while True:
        # outside points that have not been pivots yet, in a fixed order
        now = labelled(labelled(rows, "doc", "comp"), "center", "center_comp")
        order = Window.partitionBy("region").orderBy(F.xxhash64("doc"), "doc")
        outside = now.filter("comp <> center_comp").withColumn("rank", F.row_number().over(order))
        chosen = outside.filter(F.col("rank") <= turn).select(
            "region", F.col("doc").alias("pivot"), F.col("n").alias("pivot_n"), F.col("pos").alias("pivot_pos"), F.col("far").alias("pivot_far"), F.col("comp").alias("pivot_comp"))
        chosen = materialize(chosen, "pivots")
        if chosen.isEmpty():
            break
        asked = (now.join(chosen, "region").filter("comp <> pivot_comp").filter(near)
                 .filter(F.coalesce(F.abs(F.col("far") - F.col("pivot_far")) <= radius, F.lit(True)))
                 .select("doc", "n", "pivot", "pivot_n").distinct())
        fresh = materialize(_measure(asked, classes, texts, k, percent).filter(linked).select(F.col("doc").alias("u"), F.col("pivot").alias("v")), "links")
        # a point that was a pivot is done in its region
        done = chosen.select("region", F.col("pivot").alias("doc"))
        rows = materialize(now.select("region", "doc", "n", "pos", "far", "center").join(
            done.withColumn("was", F.lit(True)), ["region", "doc"], "left").filter("was IS NULL").drop("was"), "open")
        if not fresh.isEmpty():
            links = materialize(links.unionByName(fresh), "links")
            label = components(links)
        turn *= 16

    # a component's number is its smallest doc_id
    joined = label.join(classes.select(F.col("doc").alias("node"), "id"), "node")
    leader = label.select(F.col("node").alias("doc"), "component").join(joined.groupBy("component").agg(F.min("id").alias("least")), "component")
    alone = classes.select("doc", "id").join(leader.select("doc", "least"), "doc", "left").select("doc", F.coalesce("least", "id").alias("least"))
    class_of = held.join(alone, "doc").groupBy("doc_id").agg(F.min("least").alias("component_id"))
    rest = points.select("doc_id", "n_shingles")
    return rest.join(class_of, "doc_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` without those that have a smaller document in their component.

    Rows that repeat a doc_id are one document and stay or go together; of those that
    repeat its text as well one stays, the one whose other columns written as JSON have the
    smallest md5.  Rows with a null id all stay.  Only rows that may have to go are shuffled.
    """
    spark = docs.sparkSession
    ids = F.col("doc_id").cast("bigint").alias("key")
    groups = jaccard_join(docs, k, percent)
    gone = materialize(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    again = docs.groupBy(ids).count().filter("count > 1 AND key IS NOT NULL").select("key")
    bits = spark.sparkContext.broadcast(bitmap(gone.select(F.col("doc_id").alias("key")).unionByName(again)))  # 4 MB

    def parted(through: bool):
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("doc_id").cast(pa.int64())
                hit = let_through(bits.value, own.fill_null(0).to_numpy()) & ~own.is_null().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(hit == through))
        return part

    some = docs.mapInArrow(parted(True), docs.schema)
    kept = some.join(gone, some["doc_id"] == gone["doc_id"], "left_anti")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    first = Window.partitionBy("doc_id", "text").orderBy(F.md5(F.to_json(F.struct(F.lit(0).alias("0"), *others)).cast("binary")))  # limited map-side
    one = kept.withColumn("__turn", F.row_number().over(first)).filter(F.col("__turn") == 1).drop("__turn")
    return docs.mapInArrow(parted(False), docs.schema).unionByName(one)
