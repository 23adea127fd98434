"""Token ids of a corpus in raw files, with keyed access in constant time.

``write`` puts the ids of all documents, in ascending doc_id order, into payload
files of one range of ids each, and builds a minimal perfect hash index from
document keys to (file, place, length) with a fingerprint for each key.
``read`` looks keys up in the index and reads their ids from the payload.

Payload file: 16 bytes (``TWID``, version, bytes an id, zeros), then the ids,
little-endian.  Index: a Parquet table ``bucket, blob``; a bucket holds about
``BUCKET`` keys, and its blob the hash function followed by the slots' columns.

Nulls: a null text has only the end id; a null doc_id is a key like any other and
comes first.  Rows that repeat a doc_id are told apart by ``copy`` (0, 1, ...,
in the order of their texts).  An empty table gives empty files and no rows.
Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..session import materialize, scratch_path
from .job import filesystem, narrow, ship
from .mph import Mph
from .tokens import default_path, encoder, token_ids
from .words import mix

HEAD = 16
BUCKET = 1024  # keys of one bucket of the index, on average

PLACES = "shard int, doc_id bigint, copy bigint, begin bigint, n_tokens bigint"
SLOTS = (("print", "<u4"), ("shard", "<u4"), ("begin", "<u8"), ("n_tokens", "<u4"))


def _keys(doc_id: pa.Array, copy: pa.Array) -> np.ndarray:
    ids = doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    null = doc_id.is_null().to_numpy(zero_copy_only=False)
    turn = copy.to_numpy(zero_copy_only=False).astype(np.uint64)
    return mix(mix(ids + np.uint64(0x51ED270B)) ^ (turn * np.uint64(0xD6E8FEB86659FD93)) ^ null * np.uint64(0xA5A5A5A5A5A5A5A5))


def _prints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype("<u4")


def _payload_writer(folder: str, path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        fs, base = filesystem(folder)
        final, draft = f"{base}/ids-{shard:06d}.bin", f"{base}/.ids-{shard:06d}-{context.taskAttemptId()}"
        width = encoder(path).width
        begin, last, copy = 0, object(), 0
        with fs.open_output_stream(draft) as out:
            out.write(b"TWID" + struct.pack("<HH", 1, width) + bytes(8))
            for batch in batches:
                ids = token_ids(batch, "text", path)
                out.write(np.concatenate(ids).astype(f"<u{width}").tobytes())
                keys = batch.column("doc_id").to_pylist()
                copies = []
                for key in keys:
                    copy = copy + 1 if key == last else 0
                    last = key
                    copies.append(copy)
                sizes = np.array([len(x) for x in ids], np.int64)
                at = begin + np.concatenate(([0], np.cumsum(sizes)))
                begin = int(at[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), shard, np.int32)), batch.column("doc_id").cast(pa.int64()),
                     pa.array(copies, pa.int64()), pa.array(at[:-1]), pa.array(sizes)],
                    ["shard", "doc_id", "copy", "begin", "n_tokens"])
        fs.move(draft, final)
    return write


def _index_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One blob for each bucket; the rows come sorted by bucket."""
    held: list[pa.Table] = []

    def blob(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        keys = _keys(table["doc_id"].combine_chunks(), table["copy"].combine_chunks())
        function = Mph.build(keys)
        slot = function.slots(keys)
        raw = struct.pack("<I", len(keys)) + function.to_bytes()
        for name, kind in SLOTS:
            values = _prints(keys) if name == "print" else table[name].to_numpy()
            column = np.zeros(len(keys), kind)
            column[slot] = values
            raw += column.tobytes()
        return pa.RecordBatch.from_arrays([table["bucket"].combine_chunks().slice(0, 1), pa.array([raw], pa.binary())],
                                          ["bucket", "blob"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        edges = np.flatnonzero(np.diff(table["bucket"].to_numpy())) + 1
        at = 0
        for to in [*edges.tolist(), table.num_rows]:
            part = table.slice(at, to - at)
            if held and part.num_rows and held[-1]["bucket"][0] != part["bucket"][0]:
                yield blob(pa.concat_tables(held))
                held = []
            if part.num_rows:
                held.append(part)
            at = to
    if held:
        yield blob(pa.concat_tables(held))


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (wanted keys, blob) to the places of the keys found."""
    for batch in batches:
        for wanted, raw in zip(batch.column("wanted"), batch.column("blob").to_pylist()):
            rows = wanted.values
            doc_id, copy = rows.field("doc_id"), rows.field("copy")
            keys = _keys(doc_id, copy)
            n = struct.unpack_from("<I", raw)[0]
            function, at = Mph.from_bytes(raw[4:])
            at += 4
            slot = function.slots(keys)
            got = {}
            for name, kind in SLOTS:
                got[name] = np.frombuffer(raw, kind, n, at)
                at += got[name].nbytes
            good = slot >= 0
            good[good] = got["print"][slot[good]] == _prints(keys)[good]
            slot, keep = slot[good], pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["shard"][slot].astype(np.int32)), doc_id.filter(keep), copy.filter(keep),
                 pa.array(got["begin"][slot].astype(np.int64)), pa.array(got["n_tokens"][slot].astype(np.int64))],
                ["shard", "doc_id", "copy", "begin", "n_tokens"])


def _payload_reader(folder: str, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        opened, source, width = None, None, 0
        for batch in batches:
            sums, ids = [], []
            for shard, begin, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "begin", "n_tokens"))):
                if shard != opened:
                    source = fs.open_input_file(f"{base}/ids-{shard:06d}.bin")
                    magic, _, width = struct.unpack("<4sHH", source.read_at(8, 0))
                    if magic != b"TWID":
                        raise ValueError("not a payload file")
                    opened = shard
                own = np.frombuffer(source.read_at(n * width, HEAD + begin * width), f"<u{width}").astype("<u4")
                sums.append(zlib.crc32(own.tobytes()))
                ids.append(own.astype(np.int32) if with_ids else None)
            columns = [batch.column(c) for c in ("shard", "doc_id", "copy", "begin", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                ["shard", "doc_id", "copy", "begin", "n_tokens", "ids_crc32", "ids"])
    return read


class TokenFiles:
    """Written payload files and their index.  ``bases`` has one row for each file."""

    def __init__(self, spark: SparkSession, folder: str, index: DataFrame, bases: DataFrame, buckets: int):
        self.spark, self.folder, self.index, self.bases, self.buckets = spark, folder, index, bases, buckets

    def read(self, keys: DataFrame, with_ids: bool = True) -> DataFrame:
        """The ids of the wanted documents.

        ``keys`` has doc_id and copy.  Keys that were not written give no row (but
        for one in 2**32 that the fingerprint lets through).  Columns: doc_id,
        copy, start (ids of all documents before it), n_tokens, ids_crc32, ids.
        """
        wanted = (keys.select("doc_id", "copy", _bucket(self.buckets))
                  .groupBy("bucket").agg(F.collect_list(F.struct("doc_id", "copy")).alias("wanted")))  # ~BUCKET keys each
        found = wanted.join(self.index, "bucket").select("wanted", "blob").mapInArrow(_look_up, PLACES)
        block = F.shiftright(F.col("begin"), 22)
        dealt = found.repartition(F.col("shard"), block).sortWithinPartitions("shard", "begin")
        read = dealt.mapInArrow(_payload_reader(self.folder, with_ids), PLACES + ", ids_crc32 bigint, ids array<int>")
        return read.join(self.bases, "shard").select(
            "doc_id", "copy", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32", "ids")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)).cast("int").alias("bucket")


def write(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None) -> TokenFiles:
    """Write the ids of ``docs`` (doc_id, text) and their index below ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "token-files")
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    ordered = (narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    places = materialize(ordered.mapInArrow(_payload_writer(folder, tokenizer or default_path()), PLACES), "token-places")
    sizes = places.groupBy("shard").agg(F.sum("n_tokens").alias("size"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    bases = materialize(sizes.select("shard", "rows", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base")), "bases")
    rows = bases.agg(F.sum("rows")).first()[0] or 0
    buckets = max(1, -(-rows // BUCKET))
    keyed = places.withColumn("bucket", _bucket(buckets)).repartition("bucket").sortWithinPartitions("bucket")
    keyed.mapInArrow(_index_blobs, "bucket int, blob binary").write.parquet(f"{folder}/index")
    index = spark.read.schema("bucket int, blob binary").parquet(f"{folder}/index")
    return TokenFiles(spark, folder, index, bases.select("shard", "base"), buckets)


def keys_of(docs: DataFrame) -> DataFrame:
    """One key for each row of ``docs``: doc_id and copy (0, 1, ... within a doc_id)."""
    counts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id")).groupBy("doc_id").count()
    return counts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1)).alias("copy"))
