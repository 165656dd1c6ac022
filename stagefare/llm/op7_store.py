"""Token ids as binary payloads with a minimal perfect hash index over document keys.

Files in one folder of the shared store, all written and read by Spark:

* ``payload``: documents in ascending ``doc_id`` order, range-partitioned into shards. A row is a
  block of whole documents: their ids as raw little-endian unsigned 32-bit integers, end to end,
  with the documents' keys and lengths. A file holds few blocks, so reading one at a time
  bounds a task's memory.
* ``index``: keys are dealt to buckets of about BUCKET_KEYS by hash. A row is one bucket:
  its seed, a minimal perfect hash of its keys (keys fall into small groups; each group has a displacement that
  sends its keys to slots of their own), and by slot a 32-bit fingerprint of the key, the start of
  the key's ids in the whole output, their number, the number of rows with that key, and the shard and
  blocks that hold them.

Looking a key up takes its bucket, one displacement, one slot and a comparison of fingerprints,
whatever the size; a key that is not there is told by its fingerprint (but for one in 2**32). Reading back groups
the places found by block, meets them with those blocks, cuts the ids at the places and compares the fingerprint of the
key that is stored there; an entry that points elsewhere ends the job with an error.

Defined results: a null text counts as empty, and an empty one has its end id only; rows repeating a ``doc_id``
lie side by side, by text, and the index holds the first start and how many there are; a null ``doc_id``
comes first and is not indexed; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagefare.sources.scratch import new_path

from .tables import materialize, texts
from .text import mix
from .tokens import encoded_blocks

END_ID = 0
BUCKET_KEYS = 1024
GROUP_KEYS = 4
BLOCKS_PER_FILE = 8
BROADCAST_BYTES = 64 << 20
_ROW_BYTES, _PLACE_BYTES = 128, 48

_SLOT, _STEP, _GROUP, _MARK = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))

PAYLOAD = "shard int, block int, n_ids long, keys array<long>, offsets array<long>, lengths array<long>, ids binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    for number, (block, ids, bounds) in enumerate(encoded_blocks(batches, END_ID)):
        lengths = np.diff(bounds)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([len(ids)], pa.int64()),
                pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([bounds[:-1].tolist()], pa.list_(pa.int64())),
                pa.array([lengths.tolist()], pa.list_(pa.int64())),
                pa.array([ids.astype("<u4").tobytes()], pa.binary()),
            ],
            names=["shard", "block", "n_ids", "keys", "offsets", "lengths", "ids"],
        )


def _payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).parquet(f"{path}/payload")


def _bases(payload: DataFrame) -> DataFrame:
    """``(shard, block, base)``: how many ids lie before each block.

    Both windows see one row per shard or block, never documents.
    """
    sizes = payload.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shard_base"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = payload.select("shard", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_base"))
    return starts.join(bases, "shard").select("shard", "block", (F.col("shard_base") + F.col("block_base")).alias("base"))


def _met(table: DataFrame, size: int) -> DataFrame:
    """A table for a join: broadcast if its measured size is small, else joined by shuffle."""
    return F.broadcast(table) if size <= BROADCAST_BYTES else table.hint("merge")


def _documents(payload: DataFrame, bases: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, shard, block)`` of every document stored, without reading ids."""
    rows = payload.select("shard", "block", "keys", "offsets", "lengths").join(bases, ["shard", "block"])
    return rows.select("shard", "block", "base", F.inline(F.arrays_zip("keys", "offsets", "lengths"))).select(
        F.col("keys").alias("doc_id"),
        (F.col("base") + F.col("offsets")).alias("start"),
        F.col("lengths").alias("n_tokens"),
        "shard",
        "block",
    )


class PerfectHash:
    """A minimal perfect hash of the distinct keys of one bucket.

    Two keys of a group may hash alike in all that a displacement could part them by; such a
    bucket, or one with a group that finds no place in TURNS turns, is built with another seed.
    """

    TURNS = 32

    def __init__(self, size: int, seed: int, displacements: np.ndarray) -> None:
        self.size, self.seed, self.displacements = size, seed, displacements

    def _hash(self, keys: np.ndarray, salt: np.uint64, count: int) -> np.ndarray:
        return (mix(mix(keys * salt + np.uint64(self.seed)) + salt) % np.uint64(count)).astype(np.int64)

    def _parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        groups = self._hash(keys, _GROUP, len(self.displacements))
        return groups, self._hash(keys, _SLOT, self.size), self._hash(keys, _STEP, self.size)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        seed = 1
        while True:
            table = cls(len(keys), seed, np.zeros(-(-len(keys) // GROUP_KEYS), np.uint32))
            if table._place(keys):
                return table
            seed += 1

    def _place(self, keys: np.ndarray) -> bool:
        group, at, step = self._parts(keys)
        order = np.argsort(group, kind="stable")
        count = len(self.displacements)
        members = np.split(order, np.searchsorted(group[order], np.arange(1, count)))
        free, shifts = np.ones(self.size, bool), np.arange(self.size)
        for g in sorted(range(count), key=lambda g: -len(members[g])):
            own = members[g]
            for turn in range(self.TURNS):
                # All shifts of this turn at once; a displacement is turn * size + shift.
                slot = (at[own] + turn * step[own]) % self.size
                if len(set(slot.tolist())) < len(own):
                    continue
                good = free[(slot[None, :] + shifts[:, None]) % self.size].all(axis=1)
                shift = int(np.argmax(good))
                if good[shift]:
                    self.displacements[g] = turn * self.size + shift
                    free[(slot + shift) % self.size] = False
                    break
            else:
                return False
        return True

    def slots(self, keys: np.ndarray) -> np.ndarray:
        group, at, step = self._parts(keys)
        turn, shift = np.divmod(self.displacements[group].astype(np.int64), self.size)
        return (at + turn * step + shift) % self.size


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys * _MARK + np.uint64(4)) >> np.uint64(32)).astype(np.uint32)


# What the index holds of a key besides its fingerprint: where its rows start, how many ids and rows, the shard, its first and last block.
ENTRY = ("start", "size", "count", "shard", "first", "last")
INDEX = "bucket long, seed long, displacements binary, marks binary, " + ", ".join(f"{c} binary" for c in ENTRY)


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [p.split()[0] for p in INDEX.split(", ")]
    for batch in batches:
        columns: dict[str, list] = {n: [] for n in names}
        for row in range(batch.num_rows):
            entries = batch.column("entries")[row].values
            keys = np.asarray(entries.field("doc_id")).view(np.uint64)
            table = PerfectHash.build(keys)
            order = np.argsort(table.slots(keys))
            columns["bucket"].append(batch.column("bucket")[row].as_py())
            columns["seed"].append(table.seed)
            columns["displacements"].append(table.displacements.astype("<u4").tobytes())
            columns["marks"].append(fingerprints(keys)[order].astype("<u4").tobytes())
            for name in ENTRY:
                columns[name].append(np.asarray(entries.field(name))[order].astype("<i8").tobytes())
        kinds = {"bucket": pa.int64(), "seed": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array(columns[n], kinds.get(n, pa.binary())) for n in names], names=names)


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets))


def write(docs: DataFrame, path: str) -> None:
    """Write the payload and index of ``documents(doc_id, text)`` to ``path``."""
    spark = docs.sparkSession
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    payload = ordered.mapInArrow(_blocks, PAYLOAD)
    payload.write.option("compression", "zstd").option("maxRecordsPerFile", BLOCKS_PER_FILE).parquet(f"{path}/payload")
    stored = _documents(_payload(spark, path), _measured_bases(spark, path)).filter("doc_id is not null")
    # Equal keys share a range, hence a shard.
    entries = stored.groupBy("doc_id").agg(
        F.min("start").alias("start"),
        F.sum("n_tokens").alias("size"),
        F.count("*").alias("count"),
        F.min("shard").cast("long").alias("shard"),
        F.min("block").cast("long").alias("first"),
        F.max("block").cast("long").alias("last"),
    )
    keys = _payload(spark, path).agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = -(-keys // BUCKET_KEYS) or 1
    grouped = entries.withColumn("bucket", _bucket(buckets)).groupBy("bucket").agg(
        F.collect_list(F.struct("doc_id", *ENTRY)).alias("entries")
    )
    index = grouped.mapInArrow(_index_rows, INDEX).withColumn("buckets", F.lit(buckets).cast("long"))
    index.write.parquet(f"{path}/index")


def _measured_bases(spark: SparkSession, path: str) -> DataFrame:
    """The bases of all blocks, for a join; one short row per block of a store."""
    payload = _payload(spark, path).select("shard", "block", "n_ids")
    return _met(_bases(payload), payload.count() * _ROW_BYTES)


def look_up(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``doc_id`` and ENTRY of the distinct ``keys(doc_id)`` that are stored."""
    index = spark.read.parquet(f"{path}/index")
    buckets = index.agg(F.max("buckets")).first()[0] or 1
    asked = keys.filter("doc_id is not null").select("doc_id").distinct().withColumn("bucket", _bucket(buckets))
    asked = asked.groupBy("bucket").agg(F.collect_list("doc_id").alias("asked"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = [(np.zeros(0, np.int64),) * (1 + len(ENTRY))]
            for row in range(batch.num_rows):
                displacements, marks = (np.frombuffer(batch.column(c)[row].as_py(), "<u4") for c in ("displacements", "marks"))
                wanted = np.asarray(batch.column("asked")[row].values).view(np.uint64)
                table = PerfectHash(len(marks), batch.column("seed")[row].as_py(), displacements)
                slot = table.slots(wanted)
                there = marks[slot] == fingerprints(wanted)
                held = (np.frombuffer(batch.column(c)[row].as_py(), "<i8")[slot[there]] for c in ENTRY)
                parts.append((wanted[there].view(np.int64), *held))
            arrays = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *ENTRY])

    joined = asked.join(index, "bucket").select("asked", "seed", "displacements", "marks", *ENTRY)
    return joined.mapInArrow(found, "doc_id long, " + ", ".join(f"{c} long" for c in ENTRY))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents at the places asked for in payload blocks, with their ids' checksums."""
    for batch in batches:
        for row in range(batch.num_rows):
            base = batch.column("base")[row].as_py()
            keys = batch.column("keys")[row].values
            offsets, lengths = (np.asarray(batch.column(c)[row].values) for c in ("offsets", "lengths"))
            ids = np.frombuffer(batch.column("ids")[row].as_buffer(), "<u4")
            places = batch.column("places")[row].values
            asked, start, size = (places.field(k) for k in range(3))
            start, size = np.asarray(start), np.asarray(size)
            # A key's rows may begin in an earlier block and end in a later one.
            low, high = np.maximum(start - base, 0), np.minimum(start + size - base, len(ids))
            first, last = np.searchsorted(offsets, low), np.searchsorted(offsets, high)
            count = last - first
            at = np.repeat(first - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            found = asked.take(pa.array(np.repeat(np.arange(len(count)), count)))
            same = _marks(keys.take(pa.array(at))) == _marks(found)
            if (count < 1).any() or (offsets[np.minimum(first, len(offsets) - 1)] != low).any() or not same.all():
                raise ValueError("the index points to a place that does not hold its key")
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[at].tolist(), (offsets + lengths)[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [found, pa.array(base + offsets[at]), pa.array(lengths[at]), pa.array(sums, pa.int64())],
                names=[c.split()[0] for c in READ.split(", ")],
            )


def _marks(keys: pa.Array) -> np.ndarray:
    """Fingerprints of keys, with -1 for no key."""
    marks = fingerprints(np.asarray(keys.fill_null(0)).view(np.uint64)).astype(np.int64)
    return np.where(np.asarray(keys.is_null()), -1, marks)


def read_back(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the documents with the given keys.

    The index gives each key's blocks and place; places are grouped by block, and only blocks with one are
    opened: they are broadcast to the payload if their measured size allows, so that ids are not shuffled. Rows
    without a key, which no index holds, are found by the lists beside the payload.
    """
    payload = _payload(spark, path)
    place = F.struct("doc_id", "start", "size").alias("place")
    found = look_up(spark, path, keys).select("shard", F.explode(F.sequence("first", "last")).alias("block"), place)
    unkeyed = _documents(payload, _measured_bases(spark, path)).filter("doc_id is null").withColumnRenamed("n_tokens", "size")
    places = found.unionByName(unkeyed.select(F.col("shard").cast("long").alias("shard"), F.col("block").cast("long").alias("block"), place))
    by_block = places.groupBy("shard", "block").agg(F.collect_list("place").alias("places"))
    by_block = by_block.join(_measured_bases(spark, path), ["shard", "block"])
    by_block = materialize(by_block.select(F.col("shard").cast("int"), F.col("block").cast("int"), "base", "places"), "places")
    size = by_block.agg(F.sum(F.size("places") * _PLACE_BYTES + _ROW_BYTES)).first()[0] or 0
    stored = payload.select("shard", "block", "keys", "offsets", "lengths", "ids").join(_met(by_block, size), ["shard", "block"])
    return stored.select("base", "places", "keys", "offsets", "lengths", "ids").mapInArrow(_cut, READ)


def round_trip(docs: DataFrame) -> DataFrame:
    """Write documents to a new folder of the shared store and read all of them back by key."""
    spark = docs.sparkSession
    path = new_path(spark, "token-store")
    write(docs, path)
    return read_back(spark, path, docs.select(F.col("doc_id").cast("long")))
