"""Near duplicates among embeddings by random-hyperplane signs.

Vectors of one label and one length are signed by several tables of random hyperplanes;
those with equal signs in a table share a bucket. The number of bits follows the largest label
(buckets stay small as the data grows) and the number of tables follows the bits, so that a pair
at the threshold misses all tables with probability MISS at most. Pairs are verified by
exact cosine in double precision, and a pair is counted in the first table that holds it.

A bucket is dealt into chunks of about CHUNK vectors by a hash of the id, and each pair of
chunks is compared as one matrix product. What leaves a comparison is one count for each vector
and one link to the least vector of its group, never the pairs: a label that holds one large
group of near copies costs comparisons, spread over tasks, but no rows. Components come from
alternating star steps.

Defined results: vectors that are null, empty, all zero, or hold null or non-finite components, and rows with
null label or null ``vec_id``, link with nothing and keep their row; a row repeated in full
counts once; rows of one ``vec_id`` with other contents are one vertex and do not count as
each other's links; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import materialize

THRESHOLD = 0.98
MISS = 0.0005
PER_BUCKET = 8
CHUNK = 512
SEED = 20240615


def plan_tables(largest_label: int) -> tuple[int, int]:
    """``(bits, tables)`` for the number of vectors in the largest label."""
    bits = min(60, max(6, math.ceil(math.log2(max(1, largest_label / PER_BUCKET)))))
    agree = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


@cache
def _planes(length: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, length, bits]).standard_normal((length, tables * bits))


def _usable(vector) -> bool:
    return len(vector) > 0 and vector.null_count == 0 and np.isfinite(v := np.asarray(vector, np.float64)).all() and v.any()


def _signed(bits: int, tables: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("embedding")
            rows = [r for r in range(batch.num_rows) if vectors[r].is_valid and _usable(vectors[r].values)]
            by_length: dict[int, list[int]] = {}
            for r in rows:
                by_length.setdefault(len(vectors[r].values), []).append(r)
            for length, own in by_length.items():
                part = batch.take(pa.array(own))
                x = np.asarray(part.column("embedding").flatten(), np.float64).reshape(-1, length)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                signs = (x @ _planes(length, bits, tables) > 0).reshape(len(own), tables, bits)
                codes = (signs * weights).sum(axis=2)
                ends = np.arange(0, codes.size + 1, tables, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("vec_id", "label", "embedding")), pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel()))],
                    names=["vec_id", "label", "embedding", "codes"],
                )

    return signed


def _compare(ids, x, codes, chunk, table: int, same: bool) -> pa.RecordBatch:
    """Counts ``(vec_id, null, n)`` and links ``(vec_id, other, 0)`` within one pair of chunks."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of large or small entries leave the range of doubles
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    near = unit @ unit.T >= THRESHOLD
    near &= ids[:, None] != ids[None, :]
    if not same:
        near &= chunk[:, None] != chunk[None, :]
    for earlier in range(table):
        if not near.any():
            break
        near &= codes[:, earlier][:, None] != codes[:, earlier][None, :]
    counts = near.sum(axis=1)
    group = ids.copy()
    while len(ids):
        least = np.minimum(group, np.where(near, group[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == group).all():
            break
        group = least
    some, moved = counts > 0, group < ids
    zero = np.zeros(int(moved.sum()), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([ids[some], ids[moved]])),
            pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(group[moved])]),
            pa.array(np.concatenate([counts[some], zero])),
        ],
        names=["vec_id", "other", "n"],
    )


_KEY = ("label", "length", "table", "code", "one", "two")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and chunk pair; a group never exceeds two chunks."""
    held = None
    for batch in _with_end(batches):
        if batch is not None:
            held = batch if held is None else pa.concat_batches([held, batch])
        if held is None or held.num_rows == 0:
            continue
        keys = np.stack([np.asarray(held.column(c)).astype(np.int64) for c in _KEY])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts.tolist(), held.num_rows]
        done = bounds if batch is None else bounds[:-1]
        found = []
        for a, b in zip(done[:-1], done[1:], strict=True):
            if b - a > 1:
                part = held.slice(a, b - a)
                x = np.asarray(part.column("embedding").flatten(), np.float64).reshape(b - a, -1)
                codes = np.asarray(part.column("codes").flatten()).reshape(b - a, -1)
                _, _, table, _, one, two = keys[:, a].tolist()
                rows = _compare(np.asarray(part.column("vec_id")), x, codes, np.asarray(part.column("chunk")), table, one == two)
                if rows.num_rows:
                    found.append(rows)
        # Most buckets hold no near copies; one batch carries what the others found.
        if found:
            yield pa.concat_batches(found)
        held = held.slice(done[-1])


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_links(vectors: DataFrame) -> DataFrame:
    """``(vec_id, other, n)``: counts of links and, by group found, a link to its least vector."""
    usable = vectors.filter("vec_id is not null and label is not null and embedding is not null")
    largest = usable.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits, tables = plan_tables(largest)
    signed = usable.mapInArrow(_signed(bits, tables), "vec_id long, label long, embedding array<double>, codes array<long>")
    signed = materialize(signed, "signed")
    rows = signed.select("*", F.size("embedding").cast("long").alias("length"), F.posexplode("codes").alias("table", "code"))
    bucket = ["label", "length", "table", "code"]
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("held")).filter("held > 1")
    sizes = sizes.withColumn("chunks", F.ceil(F.col("held") / CHUNK))
    dealt = rows.join(sizes, bucket).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    pairs = pairs.withColumns({"one": F.least("chunk", "other"), "two": F.greatest("chunk", "other")})
    pairs = pairs.select("vec_id", "embedding", "codes", "chunk", *_KEY).repartition(*_KEY).sortWithinPartitions(*_KEY)
    return pairs.mapInArrow(_compared, "vec_id long, other long, n long")


def cluster(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each distinct row of ``(vec_id, embedding, label)``."""
    vectors = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("long")
    ).distinct()
    found = materialize(near_links(vectors), "near-links")
    counts = found.filter("other is null").groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    links = found.filter("other is not null").select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
    of = components(links).withColumnRenamed("vertex", "vec_id")
    rows = vectors.select("vec_id").join(counts, "vec_id", "left").join(of, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
