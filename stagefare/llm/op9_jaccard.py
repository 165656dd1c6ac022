"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct shingles of ``words`` words (split at space and tab to carriage
return, A-Z in lower case); a shorter text counts as one shingle. Documents link when
``100 * |A and B| >= percent * |A or B|``. Both are parameters, a ``Rule``: the query takes 3 words
and 90, the pipeline's stage 5 words and 80.

1. Sets of sizes ``a <= b`` that link have ``b <= a * 100 / percent`` and differ in at most
   ``(a + b) * (100 - percent) / (100 + percent)`` shingles. Sizes fall into bands of the first ratio, so
   partners are in the same or the next band, and a band bounds the difference of its pairs by a ``d``.
2. For a band a set is sketched as ``d + 1 + s`` words: every shingle is hashed to one
   bit and the bits are XORed. Each differing shingle changes at most one bit, so the
   Hamming distance of two sketches never exceeds the symmetric difference; by the
   pigeonhole principle linked sets agree in at least ``s + 1`` words, into which the same shingles fall.
   The words are the join keys. They are 2**64 bits wide, as 64 bits say little where few shingles fall into a word, and
   stand for themselves as the XOR of their bits' numbers, scrambled. A set leaves out those with fewer than ``t`` shingles, for the highest ``t`` that
   leaves out ``s`` at most: of the ``s + 1`` words that two linked sets share, the one with the most shingles is kept
   by both. So empty words are no keys where shingles are few for each word.
3. Texts with equal sets are one class, of which the least document goes through the join.
4. Members rank by how many members their buckets hold in all, so the text from which a group of near copies
   came ranks first. Every member of a bucket is verified against the bucket's first by rank,
   its hub, which joins most groups at one row per member.
   Short sketches of BRIEF words drop most pairs that cannot link before texts are fetched.
5. Buckets that still hold several components are gathered by hub, each member once, and dealt into chunks.
   First a task takes a pair of chunks of sketches that are as long as their sets ask for, folded to the shorter of two, and names the members
   that one of another component is near enough to; sketches are dealt again for each pair of chunks, which texts are too large for.
   Of the members named, dealt anew, a task takes a pair of chunks with texts and compares whole sketches: only pairs whose Hamming distance allows a
   link, and that nothing joins so far, are verified. What leaves a task is one link for each two components
   it joined, never the candidates, so a group of texts just below the threshold costs comparisons, spread
   over tasks, but no rows. Members of a bucket share a hub, so no pair is missed and components are exact.
6. Pairs are verified on their texts, exactly but for equal 64-bit hashes of shingles.

Defined results: null, empty and blank texts have no shingles and link with nothing; equal
texts always link otherwise; a row with null ``doc_id`` keeps its row, with its own
``n_shingles`` and a null component; rows repeating a ``doc_id`` are one vertex and each keep
their row; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagefare.functions.joins import BROADCAST_LIMIT_BYTES

from .components import components
from .tables import discard, materialize, texts
from .text import blocks, mix, words

# A chunk holds about so many texts, and shingles, of a group.
CHUNK = 256
CHUNK_SHINGLES = 1 << 17
# A chunk of sketches holds about so many members, and bytes, of a group.
SKETCHES = 512
SKETCH_BYTES = 4 << 20
# Words of the short sketch that a pair must pass before its texts are fetched.
BRIEF = 16
_SET = ("set_a", "set_b", "n_shingles")
_ODD = np.array([0x8CB92BA72F3D8DD7, 0xD1342543DE82EF95, 0xF1357AEA2E62A9C5], dtype=np.uint64)


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity of a link in percent."""

    words: int = 3
    percent: int = 90

    def __post_init__(self) -> None:
        if self.words < 1 or not 1 <= self.percent <= 100:
            raise ValueError(f"no rule for links: {self}")

    @property
    def apart(self) -> tuple[int, int]:
        """``(p, q)``: sets of sizes ``a`` and ``b`` that link have ``q * difference <= p * (a + b)``."""
        shared = math.gcd(100 - self.percent, 100 + self.percent)
        return (100 - self.percent) // shared, (100 + self.percent) // shared

    def spare(self, most: int) -> int:
        """Words beyond those that differing shingles can change; with more than 5 shingles a word none are needed."""
        p, q = self.apart
        return most // 9 + 1 if 2 * p * 5 >= q else 0

    def sizes_fit(self, one: str, two: str) -> str:
        """SQL: whether sets of two sizes can link."""
        return f"100 * least({one}, {two}) >= {self.percent} * greatest({one}, {two})"

    def linked(self, one: np.ndarray, two: np.ndarray) -> bool:
        shared = len(np.intersect1d(one, two, assume_unique=True))
        return shared > 0 and 100 * shared >= self.percent * (len(one) + len(two) - shared)


QUERY = Rule()


@cache
def _bands(up_to: int, percent: int) -> np.ndarray:
    """First sizes of the bands, until three are above ``up_to``."""
    first = [1]
    while len(first) < 3 or first[-3] <= up_to:
        first.append(max(first[-1] + 1, -(-first[-1] * 100 // percent)))
    return np.array(first)


def shingle_sets(column: pa.Array, length: int = QUERY.words) -> Iterator[np.ndarray]:
    """The sorted 64-bit shingle hashes of each text."""
    found = words(column, lower=True)
    name = mix(found.names())
    whole = np.zeros(0, np.uint64)
    if len(name) >= length:
        count = len(name) - length + 1
        whole = name[:count] * _ODD[0]
        for k in range(1, length):
            whole = mix(whole + mix(name[k : k + count] * _ODD[1] + _ODD[2]))
        whole = mix(whole)
    bounds = found.bounds.tolist()
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - start >= length:
            yield np.unique(whole[start : end - length + 1])
        elif end > start:
            salted = name[start:end] * mix(np.arange(1, end - start + 1, dtype=np.uint64)) + np.uint64(end - start)
            yield mix(np.array([np.add.reduce(mix(salted))], dtype=np.uint64))
        else:
            yield whole[:0]


def _word_of(shingles: np.ndarray, count: int) -> np.ndarray:
    """The word of a sketch that each shingle falls into."""
    return (((shingles >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def _sketch(shingles: np.ndarray, count: int) -> np.ndarray:
    """``count`` words of 64 bits, in which every shingle has flipped one bit."""
    at = _word_of(shingles, count) * 64 + (shingles & np.uint64(63)).astype(np.int64)
    parity = (np.bincount(at, minlength=count * 64) & 1).astype(np.uint8)
    return np.packbits(parity, bitorder="little").view(np.uint64)


def _sketch_keys(shingles: np.ndarray, rule: Rule) -> np.ndarray:
    """Join keys of a set: the words of its sketches for both bands it may have partners in."""
    n = len(shingles)
    bands = _bands(1 << max(4, n.bit_length()), rule.percent)
    p, q = rule.apart
    own = int(np.searchsorted(bands, n, side="right")) - 1
    keys = []
    for band in (own, own + 1):
        most = p * 2 * (int(bands[band + 1]) - 1) // q
        if most == 0 or (band > own and 100 * n < rule.percent * bands[band]):
            continue
        spare = rule.spare(most)
        count = most + 1 + spare
        place = np.arange(count, dtype=np.uint64) + np.uint64((band << 32) + 1)
        word = _word_of(shingles, count)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))  # shingles are sorted, so words are too
        bits = np.zeros(count, np.uint64)
        bits[word[starts]] = np.bitwise_xor.reduceat(mix(shingles), starts)
        key = mix(mix(place) + bits)
        held = np.bincount(word, minlength=count)
        keys.append(key[held >= np.sort(held)[spare]])
    return np.concatenate(keys) if keys else shingles[:0]


_SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, brief array<long>"


def _sketches(rule: Rule):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size, name and short sketch of every set."""
        longs = pa.list_(pa.int64())
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_shingles", "set_a", "set_b")] + [("brief", longs)])
        for batch in batches:
            for block in blocks(batch):
                sizes, first, second, brief = [], [], [], []
                for shingles in shingle_sets(block.column("text"), rule.words):
                    sizes.append(len(shingles))
                    first.append(int(np.add.reduce(shingles, dtype=np.uint64).view(np.int64)))
                    second.append(int(np.bitwise_xor.reduce(mix(shingles)).view(np.int64)))
                    brief.append(_sketch(shingles, BRIEF))
                ends = pa.array(np.arange(len(brief) + 1, dtype=np.int32) * BRIEF)
                names = [pa.array(x, pa.int64()) for x in (sizes, first, second)]
                short = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(brief).view(np.int64)))
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *names, short], schema=schema)

    return sketches


def _keyed(rule: Rule):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row ``(key, rep, size)`` for every join key of every set."""
        for batch in batches:
            for block in blocks(batch):
                reps = np.asarray(block.column("doc_id"))
                sets = list(shingle_sets(block.column("text"), rule.words))
                keys = [_sketch_keys(one, rule) if len(one) else one for one in sets]
                counts = np.array([len(k) for k in keys])
                yield pa.record_batch({
                    "key": pa.array(np.concatenate(keys).view(np.int64)),
                    "rep": pa.array(np.repeat(reps, counts)),
                    "size": pa.array(np.repeat(np.array([len(one) for one in sets], np.int32), counts)),
                })

    return keyed


def _verified(rule: Rule):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of pairs ``(a, b, text, other)`` those that link."""
        for batch in batches:
            for block in blocks(batch):
                sets = zip(*(shingle_sets(block.column(c), rule.words) for c in ("text", "other")), strict=True)
                links = [rule.linked(one, two) for one, two in sets]
                yield block.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return verified


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents named by a written table of ids, broadcast if that is measured to be small."""
    small = ids.count() * 64 <= BROADCAST_LIMIT_BYTES
    return docs.join(F.broadcast(ids) if small else ids.hint("merge"), "doc_id", "left_semi")


def _verify(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Links ``(a, b)`` among written pairs of document ids."""
    def held(end: str) -> DataFrame:
        ids = materialize(pairs.select(F.col(end).alias("doc_id")).distinct(), "named")
        return _only(docs, ids).select(F.col("doc_id").alias(end), "text")

    one, two = held("a"), held("b").withColumnRenamed("text", "other")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text", "other").mapInArrow(_verified(rule), "a long, b long")


def _joined(members: pa.RecordBatch, rule: Rule) -> list[tuple[int, int]]:
    """Links that join the components of one pair of chunks as far as its pairs link."""
    found = []
    p, q = rule.apart
    sets = [one for part in blocks(members) for one in shingle_sets(part.column("text"), rule.words)]
    size = np.array([len(one) for one in sets])
    sketches = np.stack([_sketch(one, p * 2 * int(size.max()) // q + 1) for one in sets])
    rep, chunk = np.asarray(members.column("rep")), np.asarray(members.column("chunk"))
    label = np.array(members.column("component"))
    within = members.column("one")[0].as_py() == members.column("two")[0].as_py()
    for i in range(len(sets) - 1):
        could = (label != label[i]) & (100 * np.minimum(size, size[i]) >= rule.percent * np.maximum(size, size[i]))
        if not within:
            could &= chunk != chunk[i]
        at = np.flatnonzero(could[i + 1 :]) + i + 1
        apart = np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        for j in at[q * apart <= p * (size[at] + size[i])].tolist():
            if label[j] != label[i] and rule.linked(sets[i], sets[j]):
                found.append((rep[i], rep[j]))
                label[label == label[j]] = label[i]
    return found


_PAIR = ("hub", "one", "two")


def _by_pair(found: Callable[[pa.RecordBatch], pa.RecordBatch]):
    def by_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What is found in each pair of chunks, of rows sorted by pair; a group never exceeds two chunks."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(c)) for c in _PAIR])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                key = keys[:, start].tolist()
                if held and key != last:
                    yield found(pa.concat_batches(held))
                    held = []
                last = key
                held.append(batch.slice(start, end - start))
        if held:
            yield found(pa.concat_batches(held))

    return by_pair


def _compared(rule: Rule):
    def compared(members: pa.RecordBatch) -> pa.RecordBatch:
        found = _joined(members, rule)
        return pa.record_batch({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return _by_pair(compared)


def _folding(shingles: np.ndarray, rule: Rule) -> np.ndarray:
    """A sketch of about 4 bits for each shingle that may differ; its words are a power of 2, so longer ones fold to shorter ones."""
    p, q = rule.apart
    return _sketch(shingles, max(BRIEF, 1 << (p * 2 * len(shingles) // (q * 16)).bit_length()))


def _folded(rule: Rule):
    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                sets = list(shingle_sets(block.column("text"), rule.words))
                made = pa.array([_folding(one, rule).tobytes() for one in sets], pa.binary())
                yield pa.record_batch({"rep": block.column("doc_id"), "shingles": pa.array([len(one) for one in sets], pa.int32()), "sketch": made})

    return folded


def _near(rule: Rule):
    p, q = rule.apart

    def near(members: pa.RecordBatch) -> pa.RecordBatch:
        """Members of a pair of chunks that may link with one of another component there."""
        size, label, chunk = (np.asarray(members.column(c)).astype(np.int64) for c in ("shingles", "component", "chunk"))
        within = members.column("one")[0].as_py() == members.column("two")[0].as_py()
        sketches = [np.frombuffer(one.as_buffer(), np.uint64) for one in members.column("sketch")]
        length = np.array([len(one) for one in sketches])
        met = np.zeros(len(size), bool)
        for count in np.unique(length).tolist():
            longer = np.flatnonzero(length >= count)
            words = np.stack([np.bitwise_xor.reduce(sketches[j].reshape(count, -1), axis=1) for j in longer])
            for row in np.flatnonzero(length[longer] == count).tolist():
                i = longer[row]
                could = (label[longer] != label[i]) & (100 * np.minimum(size[longer], size[i]) >= rule.percent * np.maximum(size[longer], size[i]))
                if not within:
                    could &= chunk[longer] != chunk[i]
                at = np.flatnonzero(could)
                apart = np.bitwise_count(words[at] ^ words[row]).sum(axis=1, dtype=np.int64)
                at = longer[at[q * apart <= p * (size[longer[at]] + size[i])]]
                met[at] = True
                met[i] |= len(at) > 0
        return members.select(["hub", "rep"]).filter(pa.array(met))

    return _by_pair(near)


def _in_pairs(groups: DataFrame, held: DataFrame, most: int, weight: str, most_weight: int) -> DataFrame:
    """Members with what is held of them, dealt by pairs of chunks of their groups."""
    chunks = groups.groupBy("hub").agg(
        F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum(weight) / most_weight)).alias("chunks")
    )
    dealt = groups.join(chunks, "hub").withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks")).join(held, "rep")
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    pairs = pairs.withColumns({"one": F.least("chunk", "other"), "two": F.greatest("chunk", "other")})
    pairs = pairs.select(*_PAIR, "chunk", *groups.columns[1:], *[c for c in held.columns if c not in groups.columns])
    return pairs.repartition(*_PAIR).sortWithinPartitions(*_PAIR)


def _links_between(docs: DataFrame, ranked: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """Links that join the components that buckets still hold side by side."""
    labelled = ranked.join(found.withColumnRenamed("vertex", "rep"), "rep", "left").select(
        "key", "rep", "size", "weight", F.coalesce("component", "rep").alias("component")
    )
    # A bucket of one component has nothing left to find.
    open_keys = (
        labelled.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min(F.struct(-F.col("weight"), "rep"))["rep"].alias("hub"),
        )
        .filter("low < high")
        .select("key", "hub")
    )
    groups = labelled.join(open_keys, "key").groupBy("hub", "rep").agg(F.max("size").alias("size"), F.min("component").alias("component"))
    groups = materialize(groups, "open")
    named = materialize(groups.select(F.col("rep").alias("doc_id")).distinct(), "named")
    folded = materialize(_only(docs, named).mapInArrow(_folded(rule), "rep long, shingles int, sketch binary"), "folded")
    bytes_of = folded.groupBy("rep").agg(F.sum(F.length("sketch")).alias("bytes"))
    sized = groups.join(bytes_of, "rep").select("hub", "rep", "component", "bytes")
    met = _in_pairs(sized, folded, SKETCHES, "bytes", SKETCH_BYTES).mapInArrow(_near(rule), "hub long, rep long").distinct()
    near = materialize(groups.join(materialize(met, "met"), ["hub", "rep"]).select("hub", "rep", "size", "component"), "near")
    discard(groups, folded)
    named = materialize(near.select(F.col("rep").alias("doc_id")).distinct(), "named")
    held = _only(docs, named).select(F.col("doc_id").alias("rep"), "text")
    pairs = _in_pairs(near, held, CHUNK, "size", CHUNK_SHINGLES)
    return pairs.mapInArrow(_compared(rule), "a long, b long")


def _likely(sketched: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Those of written pairs whose short sketches differ in no more bits than a link allows."""
    near = pairs
    for end in ("a", "b"):
        ids = materialize(pairs.select(F.col(end).alias("doc_id")).distinct(), "named")
        held = _only(sketched, ids).select(
            F.col("doc_id").alias(end), F.col("n_shingles").alias(f"size_{end}"), F.col("brief").alias(f"brief_{end}")
        )
        near = near.join(held, end)
    bits = "aggregate(zip_with(brief_a, brief_b, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)"
    p, q = rule.apart
    return near.filter(f"{q} * {bits} <= {p} * (size_a + size_b)").select("a", "b").distinct()


def links_of(docs: DataFrame, sketched: DataFrame, rule: Rule = QUERY) -> tuple[DataFrame, DataFrame]:
    """``(links, components)`` of all documents, given a written sketch table.

    The links span the components: a copy is linked with the representative of its class only.
    """
    named = sketched.filter("n_shingles > 0 and doc_id is not null").groupBy(*_SET)
    heads = materialize(named.agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "heads")
    # Keys are computed from the texts of heads and go straight to their buckets; they are written nowhere.
    keyed = _only(docs, heads).mapInArrow(_keyed(rule), "key long, rep long, size int")
    bucket = Window.partitionBy("key")
    held = {"held": F.count("*"), "low": F.min("rep"), "high": F.max("rep"), "least": F.min("size"), "most": F.max("size")}
    members = keyed.withColumns({n: c.over(bucket) for n, c in held.items()}).filter("held > 1 and low < high")
    members = materialize(members, "members")
    # Most buckets hold two; these are pairs at once.
    two = members.filter(f"held = 2 and rep = low and {rule.sizes_fit('least', 'most')}")
    two = two.select(F.col("high").alias("a"), F.col("low").alias("b"))
    # In the others everyone goes against the one that shares most, as it stands nearest to the middle of its group.
    weight = members.filter("held > 2").groupBy("rep").agg(F.sum("held").alias("weight"))
    ranked = members.filter("held > 2").select("key", "rep", "size").join(weight, "rep")
    ranked = materialize(ranked, "ranked")
    hub = ranked.groupBy("key").agg(F.min(F.struct(-F.col("weight"), "rep", "size")).alias("hub"))
    hub = hub.select("key", F.col("hub.rep").alias("b"), F.col("hub.size").alias("hub_size"))
    many = ranked.join(hub, "key").filter("rep <> b").filter(rule.sizes_fit("size", "hub_size")).withColumnRenamed("rep", "a")
    pairs = materialize(two.union(many.select("a", "b")).distinct(), "pairs")
    discard(members, heads)
    copies = (
        sketched.select("doc_id", *_SET)
        .join(named.agg(F.min("doc_id").alias("rep")), [*_SET])
        .filter("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    likely = materialize(_likely(sketched, pairs, rule), "likely")
    discard(pairs)
    links = materialize(_verify(docs, likely, rule).union(copies), "jaccard-links")
    discard(likely)
    found = components(links)
    every = materialize(links.union(_links_between(docs, ranked, found, rule)), "jaccard-links")
    discard(ranked, found, links)
    return every, components(every)


def cluster(docs: DataFrame, rule: Rule = QUERY) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``documents(doc_id, text)``."""
    docs = texts(docs)
    sketched = materialize(docs.mapInArrow(_sketches(rule), _SKETCH), "sketches")
    _, found = links_of(docs, sketched, rule)
    found = found.withColumnRenamed("vertex", "doc_id")
    return sketched.join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


_VERTEX = "__vertex"


def keep_one(docs: DataFrame, rule: Rule = QUERY) -> DataFrame:
    """The documents with all their columns, of each component one row: one with its least ``doc_id``.

    Of rows that repeat a ``doc_id`` the least by all columns counts. Rows without an id are named by a hash of their
    text beyond 2**62, so they take part and rows with an id stay before them; those without a word all stay.
    """
    word = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    hashed = F.xxhash64(F.col("text").cast("string")).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    held = docs.withColumn(_VERTEX, F.coalesce(F.col("doc_id").cast("long"), F.when(word, hashed)))
    ids = held.select(F.col(_VERTEX).alias("doc_id"), "text")
    gone = cluster(ids, rule).filter("doc_id <> component_id").select(F.col("doc_id").alias(_VERTEX)).distinct()
    gone = materialize(gone, "near-copies")
    again = held.filter(F.col(_VERTEX).isNotNull()).groupBy(_VERTEX).agg(F.count("*").alias("rows")).filter("rows > 1")
    again = materialize(again.select(_VERTEX).join(gone, _VERTEX, "left_anti"), "repeated")

    def named(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() * 64 <= BROADCAST_LIMIT_BYTES else ids.hint("merge")

    single = held.join(named(gone.union(again)), _VERTEX, "left_anti").select(*docs.columns)
    first = held.join(named(again), _VERTEX, "left_semi").groupBy(_VERTEX).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return single.union(first.select("row.*"))
