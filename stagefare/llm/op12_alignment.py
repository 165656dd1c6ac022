"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked pairs by external spill counting.

A text, with one space before it, is encoded by a byte-level vocabulary (A) and by a piece vocabulary
(B). Tokens are laid on the text's bytes; where tokens of both end together the text is cut into groups, and the two
tokens that end there are linked.

1. Tasks cut the documents they read into runs of bounded text. A run keeps its documents' figures, and its
   pair-document records (pair, document, links) go to radix partitions of the B id: one zstd run
   for each partition, sorted with the B id as the major key, in frames that can be read one at a time.
2. In a radix partition a k-way merge of the runs adds up each pair: a heap holds the next key of every run,
   frames are unpacked when their turn comes, and as B ids come in order, the highest count of one is known when the next
   begins. Runs are merged FAN at a time, level by level, so a task holds FAN frames and no partition grows with
   the corpus: what is merged is one entry for each distinct pair.
3. The merged counts stream back: each run's pairs of a partition are answered by count and by whether it is the
   highest of its B id. Answers meet the run's records, which gives each document its sums.

A hot token is one record in each document that has it and one entry in each run; records never gather by token.

Defined results: a null or empty text, or one whose tokens do not join to its bytes, has no tokens, zeros and an empty
digest, and counts nowhere; strings of special tokens are plain text; rows that repeat a ``doc_id``, or with a null one, each
keep their row and count; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runs import first_run, grouped, merge_rows, pack, pack_sorted, unpack, unpack_sorted
from .tables import materialize, ship_package, texts
from .text import blocks, mix, utf8
from .tokens import _signs, encoder

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
# Text of a run, at most, or one document.
RUN_BYTES = 8 << 20
# Radix partitions of the B ids.
PARTS = 32
# Bits of the A id in a pair.
SIDE = 32
# Keys of a frame.
FRAME = 1 << 14
# Text of a block that is encoded at a time.
BLOCK_BYTES = 1 << 20


# -- tokens on bytes ------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every token: token t has the bytes ``data[starts[t]:starts[t + 1]]``."""

    data: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Vocabulary:
        starts = np.append(0, np.cumsum([len(t) for t in tokens])).astype(np.int64)
        return Vocabulary(np.frombuffer(b"".join(tokens), np.uint8), starts)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.starts[ids + 1] - self.starts[ids]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths(ids)
        ends = np.cumsum(n)
        return self.data[np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def byte_tokens(path: str) -> Vocabulary:
    values = {sign: byte for byte, sign in _signs().items()}
    of = encoder(path).tokenizer.get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(of.values()) + 1)
    for token, number in of.items():
        plain = all(c in values for c in token)
        tokens[number] = bytes(values[c] for c in token) if plain else token.encode()
    return Vocabulary.of(tokens)


@cache
def pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, Vocabulary]:
    tool = sentencepiece.SentencePieceProcessor(model_file=path)

    def of(number: int) -> bytes:
        piece = tool.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if tool.is_byte(number) else piece.replace("▁", " ").encode()

    return tool, Vocabulary.of([of(k) for k in range(tool.piece_size())])


@cache
def _decimals(size: int) -> pa.Array:
    """Each id with a comma, a bar and a semicolon after it."""
    return pa.array([f"{k}{mark}" for k in range(size) for mark in ",|;"], pa.large_string())


@dataclass
class Aligned:
    """A block's documents: figures, and its links as (document, pair), a pair being ``B id * 2**32 + A id``."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    link_doc: np.ndarray
    link_pair: np.ndarray


def _fits(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which documents' tokens join to their bytes."""
    ends = np.append(0, np.cumsum(vocabulary.lengths(ids)))[bounds]
    right = np.diff(ends) == np.diff(rows)
    if right.all():
        same = vocabulary.joined(ids) == data
        return np.add.reduceat(~same, rows[:-1]) == 0 if len(data) else right
    for d in np.flatnonzero(right).tolist():
        right[d] = np.array_equal(vocabulary.joined(ids[bounds[d] : bounds[d + 1]]), data[rows[d] : rows[d + 1]])
    return right


def _kept(ids: np.ndarray, bounds: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of fitting documents only."""
    counts = np.diff(bounds)
    return ids[np.repeat(fits, counts)], np.append(0, np.cumsum(np.where(fits, counts, 0)))


def align(column: pa.Array, byte_path: str, piece_path: str) -> Aligned:
    """Tokens of both vocabularies on a column's texts, each with one space before it."""
    some = np.asarray(pc.fill_null(pc.greater(pc.binary_length(column), 0), False))
    asked = column.filter(pa.array(some))
    spaced = pc.binary_join_element_wise(pa.scalar(""), asked, pa.scalar(" "))
    data, rows = utf8(spaced)
    first, second = byte_tokens(byte_path), pieces(piece_path)
    ids_a, bounds_a = encoder(byte_path).encode(spaced)
    found = second[0].encode(asked.to_pylist(), num_threads=1)
    bounds_b = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int64)
    ids_b = np.fromiter((t for x in found for t in x), np.int64, bounds_b[-1])
    ids_a = ids_a.astype(np.int64)
    fits = _fits(first, ids_a, bounds_a, data, rows) & _fits(second[1], ids_b, bounds_b, data, rows)
    ids_a, bounds_a = _kept(ids_a, bounds_a, fits)
    ids_b, bounds_b = _kept(ids_b, bounds_b, fits)
    end_a, end_b = np.cumsum(first.lengths(ids_a)), np.cumsum(second[1].lengths(ids_b))
    # Documents are laid end to end, so ends are distinct and a shared end is of one document.
    cut_a, cut_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
    place = np.flatnonzero(cut_a)
    doc_of_link = np.searchsorted(bounds_a, place, side="right") - 1
    pair = (ids_b[cut_b] << SIDE) | ids_a[place]
    marked = _decimals(max(len(first.starts), len(second[1].starts)))
    digests = _digests(marked, ids_a, cut_a, bounds_a, ids_b, cut_b, bounds_b)
    numbers = np.flatnonzero(some)
    n = len(column)

    def spread(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[numbers] = values
        return out

    groups = np.bincount(doc_of_link, minlength=len(asked))
    texts_of = [""] * n
    for d, digest in zip(numbers.tolist(), digests, strict=True):
        texts_of[d] = digest
    return Aligned(spread(np.diff(bounds_a)), spread(np.diff(bounds_b)), spread(groups), texts_of, numbers[doc_of_link], pair.astype(np.uint64))


def _digests(marked: pa.Array, ids_a, cut_a, bounds_a, ids_b, cut_b, bounds_b) -> list[str]:
    """Of ``a1,a2|b1;a3|b2,b3`` for each document; empty without tokens."""
    group_a, group_b = (np.cumsum(c) - c for c in (cut_a, cut_b))
    mark_a = np.where(cut_a, 1, 0)
    mark_b = np.where(cut_b, 2, 0)
    entry = np.concatenate([ids_a * 3 + mark_a, ids_b * 3 + mark_b])
    order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
    listed = marked.take(pa.array(entry[order]))
    offsets = np.frombuffer(listed.buffers()[1], np.int64)[: len(listed) + 1]
    raw = memoryview(listed.buffers()[2]) if len(listed) else b""
    # Groups do not cross documents, so a document's entries lie together.
    bounds = (bounds_a + bounds_b).tolist()
    return [
        hashlib.sha256(raw[offsets[x] : offsets[y] - 1]).hexdigest() if y > x else "" for x, y in zip(bounds[:-1], bounds[1:], strict=True)
    ]


# -- runs -----------------------------------------------------------------------------

_FRAMES = pa.list_(pa.binary())
_RUN = (
    "run long, part int, keys array<binary>, firsts array<long>, counts array<binary>, best array<binary>,"
    " records array<binary>, docs binary"
)
_RUN_ARROW = pa.schema(
    [("run", pa.int64()), ("part", pa.int32()), ("keys", _FRAMES), ("firsts", pa.list_(pa.int64())), ("counts", _FRAMES), ("best", _FRAMES)]
    + [("records", _FRAMES), ("docs", pa.binary())]
)
_LIST = "part int, run long, keys array<binary>, firsts array<long>, counts array<binary>, best array<binary>"
_LIST_ARROW = pa.schema(
    [("part", pa.int32()), ("run", pa.int64()), ("keys", _FRAMES), ("firsts", pa.list_(pa.int64())), ("counts", _FRAMES), ("best", _FRAMES)]
)


def _one(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], schema)


def part_of(pairs: np.ndarray, parts: int) -> np.ndarray:
    """The radix partition of each pair, by its B id."""
    return (mix((pairs >> np.uint64(SIDE)) + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def frames(pairs: np.ndarray, counts: np.ndarray) -> dict:
    """Sorted pairs and their counts in frames; ``firsts`` holds each frame's first pair."""
    at = range(0, len(pairs), FRAME)
    return {
        "keys": [pack_sorted(pairs[k : k + FRAME]) for k in at],
        "firsts": [int(pairs[k]) for k in at],
        "counts": [pack(counts[k : k + FRAME].astype(np.int64)) for k in at],
    }


class _Run:
    def __init__(self) -> None:
        self.bytes, self.docs = 0, 0
        self.tables: list[pa.Table] = []
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, block: pa.RecordBatch, byte_path: str, piece_path: str) -> None:
        found = align(block.column("text"), byte_path, piece_path)
        figures = {"doc_id": block.column("doc_id"), "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups}
        self.tables.append(pa.table(figures | {"groups_sha256": pa.array(found.digests, pa.string())}))
        self.links.append((found.link_doc + self.docs, found.link_pair))
        self.docs += block.num_rows
        self.bytes += block.column("text").nbytes

    def rows(self, run: int, parts: int) -> Iterator[pa.RecordBatch]:
        doc = np.concatenate([d for d, _ in self.links]).astype(np.uint64)
        pair = np.concatenate([p for _, p in self.links])
        # Side-major records: by B id, A id, then document.
        named, number = np.unique(pair, return_inverse=True)
        record, links = np.unique((number.astype(np.uint64) << np.uint64(32)) | doc, return_counts=True)
        own = (record >> np.uint64(32)).astype(np.int64)
        totals = np.bincount(own, weights=links, minlength=len(named)).astype(np.int64)
        radix = part_of(named, parts)
        blank = {"run": run, "docs": b"", "records": [], "best": []}
        for p in np.unique(radix).tolist():
            at = np.flatnonzero(radix == p)
            renamed = np.zeros(len(named), np.uint64)
            renamed[at] = np.arange(len(at))
            of = radix[own] == p
            keys = (renamed[own[of]] << np.uint64(32)) | (record[of] & np.uint64(0xFFFFFFFF))
            packed = [pack_sorted(keys), pack(links[of].astype(np.int32))]
            yield _one(blank | {"part": p, "records": packed} | frames(named[at], totals[at]), _RUN_ARROW)
        sink = pa.BufferOutputStream()
        table = pa.concat_tables(self.tables)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        yield _one(blank | {"part": parts, "keys": [], "firsts": [], "counts": [], "docs": sink.getvalue().to_pybytes()}, _RUN_ARROW)


def _gathered(byte_path: str, piece_path: str, parts: int, run_bytes: int):
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = first_run(), _Run()
        for batch in batches:
            for block in blocks(batch, most=BLOCK_BYTES):
                held.add(block, byte_path, piece_path)
                if held.bytes >= run_bytes:
                    yield from held.rows(number, parts)
                    number, held = number + 1, _Run()
        if held.docs:
            yield from held.rows(number, parts)

    return gathered


# -- the merge ------------------------------------------------------------------------


def merged_pairs(rows: list[dict]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A k-way merge of runs: ``(pairs, counts)`` in order, each pair once and each B id within one piece.

    The heap holds the first key of every run's next frame. A popped frame joins those that are open; whatever
    lies before the B id of the heap's least key is complete, as no frame to come holds it.
    """
    heap = [(row["firsts"][0], k, 0) for k, row in enumerate(rows) if row["firsts"]]
    heapq.heapify(heap)
    pairs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        _, k, place = heapq.heappop(heap)
        row = rows[k]
        waiting.append((unpack_sorted(row["keys"][place]), unpack(row["counts"][place], np.int64)))
        if place + 1 < len(row["firsts"]):
            heapq.heappush(heap, (row["firsts"][place + 1], k, place + 1))
        limit = heap[0][0] >> SIDE if heap else None
        if limit is not None and sum(len(p) for p, _ in waiting) < 4 * FRAME:
            continue
        keys = np.concatenate([pairs, *(p for p, _ in waiting)])
        held = np.concatenate([counts, *(c for _, c in waiting)])
        waiting = []
        order = np.argsort(keys, kind="stable")
        keys, held = keys[order], held[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        pairs, counts = keys[starts], np.add.reduceat(held, starts)
        done = len(pairs) if limit is None else int(np.searchsorted(pairs, np.uint64(limit << SIDE)))
        if done:
            yield pairs[:done], counts[:done]
        pairs, counts = pairs[done:], counts[done:]


def highest(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which pairs have the highest count of their B id; every B id lies in one piece."""
    side = pairs >> np.uint64(SIDE)
    starts = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    most = np.maximum.reduceat(counts, starts)
    return counts == np.repeat(most, np.diff(np.append(starts, len(side))))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run of each group's; ``best`` holds for each frame which pairs are the highest of what is merged so far."""
    for rows in grouped(batches, "part", "slot"):
        out: dict = {"keys": [], "firsts": [], "counts": [], "best": []}
        for pairs, counts in merged_pairs(rows):
            top = highest(pairs, counts)
            for name, values in frames(pairs, counts).items():
                out[name] += values
            out["best"] += [pack(top[k : k + FRAME]) for k in range(0, len(top), FRAME)]
        yield _one(out | {"part": rows[0]["part"], "run": min(r["run"] for r in rows)}, _LIST_ARROW)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by part, the merged one first: counts of each run's pairs, and whether they are the highest of their B id."""
    part = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                part = row["part"]
                pairs = np.concatenate([unpack_sorted(f) for f in row["keys"]])
                counts = np.concatenate([unpack(f, np.int64) for f in row["counts"]])
                best = np.concatenate([unpack(f, np.bool_) for f in row["best"]])
                continue
            at = np.searchsorted(pairs, np.concatenate([unpack_sorted(f) for f in row["keys"]]))
            found = {"counts": [pack(counts[at])], "best": [pack(best[at])], "keys": [], "firsts": []}
            yield _one(found | {"run": row["run"], "part": part, "records": [], "docs": b""}, _RUN_ARROW)


_OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run: records meet the answers of their partition, documents get their sums."""
    for rows in grouped(batches, "run"):
        docs = pa.ipc.open_stream(rows[-1]["docs"]).read_all()
        best, total = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        answers = {r["part"]: r for r in rows if r["counts"]}
        for row in rows:
            if not row["records"]:
                continue
            record, links = unpack_sorted(row["records"][0]), unpack(row["records"][1], np.int32).astype(np.int64)
            answer = answers[row["part"]]
            own = (record >> np.uint64(32)).astype(np.int64)
            doc = (record & np.uint64(0xFFFFFFFF)).astype(np.int64)
            np.add.at(total, doc, links * unpack(answer["counts"][0], np.int64)[own])
            np.add.at(best, doc, links * unpack(answer["best"][0], np.bool_)[own])
        groups = docs.column("n_groups")
        columns = [docs.column("doc_id"), docs.column("n_a"), docs.column("n_b"), groups, groups, pa.array(best), pa.array(total)]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        yield from pa.table([*columns, docs.column("groups_sha256")], names=names).combine_chunks().to_batches()


@dataclass(frozen=True)
class Plan:
    """Vocabulary files, radix partitions and text of a run."""

    bytes: str = BYTE_VOCABULARY
    pieces: str = PIECE_VOCABULARY
    parts: int = PARTS
    run_bytes: int = RUN_BYTES


def count_links(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row for every row of ``documents(doc_id, text)``."""
    ship_package(docs.sparkSession)
    rows = texts(docs).mapInArrow(_gathered(plan.bytes, plan.pieces, plan.parts, plan.run_bytes), _RUN)
    rows = materialize(rows, "alignment-runs")
    ends, records = rows.filter(F.col("part") == plan.parts), rows.filter(F.col("part") < plan.parts)
    lists = records.select("part", "run", "keys", "firsts", "counts", "best")
    merged = materialize(merge_rows(lists, "part", "run", _merged, _LIST, ends.count()), "alignment-merged")
    asked = merged.withColumn("run", F.lit(-1).cast("long")).unionByName(lists)
    answers = asked.repartition(F.col("part")).sortWithinPartitions("part", "run").mapInArrow(_answered, _RUN)
    none = {"keys": "array<binary>", "firsts": "array<long>", "counts": "array<binary>"}
    bare = records.withColumns({name: F.array().cast(kind) for name, kind in none.items()})
    met = answers.unionByName(bare).unionByName(ends).repartition(F.col("run")).sortWithinPartitions("run", "part")
    return met.mapInArrow(_summed, _OUT)
