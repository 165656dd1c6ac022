"""Language-model scores by context-tree weighting over bytes.

A text is its words (runs of characters other than space and tab to carriage return, A-Z in lower case)
joined by one space, and an end sign. Every byte is predicted from the ``ORDER`` bytes before it, bit by bit:
the context tree of depth ORDER holds, at each context and each of the 255 places in the binary
decomposition of a byte, how often a 0 and a 1 followed in the training texts. A node's
own estimate is Krichevsky and Trofimov's, ``(n1 + 1/2) / (n0 + n1 + 1)``; its weighted probability is the mean of
that of its own sequence and of the product over its longer contexts, and the
prediction mixes the estimates of all depths along the path with the weights that follow. A context that
training never met predicts 1/2 and is mixed by the same rule. Start and end are signs that
no UTF-8 text holds, so the probabilities of all texts sum to at most 1. Scores are frozen: scoring adds no counts.

How Spark runs it. The log probability of a byte depends on ORDER + 1 bytes only, a gram. Tasks cut the documents they
read into runs of bounded text and write, for each run, its packed text and its distinct grams and words
with their counts in training texts, dealt to ``PARTS`` key partitions by the last two bytes of the
context (grams) or by hash (words). Key partitions merge the counts of all runs, compute the weighted probabilities of
their subtrees, and add up what goes to depths 0 and 1, which hold at most 257 contexts (65,535 nodes): the only
thing broadcast. Then each run's grams are answered and meet the run's text again. What is gathered grows with the corpus;
a hot text, word or gram is one entry in each run, and no task holds more than a run, or FAN runs' lists of a partition.

Defined results: null, empty and blank texts are the end sign alone; training texts are chosen by ``doc_id``, a row with
a null ``doc_id`` is held out; rows that repeat a ``doc_id`` or a text are scored, and learned from, each; without training texts
every bit has probability 1/2 and every token log10(1); no rows give no rows; other columns are ignored.
Log probabilities of grams travel as 32-bit floats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runs import distinct, first_run, grouped, merge_rows, merged, pack, pack_sorted, summed, unpack, unpack_sorted
from .sampling import fold
from .tables import materialize, ship_package, texts
from .text import blocks, mix

# Bytes of context; with the byte itself a gram has 7 bytes at most, which leaves one to tell texts apart while sorting.
ORDER = 6
# Text of a run, at most, or one document.
RUN_BYTES = 16 << 20
# Key partitions.
PARTS = 64
# Positions of a text looked at in one go.
SLICE = 1 << 20

START, END, SPACE = 0xFE, 0xFF, 0x20
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U8 = np.uint64(8)


# -- texts as streams of bytes ------------------------------------------------------


def stream_of(column: pa.Array, order: int = ORDER) -> np.ndarray:
    """All texts of a column, each as ``order`` start signs, its words joined by one space, and an end sign."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    start, end = bytes([START]) * order, bytes([END])
    data = np.frombuffer(start + (end + start).join(column.to_pylist()) + end, np.uint8) if len(column) else np.zeros(0, np.uint8)
    data = _LOWER[data]
    inside = ~_BREAK[data]
    word = inside & (data < START)
    # A space stays where the first of its run follows a word and a word follows the run.
    kept = inside.copy()
    kept[1:] |= ~inside[1:] & word[:-1]
    data = np.where(inside, data, np.uint8(SPACE))[kept]
    trailing = np.zeros(len(data), bool)
    trailing[:-1] = (data[:-1] == SPACE) & (data[1:] == END)
    return data[~trailing]


def grams_of(stream: np.ndarray, first: int, last: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, grams)`` of the predicted bytes of a stretch. A gram holds the context, nearest byte first, then the byte."""
    predicted = stream[first:last] != START
    start = max(0, first - order)
    part = stream[start:last]

    def earlier(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        out[by:] = x[:-by]
        return out

    # A context of n bytes is one of half the length, followed by the one that stands as many bytes before.
    one = earlier(part.astype(np.uint64), 1)
    known, length = {1: one}, 1
    while length * 2 <= order:
        known[length * 2] = (known[length] << np.uint64(8 * length)) | earlier(known[length], length)
        length *= 2
    code = known[length]
    while length < order:
        more = max(k for k in known if k <= order - length)
        code = (code << np.uint64(8 * more)) | earlier(known[more], length)
        length += more
    return np.flatnonzero(predicted) + first, ((code << _U8) | part)[first - start :][predicted]


@dataclass
class StreamWords:
    codes: np.ndarray
    vocabulary: pa.Array
    bounds: np.ndarray  # document d has the words bounds[d] to bounds[d + 1]


def words_of(stream: np.ndarray) -> StreamWords:
    inside = (stream != SPACE) & (stream < START)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = np.flatnonzero(starts)
    letters = np.cumsum(inside, dtype=np.int64)
    offsets = np.empty(len(first) + 1, np.int64)
    offsets[:-1] = letters[first] - 1
    offsets[-1] = letters[-1] if len(stream) else 0
    packed = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(stream[inside])])
    named = packed.dictionary_encode()
    bounds = np.append(0, np.searchsorted(first, np.flatnonzero(stream == END)))
    return StreamWords(np.asarray(named.indices), named.dictionary, bounds)


def document_ends(stream: np.ndarray) -> np.ndarray:
    return np.flatnonzero(stream == END)


# -- the tree -----------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 1/2, by Stirling's series beyond 9."""
    shift = np.ones_like(x)
    y = x.copy()
    for _ in range(9):
        low = y < 9
        shift = np.where(low, shift * y, shift)
        y = np.where(low, y + 1, y)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of any sequence with so many zeros and ones by Krichevsky and Trofimov's estimator."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - math.log(math.pi) - _log_gamma(zeros + ones + 1.0)


@dataclass
class Nodes:
    """Nodes of one depth and one bit: sorted keys (context, place), counts, and what the tree makes of them."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # log of the weighted probability
    own: np.ndarray  # weight of the node's own estimate against its longer contexts

    def ahead(self) -> np.ndarray:
        """The node's own estimate that a one follows."""
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)


def weigh(own: np.ndarray, longer: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``(weighted, weight)`` of nodes with log estimates ``own`` and products of longer contexts ``longer``."""
    if longer is None:
        return own, np.ones_like(own)
    with np.errstate(over="ignore"):
        return np.logaddexp(own, longer) - math.log(2), 1 / (1 + np.exp(longer - own))


def bit_counts(keys: np.ndarray, counts: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(nodes, zeros, ones)`` of one bit; ``keys`` are sorted (context, byte) pairs."""
    byte = keys & np.uint64(255)
    place = np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))
    node = (keys & ~np.uint64(255)) | place
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
    one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64) * counts
    if not len(node):
        return node, one, one
    ones, total = np.add.reduceat(one, starts), np.add.reduceat(counts, starts)
    return node[starts], total - ones, ones


def parents(nodes: np.ndarray) -> np.ndarray:
    """The nodes of the next shorter context."""
    return ((nodes >> np.uint64(16)) << _U8) | (nodes & np.uint64(255))


def subtree(grams: np.ndarray, counts: np.ndarray, order: int, top: int) -> list[list[Nodes]]:
    """Nodes by depth (``order`` first, down to ``top``) and bit, of sorted grams with positive counts."""
    levels: list[list[Nodes]] = []
    for depth in range(order, top - 1, -1):
        at = ((grams >> np.uint64(8 * (order - depth + 1))) << _U8) | (grams & np.uint64(255))
        keys, held = summed(at, counts)
        level = []
        for bit in range(8):
            nodes, zeros, ones = bit_counts(keys, held, bit)
            longer = None
            if levels:
                below = levels[-1][bit]
                place = np.searchsorted(nodes, parents(below.keys))
                longer = np.bincount(place, weights=below.weighted, minlength=len(nodes))
            weighted, own = weigh(log_kt(zeros, ones), longer)
            level.append(Nodes(nodes, zeros, ones, weighted, own))
        levels.append(level)
    return levels


@dataclass
class Top:
    """Depths 0 and 1 as arrays by node key: own estimates and their weights."""

    ahead: list[np.ndarray]
    own: list[np.ndarray]


def top_of(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray) -> Top:
    """From all nodes of depth 1 and the products of their longer contexts."""
    ahead, own = [], []
    weighted = np.zeros(0)
    for size, shift in ((1 << 16, 0), (1 << 8, 1)):
        at = nodes & np.int64(255) if shift else nodes
        n0, n1 = (np.bincount(at, weights=w, minlength=size) for w in (zeros, ones))
        below = np.bincount(at, weights=weighted[nodes] if shift else longer, minlength=size)
        met = n0 + n1 > 0
        weighted, weight = weigh(log_kt(n0, n1), below)
        ahead.append(np.where(met, (n1 + 0.5) / (n0 + n1 + 1.0), 0.5))
        own.append(np.where(met, weight, 0.0))
        weighted = np.where(met, weighted, 0.0)
    return Top(ahead, own)


def log10_of(grams: np.ndarray, levels: list[list[Nodes]], top: Top, order: int) -> np.ndarray:
    """Log10 probability of the last byte of each gram given its context."""
    found = np.zeros(len(grams))
    byte = grams & np.uint64(255)
    for bit in range(8):
        place = np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))
        p = np.full(len(grams), 0.5)
        for k, level in enumerate(levels):
            nodes = level[bit]
            if not len(nodes.keys):
                continue
            wanted = ((grams >> np.uint64(8 * (k + 1))) << _U8) | place
            at = np.minimum(np.searchsorted(nodes.keys, wanted), len(nodes.keys) - 1)
            met = nodes.keys[at] == wanted
            mixed = nodes.own[at] * nodes.ahead()[at] + (1 - nodes.own[at]) * p
            p = np.where(met, mixed, p)
        nearest = (((grams >> np.uint64(8 * order)) << _U8) | place).astype(np.int64)
        for at, ahead, own in zip((nearest, place.astype(np.int64)), top.ahead, top.own, strict=True):
            # A node never met has weight 0 and an unmet longer context predicts 1/2, so p stays 1/2.
            p = own[at] * ahead[at] + (1 - own[at]) * p
        one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        found += np.log10(np.where(one, p, 1 - p))
    return found


# -- Spark steps --------------------------------------------------------------------

_RUN = (
    "run long, part int, grams binary, counts binary, words binary, word_counts binary,"
    " ids binary, stream binary, train_docs long, train_tokens long"
)
_RUN_ARROW = pa.schema(
    [("run", pa.int64()), ("part", pa.int32())]
    + [(n, pa.binary()) for n in ("grams", "counts", "words", "word_counts", "ids", "stream")]
    + [("train_docs", pa.int64()), ("train_tokens", pa.int64())]
)
_EMPTY = {n: b"" for n in ("grams", "counts", "words", "word_counts", "ids", "stream")}


def _pack_words(found: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(found), 3)


def _unpack_words(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    return raw.split(b"\n") if raw else []


def _rows(block: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(block, schema)


@dataclass
class _Run:
    """What a run has gathered so far."""

    order: int
    parts: int

    def __post_init__(self) -> None:
        self.bytes, self.streams, self.tables = 0, [], []
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: dict[bytes, int] = {}
        self.docs = self.tokens = 0

    def add(self, block: pa.RecordBatch) -> None:
        stream = stream_of(block.column("text"), self.order)
        learned = ~np.asarray(block.column("held_out"))
        ends = document_ends(stream)
        self.bytes += len(stream)
        for first in range(0, len(stream), SLICE):
            last = min(len(stream), first + SLICE)
            at, grams = grams_of(stream, first, last, self.order)
            marked = np.sort((grams << _U8) | learned[np.searchsorted(ends, at)])
            starts = distinct(marked >> _U8)
            self.waiting.append((marked[starts] >> _U8, np.add.reduceat(marked & np.uint64(1), starts).astype(np.int64)))
        if sum(len(k) for k, _ in self.waiting) > 2 * SLICE:
            self._fold()
        found = words_of(stream)
        of_word = np.repeat(learned, np.diff(found.bounds))
        counted = np.bincount(found.codes, weights=of_word, minlength=len(found.vocabulary)).astype(np.int64)
        for word, n in zip(found.vocabulary.to_pylist(), counted.tolist(), strict=True):
            self.words[word] = self.words.get(word, 0) + n
        self.docs += int(learned.sum())
        self.tokens += int(of_word.sum()) + int(learned.sum())
        self.tables.append(block.select(["doc_id", "held_out"]))
        self.streams.append(zstandard.compress(stream.tobytes(), 3))

    def _fold(self) -> tuple[np.ndarray, np.ndarray]:
        self.waiting = [merged(self.waiting)]
        return self.waiting[0]

    def rows(self, run: int) -> Iterator[pa.RecordBatch]:
        grams, counts = self._fold()
        names = list(self.words)
        dealt = np.array([hash_of(w) % self.parts for w in names], np.int64)
        by_gram, grams_end = by_part(part_of(grams, self.order, self.parts), self.parts)
        by_word, words_end = by_part(dealt, self.parts)
        out = []
        for p in range(self.parts):
            own = by_gram[grams_end[p] : grams_end[p + 1]]
            named = by_word[words_end[p] : words_end[p + 1]].tolist()
            if len(own) or named:
                out.append(
                    {"run": run, "part": p, "ids": b"", "stream": b"", "train_docs": 0, "train_tokens": 0}
                    | {"grams": pack_sorted(grams[own]), "counts": pack(counts[own])}
                    | {"words": _pack_words([names[k] for k in named])}
                    | {"word_counts": pack(np.array([self.words[names[k]] for k in named], np.int64))}
                )
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(self.tables)
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        last = _EMPTY | {"run": run, "part": self.parts, "ids": sink.getvalue().to_pybytes(), "stream": _joined(self.streams)}
        out.append(last | {"train_docs": self.docs, "train_tokens": self.tokens})
        for row in out:
            yield _rows([row], _RUN_ARROW)


def _joined(pieces: list[bytes]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("piece", pa.binary())])) as writer:
        writer.write_batch(pa.record_batch({"piece": pa.array(pieces, pa.binary())}))
    return sink.getvalue().to_pybytes()


def hash_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries in order of their key partition, and where each partition's begin."""
    order = np.argsort(part.astype(np.uint16), kind="stable")
    return order, np.append(0, np.cumsum(np.bincount(part, minlength=parts)))


def part_of(grams: np.ndarray, order: int, parts: int) -> np.ndarray:
    """The key partition of each gram, by the two bytes next to the predicted one."""
    near = grams >> np.uint64(8 * (order - 1))
    return (mix(near + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def _gathered(order: int, parts: int, run_bytes: int):
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = first_run(), _Run(order, parts)
        for batch in batches:
            for block in blocks(batch):
                held.add(block)
                if held.bytes >= run_bytes:
                    yield from held.rows(number)
                    number, held = number + 1, _Run(order, parts)
        if held.tables:
            yield from held.rows(number)

    return gathered


_LIST = "part int, run long, grams binary, counts binary, words binary, word_counts binary"
_LIST_ARROW = pa.schema(
    [("part", pa.int32()), ("run", pa.int64())] + [(n, pa.binary()) for n in ("grams", "counts", "words", "word_counts")]
)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One list of each group's, with summed counts; what nobody learned from stays with count 0."""
    for rows in grouped(batches, "part", "slot"):
        grams, counts = merged([(unpack_sorted(r["grams"]), unpack(r["counts"], np.int64)) for r in rows])
        words: dict[bytes, int] = {}
        for r in rows:
            for word, n in zip(_unpack_words(r["words"]), unpack(r["word_counts"], np.int64).tolist(), strict=True):
                words[word] = words.get(word, 0) + n
        row = {"part": rows[0]["part"], "run": min(r["run"] for r in rows), "grams": pack_sorted(grams), "counts": pack(counts)}
        yield _rows([row | {"words": _pack_words(list(words)), "word_counts": pack(np.array(list(words.values()), np.int64))}], _LIST_ARROW)


def _learned(row: dict, order: int) -> list[list[Nodes]]:
    grams, counts = unpack_sorted(row["grams"]), unpack(row["counts"], np.int64)
    met = counts > 0
    return subtree(grams[met], counts[met].astype(np.float64), order, 2)


_UP = "node int, zeros double, ones double, longer double, known long"


def _upward(order: int):
    def upward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the subtrees of a key partition add to the nodes of depth 1; ``known`` is its number of learned words."""
        for rows in grouped(batches, "part"):
            known = int((unpack(rows[0]["word_counts"], np.int64) > 0).sum())
            out = [(-1, 0.0, 0.0, 0.0, known)]
            for below in _learned(rows[0], order)[-1]:
                node = parents(below.keys).astype(np.int64)
                sums = [np.bincount(node, weights=w, minlength=1 << 16) for w in (below.zeros, below.ones, below.weighted)]
                some = np.flatnonzero(sums[0] + sums[1] > 0)
                out += [(int(n), *(float(s[n]) for s in sums), 0) for n in some]
            names, kinds = ("node", "zeros", "ones", "longer", "known"), (pa.int32(), *[pa.float64()] * 3, pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return upward


_ANSWER = "run long, part int, grams binary, logs binary, words binary, word_counts binary, ids binary, stream binary"
_ANSWER_ARROW = pa.schema(
    [("run", pa.int64()), ("part", pa.int32())] + [(n, pa.binary()) for n in ("grams", "logs", "words", "word_counts", "ids", "stream")]
)


def _answered(order: int, top):
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by part, the merged one first: each run's grams with log probabilities, its words with counts."""
        part = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part = row["part"]
                    grams = unpack_sorted(row["grams"])
                    logs = log10_of(grams, _learned(row, order), top.value, order).astype(np.float32)
                    words = dict(zip(_unpack_words(row["words"]), unpack(row["word_counts"], np.int64).tolist(), strict=True))
                    continue
                own = logs[np.searchsorted(grams, unpack_sorted(row["grams"]))]
                counts = np.array([words[w] for w in _unpack_words(row["words"])], np.int64)
                found = {"run": row["run"], "part": part, "grams": row["grams"], "logs": pack(own), "words": row["words"]}
                yield _rows([found | {"word_counts": pack(counts), "ids": b"", "stream": b""}], _ANSWER_ARROW)

    return answered


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
_SCORED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_())]
    + [(n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")]
    + [(n, pa.float64()) for n in ("base_score", "score", "bits_per_byte")]
)


def _scored(order: int, train_docs: int, train_tokens: int, vocabulary: int):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "run"):
            yield from _score_run(rows, order, train_docs, train_tokens, vocabulary)

    return scored


def _score_run(rows: list[dict], order: int, train_docs: int, train_tokens: int, vocabulary: int) -> Iterator[pa.RecordBatch]:
    *lists, text = rows
    grams = np.concatenate([unpack_sorted(r["grams"]) for r in lists])
    logs = np.concatenate([unpack(r["logs"], np.float32) for r in lists])
    place = np.argsort(grams, kind="stable")
    grams, logs = grams[place], logs[place].astype(np.float64)
    counts: dict[bytes, int] = {}
    for r in lists:
        counts |= zip(_unpack_words(r["words"]), unpack(r["word_counts"], np.int64).tolist(), strict=True)
    ids = pa.ipc.open_stream(text["ids"]).read_all().combine_chunks()
    streams = pa.ipc.open_stream(text["stream"]).read_all().column("piece").to_pylist()
    floor = math.log10(train_tokens + vocabulary + 1)
    done = 0
    for piece in streams:
        stream = np.frombuffer(zstandard.decompress(piece), np.uint8)
        ends = document_ends(stream)
        score = np.zeros(len(ends))
        for some in range(0, len(ends), 256):
            last = min(some + 256, len(ends))
            bounds = (0 if some == 0 else int(ends[some - 1]) + 1, int(ends[last - 1]) + 1)
            for first in range(*bounds, SLICE):
                at, wanted = grams_of(stream, first, min(bounds[1], first + SLICE), order)
                marked = np.sort((wanted << _U8) | np.searchsorted(ends[some:last], at).astype(np.uint64))
                named = marked >> _U8
                starts = distinct(named)
                of = np.repeat(logs[np.searchsorted(grams, named[starts])], np.diff(np.append(starts, len(named))))
                score[some:last] += np.bincount((marked & np.uint64(255)).astype(np.int64), weights=of, minlength=last - some)
        found = words_of(stream)
        c = np.array([counts[w] for w in found.vocabulary.to_pylist()], np.int64)[found.codes]
        doc = np.repeat(np.arange(len(ends)), np.diff(found.bounds))
        n = np.diff(found.bounds) + 1
        known = np.bincount(doc, weights=c > 0, minlength=len(ends)).astype(np.int64) + (train_docs > 0)
        base = np.bincount(doc, weights=np.log10(c + 1.0), minlength=len(ends)) + math.log10(train_docs + 1) - n * floor
        length = np.diff(np.append(-1, ends)) - order
        own = ids.slice(done, len(ends))
        done += len(ends)
        columns = [own.column("doc_id").combine_chunks(), own.column("held_out").combine_chunks(), n, known, np.full(len(ends), train_tokens)]
        columns += [base, score, -score / length * math.log2(10)]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=_SCORED_ARROW)


@dataclass(frozen=True)
class Plan:
    """Bytes of context (2 to 6), key partitions, and text of a run."""

    order: int = ORDER
    parts: int = PARTS
    run_bytes: int = RUN_BYTES

    def __post_init__(self) -> None:
        if not 2 <= self.order <= 6:
            raise ValueError("a context has 2 to 6 bytes")


def score(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Scores of every row of ``documents(doc_id, text)``; learns from the rows whose fold of 7 is not 2."""
    spark = docs.sparkSession
    ship_package(spark)
    held = F.coalesce(fold("doc_id", 7) == 2, F.lit(True)).alias("held_out")
    order = plan.order
    rows = texts(docs).select("doc_id", "text", held).mapInArrow(_gathered(order, plan.parts, plan.run_bytes), _RUN)
    rows = materialize(rows, "weighting-runs")
    ends = rows.filter(F.col("part") == plan.parts)
    seen = ends.agg(F.count("*"), F.sum("train_docs"), F.sum("train_tokens")).first()
    runs, train_docs, tokens = (int(x or 0) for x in seen)
    lists = rows.filter(F.col("part") < plan.parts).select("part", "run", "grams", "counts", "words", "word_counts")
    whole = materialize(merge_rows(lists, "part", "run", _added, _LIST, runs), "weighting-merged")
    # At most 65,535 nodes of depth 0 and 1, whatever the corpus holds.
    up = whole.repartition("part").mapInArrow(_upward(order), _UP)
    up = up.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "longer", "known")]).collect()
    vocabulary = sum(r["known"] for r in up) + (train_docs > 0)
    nodes = sorted((r for r in up if r["node"] >= 0), key=lambda r: r["node"])
    columns = [np.array([r[c] for r in nodes], kind) for c, kind in (("node", np.int64), ("zeros", float), ("ones", float), ("longer", float))]
    top = spark.sparkContext.broadcast(top_of(*columns))
    asked = whole.withColumn("run", F.lit(-1).cast("long")).unionByName(lists)
    asked = asked.repartition(F.col("part")).sortWithinPartitions("part", "run")
    answers = asked.mapInArrow(_answered(order, top), _ANSWER)
    said = ends.select("run", "part", *[F.lit(b"").alias(c) for c in ("grams", "logs", "words", "word_counts")], "ids", "stream")
    met = answers.unionByName(said).repartition(F.col("run")).sortWithinPartitions("run", "part")
    return met.mapInArrow(_scored(order, train_docs, tokens, vocabulary), _SCORED)
