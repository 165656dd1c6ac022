"""Removal of repeated passages by recompression.

A window is 13 consecutive words of one document; every word covered by a window whose
word sequence also starts in a document with a smaller ``doc_id`` goes.

1. Recompression names substrings in rounds. A round first names runs of one symbol by
   ``(symbol, length)``; then each symbol is sided left or right by a hash, and every left symbol
   followed by a right one becomes a symbol named by the two. All of this is decided locally,
   so equal substrings get equal symbols but for a few at their ends. Names are 64-bit hashes of
   what they stand for, hence global: every task gives a pair the same name without asking, and
   a round needs no shuffle.
2. Every symbol carries its *context*, the words that decide that it is formed. A window takes as
   its anchor the symbol of the highest round with its context inside the window, by least hash;
   if there is none, the window itself. Equal windows thus have equal anchors.
3. Anchors are shuffled as ``(name, doc_id)``, one row for each document that has it. Only windows
   with anchors of several documents are kept as candidates.
4. Candidates are verified by 128-bit names of their 13 words: ``(name, doc_id)`` again, and the
   least document of a name keeps it. The last pass marks the covered words.

Both shuffles carry one short row per document and name, so a passage that all documents share
costs a row each; aggregates and joins over them stream and gather nothing. A document's own
lists are bounded by its words.

Defined results: null and blank texts have no words; documents with fewer than 13 words lose
none; rows repeating a ``doc_id`` are the same document, which does not repeat itself, and each
row is returned; a row with null ``doc_id`` is kept whole and does not count as a source;
no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts
from .text import Words, blocks, mix, words

WINDOW = 13
ROUNDS = 2
_BASES = (0xB5297A4D3F84D5B5, 0x9FB21C651E98DF25)
_RUN, _PAIR, _SIDE = (np.uint64(x) for x in (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64."""
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class _Spans:
    """64-bit names of word spans, from prefix sums of a polynomial."""

    def __init__(self, names: np.ndarray, base: int) -> None:
        size = 1 << max(16, len(names).bit_length())
        up, self.down = _powers(base, size)
        self.sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(names * up[: len(names)], out=self.sums[1:])

    def name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


class _Symbols:
    """A row of symbols: names, contexts, and the bounds of the document each is in.

    A neighbour outside the document is unknown, which puts the context outside as well.
    """

    def __init__(self, name, low, high, first, last) -> None:
        self.name, self.low, self.high, self.first, self.last = name, low, high, first, last

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        joined = self.first[1:] == self.first[:-1]
        before, after = self.first - 1, self.last + 1
        before[1:] = np.where(joined, self.low[:-1], before[1:])
        after[:-1] = np.where(joined, self.high[1:], after[:-1])
        return joined, before, after

    def runs(self) -> _Symbols:
        joined, before, after = self._neighbours()
        starts = np.ones(len(self.name), bool)
        starts[1:] = ~(joined & (self.name[1:] == self.name[:-1]))
        at = np.flatnonzero(starts)
        end = np.append(at[1:], len(self.name)) - 1
        length = (end - at + 1).astype(np.uint64)
        name = np.where(length > 1, mix(self.name[at] + length * _RUN), self.name[at])
        return _Symbols(name, before[at], after[end], self.first[at], self.last[at])

    def pairs(self, round_: int) -> _Symbols:
        joined, before, after = self._neighbours()
        right = (mix(self.name + np.uint64(round_ + 1) * _SIDE) & np.uint64(1)).astype(bool)
        opens = np.zeros(len(self.name), bool)
        opens[:-1] = joined & ~right[:-1] & right[1:]
        kept = np.ones(len(self.name), bool)
        kept[1:] = ~opens[:-1]
        at = np.flatnonzero(kept)
        pair = opens[at]
        other = np.minimum(at + 1, len(self.name) - 1)
        name = np.where(pair, mix(self.name[at] * _PAIR + mix(self.name[other])), self.name[at])
        # A single symbol of the right side had no left one before it; of the left, no right one after.
        low = np.where(~pair & right[at], before[at], self.low[at])
        high = np.where(pair, self.high[other], np.where(right[at], self.high[at], after[at]))
        return _Symbols(name, low, high, self.first[at], self.last[at])


def window_starts(found: Words) -> np.ndarray:
    """Whether a window starts at each word."""
    n = len(found.codes)
    last = np.repeat(found.bounds[1:], np.diff(found.bounds))
    return np.arange(n) + WINDOW <= last


def anchors(found: Words, names: np.ndarray, spans: _Spans) -> np.ndarray:
    """The anchor of the window at each word; meaningless where none starts."""
    n = len(names)
    if n == 0:
        return names
    counts = np.diff(found.bounds)
    first, last = np.repeat(found.bounds[:-1], counts), np.repeat(found.bounds[1:], counts)
    place = np.arange(n)
    level = _Symbols(names, place, place + 1, first, last)
    levels = []
    for round_ in range(ROUNDS):
        level = level.runs().pairs(round_)
        levels.append(level)
    best = np.zeros(n, np.uint64)
    covered = np.zeros(n, bool)
    for level in reversed(levels):
        inside = (level.low >= level.first) & (level.high <= level.last) & (level.high - level.low <= WINDOW)
        low, high = level.low[inside], level.high[inside]
        name = mix(level.name[inside] + spans.name(low, high)) | np.uint64(1)
        end = np.minimum(low, level.last[inside] - WINDOW)
        start = level.first[inside]
        least = np.full(n, np.iinfo(np.uint64).max)
        # Contexts of one round end at different words, so each step writes to different windows.
        for step in range(WINDOW):
            at = high - WINDOW + step
            going = (at >= start) & (at <= end)
            at = at[going]
            least[at] = np.minimum(least[at], name[going])
        new = ~covered & (least != np.iinfo(np.uint64).max)
        best[new] = least[new]
        covered |= new
    rest = np.flatnonzero(~covered & window_starts(found))
    best[rest] = spans.name(rest, rest + WINDOW)
    return best


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch):
            found = words(block.column("text"))
            names = mix(found.names())
            anchor = anchors(found, names, _Spans(names, _BASES[0]))
            starts = window_starts(found)
            bounds = found.bounds.tolist()
            parts = [np.unique(anchor[a:b][starts[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), _lists(parts)], names=["doc_id", "anchors"])


def _window_names(names: np.ndarray, spans: _Spans, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    other = _Spans(mix(names + _PAIR), _BASES[1])
    return spans.name(at, at + WINDOW), other.name(at, at + WINDOW)


def _rows_with_list(block: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    lists = block.column(column)
    for row in range(block.num_rows):
        if lists[row].is_valid:
            yield row, np.asarray(lists[row].values).view(np.uint64)


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = batch.filter(batch.column("anchors").is_valid())
        for block in blocks(batch):
            found = words(block.column("text"))
            names = mix(found.names())
            spans = _Spans(names, _BASES[0])
            anchor, starts = anchors(found, names, spans), window_starts(found)
            ids = np.asarray(block.column("doc_id"))
            chosen = []
            for row, shared in _rows_with_list(block, "anchors"):
                a, b = found.bounds[row], found.bounds[row + 1]
                at = a + np.flatnonzero(starts[a:b] & np.isin(anchor[a:b], shared))
                # A window that a document repeats counts once.
                chosen.append(at[np.unique(spans.name(at, at + WINDOW), return_index=True)[1]])
            at = np.concatenate([*chosen, np.zeros(0, np.int64)])
            one, two = _window_names(names, spans, at)
            doc = ids[np.searchsorted(found.bounds, at, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=["doc_id", "one", "two"]
            )


_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _removed(found: Words, block: pa.RecordBatch) -> np.ndarray:
    """Which words of a block are covered by windows named in its lists."""
    names = mix(found.names())
    spans = _Spans(names, _BASES[0])
    hit = np.zeros(len(names) + WINDOW, np.int8)
    for row, gone in _rows_with_list(block, "gone"):
        at = np.arange(found.bounds[row], found.bounds[row + 1] - WINDOW + 1)
        at = at[np.isin(spans.name(at, at + WINDOW), gone)]
        hit[at] = 1
    sums = np.cumsum(np.append(np.zeros(WINDOW, np.int8), hit), dtype=np.int64)
    return sums[WINDOW : WINDOW + len(names)] > sums[: len(names)]


def _kept_rows(with_text: bool):
    def kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                found = words(block.column("text"))
                removed = _removed(found, block)
                counts, gone, digests, texts_ = [], [], [], []
                bounds = found.bounds.tolist()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    left = found.codes[a:b][~removed[a:b]]
                    kept = b" ".join([found.vocabulary[c] for c in left.tolist()])
                    counts.append(b - a)
                    gone.append(b - a - len(left))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    texts_.append(kept.decode() if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(gone, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(texts_, pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return kept_rows


def shared_anchors(docs: DataFrame) -> DataFrame:
    """``(doc_id, anchors)``: by document, its anchors that other documents have too."""
    rows = docs.filter("doc_id is not null").mapInArrow(_anchor_rows, "doc_id long, anchors array<long>")
    # Stating that nothing is null keeps both uses below the same plan, so one shuffle serves both.
    rows = rows.select("doc_id", F.explode("anchors").alias("name")).filter("doc_id is not null and name is not null")
    rows = rows.repartition("name")
    shared = rows.groupBy("name").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    return rows.join(shared.select("name"), "name").groupBy("doc_id").agg(F.collect_set("name").alias("anchors"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``(doc_id, gone)``: by document, the names of its windows that start in a smaller one."""
    listed = docs.join(shared_anchors(docs), "doc_id", "left")
    rows = listed.mapInArrow(_candidate_rows, "doc_id long, one long, two long")
    rows = rows.filter("doc_id is not null and one is not null and two is not null").repartition("one", "two")
    owner = rows.groupBy("one", "two").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("high"))
    owner = owner.filter("owner < high").select("one", "two", "owner")
    later = rows.join(owner, ["one", "two"]).filter("doc_id > owner")
    return later.groupBy("doc_id").agg(F.collect_set("one").alias("gone"))


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` for each row of ``documents(doc_id, text)``.

    ``kept`` is the text of the kept words, joined by one space; null unless asked for.
    """
    docs = texts(docs)
    listed = docs.join(repeated_windows(docs), "doc_id", "left")
    return listed.mapInArrow(_kept_rows(with_text), _KEPT)
