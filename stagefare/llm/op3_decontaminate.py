"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are compared on their letters and digits alone, with the case of all letters folded
(beyond ASCII every sign counts as a letter, in UTF-8), so ASCII punctuation, case and spacing hide nothing. An item of ``m`` such bytes
is found where a region of a text is within ``k = m // EDIT_SHARE`` edits of it (fewer for short
items, so that the bound below stays positive).

1. An alignment within ``k`` edits keeps at least ``m - q + 1 - k * q`` of the item's q-grams, on
   diagonals (place in text less place in item) at most ``2 * k + 1`` apart.
2. Every q-gram of a text is looked up among those of the items; hits are counted by item and
   band of diagonals. Bands are twice as wide as needed and overlap by half, so one holds all.
   Pairs are expanded a slice at a time; bands that no later place can reach are closed, so memory follows the items, not
   the pairs. Where a q-gram repeats in a text, only its first place in a band is looked at.
3. Bands that reach the bound are verified by banded alignment of the item with their region.

Items are sent to tasks in groups of at most ITEM_BYTES, so what is broadcast is bounded; more
groups mean more passes over the documents, with the same result.

Defined results: a row per document, item and place found; a document with a null ``doc_id`` too; items with
fewer than MIN_ITEM bytes of letters and digits are found without edits and as whole words only; null ones and those
without a letter or digit match nothing;
items that repeat are each reported; repeated rows are each searched; empty tables give no rows; other
columns are ignored by the search and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts
from .text import blocks, mix, utf8

Q = 8
EDIT_SHARE = 10
MIN_ITEM = 24
ITEM_BYTES = 8 << 20
# Pairs of equal q-grams of text and items that are expanded at a time: it bounds memory on repetitive texts.
EXPANDED = 1 << 19
_BITS = 22

# Bytes compared: a-z, 0-9 and those of letters beyond ASCII; A-Z are mapped to a-z, others dropped.
_ASCII = np.zeros(256, np.uint8)
_ASCII[48:58] = np.arange(48, 58)
_ASCII[97:123] = np.arange(97, 123)
_ASCII[65:91] = np.arange(97, 123)
_ASCII[128:] = np.arange(128, 256)
# No letter from here on has a case.
_CASELESS = 0x1F000


@cache
def _folds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, signs, size)``: by code point its row, by row the bytes of its folded form; row 0 folds nothing.

    Folding what is upper-cased first makes one of all forms (dotless i too).
    """
    row, forms = np.zeros(_CASELESS + 1, np.int64), [b""]
    for code in range(128, _CASELESS):
        form = chr(code).upper().casefold()
        if form != chr(code):
            row[code] = len(forms)
            forms.append(form.encode())
    size = np.array([len(f) for f in forms])
    signs = np.zeros((len(forms), max(4, int(size.max()))), np.uint8)
    for k, form in enumerate(forms):
        signs[k, : len(form)] = np.frombuffer(form, np.uint8)
    return row, signs, size


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of UTF-8 as they are compared, 0 where dropped, and the place in ``data`` each comes from."""
    mapped, place = _ASCII[data], np.arange(len(data))
    lead = np.flatnonzero(data >= 0xC2)
    if not len(lead):
        return mapped, place
    first = data[lead].astype(np.int64)
    one, two, three = (data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3))
    code = np.where(
        first < 0xE0,
        (first & 0x1F) << 6 | one,
        np.where(first < 0xF0, (first & 0xF) << 12 | one << 6 | two, (first & 7) << 18 | one << 12 | two << 6 | three),
    )
    row, signs, size = _folds()
    form = row[np.minimum(code, _CASELESS)]
    cased = form > 0
    at, form, own = lead[cased], form[cased], (2 + (first >= 0xE0) + (first >= 0xF0))[cased]
    for k in range(4):
        held = k < own
        mapped[at[held] + k] = signs[form[held], k]
    more = np.maximum(size[form] - own, 0)
    if more.any():
        after = np.repeat(at + own, more)
        nth = np.arange(len(after)) - np.repeat(np.cumsum(more) - more, more)
        mapped = np.insert(mapped, after, signs[np.repeat(form, more), np.repeat(own, more) + nth])
        place = np.insert(place, after, after - 1)
    return mapped, place


class _Mapped:
    """The compared bytes of a byte string as ``_MAPPED[bytes]``, 0 where dropped."""

    def __getitem__(self, data: np.ndarray) -> np.ndarray:
        return folded(data)[0]


_MAPPED = _Mapped()


def reduced(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compared bytes of texts, their places in the column's bytes, and the texts' bounds."""
    data, rows = utf8(column)
    mapped, place = folded(data)
    kept = np.flatnonzero(mapped)
    place = place[kept]
    return mapped[kept], place, np.searchsorted(place, rows)


def grams(x: np.ndarray) -> np.ndarray:
    """The q-grams of a byte string as 64-bit numbers."""
    if len(x) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(x) - Q + 1,), "<u8", np.ascontiguousarray(x), strides=(1,)).copy()


def _windows(x: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit name of every ``n`` bytes in a row."""
    if len(x) < n:
        return np.zeros(0, np.uint64)
    if n < Q:
        return grams(np.append(x, np.zeros(Q, np.uint8)))[: len(x) - n + 1] & np.uint64((1 << 8 * n) - 1)
    gram, count = grams(x), len(x) - n + 1
    name = np.zeros(count, np.uint64)
    for start in {*range(0, n - Q, Q), n - Q}:
        name = name + mix(gram[start : start + count] + np.uint64(start))
    return name


def _joins(one: str, two: str) -> bool:
    """Whether two signs side by side are of one word; scripts without spaces have a bound after each sign."""
    spaced = not any("\u0e00" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u2e80" <= c <= "\u9fff" or "\U00020000" <= c for c in (one, two))
    return spaced and one.isalnum() and two.isalnum()


def edits_allowed(m: int) -> int:
    return min(m // EDIT_SHARE, (m - Q) // Q)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int, anchored: bool = False) -> tuple[int, int]:
    """``(edits, end)`` of the best alignment of ``item`` with a part of ``text``; given up beyond ``most``.

    Only diagonals (place in text less place in item) from ``low`` to ``high`` are used. The part may
    start anywhere, or at the text's start if ``anchored``; the least end wins a tie.
    """
    count, far = high - low + 1, len(item) + len(text) + 1
    along = np.arange(count)
    left = max(0, -low)
    padded = np.zeros(left + max(len(text), high + len(item)) + 1, np.uint8)
    padded[left : left + len(text)] = text
    column = low + along
    row = np.where((column < 0) | (column > len(text)), far, column if anchored else 0)
    for i, sign in enumerate(item.tolist()):
        at = low + i + left
        step = row + (padded[at : at + count] != sign)
        np.minimum(step[:-1], row[1:] + 1, out=step[:-1])
        # Going right along a row costs one each: a running minimum of what lies to the left.
        step -= along
        row = np.minimum.accumulate(step, out=step) + along
        if i % 8 == 7 and row.min() > most:
            return most + 1, 0
    column = column + len(item)
    row[(column < 0) | (column > len(text))] = far
    best = int(np.argmin(row))
    return int(row[best]), int(column[best])


def _since_last(gram: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How far back the same q-gram last stood in the same text; a large number if it did not."""
    gap = np.full(len(at), np.iinfo(np.int64).max)
    order = np.lexsort((at, gram, text))
    same = (gram[order][1:] == gram[order][:-1]) & (text[order][1:] == text[order][:-1])
    gap[order[1:][same]] = np.diff(at[order])[same]
    return gap


@dataclass
class Items:
    """Benchmark items with their q-grams in order."""

    ids: list[int]
    bytes_: list[np.ndarray]
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    short: dict[int, tuple[np.ndarray, dict[bytes, list[int]]]]

    @classmethod
    def of(cls, ids: list[int], column: pa.Array) -> Items:
        data, _, bounds = reduced(column)
        parts = [(i, data[a:b]) for i, a, b in zip(ids, bounds[:-1], bounds[1:], strict=True) if b - a >= MIN_ITEM]
        short: dict[int, dict[bytes, list[int]]] = {}
        for i, a, b in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if 0 < b - a < MIN_ITEM:
                short.setdefault(b - a, {}).setdefault(data[a:b].tobytes(), []).append(i)
        named = {n: (np.unique(np.concatenate([_windows(np.frombuffer(x, np.uint8), n) for x in own])), own) for n, own in short.items()}
        gram = np.concatenate([*(grams(x) for _, x in parts), np.zeros(0, np.uint64)])
        count = [len(x) - Q + 1 for _, x in parts]
        item = np.repeat(np.arange(len(parts)), count)
        place = np.concatenate([*(np.arange(n) for n in count), np.zeros(0, np.int64)])
        order = np.argsort(gram, kind="stable")
        seen = np.zeros(1 << _BITS, bool)
        seen[mix(gram) >> np.uint64(64 - _BITS)] = True
        return cls([i for i, _ in parts], [x for _, x in parts], gram[order], item[order], place[order], seen, named)

    def candidates(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows ``(text, item, first diagonal, last diagonal)`` of the bands that reach the bound."""
        none = np.zeros((0, 4), np.int64)
        if not self.ids:
            return none
        gram = grams(data)
        at = np.flatnonzero(self.seen[mix(gram) >> np.uint64(64 - _BITS)]) if len(gram) else np.zeros(0, np.int64)
        first = np.searchsorted(self.gram, gram[at], side="left")
        count = np.searchsorted(self.gram, gram[at], side="right") - first
        text = np.searchsorted(bounds, at, side="right") - 1
        count[at + Q > bounds[text + 1]] = 0
        at, first, count, text = (x[count > 0] for x in (at, first, count, text))
        if not len(at):
            return none
        sizes = np.array([len(x) for x in self.bytes_], np.int64)
        allowed = np.minimum(sizes // EDIT_SHARE, (sizes - Q) // Q)
        width, longest = 2 * allowed + 1, int(sizes.max())
        needed = sizes - Q + 1 - allowed * Q
        limit = int((np.diff(bounds).max() + longest) // width.min()) + 3
        gap = _since_last(first, text, at)
        sums = np.append(0, np.cumsum(count))
        cuts = np.unique(np.append(np.searchsorted(sums, np.arange(0, sums[-1], EXPANDED)), len(at)))
        open_, found = np.zeros(0, np.int64), []
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = slice(start, end)
            n = count[part]
            entry = np.repeat(first[part] - (sums[start:end] - sums[start]), n) + np.arange(n.sum())
            item, place = self.item[entry], self.place[entry]
            own = np.repeat(text[part], n)
            diagonal = np.repeat(at[part] - bounds[text[part]], n) - place + sizes[item]  # never negative
            # The same q-gram stood so far back on the same band: it has counted there.
            new = diagonal % width[item] < np.repeat(gap[part], n)
            own, item, place, diagonal = own[new], item[new], place[new], diagonal[new]
            # Band b holds the widths b and b + 1: a hit counts for its own and the one before.
            key = (own * len(self.ids) + item) * limit + diagonal // width[item] + 1
            # A q-gram of the item counts once in a band, however often the text repeats it.
            once = np.unique(np.concatenate([open_, key * longest + place, (key - 1) * longest + place]))
            both = once // longest
            whose, band = both // limit, both % limit - 1
            last = end == len(at)
            ahead = 0 if last else at[end] - bounds[text[end]] + Q
            closed = np.ones(len(once), bool) if last else (whose // len(self.ids) < text[end]) | ((band + 2) * width[whose % len(self.ids)] <= ahead)
            open_ = once[~closed]
            ended, hits = np.unique(both[closed], return_counts=True)
            item = ended // limit % len(self.ids)
            ended, item = ended[hits >= needed[item]], item[hits >= needed[item]]
            low = (ended % limit - 1) * width[item] - sizes[item]
            found.append(np.stack([ended // limit // len(self.ids), item, low, low + 2 * width[item] - 1], axis=1))
        return np.concatenate(found)

    def search(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """``(row, item id, first byte, end byte, edits)`` of all items found, by place."""
        data, place, bounds = reduced(column)
        _, rows = utf8(column)
        found: dict[tuple, tuple] = {}
        for text, item, low, high in self.candidates(data, bounds).tolist():
            x, own = self.bytes_[item], data[bounds[text] : bounds[text + 1]]
            start = max(0, low)
            region = own[start : high + len(x) + 1]
            exact = region.tobytes().find(x.tobytes())
            if exact >= 0:
                edits, first, end = 0, start + exact, start + exact + len(x)
            else:
                most = edits_allowed(len(x))
                edits, end = align(x, region, low - start, high - start, most)
                if edits > most:
                    continue
                _, length = align(x[::-1], region[:end][::-1], -most, most, most, anchored=True)
                first, end = start + end - length, start + end
            at = place[bounds[text] + np.array([first, end - 1])] - rows[text]
            # Overlapping bands find the same place again.
            found.setdefault((text, item, int(at[0]) // max(1, len(x) // 2)), (text, self.ids[item], int(at[0]), int(at[1]) + 1, edits))
        unique: dict[tuple, tuple] = {}
        for text, item, first, end, edits in found.values():
            best = unique.get((text, item, end))
            if best is None or edits < best[4]:
                unique[text, item, end] = (text, item, first, end, edits)
        return sorted([*unique.values(), *self._short_found(column, data, place, bounds, rows)])

    def _short_found(self, column, data, place, bounds, rows) -> Iterator[tuple[int, int, int, int, int]]:
        """As ``search``, of the short items: whole words without edits."""
        for n, (names, own) in self.short.items():
            at = np.flatnonzero(np.isin(_windows(data, n), names))
            text = np.searchsorted(bounds, at, side="right") - 1
            for start, row in zip(at.tolist(), text.tolist(), strict=True):
                ids = own.get(data[start : start + n].tobytes())
                if ids is None or start + n > bounds[row + 1]:
                    continue
                first, end = int(place[start] - rows[row]), int(place[start + n - 1] - rows[row]) + 1
                whole = column[row].as_py().encode()
                head, tail = (part.decode(errors="ignore") for part in (whole[max(0, first - 4) : first], whole[end : end + 4]))
                found = whole[first:end].decode(errors="ignore")
                if not found or (head and _joins(head[-1], found[0])) or (tail and _joins(found[-1], tail[0])):
                    continue
                yield from ((row, i, first, end, 0) for i in ids)


def _item_groups(benchmark: DataFrame) -> list[Items]:
    """All items in groups of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // ITEM_BYTES + 1
    dealt = items.withColumn("group", F.pmod(F.xxhash64("text", "item_id"), F.lit(count)))
    for group in range(count):
        table = dealt.filter(F.col("group") == group).select("item_id", "text").orderBy("item_id", "text").toArrow()
        text = pa.concat_arrays([c.cast(pa.string()) for c in table.column("text").chunks]) if table.num_rows else pa.array([], pa.string())
        yield Items.of(table.column("item_id").to_pylist(), text)


MATCHES = "doc_id long, item_id long, start long, end long, edits long"


def _matches(items):
    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                column, ids = block.column("text"), block.column("doc_id")
                out: list[list] = [[] for _ in range(5)]
                for row, item, first, end, edits in items.value.search(column):
                    whole = column[row].as_py().encode()
                    # A region may start or end inside a character beyond ASCII, which it then holds whole.
                    while whole[first] & 0xC0 == 0x80:
                        first -= 1
                    while end < len(whole) and whole[end] & 0xC0 == 0x80:
                        end += 1
                    start = len(whole[:first].decode())
                    length = len(whole[first:end].decode())
                    for values, value in zip(out, (ids[row].as_py(), item, start, start + length, edits), strict=True):
                        values.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "item_id", "start", "end", "edits"])

    return matches


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)`` of items found in ``documents(doc_id, text)``; code points, end exclusive."""
    context = docs.sparkSession.sparkContext
    docs, result = texts(docs), None
    for items in _item_groups(benchmark):
        found = docs.mapInArrow(_matches(context.broadcast(items)), MATCHES)
        result = found if result is None else result.union(found)
    return result


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    context = docs.sparkSession.sparkContext
    for group in _item_groups(benchmark):
        items = context.broadcast(group)

        def clean(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in blocks(batch):
                    kept = np.ones(block.num_rows, bool)
                    kept[[row for row, *_ in items.value.search(block.column("text"))]] = False
                    yield block.filter(pa.array(kept))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
