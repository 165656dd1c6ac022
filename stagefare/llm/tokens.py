"""Token ids of whole text columns by a public byte-level BPE vocabulary.

The vocabulary's own pattern splits a text into pieces that are encoded one by one, so a
piece has the same ids wherever it stands. The pieces of a block are found on arrays of code
points, Arrow's dictionary encoding leaves each distinct piece once, and the tokenizers library
encodes those it has not met in this worker. This gives the ids that the library gives for the
whole text. A text with characters outside the ranges that the piece rules below cover is
passed to the library as it is.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from .text import blocks, utf8

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# Text encoded at a time: with more, fewer pieces are met again in another block.
ENCODED_BYTES = 3 << 20

# Remembered pieces per worker; beyond it the memory starts afresh.
_REMEMBERED = 250_000

# Code points whose classes are taken from the table: up to Latin Extended-B, Greek and
# Cyrillic, and General Punctuation to currency signs.
_COVERED = ((0, 0x250), (0x370, 0x530), (0x2010, 0x20C0))
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
_WHITE = {*range(9, 14), 0x20, 0x85, 0xA0, 0x2028, 0x2029, 0x202F, 0x205F}


@cache
def _classes() -> np.ndarray:
    """The class of each covered code point, 0 for others."""
    table = np.zeros(0x110000, np.uint8)
    for first, last in _COVERED:
        for c in range(first, last):
            kind = unicodedata.category(chr(c))
            if kind == "Cn":
                continue
            table[c] = _SPACE if c in _WHITE else {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)
    return table


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """``x`` moved so that place i holds ``x[i + by]``, zero outside."""
    out = np.zeros_like(x)
    if by > 0:
        out[:-by] = x[by:]
    else:
        out[-by:] = x[:by]
    return out


def piece_starts(points: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces start in texts laid end to end; ``first`` marks the texts' first characters.

    A piece is a run of letters, of numbers or of other signs, each with one space before it if
    there is one; a run of white space less the last sign if anything follows; or a contraction.
    """
    joined = ~first
    previous = _shifted(kind, -1) * joined
    starts = first | (kind != previous)
    white = kind == _SPACE
    # The last sign of a white run before something else stands alone, or leads the next piece.
    ends = np.zeros(len(first), bool)
    ends[:-1] = joined[1:] & (kind[1:] != _SPACE)
    starts |= white & ends
    led = joined & ~white & (_shifted(points, -1) == 0x20)
    starts &= ~led
    # Contractions are taken where a piece would start at the apostrophe.
    at = np.flatnonzero(starts & (points == 0x27))
    if len(at):
        limit = np.flatnonzero(first)
        end = np.append(limit, len(points))[np.searchsorted(limit, at, side="right")]
        one = points[np.minimum(at + 1, len(points) - 1)] * (at + 1 < end)
        two = points[np.minimum(at + 2, len(points) - 1)] * (at + 2 < end)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        starts[at[short | long] + 1] = False
        after = np.where(short, at + 2, at + 3)[short | long]
        after = after[after < end[short | long]]
        # What follows is a piece of its own, unless a space leads it.
        starts[after] = True
    return starts


@cache
def _signs() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: visible Latin-1 signs stand for
    themselves, the other bytes in order for the characters from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Pieces(dict):
    """Numbers of pieces, given out in order; new ones wait in a list."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes blocks of texts; one for each task's worker."""

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.known, self.flat, self.ends, self.held = _Pieces(), np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64), 0

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of pieces in the memory, after encoding the new ones."""
        if len(self.known) > _REMEMBERED:
            self._forget()
        numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        signs, tokenize = _signs(), self.model.tokenize
        found = [[t.id for t in tokenize(p.decode("latin-1").translate(signs))] for p in self.known.new]
        self.known.new = []
        if found:
            added = np.fromiter(chain.from_iterable(found), np.uint32)
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) + self.held
            if self.held + len(added) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(added), np.uint32)])
            self.flat[self.held : self.held + len(added)] = added
            self.held += len(added)
            self.ends = np.concatenate([self.ends, ends])
        return numbers

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: row r has the ids bounds[r] to bounds[r + 1]. Null counts as empty."""
        data, rows = utf8(column)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        kind = _classes()[points]
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        at_byte = np.zeros(len(points) + 1, np.int32)
        np.cumsum(width, out=at_byte[1:])
        row_at = np.searchsorted(at_byte, rows)
        first = np.zeros(len(points), bool)
        first[row_at[:-1][row_at[:-1] < len(points)]] = True
        starts = np.flatnonzero(piece_starts(points, kind, first))
        offsets = np.append(at_byte[starts], len(data)).astype(np.int32)
        packed = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        strange = np.flatnonzero(kind == 0)
        strange_rows = np.unique(np.searchsorted(row_at, strange, side="right") - 1)
        piece_rows = np.searchsorted(starts, row_at)
        codes = np.asarray(packed.indices)
        skipped = np.zeros(len(codes), bool)
        for row in strange_rows.tolist():
            skipped[piece_rows[row] : piece_rows[row + 1]] = True
        pieces = packed.dictionary.to_pylist()
        if skipped.any():
            wanted = np.unique(codes[~skipped])
            renamed = np.zeros(len(pieces), np.int64)
            renamed[wanted] = np.arange(len(wanted))
            pieces, codes = [pieces[c] for c in wanted.tolist()], renamed[codes]
        number = self._learn(pieces)
        at = self.ends[number]
        length = self.ends[number + 1] - at
        counts = length[codes] if len(length) else np.zeros(len(codes), np.int64)
        counts[skipped] = 0
        sums = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(counts, out=sums[1:])
        source = np.repeat((at[codes] if len(at) else counts) - sums[:-1], counts) + np.arange(sums[-1])
        ids, bounds = self.flat[source], sums[piece_rows]
        if len(strange_rows):
            parts = np.split(ids, bounds[1:-1])
            for row in strange_rows.tolist():
                parts[row] = self._whole(data[rows[row] : rows[row + 1]].tobytes().decode())
            ids = np.concatenate(parts)
            bounds = np.cumsum([0, *map(len, parts)])
        return ids, bounds


@cache
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(vocabulary)


def encoded_blocks(batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Blocks with the ids of their texts, each text's followed by ``end_id``."""
    tool = encoder()
    for batch in batches:
        for block in blocks(batch, most=ENCODED_BYTES):
            ids, bounds = tool.encode(block.column("text"))
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))
            yield block, ids, bounds + np.arange(len(bounds))
