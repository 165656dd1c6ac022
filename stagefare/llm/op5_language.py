"""Language identification by hyperdimensional profiles.

Each letter has a random vector of DIMENSIONS signs; a boundary between words has one too. A
trigram is bound as the product of its letters' vectors, each permuted by its place (rolled
by two, one and no places), and a text is the bundle, the sum, of its trigrams. A language's
prototype bundles the unit vectors of its training texts. The prediction is the prototype with
the greatest cosine; ``score`` is that cosine, at least 0.

Prototypes come from about TRAINING texts at most, spread over all by a hash of ``doc_id`` (a
bound on the fit alone; every text is compared). They are a few vectors, whose number is
that of the languages in the sample.

Defined results: a text that is null or has no letter gets ``und`` with score 0, as does every
text if nothing could be learned; ties go to the language first in the alphabet; ``held_out`` is
false for a null ``doc_id``; repeated rows are each predicted; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import bounded, fold
from .tables import texts
from .text import blocks, utf8

DIMENSIONS = 512
TRAINING = 20_000
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_SYMBOLS = 64
_BLOCK_BYTES = 2 << 20


@cache
def _symbols() -> np.ndarray:
    """The symbol of every code point: 0 if it is no letter, 1 to 26 for a to z, else one of the rest."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if (sign := chr(c)).isalpha():
            low = ord(sign.lower()[0])
            table[c] = low - 96 if 97 <= low < 123 else 27 + low * 7 % (_SYMBOLS - 27)
    return table


@cache
def _letters() -> np.ndarray:
    return np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (_SYMBOLS, DIMENSIONS))


def _trigrams(codes: np.ndarray) -> np.ndarray:
    """Vectors of trigram codes."""
    letters = _letters()
    a, b, c = codes // _SYMBOLS**2, codes // _SYMBOLS % _SYMBOLS, codes % _SYMBOLS
    return np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]


def profiles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of texts, and whether each has a letter."""
    data, rows = utf8(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts_char = (data & 0xC0) != 0x80
    row_at = np.append(0, np.cumsum(starts_char))[rows] if len(data) else rows
    symbols = _symbols()[points]
    count = len(rows) - 1
    lengths = np.diff(row_at)
    # Each text gets a boundary on both sides; runs of signs that are no letters count as one.
    row_of = np.repeat(np.arange(count), lengths)
    padded = np.zeros(len(symbols) + 2 * count, np.int32)
    padded[np.arange(len(symbols)) + 2 * row_of + 1] = symbols
    owner = np.repeat(np.arange(count), lengths + 2)
    edge = np.ones(len(padded), bool)
    edge[1:] = (padded[1:] != 0) | (padded[:-1] != 0) | (owner[1:] != owner[:-1])
    padded, owner = padded[edge], owner[edge]
    codes = padded[:-2] * _SYMBOLS**2 + padded[1:-1] * _SYMBOLS + padded[2:]
    inside = (owner[:-2] == owner[2:]) & (padded[1:-1] != 0)
    codes, owner = codes[inside], owner[1:-1][inside]
    used = np.flatnonzero(np.bincount(codes, minlength=_SYMBOLS**3))
    number = np.zeros(_SYMBOLS**3, np.int64)
    number[used] = np.arange(len(used))
    table = _trigrams(used)
    vectors = np.zeros((count, DIMENSIONS), np.float32)
    for first in range(0, count, 256):
        last = min(first + 256, count)
        a, b = np.searchsorted(owner, [first, last])
        at = (owner[a:b] - first) * len(used) + number[codes[a:b]]
        counts = np.bincount(at, minlength=(last - first) * len(used)).reshape(last - first, -1)
        vectors[first:last] = counts.astype(np.float32) @ table
    lettered = np.bincount(owner, minlength=count) > 0
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norm > 0, norm, 1), lettered


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bundles: dict[str, np.ndarray] = {}
    for batch in batches:
        for block in blocks(batch, most=_BLOCK_BYTES):
            vectors, lettered = profiles(block.column("text"))
            langs = np.array(block.column("lang").to_pylist(), dtype=object)
            for lang in sorted(set(langs[lettered])):
                total = vectors[lettered & (langs == lang)].sum(axis=0, dtype=np.float64)
                bundles[lang] = bundles.get(lang, 0) + total
    rows = [pa.array(list(bundles), pa.string()), pa.array([b.tolist() for b in bundles.values()], pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays(rows, names=["lang", "bundle"])


def learn(docs: DataFrame, most: int = TRAINING) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from ``documents(doc_id, text, lang)``."""
    known = docs.filter((fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    sums = (
        bounded(known, "doc_id", most)
        .mapInArrow(_bundled, "lang string, bundle array<double>")
        .select("lang", F.posexplode("bundle").alias("place", "value"))
        # Rounded, so that the order of adding leaves no trace.
        .groupBy("lang", "place")
        .agg(F.round(F.sum("value"), 6).alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value")))["value"].alias("bundle"))
        .orderBy("lang")
        .collect()
    )
    vectors = np.array([r["bundle"] for r in sums], np.float64).reshape(len(sums), DIMENSIONS)
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return [r["lang"] for r in sums], vectors / np.where(norm > 0, norm, 1)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row."""
    names = np.array([*languages, UNKNOWN], dtype=object)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, most=_BLOCK_BYTES):
                vectors, lettered = profiles(block.column("text"))
                cosine = np.zeros((block.num_rows, 1)) if not languages else vectors.astype(np.float64) @ prototypes.T
                best = np.where(lettered & bool(languages), cosine.argmax(axis=1), len(languages))
                score = np.where(best < len(languages), np.clip(cosine.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return texts(docs).mapInArrow(predicted, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the training folds of ``documents(doc_id, text, lang)`` and predict every row."""
    docs = texts(docs, F.col("lang").cast("string"))
    found = predict(docs, *learn(docs))
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
