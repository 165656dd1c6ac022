"""Sets of numbered rows as bits: one bit a row, so a set of many rows is still broadcast.

Rows are numbered by ``monotonically_increasing_id``, dense within a task, and written with their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagefare.functions.joins import Lookup, look_up
from stagefare.sources.scratch import materialize

# Bits of a word, words of a block, and the size of a block with what a row of the table takes besides.
_WORD, _WORDS = 6, 9
_BLOCK_BYTES = 8 * 2**_WORDS + 256


def row_set(rows: DataFrame, number: str) -> Lookup:
    """The numbers of ``rows`` as a written table ``(block, words)`` of 512 words of 64 bits, and its size."""
    at = F.col(number)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(2**_WORD - 1).cast("int"))
    words = rows.groupBy(F.shiftright(at, _WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    entry = F.struct(F.col("word").bitwiseAND(2**_WORDS - 1).cast("int").alias("at"), "bits")
    blocks = words.groupBy(F.shiftright("word", _WORDS).alias("block")).agg(F.map_from_entries(F.collect_list(entry)).alias("set"))
    places = F.sequence(F.lit(0), F.lit(2**_WORDS - 1))
    filled = F.transform(places, lambda i: F.coalesce(F.try_element_at("set", i), F.lit(0).cast("bigint")))
    table = materialize(blocks.select("block", filled.alias("words")), "row-set")
    return Lookup(table, "block", table.count() * _BLOCK_BYTES)


def in_set(df: DataFrame, found: Lookup, number: str, limit: int | None = None) -> DataFrame:
    """The rows of ``df`` whose number is in the set, which is broadcast if it is measured to be small."""
    at = F.col(number)
    met = look_up(df.withColumn("__block", F.shiftright(at, _WORD + _WORDS)), found, "__block", limit)
    word = F.get("words", F.shiftright(at, _WORD).bitwiseAND(2**_WORDS - 1).cast("int"))
    return met.filter(F.getbit(word, at.bitwiseAND(2**_WORD - 1).cast("int")) == 1).select(*df.columns)
