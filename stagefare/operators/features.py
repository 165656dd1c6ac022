"""MLlib feature stages."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column
from pyspark.sql import functions as F

from stagefare.columns import MEAN_FEATURES, ONE_HOT_DIMS, PLAIN_FEATURES


def dense_assembler(columns=MEAN_FEATURES, invalid: str = "error") -> VectorAssembler:
    """Numeric columns to ``features``; a null fails the job or (``skip``) drops its row."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid=invalid)


def indexer(dims=ONE_HOT_DIMS) -> StringIndexer:
    """Categories to indices, most frequent first, ties by name; unseen ones come last.

    One stage for all columns, so fitting counts them in one pass.
    """
    return StringIndexer(
        inputCols=list(dims), outputCols=[f"{d}_idx" for d in dims], handleInvalid="keep"
    )


def one_hot_encoder(dims=ONE_HOT_DIMS) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{d}_idx" for d in dims], outputCols=[f"{d}_vec" for d in dims]
    )


def one_hot_stages(dims=ONE_HOT_DIMS, numbers=PLAIN_FEATURES, invalid: str = "skip") -> list:
    """Indexer, one-hot encoder and the assembler of numbers and one-hot vectors."""
    inputs = [*numbers, *[f"{d}_vec" for d in dims]]
    return [indexer(dims), one_hot_encoder(dims), dense_assembler(inputs, invalid)]


def slot_count(vector: Column) -> Column:
    """How many slots a vector has; a sparse one stores the number, a dense one has that many values."""
    plain = F.unwrap_udt(vector)
    return F.coalesce(plain["size"], F.size(plain["values"]))


def slot_value(vector: Column, slot: Column) -> Column:
    """The value of one slot, looked up among those that a sparse vector stores; no array of all slots is made."""
    plain = F.unwrap_udt(vector)
    stored = F.get(plain["values"], (F.array_position(plain["indices"], slot) - 1).cast("int"))
    return F.when(plain["indices"].isNull(), F.get(plain["values"], slot)).otherwise(F.coalesce(stored, F.lit(0.0)))
