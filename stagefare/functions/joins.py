"""Look-ups of a large table in a smaller one whose size has been measured."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A look-up table is broadcast only when its measured size is below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# Per-row overhead assumed on top of the text bytes when measuring.
_ROW_BYTES = 64


@dataclass(frozen=True)
class Lookup:
    """A look-up table, unique on ``key``, and its measured size."""

    table: DataFrame
    key: str
    size_bytes: int

    def fits(self, limit: int | None = None) -> bool:
        return self.size_bytes <= (BROADCAST_LIMIT_BYTES if limit is None else limit)


def row_bytes(table: DataFrame) -> Column:
    """Estimated size of a row in memory: its texts plus a fixed part."""
    texts = [f.name for f in table.schema.fields if f.dataType.typeName() == "string"]
    size = F.lit(_ROW_BYTES + 8 * len(table.columns)).cast("bigint")
    for name in texts:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return size


def measure(table: DataFrame, key: str) -> Lookup:
    """Measure a look-up table that is already written (see ``materialize``)."""
    size = table.agg(F.sum(row_bytes(table)).alias("size")).first()["size"]
    return Lookup(table, key, int(size or 0))


def measure_dims(table: DataFrame, dims: tuple[str, ...]) -> dict[str, Lookup]:
    """The look-ups of a written long table ``(dim, key, ...)``, measured in one pass."""
    sizes = dict(
        table.groupBy("dim").agg(F.sum(row_bytes(table)).alias("size")).collect()
    )
    return {
        d: Lookup(table.filter(F.col("dim") == d).drop("dim"), "key", int(sizes.get(d, 0)))
        for d in dims
    }


def look_up(df: DataFrame, lookup: Lookup, on: str, limit: int | None = None) -> DataFrame:
    """Left join ``df`` to a look-up table on ``df[on] = lookup.key``.

    A table below the limit is broadcast: no shuffle of ``df``, so hot keys do
    not matter. A larger one is joined by a shuffle on the key; adaptive
    execution then splits a partition of ``df`` that a hot key (or null) fills,
    which is allowed for the left side of a left join.
    """
    right = lookup.table.withColumnRenamed(lookup.key, "__lookup_key")
    if lookup.fits(limit):
        right = F.broadcast(right)
    else:
        right = right.hint("merge")
    return df.join(right, F.col(on) == F.col("__lookup_key"), "left").drop("__lookup_key")
