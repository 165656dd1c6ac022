"""Running totals over a whole table in a stated order, and exact quantiles from them.

Rows are dealt to tasks by range, so each task holds a stretch of the order; what lies before a stretch is
the sum of the earlier stretches' totals, one number for each task. No task sees a whole group.
"""

from __future__ import annotations

from functools import reduce
from itertools import batched

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagefare.sources.scratch import materialize

_PART = "__part"


def running_total(df: DataFrame, group: str, order: list[Column], weight: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` over the rows of the same group up to and with this one.

    ``order`` must tell the rows of a group apart. The dealt rows are written, as a range
    partitioning that is computed again may cut elsewhere; order and weight are computed again instead of stored.
    """
    dealt = df.repartitionByRange(group, *order)
    dealt = materialize(dealt.withColumn(_PART, F.spark_partition_id()), "dealt")
    totals = dealt.groupBy(group, _PART).agg(F.sum(weight).alias("__total"))
    # One row for each group in each task, a few thousand at most.
    before = Window.partitionBy(group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, _PART, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    offsets = offsets.withColumnsRenamed({group: "__group", _PART: "__of"})
    stretch = Window.partitionBy(_PART, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn(name, F.sum(weight).over(stretch))
    met = summed.join(F.broadcast(offsets), (F.col(_PART) == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group")))
    return met.withColumn(name, F.col(name) + F.col("__before")).select(*df.columns, name)


def number(column: str) -> Column:
    """The column as double, with NaN as a missing value."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


# Values of a column from which its quantiles are first estimated, to so many parts of them.
LEAST_VALUES, PARTS = 1_000_000, 2_000
# Columns that one scan counts by zones: code for more grows beyond what the JVM compiles.
AT_ONCE = 5


def quantile_zones(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[tuple[float, float]]]:
    """Stretches of values in order, within which the quantiles of columns of many values lie, from one pass; none for a small table."""
    if df.count() < LEAST_VALUES:
        return {}
    # An estimate is off by one part of the values at most.
    ends = [min(1.0, max(0.0, p + side * 2 / PARTS)) for p in sorted(probs) for side in (-1, 1)]
    near = [F.percentile_approx(number(c), ends, PARTS) for c in columns]
    row = df.agg(*[F.count(number(c)) for c in columns], *near).first()
    zones: dict[str, list[tuple[float, float]]] = {}
    for c, n, found in zip(columns, row[: len(columns)], row[len(columns) :], strict=True):
        zones[c] = [] if n >= LEAST_VALUES else [(float("-inf"), float("inf"))]
        for low, high in zip(found[::2], found[1::2]) if n >= LEAST_VALUES else ():
            if zones[c] and low <= zones[c][-1][1]:
                low, high = zones[c][-1][0], max(high, zones[c].pop()[1])
            zones[c].append((low, high))
    return zones


def _in_zones(df: DataFrame, columns: list[str], zones: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """``slot, value, beyond``: a value in a zone as itself; any before, between or after zones as the end of the zone before, and beyond."""

    def entry(slot: int, value: Column, found: list[tuple[float, float]]) -> Column:
        def held(kept: Column, beyond: bool) -> Column:
            return F.struct(F.lit(slot).alias("slot"), kept.alias("value"), F.lit(beyond).alias("beyond"))

        out = F.when(value.isNull(), None).when(value < found[0][0], held(F.lit(float("-inf")), True))
        for (_, high), after in zip(found, [*found[1:], None]):
            out = out.when(value <= high, held(value, False))
            if after:
                out = out.when(value < after[0], held(F.lit(high), True))
        return out.otherwise(held(F.lit(found[-1][1]), True))

    def counted(some: tuple[tuple[int, str], ...]) -> DataFrame:
        entries = F.array(*[entry(i, number(c), zones[c]) for i, c in some])
        return df.select(F.explode(entries).alias("entry")).filter("entry is not null").select("entry.*")

    return reduce(DataFrame.unionAll, [counted(some) for some in batched(enumerate(columns), AT_ONCE)])


def quantiles(
    df: DataFrame, columns: list[str], probs: list[float], zones: dict[str, list[tuple[float, float]]] | None = None
) -> DataFrame:
    """``column_name, prob, value``: linearly interpolated exact quantiles; none for a column without values.

    Equal values are counted once before anything is sorted, so a value that fills a column is one row. With ``zones`` (see
    ``quantile_zones``) so are all values that lie between two zones; should a quantile lie there, values are counted one by one after all.
    """
    found = _quantiles(df, columns, probs, zones or {})
    if zones:
        found = materialize(found, "quantiles")
        if found.filter("beyond").limit(1).count():
            found = _quantiles(df, columns, probs, {})
    return found.select("column_name", "prob", "value")


def _quantiles(df: DataFrame, columns: list[str], probs: list[float], zones: dict[str, list[tuple[float, float]]]) -> DataFrame:
    if zones:
        values = _in_zones(df, columns, zones)
    else:
        entries = F.array(*[F.struct(F.lit(i).alias("slot"), number(c).alias("value")) for i, c in enumerate(columns)])
        values = df.select(F.inline(entries)).filter("value is not null")
    mark = ["beyond"] if zones else []
    counted = values.groupBy("slot", "value", *mark).agg(F.count("*").alias("n"))
    name = F.array(*[F.lit(c) for c in columns])[F.col("slot")]
    counted = counted.select(name.alias("column_name"), "value", *mark, "n")
    placed = running_total(counted, "column_name", [F.col(c) for c in ("value", *mark)], F.col("n"), "last")
    size = placed.groupBy("column_name").agg(F.max("last").alias("size"))
    wanted = size.select("column_name", "size", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    wanted = wanted.withColumn("position", (F.col("size") - 1) * F.col("prob"))
    wanted = wanted.withColumns({"low": F.floor("position"), "high": F.ceil("position")})
    # As many rows as columns times probabilities.
    met = placed.join(F.broadcast(wanted), "column_name")
    first = F.col("last") - F.col("n")

    def at(rank: str, column: str = "value") -> Column:
        return F.max(F.when((first <= F.col(rank)) & (F.col(rank) < F.col("last")), F.col(column)))

    off = at("low", "beyond") | at("high", "beyond") if zones else F.lit(False)
    found = met.groupBy("column_name", "prob", "position", "low").agg(at("low").alias("lower"), at("high").alias("upper"), off.alias("beyond"))
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * (F.col("position") - F.col("low"))
    value = F.when(F.col("lower") == F.col("upper"), F.col("lower")).otherwise(between)
    return found.select("column_name", "prob", value.alias("value"), "beyond")
