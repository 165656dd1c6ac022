"""Target-mean encoding of categories.

The fitted map is one long table ``(dim, key, avg_price, n, total)``; the overall
mean is its row with dim ``global``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagefare.columns import ENCODED_DIMS, Label, mean_column
from stagefare.functions.joins import Lookup, look_up, measure_dims
from stagefare.sources.scratch import materialize

GLOBAL = "global"
MAP_SCHEMA = "key string, avg_price double, n bigint, total double, dim string"


def encoding_map(
    train: DataFrame, label: Label | str, dims: tuple[str, ...] = ENCODED_DIMS
) -> DataFrame:
    """Mean label per category of each dim and overall, in one scan.

    Rows are first summed per combination of categories, so the expansion into
    one group per dim happens on combinations, not on rows; both steps combine
    within tasks before the shuffle.
    """
    price = F.col(label.column if isinstance(label, Label) else label)
    combos = train.groupBy(*dims).agg(F.sum(price).alias("total"), F.count(price).alias("n"))
    grouped = combos.groupingSets([*[[d] for d in dims], []], *dims).agg(
        *[F.grouping(d).alias(f"__off_{d}") for d in dims],
        F.sum("total").alias("total"),
        F.sum("n").alias("n"),
    )
    dim, key = F.lit(GLOBAL), F.lit(GLOBAL)
    for d in dims:
        chosen = F.col(f"__off_{d}") == 0
        dim = F.when(chosen, F.lit(d)).otherwise(dim)
        key = F.when(chosen, F.col(d).cast("string")).otherwise(key)
    return grouped.select(
        dim.alias("dim"),
        key.alias("key"),
        F.try_divide("total", "n").alias("avg_price"),
        F.col("n").cast("bigint").alias("n"),
        F.col("total").cast("double").alias("total"),
    )


@dataclass
class MeanEncoding:
    """A fitted encoding: the map of each dim with its size, and the overall mean."""

    table: DataFrame
    dims: tuple[str, ...]
    lookups: dict[str, Lookup]
    global_mean: float | None
    label: str

    @classmethod
    def of(cls, table: DataFrame, label: Label | str, dims: tuple[str, ...] = ENCODED_DIMS):
        """From a written map table."""
        name = label.column if isinstance(label, Label) else label
        lookups = measure_dims(table, dims)
        overall = table.filter(F.col("dim") == GLOBAL).select("avg_price").first()
        return cls(table, dims, lookups, overall[0] if overall else None, name)

    def transform(
        self,
        df: DataFrame,
        leave_one_out: Column | bool = False,
        broadcast_limit: int | None = None,
    ) -> DataFrame:
        """Add ``<dim>_avg_price``: the category's mean, else the overall mean, else 0.

        ``leave_one_out`` takes a row's own label out of its mean. It is for the
        rows the encoding was fitted on; a condition names them in a mixed table.
        """
        if isinstance(leave_one_out, bool):
            leave_one_out = F.lit(True) if leave_one_out else None
        out = df
        for d in self.dims:
            lookup = self.lookups[d]
            renamed = lookup.table.select("key", self._known(leave_one_out).alias(f"__known_{d}"))
            out = look_up(out, Lookup(renamed, "key", lookup.size_bytes), d, broadcast_limit)
        columns = {mean_column(d): self._value(d, leave_one_out) for d in self.dims}
        return out.withColumns(columns).drop(*[f"__known_{d}" for d in self.dims])

    @staticmethod
    def _known(leave_one_out: Column | None) -> Column:
        if leave_one_out is None:
            return F.col("avg_price")
        return F.struct("avg_price", "total", "n")

    def _value(self, dim: str, leave_one_out: Column | None) -> Column:
        mean = known = F.col(f"__known_{dim}")
        if leave_one_out is not None:
            others = F.try_divide(known["total"] - F.col(self.label), known["n"] - 1)
            mean = F.when(leave_one_out, others).otherwise(known["avg_price"])
        return F.coalesce(mean, F.lit(self.global_mean).cast("double"), F.lit(0.0))


@dataclass(frozen=True)
class MeanEncoder:
    """Estimator of :class:`MeanEncoding`."""

    label: Label
    dims: tuple[str, ...] = ENCODED_DIMS

    def fit(self, train: DataFrame) -> MeanEncoding:
        table = encoding_map(train, self.label, self.dims)
        return MeanEncoding.of(materialize(table, "encoding"), self.label, self.dims)


def with_joint_key(df: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """Add a category made of several columns, to keep cities of the same name apart."""
    return df.withColumn(name, F.concat_ws(", ", *columns))


def save_encoding(encoding: MeanEncoding, path: str) -> None:
    encoding.table.write.mode("overwrite").partitionBy("dim").parquet(path)


def load_encoding(
    spark: SparkSession, path: str, label: Label, dims: tuple[str, ...] = ENCODED_DIMS
) -> MeanEncoding:
    table = spark.read.schema(MAP_SCHEMA).parquet(path)
    return MeanEncoding.of(table, label, dims)
