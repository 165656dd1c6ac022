"""Plans, skew and independence of partitioning."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from stagefare.catalog.fixture import raw_listings
from stagefare.columns import MAX_PRICE
from stagefare.functions.joins import Lookup, look_up, measure
from stagefare.functions import running
from stagefare.functions.running import quantiles, running_total
from stagefare.operators.profile import profile_numeric
from stagefare.operators.category_index import apply_index, category_index, slots
from stagefare.operators import reports
from stagefare.operators.encoding import MeanEncoder, encoding_map
from stagefare.operators.rows import hash_split
from stagefare.plans import training
from stagefare.plans.cleaning import clean_table
from stagefare.sources.scratch import materialize, shared_dir


def test_no_python_in_plans(spark, sf_dir, cleaned):
    for df in (
        clean_table(raw_listings(spark, sf_dir)),
        reports.report_secondary_market(cleaned),
        encoding_map(training.labelled(cleaned, MAX_PRICE), MAX_PRICE),
    ):
        assert "Python" not in plan_of(df)


def test_dedup_shrinks_before_its_only_shuffle(spark, sf_dir):
    plan = plan_of(clean_table(raw_listings(spark, sf_dir)))
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "partial_max" in below


def test_encoding_map_reads_once(spark, cleaned):
    plan = plan_of(encoding_map(training.labelled(cleaned, MAX_PRICE), MAX_PRICE))
    assert plan.count("FileScan") == 1


def test_report_reads_only_its_columns(cleaned):
    plan = plan_of(reports.report_year_genre(cleaned))
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"genre", "tm_min_price", "spotify_popularity"}


def test_top_k_is_not_a_full_sort(cleaned):
    assert "TakeOrderedAndProject" in plan_of(reports.report_top_cities(cleaned))


def test_label_filter_is_pushed_down(cleaned):
    plan = plan_of(training.labelled(cleaned, MAX_PRICE))
    assert "GreaterThan(tm_max_price,0.0)" in plan


def test_split_ignores_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("event_id"))
    sides = [
        {r.event_id for r in hash_split(df.repartition(n), "event_id")[0].collect()} for n in (1, 7)
    ]
    assert sides[0] == sides[1] and 0.75 < len(sides[0]) / 2000 < 0.85
    train, test = hash_split(df, "event_id")
    assert train.count() + test.count() == 2000


def _skewed(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("city"), F.col("id").cast("double").alias("x"))
    rest = spark.range(3000).select(
        F.concat(F.lit("c"), F.col("id") % 50).alias("city"), F.col("id").cast("double").alias("x")
    )
    none = spark.range(500).select(F.lit(None).cast("string").alias("city"), F.lit(1.0).alias("x"))
    return hot.unionByName(rest).unionByName(none)


def test_look_up_small_and_large_agree_on_hot_keys(spark):
    rows = _skewed(spark)
    table = materialize(
        rows.filter("city is not null").groupBy("city").agg(F.avg("x").alias("m")).withColumnRenamed("city", "key"),
        "lookup-test",
    )
    lookup = measure(table, "key")
    assert 51 * 64 < lookup.size_bytes < 51 * 200
    small = look_up(rows, lookup, "city")
    large = look_up(rows, lookup, "city", limit=0)
    assert "BroadcastHashJoin" in plan_of(small)
    assert "SortMergeJoin" in plan_of(large)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert small.count() == 6500


def test_large_look_up_splits_a_hot_key(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("city"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    table = materialize(rows.select(F.col("city").alias("key")).distinct().withColumn("m", F.lit(1)), "hot-test")
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "20",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        # Several map tasks, as the split is along map outputs.
        joined = look_up(rows.repartition(8), Lookup(table, "key", 0), "city", limit=-1)
        assert joined.filter("m = 1").count() == 200_000
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_exact_quantiles(spark):
    rng = random.Random(5)
    values = [round(rng.gauss(100, 30), 2) for _ in range(3000)] + [77.0] * 1500
    other = [float(rng.randint(0, 3)) for _ in values]
    data = [(v, o, None) for v, o in zip(values, other)] + [(float("nan"), None, None), (float("inf"), None, None)]
    df = spark.createDataFrame(data, "v double, o double, none double").repartition(6)
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.column_name, r.prob): r.value for r in quantiles(df, ["v", "o", "none"], probs).collect()}
    for name, column in (("v", sorted([*values, float("inf")])), ("o", sorted(other))):
        for p in probs:
            at = (len(column) - 1) * p
            low = column[int(at)]
            high = column[min(int(at) + 1, len(column) - 1)]
            want = low if low == high else low + (high - low) * (at - int(at))
            assert got[(name, p)] == pytest.approx(want, abs=1e-9)
    assert len(got) == 2 * len(probs)
    assert got[("o", 0.5)] == pytest.approx(statistics.median(other))


def test_quantiles_of_many_values_count_those_near_them(spark, monkeypatch):
    """Zones about the estimates: as exact as all values, in far fewer rows."""
    monkeypatch.setattr(running, "LEAST_VALUES", 3000)
    monkeypatch.setattr(running, "PARTS", 100)
    k = F.col("id")
    df = spark.range(0, 20_000, 1, 5).select(
        (k * 7919 % 20_011).cast("double").alias("v"),
        F.when(k % 4 == 0, None).when(k % 4 == 1, float("nan")).otherwise(F.exp(k / 2000) - 50).alias("some"),
        (k % 3).alias("few"),
        F.when(k < 500, k / 7).alias("rare"),
        F.lit(2.5).alias("same"),
        F.when(k % 5 == 0, float("inf")).when(k % 5 < 3, float("-inf")).otherwise(k * 1.0).alias("ends"),
        F.lit(None).cast("double").alias("none"),
    )
    columns, probs = df.columns, [0.25, 0.5, 0.75]
    want = {tuple(r) for r in quantiles(df, columns, probs).collect()}
    written, write = [], running.materialize
    monkeypatch.setattr(running, "materialize", lambda d, n: written.append(d.count()) or write(d, n))
    zones = running.quantile_zones(df, columns, probs)
    assert zones["rare"] == [(float("-inf"), float("inf"))] and len(zones["v"]) == 3 and zones["same"] == [(2.5, 2.5)]
    assert {tuple(r) for r in quantiles(df, columns, probs, zones).collect()} == want and len(want) == 3 * 6
    assert written[0] < 20_000 / 2
    # Where estimates were off, all values are counted.
    wrong = {**zones, "v": [(5.0, 9.0)]}
    assert {tuple(r) for r in quantiles(df, columns, probs, wrong).collect()} == want
    assert running.quantile_zones(df.limit(100), columns, probs) == {}


def test_profiles_of_many_rows_deal_few_values(spark, monkeypatch):
    df = spark.range(0, 20_000, 1, 5).select((F.col("id") * 7919 % 20_011).alias("v"))
    want = sorted(map(tuple, profile_numeric(df).collect()))
    monkeypatch.setattr(running, "LEAST_VALUES", 3000)
    monkeypatch.setattr(running, "PARTS", 100)
    dealt, write = [], running.materialize
    monkeypatch.setattr(running, "materialize", lambda d, n: dealt.append(d.count()) or write(d, n))
    assert sorted(map(tuple, profile_numeric(df).collect())) == want
    assert dealt[0] < 20_000 / 2


def test_running_totals_span_tasks(spark):
    rows = [(g, k, k % 5) for g in ("a", "b", None) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, w int").repartition(7)
    found = running_total(df, "g", [-F.col("k")], F.col("w"), "s")
    assert "SinglePartition" not in plan_of(found)
    for g in ("a", "b", None):
        total = 0
        for r in sorted((r for r in found.collect() if r.g == g), key=lambda r: -r.k):
            total += r.w
            assert r.s == total


def test_running_totals_deal_only_the_rows_own_columns(spark, monkeypatch):
    dealt = []

    def noted(df, name):
        dealt.append(df.columns)
        return materialize(df, name)

    monkeypatch.setattr("stagefare.functions.running.materialize", noted)
    found = quantiles(spark.createDataFrame([(1.0,), (3.0,), (3.0,)], "v double"), ["v"], [0.25])
    assert [r["value"] for r in found.collect()] == [2.0]
    assert dealt == [["column_name", "value", "n", "__part"]]


def test_category_index_by_frequency_and_name(spark):
    rows = [("x", "m")] * 5 + [("y", "m")] * 5 + [("z", "n")] * 9 + [(None, "n")] * 3
    df = spark.createDataFrame(rows, "one string, two string").repartition(4)
    index = category_index(df, ("one", "two"))
    assert {(r.dim, r.key): (r["index"], r["rows"]) for r in index.collect()} == {
        ("one", "z"): (0, 9), ("one", "x"): (1, 5), ("one", "y"): (2, 5), ("two", "n"): (0, 12), ("two", "m"): (1, 10)
    }
    new = spark.createDataFrame([("x", "?"), (None, "n")], "one string, two string")
    assert sorted(map(tuple, apply_index(new, index, ("one", "two")).select("one_idx", "two_idx").collect())) == [(1.0, 2.0), (3.0, 0.0)]
    assert slots(index, ("one", "two")) == {"one": 3, "two": 2}
    none = category_index(df.limit(0), ("one",))
    assert [r.one_idx for r in apply_index(df, none, ("one",)).collect()] == [0.0] * 22


def test_encoding_same_by_broadcast_and_shuffle(spark, cleaned):
    rows = training.labelled(cleaned, MAX_PRICE)
    encoding = MeanEncoder(MAX_PRICE).fit(rows)
    one = encoding.transform(rows).drop("event_date")
    other = encoding.transform(rows, broadcast_limit=0).drop("event_date")
    assert one.exceptAll(other).count() == 0 and one.count() == other.count()


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_dedup_shuffles_no_derived_columns(spark, sf_dir):
    plan = plan_of(clean_table(raw_listings(spark, sf_dir)))
    below = plan.split("Exchange hashpartitioning(event_id", 1)[1]
    assert "price_range" not in below and "is_weekend" not in below


def test_small_supplier_table_is_broadcast_whatever_sparks_threshold(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(raw_listings(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join [l_suppkey" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
