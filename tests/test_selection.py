"""Numbering, exact quantiles, samples of exact size, category order."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from weft.operators.sequence import numbered
from weft.plans.profile import categories_by_total, profile_quantiles, sample_rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_numbered(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.randint(0, 50)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(partitions)
    got = numbered(df, [F.desc("v")], "place").collect()
    assert sorted(r.place for r in got) == list(range(1000))
    assert [r.v for r in sorted(got, key=lambda r: r.place)] == sorted((v for _, v in rows), reverse=True)
    per = collections.defaultdict(list)
    for r in numbered(df, [F.col("v")], "place", within=["g"]).collect():
        per[r.g].append((r.place, r.v))
    for g, cells in per.items():
        assert [v for _, v in sorted(cells)] == sorted(v for x, v in rows if x == g)
        assert sorted(p for p, _ in cells) == list(range(len(cells)))
    assert numbered(df.limit(0), [F.col("v")]).collect() == []


def test_numbered_spreads_a_hot_group_of_equal_rows(spark):
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 > 0, F.lit("same")).otherwise(
        F.col("id").cast("string")).alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = numbered(df, [F.col("g")], "place").select((F.col("place") / 3000).cast("int").alias("r")).distinct().count()
        assert ranges == 10
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_quantiles_are_exact(spark):
    rng = random.Random(2)
    x = [rng.choice([None, 1.0, rng.gauss(0, 100)]) for _ in range(30_000)]
    df = spark.createDataFrame([(v, 7, None) for v in x], "x double, same int, none double").repartition(6)
    got = {r["column"]: r for r in profile_quantiles(df, ["x", "same", "none"], (0.1, 0.25, 0.5, 0.99)).collect()}
    known = sorted(v for v in x if v is not None)
    for p in (0.1, 0.25, 0.5, 0.99):
        assert got["x"][f"p{round(p * 100)}"] == known[math.ceil(p * len(known)) - 1]
    assert (got["same"].p10, got["same"].p99, got["none"].p50) == (7.0, 7.0, None)


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("k"), F.lit("x").alias("s"))
    df = df.unionByName(df.limit(1000).select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("k"), "s"))

    def drawn(parts, **how):
        return sorted(map(tuple, sample_rows(df.repartition(parts), 800, seed=5, **how).collect()))

    again = drawn(3)
    assert len(again) == 800 and again == drawn(17) and len(set(again)) < 800
    once = drawn(3, with_replacement=False)
    assert len(once) == 800 and once == drawn(17, with_replacement=False)
    assert len(drawn(4, key=["id"])) == 800
    assert sample_rows(df.limit(0), 5).count() == 0
    assert sample_rows(df, 10_000, with_replacement=False).count() == 6000


def test_categories_by_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1), (None, 2)], "c string, d int")
    got = sorted((r.place, r.c, r.d, r.n, r.total) for r in categories_by_total(df, "c", "d").collect())
    assert got == [(1, None, 1, 2, 3), (1, None, 2, 1, 3), (2, "a", 1, 1, 2), (2, "a", 2, 1, 2), (3, "b", 1, 1, 1)]
