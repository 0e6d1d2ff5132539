"""Table profiles and the grouped counts behind the exploration charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.operators.iterate import cut
from weft.operators.sequence import numbered


def grouped_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def share(df: DataFrame, key: str) -> DataFrame:
    """Count and share of each category.  The share's total comes from a
    window over the aggregated rows, one per category (bounded by the
    cardinality, not the data)."""
    c = grouped_counts(df, key)
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def histogram(df: DataFrame, col: str, width: float, *keys: str) -> DataFrame:
    """Counts per bin ``floor(col / width)`` (and optional keys)."""
    b = F.floor(F.col(col) / F.lit(width)).cast("long").alias("bin")
    return df.groupBy(b, *keys).agg(F.count(F.lit(1)).alias("n"))


def profile_numeric(df: DataFrame, cols, exact: bool = True) -> DataFrame:
    """One row per column: count, nulls, distinct, min, max, mean, std.

    All statistics of all columns come from one aggregate pass; the wide
    result row is unpivoted with ``stack``.  ``exact=False`` uses HyperLogLog
    (``approx_count_distinct``) so the distinct counts need no per-column
    shuffle at scale.
    """
    aggs = []
    for c in cols:
        dist = F.countDistinct(c) if exact else F.approx_count_distinct(c)
        aggs += [
            F.count(c).alias(f"{c}__n"),
            F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__nulls"),
            dist.alias(f"{c}__distinct"),
            F.min(F.col(c).cast("double")).alias(f"{c}__min"),
            F.max(F.col(c).cast("double")).alias(f"{c}__max"),
            F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
            F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__std"),
        ]
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', `{c}__n`, `{c}__nulls`, `{c}__distinct`, `{c}__min`, `{c}__max`, `{c}__mean`, `{c}__std`"
        for c in cols
    )
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) AS (`column`, n, nulls, distinct_count, min, max, mean, std)"
    )


def top_values(df: DataFrame, cols) -> DataFrame:
    """Most frequent value of each column (ties: smallest value), with count."""
    longf = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("x")).select("x.*").where(F.col("value").isNotNull())
    counts = longf.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("b")
    )
    return best.select("column", "b.value", "b.n")


def categories_by_total(df: DataFrame, key: str, *parts: str) -> DataFrame:
    """Counts ``n`` by category and ``parts`` with the category's ``total`` and
    its ``place`` from 1 by total, descending (ties: smaller category)."""
    totals = grouped_counts(df, key).withColumnRenamed("n", "total")
    placed = numbered(totals, [F.desc("total"), F.asc_nulls_first(key)]).withColumn("place", F.col("place") + 1)
    counts, named = grouped_counts(df, key, *parts), placed.withColumnRenamed(key, "_key")
    return counts.join(named, counts[key].eqNullSafe(named["_key"])).drop("_key")


def sample_rows(df: DataFrame, n: int, seed: int = 123, with_replacement: bool = True,
                key: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows, drawn with replacement, or ``n`` different ones (all,
    if there are fewer).

    Rows are placed by a seeded hash of ``key`` (default: all columns); draw i
    takes the row whose place is a seeded hash of i.  The same rows come out
    whatever the partitioning."""
    by = [F.col(c).cast("string") for c in key or df.columns]
    order = [F.md5(F.concat_ws(":", *by, F.lit(str(seed)))), F.xxhash64(*df.columns)]
    rows = numbered(df, order, "_place")
    if not with_replacement:
        return rows.where(F.col("_place") < n).drop("_place")
    total = rows.count()
    if total == 0:
        return df.limit(0)
    spark = df.sparkSession
    draws = spark.range(n).select(F.pmod(_hash60(F.concat_ws(":", "id", F.lit(str(seed)))), F.lit(total)).alias("_place"))
    return rows.join(draws, "_place").drop("_place")


def _hash60(text: Column) -> Column:
    """A 60-bit number from a text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_sample(df: DataFrame, key: str, n: int = 100, seed: int = 123) -> DataFrame:
    """Exactly min(n, rows) rows chosen by a seeded hash of the key: a top-n
    (each task keeps its best n, the driver merges n per task), repeatable
    whatever the partitioning."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def profile_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(column, p25, p50, p75), exact: the smallest value whose rank reaches
    the probability.

    A distributed selection: values are counted and range-partitioned, counts
    of the ranges before tell which range holds a wanted rank, and only those
    ranges are looked through.  No value list is gathered; a value that most
    rows share is one row."""
    names = [f"p{int(round(p * 100))}" for p in probs]
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")
    ).select("x.*").where(F.col("value").isNotNull())
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = cut(counts.repartitionByRange("column", "value").withColumn("_range", F.spark_partition_id()))
    per_column = Window.partitionBy("column")
    heads = ranged.groupBy("column", "_range").agg(F.sum("n").alias("_n")).select(
        "column", "_range", "_n", F.sum("_n").over(per_column).alias("_all"),
        F.coalesce(F.sum("_n").over(per_column.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"))
    rank = F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("_all")))
    wanted = heads.withColumn("probe", F.explode(F.array(*[
        F.struct(F.lit(nm).alias("name"), F.lit(float(p)).alias("p")) for nm, p in zip(names, probs, strict=True)])))
    wanted = wanted.select("column", "_range", "_n", "_before", "_all", "probe.*").withColumn("_rank", rank).where(
        (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
    upto = Window.partitionBy("column", "_range", "name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    found = (ranged.join(wanted.select("column", "_range", "name", "_before", "_rank"), ["column", "_range"])
             .withColumn("_reach", F.col("_before") + F.sum("n").over(upto))
             .where(F.col("_reach") >= F.col("_rank"))
             .groupBy("column").agg(*[F.min(F.when(F.col("name") == nm, F.col("value"))).alias(nm) for nm in names]))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return every.join(found, "column", "left")
