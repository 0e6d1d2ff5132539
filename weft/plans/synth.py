"""Synthetic users / orders / events, generated as Spark jobs.

Every random draw is a seeded hash of the row's key (``xxhash64``), so the
data is the same whatever the partitioning and survives recomputation after
an executor loss; ``rand()`` would not.  Users come from one ``range``
(cohorts by arithmetic, no union of 24 frames); each user's orders come from
``explode(sequence(...))`` of a per-user count, never from a driver loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the generator
FIRST_COHORT = 133
COHORTS = 23            # monthly cohorts after the first
COHORT_BASE = 2000
COHORT_STEP = 200
CANALS = [("WEBAPP", 0.5), ("MOBILE", 0.1), ("PHONE", 0.3), (None, 0.01)]
COUNTRIES = ["FR", "USA", "SPAIN"]
PLATFORMS = [("ios", 0.5), ("android", 0.1), ("other", 0.3), (None, 0.01)]
ACTIONS = [("view", 0.5), ("log", 0.1), ("click", 0.3), (None, 0.01)]
NULL_ID_RATE = 0.02
ORDERS_MEAN, ORDERS_STD = 3.0, 2.0
DATE_FORMAT = "MM-dd-yyyy HH:mm:ss"


def cohort_bounds() -> list[int]:
    """Cumulative user count at the end of each cohort (first cohort = 133)."""
    out, total = [FIRST_COHORT], FIRST_COHORT
    for i in range(1, COHORTS + 1):
        total += COHORT_BASE + COHORT_STEP * i
        out.append(total)
    return out


def uniform(key: Column, seed: int, salt: int) -> Column:
    """U[0, 1) from a hash of (key, seed, salt)."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(salt)), F.lit(1 << 31)) / float(1 << 31)


def normal(key: Column, seed: int, salt: int) -> Column:
    """N(0, 1) by Box-Muller from two hashed uniforms."""
    u1 = F.greatest(uniform(key, seed, salt), F.lit(1e-12))
    u2 = uniform(key, seed, salt + 1)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * math.pi * u2)


def weighted(u: Column, choices) -> Column:
    """Pick from (value, weight) pairs; weights are normalised."""
    total = sum(w for _, w in choices)
    expr, acc = None, 0.0
    for value, w in choices[:-1]:
        acc += w / total
        cond = u < acc
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(choices[-1][0]))


def hashed_id(key: Column, seed: int, salt: int) -> Column:
    """UUID-shaped id from a hash, null for about 2 % of rows."""
    h = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(str(salt))))
    uid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                      F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(uniform(key, seed, salt + 50) >= NULL_ID_RATE, uid)


def _date_between(u: Column, start: Column, days: Column) -> Column:
    secs = (u * days * 86400).cast("long")
    return F.date_format(F.timestamp_seconds(F.unix_timestamp(start) + secs), DATE_FORMAT)


def users(spark: SparkSession, as_of: str = "2024-02-01", seed: int = 7, partitions: int | None = None) -> DataFrame:
    """101,333 users in 24 monthly cohorts."""
    bounds = cohort_bounds()
    total = bounds[-1]
    n = partitions or max(1, spark.sparkContext.defaultParallelism)
    r = spark.range(0, total, 1, n)
    k = F.col("id")
    arr = F.array(*[F.lit(b) for b in bounds])
    cohort = F.size(F.filter(arr, lambda b: b <= k))  # 0 .. 23
    now = F.lit(as_of).cast("timestamp")
    start = F.when(cohort == 0, F.lit("2012-01-01").cast("timestamp")).otherwise(
        F.timestamp_seconds(F.unix_timestamp(now) - (F.lit(COHORTS + 1) - cohort) * 30 * 86400))
    span = F.when(cohort == 0, F.lit(1460)).otherwise(F.lit(30))
    month_start = F.date_trunc("month", now)
    first = F.concat(F.lit("user"), F.pmod(F.xxhash64(k, F.lit(seed), F.lit(1)), F.lit(5000)).cast("string"))
    last = F.concat(F.lit("name"), F.pmod(F.xxhash64(k, F.lit(seed), F.lit(2)), F.lit(5000)).cast("string"))
    return r.select(
        hashed_id(k, seed, 3).alias("id"),
        first.alias("firstname"),
        last.alias("lastname"),
        F.concat(first, F.lit("."), last, F.lit("@company.example")).alias("email"),
        F.concat(F.pmod(F.xxhash64(k, F.lit(seed), F.lit(4)), F.lit(9999)).cast("string"),
                 F.lit(" Main Street")).alias("address"),
        weighted(uniform(k, seed, 5), CANALS).alias("canal"),
        F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]),
                     (F.floor(uniform(k, seed, 6) * 3) + 1).cast("int")).alias("country"),
        _date_between(uniform(k, seed, 7), start, span).alias("creation_date"),
        _date_between(uniform(k, seed, 8), month_start, F.lit(28)).alias("last_activity_date"),
        F.round(uniform(k, seed, 9) + 0.2).alias("gender"),
        F.round(uniform(k, seed, 10) * 10).alias("age_group"),
        k.alias("_row"),
    )


def orders(users_df: DataFrame, as_of: str = "2024-02-01", seed: int = 11) -> DataFrame:
    """About max(0, N(3, 2)) - 1 orders per user (the original count rule)."""
    k = F.col("_row")
    s = F.greatest(F.lit(0.0), F.lit(ORDERS_MEAN) + F.lit(ORDERS_STD) * normal(k, seed, 1)).cast("int")
    per_user = users_df.where(F.col("id").isNotNull()).select(F.col("id").alias("user_id"), k, s.alias("_s"))
    rows = per_user.where(F.col("_s") >= 2).select(
        "user_id", "_row", F.explode(F.sequence(F.lit(1), F.col("_s") - 1)).alias("_j"))
    ok = F.concat_ws(":", F.col("_row").cast("string"), F.col("_j").cast("string"))
    month_start = F.date_trunc("month", F.lit(as_of).cast("timestamp"))
    items = F.round(uniform(ok, seed, 2) * 2) + 1
    return rows.select(
        "user_id",
        hashed_id(ok, seed, 3).alias("id"),
        _date_between(uniform(ok, seed, 4), month_start, F.lit(28)).alias("transaction_date"),
        items.alias("item_count"),
        (items * F.round(uniform(ok, seed, 5) * 30 + 10)).alias("amount"),
        ok.alias("_okey"),
    )


def events(orders_df: DataFrame, as_of: str = "2024-02-01", seed: int = 13, per_order: int = 1) -> DataFrame:
    """App events: ``per_order`` events for each order of a user (the original
    builds them from the order list, i.e. one per order)."""
    rows = orders_df.select("user_id", "_okey", F.explode(F.sequence(F.lit(1), F.lit(per_order))).alias("_e"))
    ek = F.concat_ws(":", F.col("_okey"), F.col("_e").cast("string"))
    month_start = F.date_trunc("month", F.lit(as_of).cast("timestamp"))
    path = F.concat(F.lit("http://site"), F.pmod(F.xxhash64(ek, F.lit(seed)), F.lit(50)).cast("string"),
                    F.lit(".example/p/"), F.pmod(F.xxhash64(ek, F.lit(seed), F.lit(1)), F.lit(1000)).cast("string"))
    return rows.select(
        "user_id",
        hashed_id(ek, seed, 2).alias("event_id"),
        weighted(uniform(ek, seed, 3), PLATFORMS).alias("platform"),
        _date_between(uniform(ek, seed, 4), month_start, F.lit(28)).alias("date"),
        weighted(uniform(ek, seed, 5), ACTIONS).alias("action"),
        hashed_id(ek, seed, 6).alias("session_id"),
        F.regexp_replace(path, r"https?://.*?/", "https://shop.example/").alias("url"),
    )
