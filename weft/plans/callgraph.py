"""The customer call network, derived from the driver tables.

Every order is one purchase: of the part on its first line, with the units of
all its lines, at its earliest ship date; the parts of its other lines link nobody.
A "call" goes from the buyer to the next buyer of the same part (by date, then
order key).  Customers are the vertices; their attributes stand in
for the telecom customer table (monthly charges = account balance, total
charges = sum of order totals, tenure = days since the first order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.graph import PropertyGraph
from weft.operators.iterate import shared_path
from weft.operators.sequence import next_in_key
from weft.sources.tables import path_stamp, table

# Fixed values of the derivation (shared with the SQL oracle).
TENURE_END = "2001-08-01"   # last order date in the data
CHURN_BEFORE = "2001-01-01"  # last order before this date => churned
PHONE_PREFIX = "P"


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, from all of its lines; ``returned`` is the greatest
    return flag (R if any line came back)."""
    first = F.min(F.struct("l_linenumber", "l_partkey"))["l_partkey"]
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        first.alias("part"), F.sum("l_quantity").cast("long").alias("units"),
        F.min("l_shipdate").alias("shipped"), F.max("l_returnflag").alias("returned"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        "part", "shipped", "l_orderkey", "units", "returned", "o_custkey")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call rows (caller custkey, callee custkey, time, duration, returned)."""
    # (part, shipped, l_orderkey) is a total order: one row per order
    nxt = next_in_key(purchases(spark, sf_dir), "part", ["shipped", "l_orderkey"], "o_custkey", "callee")
    return nxt.where(F.col("callee").isNotNull()).select(
        F.col("o_custkey").alias("caller"),
        F.col("callee"),
        F.col("shipped").alias("datatime"),
        F.col("units").alias("duration"),
        F.col("returned"),
    )


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call log with phone numbers, as the telecom input has it."""
    return calls(spark, sf_dir).select(
        F.col("datatime"),
        F.concat(F.lit(PHONE_PREFIX), F.col("caller").cast("string")).alias("caller_mobile_number"),
        F.concat(F.lit(PHONE_PREFIX), F.col("callee").cast("string")).alias("callee_mobile_number"),
        F.col("duration"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct directed edges (src, dst, relationship).

    relationship = 'follow' when any call on the pair came from an order of
    which nothing was returned, else 'friend' (the greatest label).
    """
    c = calls(spark, sf_dir)
    return c.groupBy(F.col("caller").alias("src"), F.col("callee").alias("dst")).agg(
        F.min(F.col("returned") == "R").alias("_all")
    ).select("src", "dst", F.when(F.col("_all"), "friend").otherwise("follow").alias("relationship"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer table (one row per customer) with the telecom-style columns."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    od = table(spark, sf_dir, "orders")
    stats = od.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("total_charges"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"),
    )
    # nation and region are fixed-size dimensions; no hint: the planner
    # broadcasts them from their measured size (autoBroadcastJoinThreshold)
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    out = (
        cust.join(stats, cust.c_custkey == stats.o_custkey, "left")
        .join(geo, cust.c_nationkey == geo.n_nationkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.col("last_priority").alias("priority"),
            F.col("c_acctbal").alias("monthly_charges"),
            F.round(F.col("total_charges"), 2).alias("total_charges"),
            F.datediff(F.lit(TENURE_END).cast("date"), F.col("first_order").cast("date"))
            .cast("long").alias("tenure"),
            F.when(F.col("last_order").isNull() | (F.col("last_order") < F.lit(CHURN_BEFORE).cast("timestamp_ntz")), "Yes")
            .otherwise("No").alias("churn"),
            F.concat(F.lit(PHONE_PREFIX), F.col("c_custkey").cast("string")).alias("mobile_number"),
        )
    )
    return out


def phone_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, mobile_number) of the customers that are listed: those
    without debts."""
    listed = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    key = F.col("c_custkey")
    return listed.select(key.alias("customer_id"), F.concat(F.lit(PHONE_PREFIX), key.cast("string")).alias("mobile_number"))


def customers_with_numbers(customers: DataFrame, directory: DataFrame) -> DataFrame:
    """All customers with the number that the directory has for them."""
    return customers.drop("mobile_number").join(directory, "customer_id", "left")


def calls_by_month(log: DataFrame) -> DataFrame:
    """(month, calls, duration) of a call log whose ``datatime`` is text in
    the default timestamp format; text that is no time counts under null."""
    time = F.try_to_timestamp(F.col("datatime"))
    return log.groupBy(F.date_format(time, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("calls"), F.sum("duration").alias("duration"))


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).drop("mobile_number").withColumnRenamed("customer_id", "id")


def customer_graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """The graph as a lazy derivation from the driver tables."""
    return PropertyGraph(vertices(spark, sf_dir), edges(spark, sf_dir))


_SILVER: dict = {}
_INPUTS = ("lineitem", "orders", "customer", "nation", "region")


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    return tuple(path_stamp(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in _INPUTS)


def silver_graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Vertices and edges written once as parquet tables in the shared folder
    and read back — the silver layer every later graph job starts from.

    The derivation (a range shuffle of the purchases plus a window) then runs
    once per session and input, not once per query; the tables live in the
    shared checkpoint area, so they outlive lost executors.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip('/'), _stamp(spark, sf_dir))
    root = _SILVER.get(key)
    if root is None:
        root = shared_path(spark, "silver-graph")
        vertices(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/vertices")
        edges(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/edges")
        _SILVER[key] = root
    return PropertyGraph(spark.read.parquet(f"{root}/vertices"), spark.read.parquet(f"{root}/edges"))


def edges_from_call_log(
    call_log: DataFrame, directory: DataFrame, drop_unmatched: bool = False
) -> DataFrame:
    """Directed (src, dst) customer pairs from a call log and a phone directory.

    ``directory`` has (customer_id, mobile_number).  Calls are first reduced
    to distinct number pairs (a call log repeats pairs many times, so this
    partial aggregation shrinks the data before any join shuffles it), then
    both numbers are mapped to customers.  With ``drop_unmatched=False`` an
    unknown number gives a null endpoint, as in the original pipeline.
    """
    how = "inner" if drop_unmatched else "left"
    pairs = call_log.select("caller_mobile_number", "callee_mobile_number").distinct()
    a = directory.select(F.col("mobile_number").alias("_m1"), F.col("customer_id").alias("src"))
    b = directory.select(F.col("mobile_number").alias("_m2"), F.col("customer_id").alias("dst"))
    x = pairs.join(a, pairs.caller_mobile_number == a._m1, how)
    y = x.join(b, x.callee_mobile_number == b._m2, how)
    return y.select("dst", "src").dropDuplicates()
