"""The activity path run as streams: raw folders -> bronze -> silver -> features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators.iterate import shared_path
from weft.plans import activity as act
from weft.sources.sinks import read_table
from weft.streaming.ingest import await_all, ingest_folder, stream_table

DROPS = (1997, 2000)  # years at which the second and the third drop of orders begin
USERS_SCHEMA = (
    "id BIGINT, firstname STRING, lastname STRING, email STRING, canal STRING, country STRING, "
    "creation_date STRING, last_activity_date STRING, gender DOUBLE, age_group DOUBLE"
)
LABELLED_USERS_SCHEMA = USERS_SCHEMA + ", address STRING, churn BOOLEAN"
ORDERS_SCHEMA = "user_id BIGINT, id BIGINT, transaction_date STRING, item_count DOUBLE, amount DOUBLE"
EVENTS_SCHEMA = (
    "user_id BIGINT, event_id BIGINT, platform STRING, date STRING, action STRING, "
    "session_id STRING, url STRING"
)


def write_raw_folders(spark: SparkSession, sf_dir: str, root: str, users: DataFrame | None = None) -> None:
    """Land the raw inputs as the source system does: users and orders as
    JSON lines, events as CSV with a header."""
    (users if users is not None else act.raw_users(spark, sf_dir)).write.mode("overwrite").json(f"{root}/users")
    act.raw_orders(spark, sf_dir).write.mode("overwrite").json(f"{root}/orders")
    act.raw_events(spark, sf_dir).write.mode("overwrite").option("header", True).csv(f"{root}/events")


def run(spark: SparkSession, sf_dir: str, root: str | None = None, land_raw: bool = True,
        labelled: DataFrame | None = None) -> dict[str, str]:
    """Run every stream once; returns the table folders.  Re-running on the
    same root only picks up files not yet committed in the checkpoints.
    ``labelled`` users (with address and churn) take the place of the raw ones."""
    root = root or shared_path(spark, "activity")
    users_schema = USERS_SCHEMA if labelled is None else LABELLED_USERS_SCHEMA
    if land_raw:
        write_raw_folders(spark, sf_dir, f"{root}/raw", labelled)
    t = {k: f"{root}/tables/{k}" for k in ("users_bronze", "orders_bronze", "events", "users", "orders")}
    ck = f"{root}/checkpoints"
    await_all(
        ingest_folder(spark, f"{root}/raw/orders", "json", t["orders_bronze"], f"{ck}/orders_bronze", ORDERS_SCHEMA),
        ingest_folder(spark, f"{root}/raw/events", "csv", t["events"], f"{ck}/events", EVENTS_SCHEMA),
        ingest_folder(spark, f"{root}/raw/users", "json", t["users_bronze"], f"{ck}/users_bronze", users_schema),
    )
    await_all(
        stream_table(spark, t["users_bronze"], act.users_silver, t["users"], f"{ck}/users"),
        stream_table(spark, t["orders_bronze"], act.orders_silver, t["orders"], f"{ck}/orders"),
    )
    return t


def features(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    users = spark.read.parquet(tables["users"])
    orders = spark.read.parquet(tables["orders"])
    events = spark.read.parquet(tables["events"]).drop("_rescued_data")
    return act.churn_features(users, orders, events)


def orders_with_new_fields(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """Orders that land in three drops, by order date, each ingested by a run
    of its own: the first without, the others with the fields ``status`` and
    ``urgency``, which no schema names."""
    from weft.sources.tables import table

    root = root or shared_path(spark, "evolving")
    priority = F.col("o_orderpriority")
    whole = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"),
        F.substring(priority, 1, 1).cast("int").alias("urgency"))
    known = ["user_id", "id", "amount"]
    drops = [whole.where(F.col("year") < DROPS[0]).select(known),
             whole.where((F.col("year") >= DROPS[0]) & (F.col("year") < DROPS[1])).drop("year"),
             whole.where(F.col("year") >= DROPS[1]).drop("year")]
    for drop in drops:
        drop.write.mode("append").json(f"{root}/raw")
        await_all(ingest_folder(spark, f"{root}/raw", "json", f"{root}/orders", f"{root}/checkpoint",
                                hints="user_id BIGINT, id BIGINT, amount DOUBLE"))
    return read_table(spark, f"{root}/orders")
