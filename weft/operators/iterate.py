"""Loop support shared by every iterative operator.

Iterative graph algorithms run one Spark job per round, driven by a short
Python loop (the loop is over rounds, never over data).  Two things keep
such loops healthy at scale:

* the static side (edges) is hash-partitioned on its join key and persisted
  once, so each round only shuffles the small vertex state;
* the growing lineage is cut with a *reliable* ``checkpoint()`` into the
  shared folder named by ``spark.checkpoint.dir``.  A reliable checkpoint
  survives the loss of executors; ``localCheckpoint`` would not, so it is
  never used.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Order: the directory already set on the SparkContext, then the
    ``spark.checkpoint.dir`` setting.  Only a local-mode session (tests,
    single-node runs) may fall back to a fresh temporary folder; a cluster
    session without a shared folder is an error, since a machine-local
    folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weft-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators need a shared folder"
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint area (tables, stream state)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/weft-{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and return a frame with a one-step lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin(df: DataFrame) -> DataFrame:
    """Persist a frame that every round reads (memory, spilling to disk)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def state_partitions(spark: SparkSession, rows: int | None = None) -> int:
    """Partition count for pinned edge layouts and per-round vertex state.

    Sized from the data when its row count is known: about
    ``weft.rowsPerPartition`` rows (default 50,000) per partition, at least
    one partition per core, at most ``spark.sql.shuffle.partitions``.
    Keeping edges and state on the same count lets the per-round join reuse
    the edges' partitioning instead of shuffling them again.
    """
    conf_n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        return conf_n
    per = int(spark.conf.get("weft.rowsPerPartition", "50000"))
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(conf_n, max(cores, -(-rows // per))))


class Rounds:
    """Helper that decides when a loop cuts its lineage."""

    def __init__(self, every: int = 3):
        self.every = max(1, every)

    def step(self, df: DataFrame, i: int) -> DataFrame:
        return cut(df) if (i + 1) % self.every == 0 else df


@contextmanager
def fixed_layout(spark: SparkSession):
    """Plan with adaptive execution off, so a frame pinned inside keeps a
    partitioning the planner can see; later adaptive joins then reuse it
    instead of shuffling the frame again.  Restores the setting after."""
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def broadcast_state_rows(spark: SparkSession) -> int:
    """Row limit under which per-round vertex state is broadcast
    (``weft.broadcastStateRows``, default 2,000,000 rows)."""
    return int(spark.conf.get("weft.broadcastStateRows", "2000000"))


def broadcast_state_bytes(spark: SparkSession) -> int:
    """Byte limit for a broadcast state (``weft.broadcastStateBytes``,
    default 64 MiB), checked against rows x estimated row width."""
    return int(spark.conf.get("weft.broadcastStateBytes", str(64 << 20)))


def row_width(dt: T.DataType) -> int:
    """Estimated bytes of one value of ``dt`` (strings and binaries 20,
    arrays and maps as one element; an upper-end guess, like Spark's
    default sizes)."""
    if isinstance(dt, T.StructType):
        return sum(row_width(f.dataType) for f in dt.fields) or 1
    if isinstance(dt, T.ArrayType):
        return row_width(dt.elementType)
    if isinstance(dt, T.MapType):
        return row_width(dt.keyType) + row_width(dt.valueType)
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return 20
    if isinstance(dt, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    return 8


def state_fits_broadcast(state: DataFrame, rows: int | None) -> bool:
    """True when a state of exactly ``rows`` rows is within both limits."""
    if rows is None:
        return False
    spark = state.sparkSession
    return rows <= broadcast_state_rows(spark) and rows * row_width(state.schema) <= broadcast_state_bytes(spark)


class KeyedEdges:
    """The static edge side of a per-round join, laid out once.

    Edges are hash-partitioned on ``(key, _salt)`` and pinned.  ``_salt`` is 0
    except for hub keys — keys with more than ``|E| / (n * hub_factor)`` edges
    (at most ``n * hub_factor`` of them) — whose edges are spread over
    ``ceil(4 * degree / (|E| / n))`` salts (capped at ``n``), so a hot key is
    cut into pieces of about a quarter of a balanced partition and no task
    holds much more than ``|E| / n`` edges.  The (hub, salt) table has at most
    about ``n * (4 + hub_factor)`` rows: a proven bound, so it is broadcast.

    Each round only the vertex state moves: hub rows are replicated once per
    salt through that small table and the state is shuffled to the edges'
    layout; the edges never shuffle again.
    """

    def __init__(self, edges: DataFrame, key: str, partitions: int | None = None, hub_factor: int = 4):
        spark = edges.sparkSession
        self.key = key
        total = edges.count()
        self.rows = total
        self.n = n = partitions or state_partitions(spark, total)
        piece = max(1, total // (4 * n))  # a quarter of a balanced partition
        threshold = max(1, total // (n * hub_factor))
        deg = edges.groupBy(F.col(key).alias("_hk")).agg(F.count(F.lit(1)).alias("_d"))
        hubs = deg.where(F.col("_d") > threshold).select(
            "_hk", F.least(F.lit(n), F.ceil(F.col("_d") / F.lit(piece))).cast("int").alias("_ns")
        )
        self.salts = cut(hubs.select("_hk", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1)).alias("_hs")))
        self.hubs = self.salts.groupBy("_hk").agg(F.count(F.lit(1)).cast("int").alias("_ns"))
        others = [c for c in edges.columns if c != key]
        spread = F.xxhash64(*[F.col(c) for c in others]) if others else F.lit(0)
        salted = edges.join(F.broadcast(self.hubs), edges[key] == F.col("_hk"), "left").select(
            *edges.columns,
            F.when(F.col("_hk").isNotNull(), F.pmod(spread, F.col("_ns").cast("long"))).otherwise(F.lit(0))
            .cast("int").alias("_salt"),
        )
        with fixed_layout(spark):
            self.df = pin(salted.repartition(n, key, "_salt").sortWithinPartitions(key, "_salt"))

    def spread_state(self, state: DataFrame, state_key: str = "id") -> DataFrame:
        """State rows with ``_ssalt``: one row per salt for hubs, else salt 0."""
        s = state.join(F.broadcast(self.salts), state[state_key] == F.col("_hk"), "left")
        return s.select(*state.columns, F.coalesce(F.col("_hs"), F.lit(0)).alias("_ssalt"))

    def join(self, state: DataFrame, state_key: str = "id", how: str = "inner",
             state_rows: int | None = None) -> DataFrame:
        """Edges joined with the per-key state (edges keep their layout).

        When the caller knows the state's exact row count and both the rows
        and rows x row width are within the limits (``state_fits_broadcast``),
        the state is broadcast (a proven size bound) and the edges are
        streamed in place; otherwise the state is spread over the salts and
        shuffled to the edges' layout.
        """
        if state_fits_broadcast(state, state_rows):
            cond = self.df[self.key] == state[state_key]
            return self.df.join(F.broadcast(state), cond, how).drop("_salt")
        s = self.spread_state(state, state_key)
        cond = (self.df[self.key] == s[state_key]) & (self.df["_salt"] == s["_ssalt"])
        return self.df.join(s, cond, how).drop("_salt", "_ssalt")

    def extend(self, state: DataFrame, columns: list[str], state_key: str = "id") -> None:
        """Add columns of a per-key table to the edges for good; they keep
        their layout."""
        old = self.df
        s = self.spread_state(state, state_key)
        same = (old[self.key] == s[state_key]) & (old["_salt"] == s["_ssalt"])
        with fixed_layout(state.sparkSession):
            self.df = pin(old.join(s, same).select(*columns, "_salt"))
            self.df.count()
        old.unpersist()

    def unpersist(self) -> None:
        self.df.unpersist()
