"""Skew-safe "next row within a key" (a distributed ``lead``).

``lead(v) OVER (PARTITION BY k ORDER BY o)`` makes Spark cluster every row
of one key into one task; a key holding a third of the data would then sit
in one task.  Here the rows are range-partitioned on ``(k, o)`` instead, so
a hot key is spread over many contiguous partitions.  ``lead`` is computed
inside each (partition, key) chunk, and the last row of a chunk takes the
first row of the next non-empty partition when that row has the same key.
The fix-up table has one row per partition, so its size is bounded by the
partition count, not by the data, and it is safe to broadcast.

The in-chunk ``lead`` runs as ``mapInArrow`` over the range-partitioned,
locally sorted rows.  A ``Window.partitionBy(partition id, key)`` would need
its own hash exchange (Spark cannot see that the rows already sit in those
partitions), i.e. a second full shuffle of the input; the Arrow step is a
vectorised shift per batch that moves no data and keeps every type.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from weft.operators.iterate import cut


def _lead_in_partition(key: str, value: str, out: str):
    """Per-partition step: rows arrive sorted by (key, order); ``out`` is the
    next row's ``value`` when its key is the same (nulls compare equal, as
    window partitions group them).  One batch is held back so its last row
    can look at the first row of the following batch; ``_last`` marks the
    partition's last row, whose successor is not known here."""

    def led(batch, after, last):
        k, v = (pa.concat_arrays([batch.column(c), *([after.column(c).slice(0, 1)] if after else [])])
                for c in (key, value))
        n = batch.num_rows
        here, there = k.slice(0, len(k) - 1), k.slice(1)
        both_null = pc.and_(here.is_null(), there.is_null())
        same = pc.or_(pc.fill_null(pc.equal(here, there), False), both_null)
        nxt = pc.if_else(same, v.slice(1), pa.nulls(len(same), v.type))
        if not after:  # the last row has no successor in this partition
            nxt = pa.concat_arrays([nxt, pa.nulls(1, v.type)])
        marks = pa.array([False] * (n - 1) + [last])
        return pa.RecordBatch.from_arrays([*batch.columns, nxt, marks], names=[*batch.schema.names, out, "_last"])

    def run(batches):
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                yield led(held, batch, False)
            held = batch
        if held is not None:
            yield led(held, None, True)

    return run


def next_in_key(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """Add column ``out`` = ``value`` of the next row of the same ``key``.

    Rows tied on ``(key, *order)`` must carry the same ``value`` for the
    result to be deterministic (true for the call-graph derivation).
    """
    sort_cols = [key, *order]
    # Both branches below (the lead and the partition heads) must see the same
    # ranges; bounds are sampled per exchange, so the ranged rows are cut once
    # and read by both.  Without an explicit count, adaptive execution sizes
    # the range partitions from the data (it only merges adjacent ranges, so
    # partition ids stay in key order).
    ranged_rows = df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
    ranged = cut(ranged_rows.sortWithinPartitions(*sort_cols).withColumn("_pid", F.spark_partition_id()))

    vtype = df.schema[value].dataType
    schema = StructType(ranged.schema.fields + [StructField(out, vtype, True), StructField("_last", BooleanType())])
    chunked = ranged.mapInArrow(_lead_in_partition(key, value, out), schema)

    # First row of every non-empty partition (a global-order minimum).
    heads = ranged.groupBy("_pid").agg(
        F.min(F.struct(*[F.col(c) for c in sort_cols], F.col(value).alias("_v"))).alias("_h")
    )
    wp = Window.orderBy("_pid")  # one row per partition: bounded, tiny
    nxt = heads.select(
        "_pid",
        F.lead(F.lit(True)).over(wp).alias("_more"),
        F.lead(F.col("_h").getField(key)).over(wp).alias("_nk"),
        F.lead(F.col("_h").getField("_v")).over(wp).alias("_nv"),
    )
    goes_on = F.col("_last") & F.col("_more") & F.col("_nk").eqNullSafe(F.col(key))
    return chunked.join(F.broadcast(nxt), "_pid", "left").select(
        *df.columns, F.when(goes_on, F.col("_nv")).otherwise(F.col(out)).alias(out))


def latest_per_key(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per ``key`` (top-1 per group).

    A ``max_by`` aggregate rather than ``row_number()`` over a window: the
    aggregate combines map-side, so each task ships one candidate per key and
    a key holding a third of the rows is still reduced in parallel.
    """
    best = F.max_by(F.struct(*[F.col(c) for c in columns]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(best.alias("_top")).select(key, *[F.col(f"_top.{c}").alias(c) for c in columns])


def numbered(df: DataFrame, order: list[Column], out: str = "place", within: list[str] | None = None) -> DataFrame:
    """``df`` with ``out``: each row's place from 0 in ``order``, in the whole
    table or among the rows of equal ``within`` columns (nulls are equal).

    Rows are range-partitioned and sorted in place; a row's place is its place
    in its range and what the ranges before hold, from a table of one row per
    range (and group).  No window spans a group, so a hot group is spread over
    many ranges, as are rows tied in ``order``, which take any of their places.
    """
    within = list(within or [])
    keys = [*[F.col(c) for c in within], *order, F.col("_tie")]
    ranged = (df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
              .sortWithinPartitions(*keys).drop("_tie"))
    # cut, so that the numbering and the sums below see the same ranges
    rows = cut(ranged.withColumn("_row", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_row", 33))
    runs = rows.groupBy(*within, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)], F.col("_range").alias("_at"),
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = rows["_range"] == runs["_at"]
    for i, c in enumerate(within):
        same = same & rows[c].eqNullSafe(runs[f"_w{i}"])
    return rows.join(runs, same).select(*df.columns, (F.col("_row") + F.col("_shift")).alias(out))
