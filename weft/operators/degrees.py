"""Degrees and neighbourhoods: single aggregates over the edge table.

All of them are one hash aggregate with map-side partial aggregation, so a
hub vertex costs one partial row per map task, not one task for all its
edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions.columns import safe_ratio
from weft.operators.sequence import numbered


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDegree"))


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDegree"))


def degrees(edges: DataFrame) -> DataFrame:
    """in + out; a self-loop counts twice."""
    ends = edges.select(F.explode(F.array(F.col("src"), F.col("dst"))).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def all_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree, in_degree, out_degree) for every vertex, 0 when absent.

    One pass: both endpoints are emitted with an in/out flag and counted in
    a single aggregate, then left-joined to the vertex ids.
    """
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        ).alias("e")
    ).select("e.*")
    agg = ends.groupBy("id").agg(
        F.count(F.lit(1)).alias("degree"),
        F.sum("i").cast("long").alias("in_degree"),
        F.sum("o").cast("long").alias("out_degree"),
    )
    return vertices.select("id").join(agg, "id", "left").fillna(
        0, ["degree", "in_degree", "out_degree"]
    )


def degree_ratios(deg: DataFrame) -> DataFrame:
    """Adds in_degree_ratio / out_degree_ratio (float32, 0.0 when degree 0)."""
    return deg.withColumn("in_degree_ratio", safe_ratio("in_degree", "degree")).withColumn(
        "out_degree_ratio", safe_ratio("out_degree", "degree")
    )


def neighbor_pairs(edges: DataFrame) -> DataFrame:
    """Distinct (id, neighbor) pairs over both edge directions (long form).

    This is the distributed form of the neighbour lists: no vertex's list is
    ever gathered into one row, so a hub stays spread over many tasks.
    """
    both = edges.select(F.col("src").alias("id"), F.col("dst").alias("neighbor")).unionByName(
        edges.select(F.col("dst").alias("id"), F.col("src").alias("neighbor"))
    )
    return both.where(F.col("id").isNotNull() & F.col("neighbor").isNotNull()).distinct()


def neighbors(edges: DataFrame, strict_parity: bool = False) -> DataFrame:
    """(id, neighbors array) per vertex with at least one edge.

    Default: the union of out- and in-neighbours.  ``strict_parity=True``
    reproduces the original helper, whose result is null for a vertex that has
    only out- or only in-edges.  The list of one vertex is one output row, so
    its size is that vertex's degree; use :func:`neighbor_pairs` when hubs
    can be huge.
    """
    outs = edges.groupBy(F.col("src").alias("id")).agg(F.collect_set("dst").alias("n_out"))
    ins = edges.groupBy(F.col("dst").alias("id")).agg(F.collect_set("src").alias("n_in"))
    j = outs.join(ins, "id", "full")
    if strict_parity:
        nb = F.array_distinct(F.concat("n_out", "n_in"))
    else:
        nb = F.array_sort(
            F.array_distinct(
                F.concat(F.coalesce("n_out", F.array()), F.coalesce("n_in", F.array()))
            )
        )
    return j.select("id", nb.alias("neighbors"))


def neighbor_pieces(edges: DataFrame, strict_parity: bool = False, piece: int = 1000) -> DataFrame:
    """(id, piece, neighbors): the lists of :func:`neighbors` in ascending
    pieces of at most ``piece`` neighbours, numbered from 0.

    Default: distinct in- and out-neighbours of every vertex with an edge.
    ``strict_parity=True``: a vertex that has only in- or only out-edges has
    one piece, null, as the full outer join of both lists gives it.  A hub's
    pairs are numbered over many tasks and no row outgrows ``piece``.
    """
    pairs = neighbor_pairs(edges)
    cut_at = F.floor(F.col("place") / piece).cast("int")
    placed = numbered(pairs, [F.col("neighbor")], "place", within=["id"])
    lists = placed.groupBy("id", cut_at.alias("piece")).agg(F.array_sort(F.collect_list("neighbor")).alias("neighbors"))
    if not strict_parity:
        return lists
    outs = edges.where("src is not null").select(F.col("src").alias("id")).distinct()
    ins = edges.where("dst is not null").select(F.col("dst").alias("id")).distinct()
    one_sided = outs.join(ins, "id", "left_anti").unionByName(ins.join(outs, "id", "left_anti"))
    kept = lists.join(one_sided, "id", "left_anti")
    empty = F.lit(None).cast(lists.schema["neighbors"].dataType)
    return kept.unionByName(one_sided.select("id", F.lit(0).alias("piece"), empty.alias("neighbors")))
