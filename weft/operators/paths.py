"""Breadth-first search and landmark shortest paths.

BFS runs in two phases so the work is proportional to the output:

1. a frontier loop computes the hop distance from the source set to every
   vertex it reaches (one join + anti-join per level), stopping at the first
   level that contains a target, or at ``max_path_length``;
2. all shortest paths are rebuilt backwards from the targets at that level
   along DAG edges (dist(v) = dist(u) + 1) only, so no path that cannot end
   in a target is ever built.

Landmark distances run one multi-source frontier loop over reversed edges
with state (vertex, landmark, distance); the landmark set may be a list or
a DataFrame, so it never passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.operators.iterate import KeyedEdges, cut, pin


def _as_col(expr) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def bfs_paths(g, from_expr, to_expr, edge_filter=None, max_path_length: int = 10) -> tuple[DataFrame, int]:
    """Shortest paths as (path index columns v0..vk) plus their length k.

    Returns ``(paths, k)`` where ``paths`` has id columns ``v0 .. vk`` and
    ``k`` is -1 when no target is reachable within the bound.
    """
    v = g.vertices
    e = g.edges if edge_filter is None else g.edges.filter(edge_filter)
    e = e.select("src", "dst")
    e = e.join(v.select(F.col("id").alias("src")), "src", "left_semi").join(
        v.select(F.col("id").alias("dst")), "dst", "left_semi"
    )
    ke = KeyedEdges(e, "src")
    n = ke.n
    n_vertices = v.count()
    targets = v.where(_as_col(to_expr)).select("id")
    try:
        seen = cut(v.where(_as_col(from_expr)).select("id", F.lit(0).alias("d")).repartition(n, "id"))
        if seen.isEmpty():
            return None, -1
        levels = [seen]
        frontier = seen
        k = -1
        if not seen.join(targets, "id", "left_semi").isEmpty():
            k = 0
        depth = 0
        while k < 0 and depth < max_path_length:
            depth += 1
            nxt = (
                ke.join(frontier.select("id"), state_rows=n_vertices)
                .select(F.col("dst").alias("id"))
                .distinct()
                .join(seen.select("id"), "id", "left_anti")
                .select("id", F.lit(depth).alias("d"))
            )
            nxt = cut(nxt.repartition(n, "id"))
            if nxt.isEmpty():
                break
            levels.append(nxt)
            seen = seen.unionByName(nxt)  # union of checkpointed levels
            frontier = nxt
            if not nxt.join(targets, "id", "left_semi").isEmpty():
                k = depth
        if k < 0:
            return None, -1
        # Backward rebuild along DAG edges, from the targets of level k; vertex
        # paths are distinct (parallel edges are attached later, in ``bfs``).
        links = e.distinct()
        paths = levels[k].join(targets, "id", "left_semi").select(F.col("id").alias(f"v{k}"))
        for i in range(k, 0, -1):
            prev = levels[i - 1].select(F.col("id").alias(f"v{i-1}"))
            step = links.select(F.col("src").alias(f"v{i-1}"), F.col("dst").alias(f"v{i}"))
            paths = paths.join(step, f"v{i}").join(prev, f"v{i-1}", "left_semi")
        cols = [f"v{i}" for i in range(k + 1)]
        return cut(paths.select(*cols)), k
    finally:
        ke.unpersist()


def bfs_path_strings(g, from_expr, to_expr, edge_filter=None, max_path_length: int = 10) -> DataFrame:
    """(path, hops): each shortest path as 'id>id>...' (flat, comparable form)."""
    ids, k = bfs_paths(g, from_expr, to_expr, edge_filter, max_path_length)
    if k < 0:
        return g.spark.createDataFrame([], "path string, hops int")
    cols = [F.col(f"v{i}").cast("string") for i in range(k + 1)]
    return ids.select(F.concat_ws(">", *cols).alias("path"), F.lit(k).cast("int").alias("hops"))


def bfs(g, from_expr, to_expr, edge_filter=None, max_path_length: int = 10) -> DataFrame:
    """Paths as struct columns ``from, e0, v1, e1, ..., to`` (library layout).

    A source that already satisfies ``to_expr`` gives a zero-length path
    (columns ``from`` and ``to``).  No path: an empty frame.
    """
    ids, k = bfs_paths(g, from_expr, to_expr, edge_filter, max_path_length)
    if k < 0:
        return g.spark.createDataFrame([], "from string").limit(0)
    vs = g.vertices
    es = g.edges if edge_filter is None else g.edges.filter(edge_filter)
    vstruct = vs.select(F.col("id").alias("_k"), F.struct(*vs.columns).alias("_s"))
    out = ids
    names = ["from"] + [f"v{i}" for i in range(1, k)] + ["to"] if k > 0 else ["from", "to"]
    if k == 0:
        out = out.join(vstruct, out.v0 == vstruct._k).select(F.col("_s").alias("from"), F.col("_s").alias("to"))
        return out
    for i in range(k + 1):
        out = out.join(vstruct.withColumnRenamed("_k", f"v{i}").withColumnRenamed("_s", f"_vs{i}"), f"v{i}")
    estruct = es.select(F.col("src").alias("_a"), F.col("dst").alias("_b"), F.struct(*es.columns).alias("_es"))
    cols = []
    for i in range(k):
        ei = estruct.withColumnRenamed("_a", f"v{i}").withColumnRenamed("_b", f"v{i+1}").withColumnRenamed("_es", f"e{i}")
        out = out.join(ei, [f"v{i}", f"v{i+1}"])
    for i in range(k + 1):
        cols.append(F.col(f"_vs{i}").alias(names[i]))
        if i < k:
            cols.append(F.col(f"e{i}"))
    return out.select(*cols)


def shortest_path_rows(g, landmarks) -> DataFrame:
    """(id, landmark, distance) for every vertex that reaches a landmark.

    Distances follow edge direction: hops from ``id`` to ``landmark``.
    """
    spark = g.spark
    if isinstance(landmarks, DataFrame):
        lm = landmarks.select(F.col(landmarks.columns[0]).alias("id"))
    else:
        lm = spark.createDataFrame([(x,) for x in landmarks], g.vertices.select("id").schema)
    lm = lm.join(g.vertices.select("id"), "id", "left_semi").distinct()
    # reversed edges: walk from a landmark back to everything that reaches it
    # pinned, since the layout reads them three times
    edges = pin(g.valid_edges().select(F.col("dst").alias("at"), F.col("src").alias("to")).distinct())
    rev = KeyedEdges(edges, "at")
    n = rev.n
    try:
        seen = cut(lm.select("id", F.col("id").alias("landmark"), F.lit(0).alias("distance")).repartition(n, "id"))
        frontier, rows = seen, seen.count()
        depth = 0
        while True:
            depth += 1
            nxt = (
                rev.join(frontier.select("id", "landmark"), state_rows=rows)
                .select(F.col("to").alias("id"), "landmark")
                .distinct()
                .join(seen.select("id", "landmark"), ["id", "landmark"], "left_anti")
                .select("id", "landmark", F.lit(depth).alias("distance"))
            )
            nxt = cut(nxt.repartition(n, "id"))
            rows = nxt.count()
            if not rows:
                return seen
            seen = seen.unionByName(nxt)  # union of checkpointed levels
            frontier = nxt
    finally:
        rev.unpersist()
        edges.unpersist()


def shortest_paths(g, landmarks) -> DataFrame:
    """Vertex columns plus ``distances`` map (landmark -> hops); every vertex
    is present, with an empty map when it reaches no landmark."""
    rows = shortest_path_rows(g, landmarks)
    m = rows.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("landmark", "distance"))).alias("distances")
    )
    return g.vertices.join(m, "id", "left").withColumn(
        "distances", F.coalesce(F.col("distances"), F.create_map().cast(m.schema["distances"].dataType))
    )
