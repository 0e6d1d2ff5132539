"""Weakly and strongly connected components as DataFrame loops.

Component labels are the smallest vertex id of the component, so results
are repeatable and comparable with a SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.iterate import KeyedEdges, cut, state_partitions


# --------------------------------------------------------------------------
# Weak components: large-star / small-star (Kiveris et al., SoCC 2014).
#
# The graph is kept as canonical undirected pairs (a, b) with a < b.  Both
# steps need one aggregate, m(b) = min{a : (a, b)}, and one join, so each
# round costs O(|E|) and the number of rounds is O(log^2 |V|).  The loop
# stops once the pairs form stars around their minimum: every b has one
# smaller neighbour and no centre is itself a leaf.
# --------------------------------------------------------------------------


def _canonical(e: DataFrame) -> DataFrame:
    return (
        e.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )


def _large_star(c: DataFrame) -> DataFrame:
    # For each node u the minimum of its closed neighbourhood; every larger
    # neighbour v is re-attached to it.
    mins = c.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("mn"))
    j = c.join(mins, c.a == mins.u, "left")
    return j.select(F.coalesce("mn", "a").alias("a"), F.col("b")).distinct()


def _small_star(c: DataFrame) -> DataFrame:
    # For each node u, its smaller neighbours and u itself are attached to the
    # minimum among them.
    mins = c.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("mn"))
    j = c.join(mins, c.b == mins.u)
    moved = j.where(F.col("a") != F.col("mn")).select(F.col("mn").alias("a"), F.col("a").alias("b"))
    anchor = mins.select(F.col("mn").alias("a"), F.col("u").alias("b"))
    return moved.unionByName(anchor).distinct()


def _is_star_forest(c: DataFrame) -> bool:
    multi = c.groupBy("b").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1)
    if not multi.isEmpty():
        return False
    # distinct first: near the end most pairs have the same centre
    centres_as_leaves = c.select(F.col("a").alias("b")).distinct().join(c.select("b"), "b", "left_semi")
    return centres_as_leaves.isEmpty()


def component_labels(g, max_rounds: int = 100) -> DataFrame:
    """(id, component) for every vertex; isolated vertices label themselves."""
    c = cut(_canonical(g.valid_edges()))
    n = state_partitions(g.spark, c.count())
    c = cut(c.repartition(n, "b"))
    for _ in range(max_rounds):
        c = cut(_small_star(_large_star(c)))
        if _is_star_forest(c):
            break
    else:
        raise RuntimeError("connected components did not converge")
    root = c.select(F.col("b").alias("id"), F.col("a").alias("component"))
    v = g.vertices.select("id")
    return v.join(root, "id", "left").select(
        "id", F.coalesce(F.col("component"), F.col("id")).alias("component")
    )


def connected_components(g) -> DataFrame:
    return g.vertices.join(component_labels(g), "id", "left")


# --------------------------------------------------------------------------
# Strong components: forward-backward colouring.
#
# Outer round: (1) trim vertices with no in- or no out-edge among the
# remaining ones until there are none (each is its own component); (2) colour every vertex with
# the smallest id that reaches it (min-label propagation along edges);
# (3) vertices whose colour is their own id are roots; the component of a
# root is the set of vertices of that colour that reach the root, found by
# backward propagation inside the colour.  The root is the smallest id of
# its component.  Assigned vertices leave the graph; repeat.
# The rounds go on until every vertex is assigned; ``max_iter`` is a limit
# that raises, never a partial result.
# --------------------------------------------------------------------------


def _propagate_min(ke: KeyedEdges, lab: DataFrame, n: int, rows: int) -> DataFrame:
    """Fixpoint of lab(v) = min(lab(v), lab(u)) over edges u -> v."""
    sent = lab
    while True:
        cand = ke.join(sent, state_rows=rows).select(F.col("dst").alias("id"), F.col("lab").alias("c"))
        best = cand.groupBy("id").agg(F.min("c").alias("c"))
        new = lab.join(best, "id", "left").select(
            "id",
            F.least(F.col("lab"), F.coalesce(F.col("c"), F.col("lab"))).alias("lab"),
            (F.col("c") < F.col("lab")).alias("chg"),
        )
        new = cut(new)
        # a label that stays was sent before: only changed ones are sent on
        sent = new.where(F.col("chg")).select("id", "lab")
        rows = sent.count()
        if rows == 0:
            return new.select("id", "lab")
        lab = new.select("id", "lab")


def _reach_back(e: DataFrame, colour: DataFrame, n: int, rows: int) -> DataFrame:
    """Vertices (id, lab) that reach the root of their colour inside it."""
    # Edges inside one colour only, laid out once on dst for the backward walk.
    ec = (
        e.join(colour.withColumnRenamed("id", "src").withColumnRenamed("lab", "ls"), "src")
        .join(colour.withColumnRenamed("id", "dst").withColumnRenamed("lab", "ld"), "dst")
        .where(F.col("ls") == F.col("ld"))
        .select("dst", "src")
    )
    ke = KeyedEdges(ec, "dst")
    found = cut(colour.where(F.col("id") == F.col("lab")))
    frontier = found
    try:
        while True:
            # an edge inside a colour links vertices of that colour, so the
            # frontier's label is the label of every vertex it reaches
            step = ke.join(frontier, state_rows=rows).select(F.col("src").alias("id"), "lab").distinct()
            new = cut(step.join(found.select("id"), "id", "left_anti"))
            if new.isEmpty():
                return found
            found = found.unionByName(new)  # union of checkpointed levels
            frontier = new
    finally:
        ke.unpersist()


def scc_labels(g, max_iter: int | None = None) -> DataFrame:
    v_all = g.vertices.select("id")
    e = cut(g.valid_edges().where(F.col("src") != F.col("dst")).distinct())
    n = state_partitions(g.spark, e.count())
    e = cut(e.repartition(n, "src"))
    remaining = cut(v_all.repartition(n, "id"))
    done = []
    rounds = 0
    while not remaining.isEmpty():
        if rounds == max_iter:
            raise RuntimeError(f"strong components not settled after {max_iter} rounds")
        rounds += 1
        # (1) trim: vertices with no in-edge or no out-edge inside the rest
        core, rows, before = remaining, remaining.count(), None
        while rows and rows != before:
            has_out = e.select(F.col("src").alias("id")).distinct()
            has_in = e.select(F.col("dst").alias("id")).distinct()
            core = cut(core.join(has_out, "id", "left_semi").join(has_in, "id", "left_semi").repartition(n, "id"))
            e = cut(
                e.join(core.withColumnRenamed("id", "src"), "src", "left_semi").join(
                    core.withColumnRenamed("id", "dst"), "dst", "left_semi"
                )
            )
            rows, before = core.count(), rows
        trivial = remaining.join(core, "id", "left_anti").select("id", F.col("id").alias("component"))
        done.append(cut(trivial))
        if rows == 0:
            break
        # (2) colour by smallest reaching id
        ke = KeyedEdges(e, "src")
        try:
            colour = _propagate_min(ke, core.select("id", F.col("id").alias("lab")), n, rows)
        finally:
            ke.unpersist()
        # (3) backward reach from roots inside each colour
        comp = _reach_back(e, colour, n, rows)
        done.append(comp.select("id", F.col("lab").alias("component")))
        remaining = cut(core.join(comp.select("id"), "id", "left_anti").repartition(n, "id"))
        if remaining.isEmpty():
            break
        e = cut(
            e.join(remaining.withColumnRenamed("id", "src"), "src", "left_semi").join(
                remaining.withColumnRenamed("id", "dst"), "dst", "left_semi"
            )
        )
    if not done:
        return v_all.select("id", F.col("id").alias("component"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def strongly_connected_components(g, max_iter: int | None = None) -> DataFrame:
    return g.vertices.join(scc_labels(g, max_iter), "id", "left")
