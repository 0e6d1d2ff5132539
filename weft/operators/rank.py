"""PageRank as a DataFrame loop.

Layout per round: the weighted edge table (src, dst, w) is hash-partitioned
on ``src``, sorted and pinned once; the rank vector is kept partitioned on
``id`` with the same partition count, so the edge side of the per-round join
never moves.  Contributions are summed per ``dst`` with map-side partial
aggregation (a hub receiving a third of all edges is combined per map task
before the shuffle).  Only the vertex-sized vectors shuffle each round.

Semantics follow the classic graph-library definition:

* fixed rounds: every rank starts at 1 (personalised: 1 at the source, 0
  elsewhere); ``rank' = reset + (1 - reset_prob) * sum(rank_src / outdeg)``
  where ``reset`` is ``reset_prob`` (personalised: only at the source);
* tolerance: the delta-propagation form — each vertex forwards the change
  it received last round while that change exceeds ``tol``;
* finally ranks are scaled to sum to the vertex count (personalised: to 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.iterate import KeyedEdges, Rounds, cut, fixed_layout, pin


def _weighted_edges(g, n: int | None) -> KeyedEdges:
    edges = KeyedEdges(g.valid_edges(), "src", n)
    outdeg = edges.df.groupBy("src").agg(F.count(F.lit(1)).alias("_od"))
    # in the salted layout, so a hub's edges are never in one task
    edges.extend(outdeg.select(F.col("src").alias("id"), (1.0 / F.col("_od")).alias("w")), ["src", "dst", "w"])
    return edges


def _scale(ranks: DataFrame, personalized: bool, n_vertices: int) -> DataFrame:
    total = ranks.agg(F.sum("rank")).first()[0] or 0.0
    if total == 0.0:
        return ranks.withColumnRenamed("rank", "pagerank")
    factor = (1.0 / total) if personalized else (n_vertices / total)
    return ranks.select("id", (F.col("rank") * F.lit(factor)).alias("pagerank"))


def page_rank_scores(
    g,
    reset_prob: float = 0.15,
    source_id=None,
    max_iter: int | None = None,
    tol: float | None = None,
    checkpoint_every: int = 4,
) -> DataFrame:
    """(id, pagerank) for every vertex."""
    if (max_iter is None) == (tol is None):
        raise ValueError("give exactly one of max_iter and tol")
    spark = g.spark
    ew = _weighted_edges(g, None)
    n = ew.n
    with fixed_layout(spark):
        ids = pin(g.vertices.select("id").repartition(n, "id"))
    n_vertices = ids.count()
    personalized = source_id is not None
    try:
        if max_iter is not None:
            ranks = _static(ids, ew, reset_prob, source_id, max_iter, checkpoint_every, n_vertices)
        else:
            if personalized:
                raise NotImplementedError("personalised PageRank takes max_iter")
            ranks = _until_converged(ids, ew, reset_prob, tol, n_vertices)
        ranks = cut(ranks)
        return _scale(ranks, personalized, n_vertices)
    finally:
        ew.unpersist()
        ids.unpersist()


def _static(ids, ew, alpha, source_id, max_iter, every, n_vertices) -> DataFrame:
    personalized = source_id is not None
    if personalized:
        is_src = F.col("id") == F.lit(source_id)
        ranks = ids.select("id", F.when(is_src, 1.0).otherwise(0.0).alias("rank"))
        reset = F.when(is_src, F.lit(alpha)).otherwise(F.lit(0.0))
    else:
        ranks = ids.select("id", F.lit(1.0).alias("rank"))
        reset = F.lit(alpha)
    loop = Rounds(every)
    # every vertex adds a zero contribution to itself, so the sum covers all
    # vertices and no join back to the vertex table is needed
    zero = ids.select(F.col("id").alias("dst"), F.lit(0.0).alias("c"))
    for i in range(max_iter):
        contrib = ew.join(ranks, state_rows=n_vertices).select("dst", (F.col("rank") * F.col("w")).alias("c"))
        sums = contrib.unionByName(zero).groupBy(F.col("dst").alias("id")).agg(F.sum("c").alias("s"))
        ranks = sums.select("id", (reset + F.lit(1.0 - alpha) * F.col("s")).alias("rank"))
        ranks = loop.step(ranks, i)
    return ranks


def _until_converged(ids, ew, alpha, tol, n_vertices) -> DataFrame:
    # Round 0: every vertex takes the initial message and holds rank = delta = alpha.
    frontier = ids.select("id", F.lit(alpha).alias("delta"))
    deltas = []
    while True:
        active = frontier.where(F.col("delta") > tol)
        msgs = ew.join(active, state_rows=n_vertices).select("dst", (F.col("delta") * F.col("w")).alias("m"))
        recv = msgs.groupBy("dst").agg(F.sum("m").alias("s")).select(
            F.col("dst").alias("id"), (F.lit(1.0 - alpha) * F.col("s")).alias("delta")
        )
        recv = cut(recv)
        if recv.isEmpty():
            break
        deltas.append(recv)
        frontier = recv
    ranks = ids.select("id", F.lit(alpha).alias("delta"))
    for d in deltas:
        ranks = ranks.unionByName(d)
    return ranks.groupBy("id").agg(F.sum("delta").alias("rank"))


def page_rank(g, reset_prob=0.15, sourceId=None, maxIter=None, tol=None):
    """Graph whose vertices carry ``pagerank`` and edges carry ``weight``."""
    from weft.graph import PropertyGraph

    scores = page_rank_scores(g, reset_prob, source_id=sourceId, max_iter=maxIter, tol=tol)
    v = g.vertices.join(scores, "id", "left")
    # the scores go by valid edges, and so do the weights
    outdeg = g.valid_edges().groupBy("src").agg(F.count(F.lit(1)).alias("_od"))
    e = g.edges.join(outdeg, "src", "left").withColumn("weight", 1.0 / F.col("_od")).drop("_od")
    return PropertyGraph(v, e)


def rank_by_messages(g, rounds: int, reset: float = 0.15):
    """(id, outDegree, rank) of the vertices with out-edges, ranks summing to
    at most 1, by message passing.  The state is the share that a vertex sends
    along each of its edges, so the message is the state itself."""
    from weft.graph import PropertyGraph
    from weft.operators.pregel import Pregel

    n = g.vertices.count()
    senders = PropertyGraph(g.outDegrees, g.edges.select("src", "dst"))
    arrived = F.coalesce(Pregel.msg(), F.lit(0.0))
    share = (reset / n + (1 - reset) * arrived) / F.col("outDegree")
    passing = senders.pregel.setMaxIter(rounds).withVertexColumn("share", 1 / n / F.col("outDegree"), share)
    done = passing.sendMsgToDst(Pregel.src("share")).aggMsgs(F.sum(Pregel.msg())).run()
    return done.select("id", "outDegree", (F.col("share") * F.col("outDegree")).alias("rank"))
