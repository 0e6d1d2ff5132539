"""Label propagation (synchronous, fixed rounds).

Each vertex starts with its own id.  Every round each edge carries the
source's label to the destination and the destination's label to the
source (parallel edges count again, a self-loop sends twice to itself).  A
vertex adopts the most frequent label it received; ties go to the smallest
label; a vertex that received nothing keeps its label.

Messages are shuffled once a round, by the receiver (a hub's by receiver and
a salt of the label, so they spread over the reducers); there they are counted
per label, and a ``min_by`` ordered by (-count, label) chooses.  Only the
hubs' choices of each salt, a row per salt, are shuffled again.

The step depends on the labels alone: once a round changes none, the rounds
that are left would not either, and are not run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.iterate import KeyedEdges, Rounds, cut


def label_scores(g, max_iter: int, checkpoint_every: int = 3) -> DataFrame:
    """(id, label) for every vertex."""
    e = g.valid_edges()
    ids = g.vertices.select("id")
    # The static link table: one row per (edge, direction) carrying a vote
    # (w = 1) from ``frm`` to ``tgt``, plus one self row per vertex (w = 0).
    # The self row is not counted as a vote, but it offers the vertex its own
    # label, so a vertex without messages keeps it.  Each round then reads
    # the previous labels exactly once (one join), so rounds between cuts
    # cost linearly instead of re-running the earlier rounds per reference.
    links = KeyedEdges(
        e.select(F.col("dst").alias("tgt"), F.col("src").alias("frm"), F.lit(1).alias("w"))
        .unionByName(e.select(F.col("src").alias("tgt"), F.col("dst").alias("frm"), F.lit(1).alias("w")))
        .unionByName(ids.select(F.col("id").alias("tgt"), F.col("id").alias("frm"), F.lit(0).alias("w"))),
        "frm",
    )
    n = links.n
    labels = ids.repartition(n, "id").select("id", F.col("id").alias("label"))
    hubs = not links.salts.isEmpty()
    first = F.struct((-F.col("cnt")).alias("k"), F.col("label").alias("l"))
    loop = Rounds(checkpoint_every)
    try:
        for i in range(max_iter):
            # shuffled to the edges, never sent through the driver
            msgs = links.join(labels.select("id", "label")).select("tgt", "label", "w")
            salt = F.lit(0)
            if hubs:  # links go both ways, so hubs that send are those that receive
                msgs = msgs.join(F.broadcast(links.hubs), F.col("tgt") == F.col("_hk"), "left")
                salt = F.coalesce(F.pmod(F.xxhash64("label"), F.col("_ns").cast("long")), F.lit(0)).cast("int")
            sent = msgs.select("tgt", salt.alias("part"), "label", "w").repartition(n, "tgt", "part")
            counts = sent.groupBy("tgt", "part", "label").agg(F.sum("w").alias("cnt"), (F.min("w") == 0).alias("own"))
            labels = counts.groupBy("tgt", "part").agg(
                F.min_by("label", first).alias("label"), F.max("cnt").alias("cnt"),
                F.max(F.when(F.col("own"), F.col("label"))).alias("old"))
            if hubs:
                labels = labels.groupBy("tgt").agg(F.min_by("label", first).alias("label"), F.max("old").alias("old"))
            labels = loop.step(labels.select(F.col("tgt").alias("id"), "label", "old"), i)
            if i and (i + 1) % checkpoint_every == 0 and labels.where("label != old").isEmpty():
                break
        return cut(labels.select("id", "label"))
    finally:
        links.unpersist()


def label_propagation(g, max_iter: int) -> DataFrame:
    """Vertex columns plus ``label``."""
    return g.vertices.join(label_scores(g, max_iter), "id", "left")
