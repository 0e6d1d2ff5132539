"""The per-customer graph feature table (18 features) and its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions.columns import cent_mean
from weft.operators.labels import label_scores

MEASURES = ("monthly_charges", "total_charges", "tenure")


def community_stats(g, rounds: int = 25, labels: DataFrame | None = None) -> DataFrame:
    """Per community: mean of the three measures and size."""
    lab = labels if labels is not None else label_scores(g, rounds)
    v = g.vertices.select("id", *MEASURES).join(lab, "id")
    return v.groupBy("label").agg(
        *[cent_mean(m).alias(f"comm_avg_{m}") for m in MEASURES],
        F.count("id").alias("comm_size"),
    )


def community_deviation(g, rounds: int = 25, labels: DataFrame | None = None) -> DataFrame:
    """Per vertex: its community, the community means and (mean - own value).

    The community means are joined back on ``label`` (one row per label), an
    aggregate-then-join instead of a window over the community: a community
    holding a third of the vertices is then still aggregated in parallel.
    """
    lab = labels if labels is not None else label_scores(g, rounds)
    stats = community_stats(g, rounds, labels=lab)
    v = g.vertices.select("id", *MEASURES).join(lab, "id")
    j = v.join(stats, "label", "left")
    return j.select(
        "id", "label",
        *[f"comm_avg_{m}" for m in MEASURES], "comm_size",
        *[(F.col(f"comm_avg_{m}") - F.col(m)).alias(f"comm_dev_avg_{m}") for m in MEASURES],
    )


def neighbor_averages(g, direction: str = "out") -> DataFrame:
    """Mean of the neighbours' measures per vertex.

    ``direction='out'`` reproduces the original feature (out-neighbours only:
    its union joined a frame with itself); ``'in'`` and ``'both'`` (bag union of
    both orientations) are the other readings.
    """
    e = g.edges
    out_e = e.select(F.col("src").alias("id"), F.col("dst").alias("nbr"))
    in_e = e.select(F.col("dst").alias("id"), F.col("src").alias("nbr"))
    und = {"out": out_e, "in": in_e, "both": out_e.unionByName(in_e)}[direction]
    meas = g.vertices.select(F.col("id").alias("nbr"), *MEASURES)
    return und.join(meas, "nbr", "left").groupBy("id").agg(
        *[cent_mean(m).alias(f"nghb_avg_{m}") for m in MEASURES]
    )


def graph_features(g, lpa_rounds: int = 25, tol: float = 0.01) -> DataFrame:
    """The 18 graph features per customer (key ``customer_id``).

    Every part is a (vertex id, columns) frame; they are assembled with left
    joins on the id, all keyed the same way, so Spark plans them as a chain of
    joins on one key.  Null counts become 0 as in the original table.
    """
    from weft.functions.columns import clustering_coefficient
    from weft.operators.degrees import all_degrees, degree_ratios
    from weft.operators.rank import page_rank_scores
    from weft.operators.triangles import triangle_counts

    d = degree_ratios(all_degrees(g.vertices, g.edges))
    pr = page_rank_scores(g, 0.15, tol=tol)
    tri = triangle_counts(g).withColumnRenamed("count", "trian_count")
    comm = community_deviation(g, lpa_rounds).drop("label")
    nb = neighbor_averages(g, "out")
    f = (
        d.join(pr, "id", "left")
        .join(tri, "id", "left")
        .withColumn("cc", clustering_coefficient(F.coalesce("trian_count", F.lit(0)), "degree"))
        .fillna(0)
        .join(comm, "id", "left")
        .join(nb, "id", "left")
        .fillna(0)
    )
    return f.withColumnRenamed("id", "customer_id").select(
        "customer_id", "degree", "in_degree", "out_degree", "in_degree_ratio", "out_degree_ratio",
        "pagerank", "trian_count", "cc",
        *[f"comm_avg_{m}" for m in MEASURES], "comm_size",
        *[f"comm_dev_avg_{m}" for m in MEASURES],
        *[f"nghb_avg_{m}" for m in MEASURES],
    )
