"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query reads the driver tables (or frames Spark derives from them) in
full.  Column names match the SQL in :mod:`weft.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.graph import PropertyGraph
from weft.operators import degrees as deg
from weft.plans import callgraph as cg
from weft.sources.tables import table as _table

Query = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, Query] = {}

PERSONALIZED_SOURCE = 1  # customer key of the personalised PageRank source
BFS_FROM = "name = 'Customer#000000001'"
BFS_TO = "segment = 'AUTOMOBILE' AND monthly_charges > 9000"


def q(name: str):
    def deco(fn: Query) -> Query:
        _REG[name] = fn
        return fn

    return deco


def queries() -> dict[str, Query]:
    return dict(_REG)


def graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    return cg.silver_graph(spark, sf_dir)


# -- edges and degrees -------------------------------------------------------
@q("call_edges")
def call_edges(spark, sf_dir):
    log = cg.call_log(spark, sf_dir)
    directory = cg.customers(spark, sf_dir).select("customer_id", "mobile_number")
    return cg.edges_from_call_log(log, directory)


@q("customers_with_numbers")
def customers_with_numbers(spark, sf_dir):
    return cg.customers_with_numbers(cg.customers(spark, sf_dir), cg.phone_directory(spark, sf_dir))


@q("calls_by_month")
def calls_by_month(spark, sf_dir):
    """The call log with its time as text, parsed by the default format."""
    log = cg.call_log(spark, sf_dir)
    return cg.calls_by_month(log.withColumn("datatime", F.date_format("datatime", "yyyy-MM-dd HH:mm:ss")))


@q("in_degrees")
def in_degrees(spark, sf_dir):
    return graph(spark, sf_dir).inDegrees


@q("out_degrees")
def out_degrees(spark, sf_dir):
    return graph(spark, sf_dir).outDegrees


@q("degrees")
def degrees(spark, sf_dir):
    return graph(spark, sf_dir).degrees


@q("degrees_top")
def degrees_top(spark, sf_dir):
    return degrees(spark, sf_dir).orderBy(F.desc("degree"), "id").limit(20)


@q("degrees_ranked")
def degrees_ranked(spark, sf_dir):
    return degrees(spark, sf_dir).orderBy(F.desc("degree"), "id")


@q("in_degrees_ranked")
def in_degrees_ranked(spark, sf_dir):
    return in_degrees(spark, sf_dir).orderBy(F.desc("inDegree"), "id")


@q("out_degrees_ranked")
def out_degrees_ranked(spark, sf_dir):
    return out_degrees(spark, sf_dir).orderBy(F.desc("outDegree"), "id")


@q("degree_ratios")
def degree_ratios(spark, sf_dir):
    g = graph(spark, sf_dir)
    return deg.degree_ratios(deg.all_degrees(g.vertices, g.edges))


@q("neighbors")
def neighbors(spark, sf_dir):
    return deg.neighbor_pairs(graph(spark, sf_dir).edges)


@q("youngest")
def youngest(spark, sf_dir):
    return graph(spark, sf_dir).vertices.groupBy().agg(F.min("tenure").alias("min_tenure"))


@q("edge_filter_count")
def edge_filter_count(spark, sf_dir):
    e = graph(spark, sf_dir).edges.filter("relationship = 'follow'")
    return e.groupBy().agg(F.count(F.lit(1)).alias("follow_edges"))


# -- motifs and subgraphs ----------------------------------------------------
@q("reciprocal_pairs")
def reciprocal_pairs(spark, sf_dir):
    m = graph(spark, sf_dir).find("(a)-[e]->(b); (b)-[e2]->(a)")
    m = m.filter("a.monthly_charges > 5000 or b.monthly_charges > 5000")
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


@q("chain4_friends")
def chain4_friends(spark, sf_dir):
    """Walks of three edges, two or more of them between friends."""
    from weft.operators.motif import walks

    found = walks(graph(spark, sf_dir), 3, "relationship = 'friend'", at_least=2)
    return found.toDF("a_id", "b_id", "c_id", "d_id", "num_friends")


@q("neighbor_pieces")
def neighbor_pieces(spark, sf_dir):
    return deg.neighbor_pieces(graph(spark, sf_dir).edges, piece=10).withColumn(
        "neighbors", F.concat_ws(",", F.col("neighbors").cast("array<string>")))


@q("neighbor_pieces_strict")
def neighbor_pieces_strict(spark, sf_dir):
    """Lists of vertices with in- and out-edges; null for the others."""
    got = deg.neighbor_pieces(_friend_subgraph(spark, sf_dir).edges, strict_parity=True, piece=10)
    text = F.concat_ws(",", F.col("neighbors").cast("array<string>"))
    return got.withColumn("neighbors", F.when(F.col("neighbors").isNotNull(), text))


@q("one_way_edges")
def one_way_edges(spark, sf_dir):
    m = graph(spark, sf_dir).find("(a)-[]->(b); !(b)-[]->(a)")
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


def _friend_subgraph(spark, sf_dir):
    g = graph(spark, sf_dir)
    return g.filterEdges("relationship = 'friend'").filterVertices("monthly_charges > 3000").dropIsolatedVertices()


@q("subgraph_vertices")
def subgraph_vertices(spark, sf_dir):
    return _friend_subgraph(spark, sf_dir).vertices.select("id", "name", "monthly_charges")


@q("subgraph_edges")
def subgraph_edges(spark, sf_dir):
    return _friend_subgraph(spark, sf_dir).edges.select("src", "dst", "relationship")


# -- iterative algorithms ----------------------------------------------------
@q("connected_components")
def connected_components(spark, sf_dir):
    from weft.operators.components import component_labels

    return component_labels(graph(spark, sf_dir))


@q("scc")
def scc(spark, sf_dir):
    from weft.operators.components import scc_labels

    return scc_labels(graph(spark, sf_dir))


def _local_graph(spark, sf_dir):
    """Calls within one nation, of which those between friends go both ways:
    many components, strong components and communities."""
    nation = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    g = graph(spark, sf_dir)
    own = PropertyGraph(g.vertices.join(nation, "id"), g.edges).find("(a)-[e]->(b)").where("a.nation = b.nation").select("e.*")
    back = own.where("relationship = 'friend'").select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return PropertyGraph(g.vertices, own.select("src", "dst").unionByName(back).distinct())


@q("local_components")
def local_components(spark, sf_dir):
    from weft.operators.components import component_labels

    return component_labels(_local_graph(spark, sf_dir))


@q("local_scc")
def local_scc(spark, sf_dir):
    from weft.operators.components import scc_labels

    return scc_labels(_local_graph(spark, sf_dir))


@q("local_communities")
def local_communities(spark, sf_dir):
    """Members, community means and deviations of the local graph."""
    from weft.plans.graph_features import community_deviation as cd

    return _round6(cd(_local_graph(spark, sf_dir), 25))


@q("label_propagation_5")
def label_propagation_5(spark, sf_dir):
    from weft.operators.labels import label_scores

    return label_scores(graph(spark, sf_dir), 5)


@q("community_stats")
def community_stats(spark, sf_dir):
    from weft.plans.graph_features import community_stats as cs

    g = graph(spark, sf_dir)
    return cs(g, 25).select(
        "label",
        *[F.round(c, 6).alias(c) for c in
          ("comm_avg_monthly_charges", "comm_avg_total_charges", "comm_avg_tenure")],
        "comm_size",
    )


@q("pagerank_10")
def pagerank_10(spark, sf_dir):
    from weft.operators.rank import page_rank_scores

    s = page_rank_scores(graph(spark, sf_dir), 0.15, max_iter=10)
    return s.select("id", F.round("pagerank", 6).alias("pagerank"))


@q("pagerank_personalized")
def pagerank_personalized(spark, sf_dir):
    from weft.operators.rank import page_rank_scores

    s = page_rank_scores(graph(spark, sf_dir), 0.15, source_id=PERSONALIZED_SOURCE, max_iter=10)
    return s.select("id", F.round("pagerank", 6).alias("pagerank"))


@q("pagerank_edges")
def pagerank_edges(spark, sf_dir):
    g = graph(spark, sf_dir)
    outdeg = g.edges.groupBy("src").agg(F.count(F.lit(1)).alias("_od"))
    return g.edges.join(outdeg, "src").select(
        "src", "dst", "relationship", (1.0 / F.col("_od")).alias("weight")
    )


@q("pregel_pagerank")
def pregel_pagerank(spark, sf_dir):
    from weft.operators.rank import rank_by_messages

    return rank_by_messages(graph(spark, sf_dir), 5).withColumn("rank", F.round("rank", 9))


@q("pregel_two_way")
def pregel_two_way(spark, sf_dir):
    """Smallest id and largest balance within three hops in either direction:
    messages go along edges and against them."""
    from weft.operators.pregel import Pregel

    g = graph(spark, sf_dir)
    along, against = (F.struct(end("least").alias("least"), end("most").alias("most")) for end in (Pregel.src, Pregel.dst))
    least, most = Pregel.msg()["least"], Pregel.msg()["most"]
    done = (PropertyGraph(g.vertices.select("id", "monthly_charges"), g.edges).pregel.setMaxIter(3)
            .withVertexColumn("least", F.col("id"), F.least("least", least))
            .withVertexColumn("most", F.col("monthly_charges"), F.greatest("most", most))
            .sendMsgToDst(along).sendMsgToSrc(against)
            .aggMsgs(F.struct(F.min(least).alias("least"), F.max(most).alias("most")))
            .run())
    return done.select("id", "least", "most")


@q("triangle_count")
def triangle_count(spark, sf_dir):
    from weft.operators.triangles import triangle_counts

    return triangle_counts(graph(spark, sf_dir))


@q("clustering_coefficient")
def clustering_coefficient(spark, sf_dir):
    from weft.operators.triangles import clustering

    return clustering(graph(spark, sf_dir))


# -- paths -------------------------------------------------------------------
@q("bfs_paths")
def bfs_paths(spark, sf_dir):
    from weft.operators.paths import bfs_path_strings

    return bfs_path_strings(graph(spark, sf_dir), BFS_FROM, BFS_TO)


@q("bfs_filtered")
def bfs_filtered(spark, sf_dir):
    from weft.operators.paths import bfs_path_strings

    return bfs_path_strings(
        graph(spark, sf_dir), BFS_FROM, BFS_TO, edge_filter="relationship != 'friend'", max_path_length=3
    )


FAR_FROM = "name = 'Customer#000000002'"
FAR_TO = "segment = 'MACHINERY' AND monthly_charges > 9500"


@q("bfs_far")
def bfs_far(spark, sf_dir):
    """Several shortest paths of several hops."""
    from weft.operators.paths import bfs_path_strings

    return bfs_path_strings(graph(spark, sf_dir), FAR_FROM, FAR_TO)


@q("bfs_far_filtered")
def bfs_far_filtered(spark, sf_dir):
    """The same ends without friends' calls: other and longer paths."""
    from weft.operators.paths import bfs_path_strings

    return bfs_path_strings(graph(spark, sf_dir), FAR_FROM, FAR_TO, edge_filter="relationship != 'friend'",
                            max_path_length=5)


@q("bfs_structs")
def bfs_structs(spark, sf_dir):
    """The paths in the library's layout (from, e0, v1, ..., to): names of the
    vertices and relationships of the edges along each."""
    found = graph(spark, sf_dir).bfs(FAR_FROM, FAR_TO)
    if len(found.columns) < 2:
        return spark.createDataFrame([], "path string")
    along = [F.col(c)["relationship" if c.startswith("e") else "name"] for c in found.columns]
    return found.select(F.concat_ws(">", *along).alias("path"))


@q("distance_maps")
def distance_maps(spark, sf_dir):
    """Every vertex with the map of its distances to the landmarks, as text."""
    g = graph(spark, sf_dir)
    found = g.shortestPaths(_hubs(g))
    cells = F.transform(F.map_entries("distances"), lambda x: F.concat_ws(":", x["key"], x["value"]))
    return found.select("id", F.array_join(F.array_sort(cells), ",").alias("distances"))


def _hubs(g, k: int = 3) -> DataFrame:
    """The k vertices with most in-edges (ties: smaller id) — a DataFrame."""
    return g.inDegrees.orderBy(F.desc("inDegree"), "id").limit(k).select("id")


@q("shortest_paths")
def shortest_paths(spark, sf_dir):
    from weft.operators.paths import shortest_path_rows

    g = graph(spark, sf_dir)
    return shortest_path_rows(g, _hubs(g))


@q("pagerank_tol")
def pagerank_tol(spark, sf_dir):
    from weft.operators.rank import page_rank_scores

    s = page_rank_scores(graph(spark, sf_dir), 0.15, tol=0.01)
    return s.select("id", F.round("pagerank", 6).alias("pagerank"))


# -- feature parts -------------------------------------------------------------
_R6 = ("comm_avg_monthly_charges", "comm_avg_total_charges", "comm_avg_tenure",
       "comm_dev_avg_monthly_charges", "comm_dev_avg_total_charges", "comm_dev_avg_tenure",
       "nghb_avg_monthly_charges", "nghb_avg_total_charges", "nghb_avg_tenure", "pagerank")


def _round6(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in _R6 else F.col(c) for c in df.columns])


@q("community_deviation")
def community_deviation(spark, sf_dir):
    from weft.plans.graph_features import community_deviation as cd

    return _round6(cd(graph(spark, sf_dir), 25))


@q("neighbor_avg_out")
def neighbor_avg_out(spark, sf_dir):
    from weft.plans.graph_features import neighbor_averages

    return _round6(neighbor_averages(graph(spark, sf_dir), "out"))


@q("neighbor_avg_both")
def neighbor_avg_both(spark, sf_dir):
    from weft.plans.graph_features import neighbor_averages

    return _round6(neighbor_averages(graph(spark, sf_dir), "both"))


@q("graph_features")
def graph_features(spark, sf_dir):
    from weft.plans.graph_features import graph_features as gf

    return _round6(gf(graph(spark, sf_dir)))


# -- customer features, cleanup, charts, profile ----------------------------------
@q("customer_features")
def customer_features(spark, sf_dir):
    from weft.plans.customer_features import customer_features as cf

    return cf(cg.customers(spark, sf_dir))


@q("column_cleanup")
def column_cleanup(spark, sf_dir):
    from weft.plans.customer_features import bronze_customers, silver_customers

    return silver_customers(bronze_customers(cg.customers(spark, sf_dir)))


@q("try_cast_clean")
def try_cast_clean(spark, sf_dir):
    silver = column_cleanup(spark, sf_dir)
    return silver.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("total_charges").isNull().cast("long")).alias("blank_totals"),
        F.round(F.sum(F.round(F.col("total_charges") * 100).cast("long")) / 100.0, 2).alias("sum_totals"),
    )


@q("category_counts")
def category_counts(spark, sf_dir):
    from weft.plans.profile import grouped_counts

    return grouped_counts(cg.customers(spark, sf_dir), "segment", "churn")


@q("contract_share")
def contract_share(spark, sf_dir):
    from weft.plans.profile import share

    s = share(cg.customers(spark, sf_dir), "priority")
    return s.select("priority", "n", F.round("share", 6).alias("share"))


@q("categories_by_total")
def categories_by_total(spark, sf_dir):
    from weft.plans.profile import categories_by_total as cbt

    return cbt(cg.customers(spark, sf_dir), "priority", "churn")


@q("sample_with_replacement")
def sample_with_replacement(spark, sf_dir):
    """10,000 customers drawn with replacement, how often each was drawn."""
    from weft.plans.profile import sample_rows

    c = cg.customers(spark, sf_dir).select("customer_id", "priority", "churn")
    drawn = sample_rows(c, 10_000, seed=123, key=["customer_id"])
    return drawn.groupBy("customer_id", "priority", "churn").agg(F.count(F.lit(1)).alias("times"))


def _ranked(counts, by, spark):
    from weft.operators.sequence import numbered

    placed = numbered(counts, [F.desc(by), F.col("id")], "place")
    return placed.withColumn("place", F.col("place") + 1)


@q("degree_places")
def degree_places(spark, sf_dir):
    """Vertices ranked by degree, with their place."""
    return _ranked(degrees(spark, sf_dir), "degree", spark)


@q("triangle_places")
def triangle_places(spark, sf_dir):
    """Vertices ranked by their number of triangles, with their place."""
    return _ranked(triangle_count(spark, sf_dir), "count", spark)


@q("histogram")
def histogram(spark, sf_dir):
    from weft.plans.profile import histogram as hist

    return hist(cg.customers(spark, sf_dir), "tenure", 100.0, "churn")


@q("profile")
def profile(spark, sf_dir):
    from weft.plans.profile import profile_numeric

    p = profile_numeric(cg.customers(spark, sf_dir), ["monthly_charges", "total_charges", "tenure"])
    return p.select("column", "n", "nulls", "distinct_count", "min", "max",
                    F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@q("top_values")
def top_values(spark, sf_dir):
    from weft.plans.profile import top_values as tv

    return tv(cg.customers(spark, sf_dir), ["segment", "region", "priority", "churn"])


# -- activity / churn features -------------------------------------------------------
COUNTRY = "NATION_24"


def _silver(spark, sf_dir):
    from weft.plans import activity as act

    return (
        act.users_silver(act.raw_users(spark, sf_dir)),
        act.orders_silver(act.raw_orders(spark, sf_dir)),
        act.raw_events(spark, sf_dir),
    )


@q("order_stats")
def order_stats(spark, sf_dir):
    from weft.plans.activity import order_stats as os_

    return os_(_silver(spark, sf_dir)[1])


@q("event_stats")
def event_stats(spark, sf_dir):
    from weft.plans.activity import event_stats as es

    return es(_silver(spark, sf_dir)[2])


@q("activity_features")
def activity_features(spark, sf_dir):
    from weft.plans.activity import churn_features

    users, orders, events = _silver(spark, sf_dir)
    return churn_features(users, orders, events)


@q("churn_rule")
def churn_rule(spark, sf_dir):
    from weft.plans import activity as act

    return act.churn_probability(
        act.raw_orders(spark, sf_dir), act.raw_events(spark, sf_dir), act.raw_users(spark, sf_dir),
        platform_a="purchase", platform_b="view", country=COUNTRY,
    )


# -- streams -----------------------------------------------------------------------
_STREAMS: dict = {}


def _stream_tables(spark, sf_dir):
    """Run the stream pipeline once per session and input folder; the stream
    queries read its tables (like the model queries share one training)."""
    from weft.plans import activity_stream as st

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAMS:
        _STREAMS[key] = st.run(spark, sf_dir)
    return _STREAMS[key]


@q("stream_activity_features")
def stream_activity_features(spark, sf_dir):
    from weft.plans import activity_stream as st

    return st.features(spark, _stream_tables(spark, sf_dir))


@q("stream_ingest_orders")
def stream_ingest_orders(spark, sf_dir):
    tables = _stream_tables(spark, sf_dir)
    return spark.read.parquet(tables["orders"])


@q("stream_users")
def stream_users(spark, sf_dir):
    """Silver users (rename, hash, parse, initcap, cast) written by the stream."""
    tables = _stream_tables(spark, sf_dir)
    return spark.read.parquet(tables["users"])


@q("stream_events")
def stream_events(spark, sf_dir):
    """Events landed as CSV and ingested by the stream (rescued column dropped)."""
    tables = _stream_tables(spark, sf_dir)
    return spark.read.parquet(tables["events"]).drop("_rescued_data")


_CHURN_RULE = {"platform_a": "purchase", "platform_b": "view", "country": COUNTRY}


@q("labelled_users")
def labelled_users(spark, sf_dir):
    """Raw users with their address and drawn churn label."""
    from weft.plans import activity as act

    return act.labelled_users(spark, sf_dir, **_CHURN_RULE)


@q("stream_churn_features")
def stream_churn_features(spark, sf_dir):
    """Labelled users, orders and events through the streams into the churn
    feature table."""
    from weft.plans import activity as act
    from weft.plans import activity_stream as st

    key = (spark.sparkContext.applicationId, sf_dir, "labelled")
    if key not in _STREAMS:
        _STREAMS[key] = st.run(spark, sf_dir, labelled=act.labelled_users(spark, sf_dir, **_CHURN_RULE))
    return st.features(spark, _STREAMS[key])


@q("stream_schema_evolution")
def stream_schema_evolution(spark, sf_dir):
    """Orders landed in three drops; the second and third have fields that the
    first lacks.  A field is rescued in the run that meets it and a column
    from the next run on."""
    from weft.plans import activity_stream as st

    return st.orders_with_new_fields(spark, sf_dir)


@q("latest_order")
def latest_order(spark, sf_dir):
    """Latest order per customer: date, then order key, descending (ORD-02)."""
    from weft.operators.sequence import latest_per_key
    from weft.sources.tables import table

    od = table(spark, sf_dir, "orders")
    return latest_per_key(
        od, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate", "o_totalprice"]
    ).withColumnRenamed("o_custkey", "customer_id")


# -- model stage -----------------------------------------------------------------------
def _score_frame(spark, sf_dir):
    """Customers with a 0/1 label and a fixed [0, 1] score from the balance."""
    c = cg.customers(spark, sf_dir)
    return c.select(
        "customer_id",
        F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("label"),
        ((F.col("monthly_charges") + 1000.0) / 11000.0).alias("score"),
    )


@q("classification_metrics")
def classification_metrics(spark, sf_dir):
    """Metrics by split of a fixed score column."""
    from weft.plans import model as m

    s = m.with_split(_score_frame(spark, sf_dir), "customer_id").withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int"))
    got = m.classification_metrics(s, "label", "score", "prediction", "split")
    return got.select("split", "n", *[F.round(c, 9).alias(c) for c in got.columns if c not in ("split", "n")])


SHAPLEY_WEIGHTS = {"monthly_charges": 0.001, "total_charges": -0.00002, "tenure": 0.003}


@q("shapley_linear")
def shapley_linear(spark, sf_dir):
    """Shapley values of a linear score: 100 examples of the val rows against
    100 background rows of the train rows."""
    from weft.plans import model as m
    from weft.plans.profile import hash_sample

    c = m.with_split(cg.customers(spark, sf_dir), "customer_id").na.drop(subset=list(SHAPLEY_WEIGHTS))
    examples = hash_sample(c.where("split = 'val'"), "customer_id", 100, seed=1)
    background = hash_sample(c.where("split = 'train'"), "customer_id", 100, seed=2)
    line = sum((F.col(f) * w for f, w in SHAPLEY_WEIGHTS.items()), F.lit(1.0))
    got = m.shapley_values(lambda df: df.withColumn("score", line), examples, background, list(SHAPLEY_WEIGHTS),
                           "customer_id")
    return got.select("customer_id", "feature", F.round("contribution", 6).alias("contribution"),
                      F.round("base", 6).alias("base"))


@q("split_counts")
def split_counts(spark, sf_dir):
    from weft.plans.model import with_split

    c = cg.customers(spark, sf_dir)
    return with_split(c, "customer_id").groupBy("split", "churn").agg(F.count(F.lit(1)).alias("n"))


@q("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    from weft.plans.model import confusion_matrix as cm

    s = _score_frame(spark, sf_dir).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return cm(s, "label")


@q("roc_points")
def roc_points(spark, sf_dir):
    from weft.plans.model import roc_points as rp

    p = rp(_score_frame(spark, sf_dir), "label", "score")
    return p.select(F.round("threshold", 6).alias("threshold"), F.round("fpr", 9).alias("fpr"),
                    F.round("tpr", 9).alias("tpr"))


@q("pr_points")
def pr_points(spark, sf_dir):
    from weft.plans.model import pr_points as pp

    p = pp(_score_frame(spark, sf_dir), "label", "score")
    return p.select(F.round("threshold", 6).alias("threshold"), F.round("recall", 9).alias("recall"),
                    F.round("precision", 9).alias("precision"))


@q("roc_auc")
def roc_auc(spark, sf_dir):
    from weft.plans.model import roc_auc as auc

    a = auc(_score_frame(spark, sf_dir), "label", "score")
    return a.select(F.round("auc", 9).alias("auc"))


_TRAINING: dict = {}
_MODELS: dict = {}


def _training_rows(spark, sf_dir):
    """Customer and graph features with their split, made once per session
    and input folder."""
    from weft.operators.iterate import cut
    from weft.plans import model as m
    from weft.plans.customer_features import customer_features as cf
    from weft.plans.graph_features import graph_features as gf

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINING:
        g = graph(spark, sf_dir)
        # the graph's vertices are the customers, written once
        ts = m.training_set(cf(g.vertices.withColumnRenamed("id", "customer_id")), gf(g))
        _TRAINING[key] = cut(m.with_split(ts, "customer_id"))
    return _TRAINING[key]


def _trained(spark, sf_dir):
    """Train once per session and input folder (the model queries share it):
    (model, its columns, training set, validation curve)."""
    from weft.plans import model as m

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        ts = _training_rows(spark, sf_dir)
        model, cols, curve = m.train_stopped(ts, "customer_id", "churn")
        _MODELS[key] = (model, cols, ts, curve)
    return _MODELS[key]


@q("model_metrics")
def model_metrics(spark, sf_dir):
    from weft.plans import model as m

    model, cols, ts, _ = _trained(spark, sf_dir)
    return m.metrics(m.score(model, ts, cols, "churn"), "churn")


@q("validation_curve")
def validation_curve(spark, sf_dir):
    """Validation loss by round; the model has the trees up to ``best``."""
    model, _, _, curve = _trained(spark, sf_dir)
    best = model.stages[-1].getNumTrees
    return spark.createDataFrame([(i + 1, float(x), i + 1 == best) for i, x in enumerate(curve)],
                                 "round int, loss double, best boolean")


@q("model_search")
def model_search(spark, sf_dir):
    """Grid search over the training set, compared on the val rows: one
    (params, auc) row per candidate."""
    from weft.plans import model as m

    return m.search(_training_rows(spark, sf_dir), "customer_id", "churn")[2]


@q("feature_importance")
def feature_importance(spark, sf_dir):
    from weft.plans import model as m

    model, cols, ts, _ = _trained(spark, sf_dir)
    return m.feature_importances(spark, model, cols, ts)


@q("permutation_importance")
def permutation_importance(spark, sf_dir):
    from weft.plans import model as m

    model, cols, ts, _ = _trained(spark, sf_dir)
    return m.permutation_importance(model, ts, cols, "customer_id", "churn")


@q("model_shapley")
def model_shapley(spark, sf_dir):
    """Shapley values of the model's score: 100 val rows against 100 train
    rows (both samples by hash, as the sizes of the explainer)."""
    from weft.plans import model as m
    from weft.plans.profile import hash_sample

    model, cols, ts, _ = _trained(spark, sf_dir)
    examples = hash_sample(ts.where("split = 'val'"), "customer_id", 100, seed=1)
    background = hash_sample(ts.where("split = 'train'"), "customer_id", 100, seed=2)
    return m.shapley_values(lambda df: m.score(model, df, cols, "churn"), examples, background, cols, "customer_id")


@q("batch_score")
def batch_score(spark, sf_dir):
    from pyspark.ml import PipelineModel

    from weft.operators.iterate import shared_path
    from weft.plans import model as m

    model, cols, ts, _ = _trained(spark, sf_dir)
    path = shared_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    out = m.score(loaded, ts, cols, "churn")
    return out.select("customer_id", "split", "score", "prediction")


@q("csv_customers")
def csv_customers(spark, sf_dir):
    """Customers written as CSV with a header and read back by a schema."""
    from weft.operators.iterate import shared_path
    from weft.sources.tables import csv_dir

    c = cg.customers(spark, sf_dir).select("customer_id", "segment", "monthly_charges", "tenure", "churn")
    path = shared_path(spark, "csv-customers")
    c.write.option("header", True).csv(path)
    return csv_dir(spark, path, c.schema.add("_rescued_data", "string")).drop("_rescued_data")


@q("append_and_delete")
def append_and_delete(spark, sf_dir):
    """Orders of two periods appended to one table, the later ones with a
    further column, and the cheap ones deleted."""
    from weft.operators.iterate import shared_path
    from weft.sources.sinks import append_table, delete_where, read_table

    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    path = shared_path(spark, "appended")
    append_table(od.where("year(o_orderdate) < 1998").drop("o_orderstatus"), path)
    append_table(od.where("year(o_orderdate) >= 1998"), path)
    return read_table(spark, delete_where(spark, path, "o_totalprice < 100000"))


@q("sample_preview")
def sample_preview(spark, sf_dir):
    from weft.plans.profile import hash_sample

    c = cg.customers(spark, sf_dir).select("customer_id", "segment", "monthly_charges", "churn")
    return hash_sample(c, "customer_id", 100, seed=123)


@q("activity_features_sql")
def activity_features_sql(spark, sf_dir):
    """The feature table created by a SQL statement and read by its name."""
    import uuid

    from weft.operators.iterate import shared_path
    from weft.plans.activity import churn_features, churn_table

    name = f"churn_features_{uuid.uuid4().hex[:12]}"
    return churn_table(churn_features(*_silver(spark, sf_dir)), name, shared_path(spark, name))


def _partial_directory_edges(spark, sf_dir):
    """Call edges when the phone directory lists only customers with a
    non-negative balance: unknown numbers become null endpoints (kept)."""
    log = cg.call_log(spark, sf_dir)
    directory = cg.customers(spark, sf_dir).where(F.col("monthly_charges") >= 0).select(
        "customer_id", "mobile_number")
    return cg.edges_from_call_log(log, directory, drop_unmatched=False)


@q("call_edges_unmatched")
def call_edges_unmatched(spark, sf_dir):
    return _partial_directory_edges(spark, sf_dir)


@q("unmatched_degrees")
def unmatched_degrees(spark, sf_dir):
    from weft.operators.degrees import degrees as dg

    return dg(_partial_directory_edges(spark, sf_dir))


@q("profile_quantiles")
def profile_quantiles(spark, sf_dir):
    from weft.plans.profile import profile_quantiles as pq

    return pq(cg.customers(spark, sf_dir), ["monthly_charges", "total_charges", "tenure"])


@q("training_set")
def training_set(spark, sf_dir):
    """Customer and graph feature tables written as keyed tables (key checked
    non-null and unique), read back, and left-joined on the key."""
    from weft.operators.iterate import shared_path
    from weft.plans.customer_features import customer_features as cf
    from weft.plans.graph_features import graph_features as gf
    from weft.plans.model import training_set as ts
    from weft.sources.sinks import read_table, write_feature_table

    root = shared_path(spark, "feature-tables")
    write_feature_table(cf(cg.customers(spark, sf_dir)), f"{root}/customer_features", "customer_id",
                        "customer attributes: one-hot categoricals, label")
    write_feature_table(_round6(gf(graph(spark, sf_dir))), f"{root}/graph_features", "customer_id",
                        "features of the customer call network")
    return ts(read_table(spark, f"{root}/customer_features"), read_table(spark, f"{root}/graph_features"))
