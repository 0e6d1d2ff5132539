"""Edge cases: empty edges, self-loops, parallel edges, null and absent
endpoints, isolated vertices, and graph-level invariants."""

import pytest
from pyspark.sql import functions as F

from weft.graph import PropertyGraph
from weft.operators.components import component_labels, scc_labels
from weft.operators.labels import label_scores
from weft.operators.rank import page_rank_scores
from weft.operators.triangles import triangle_counts


def graph(spark, vs, es):
    v = spark.createDataFrame([(x,) for x in vs], "id long")
    e = spark.createDataFrame(es, "src long, dst long")
    return PropertyGraph(v, e)


def test_empty_edges(spark):
    g = graph(spark, [1, 2, 3], [])
    assert g.degrees.count() == 0
    assert {r[0]: r[1] for r in component_labels(g).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r[0]: r[1] for r in scc_labels(g).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r[0]: r[1] for r in triangle_counts(g).collect()} == {1: 0, 2: 0, 3: 0}
    assert {r[0]: r[1] for r in label_scores(g, 3).collect()} == {1: 1, 2: 2, 3: 3}
    pr = {r[0]: r[1] for r in page_rank_scores(g, max_iter=5).collect()}
    assert all(abs(x - 1.0) < 1e-9 for x in pr.values())


def test_self_loop_and_parallel_edges(spark):
    g = graph(spark, [1, 2], [(1, 1), (1, 2), (1, 2)])
    assert {r[0]: r[1] for r in g.degrees.collect()} == {1: 4, 2: 2}
    assert {r[0]: r[1] for r in triangle_counts(g).collect()} == {1: 0, 2: 0}
    assert {r[0]: r[1] for r in component_labels(g).collect()} == {1: 1, 2: 1}


def test_null_and_absent_endpoints(spark):
    v = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    e = spark.createDataFrame([(1, 2), (2, None), (None, 3), (2, 9)], "src long, dst long")
    g = PropertyGraph(v, e)
    deg = {r[0]: r[1] for r in g.degrees.collect()}
    assert deg[None] == 2 and deg[2] == 3  # null endpoints count in degrees
    assert g.valid_edges().count() == 1
    assert g.validate().count() == 3
    assert {r[0]: r[1] for r in component_labels(g).collect()} == {1: 1, 2: 1, 3: 3}


def test_isolated_vertex_in_pagerank(spark):
    g = graph(spark, [1, 2, 3], [(1, 2), (2, 1)])
    pr = {r[0]: r[1] for r in page_rank_scores(g, max_iter=10).collect()}
    assert abs(sum(pr.values()) - 3) < 1e-9 and pr[3] < pr[1]


def test_invariants_on_ring_with_chord(spark):
    es = [(i, (i + 1) % 10) for i in range(10)] + [(0, 5), (5, 0), (2, 7)]
    g = graph(spark, list(range(12)), es)
    ins = g.inDegrees.agg(F.sum("inDegree")).first()[0]
    outs = g.outDegrees.agg(F.sum("outDegree")).first()[0]
    assert ins == outs == len(es)
    assert g.degrees.agg(F.sum("degree")).first()[0] == 2 * len(es)
    tri = triangle_counts(g).agg(F.sum("count")).first()[0]
    assert tri % 3 == 0
    wcc = {r[0]: r[1] for r in component_labels(g).collect()}
    scc = {r[0]: r[1] for r in scc_labels(g).collect()}
    # SCC refines WCC, labels are the minimum id
    assert all(wcc[v] <= scc[v] for v in wcc)
    assert wcc[10] == 10 and wcc[11] == 11 and wcc[9] == 0 and scc[9] == 0


def test_equal_count_labels_take_smallest(spark):
    # 3 hears 1 and 2 once each: tie -> smallest label
    g = graph(spark, [1, 2, 3], [(1, 3), (2, 3)])
    lab = {r[0]: r[1] for r in label_scores(g, 1).collect()}
    assert lab[3] == 1


def test_bfs_parallel_edges(spark):
    v = spark.createDataFrame([(1, "s"), (2, "m"), (3, "t")], "id long, name string")
    e = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (2, 3, "z")], "src long, dst long, kind string")
    g = PropertyGraph(v, e)
    p = g.bfs("name = 's'", "name = 't'")
    # one row per edge combination: two parallel first hops
    assert sorted(r[0] for r in p.select("e0.kind").collect()) == ["x", "y"]
    from weft.operators.paths import bfs_path_strings
    assert [tuple(r) for r in bfs_path_strings(g, "name = 's'", "name = 't'").collect()] == [("1>2>3", 2)]


def test_properties_on_derived_call_graph(spark):
    from weft.plans import callgraph as cg

    g = cg.silver_graph(spark, "/root/testdata/sf0.001")
    n = g.vertices.count()
    e = g.valid_edges()
    pr = page_rank_scores(g, max_iter=10)
    assert abs(pr.agg(F.sum("pagerank")).first()[0] - n) < 1e-6 * n  # rank sum = |V|
    wcc = component_labels(g)
    scc = scc_labels(g)
    # component label is constant across every edge and is the smallest member id
    ends = e.join(wcc.withColumnRenamed("id", "src").withColumnRenamed("component", "cs"), "src").join(
        wcc.withColumnRenamed("id", "dst").withColumnRenamed("component", "cd"), "dst")
    assert ends.where("cs != cd").count() == 0
    assert wcc.groupBy("component").agg(F.min("id").alias("m")).where("m != component").count() == 0
    assert scc.groupBy("component").agg(F.min("id").alias("m")).where("m != component").count() == 0
    # SCC refines WCC: every strong component lies inside one weak component
    both = scc.withColumnRenamed("component", "s").join(wcc.withColumnRenamed("component", "w"), "id")
    assert both.groupBy("s").agg(F.countDistinct("w").alias("k")).where("k > 1").count() == 0
    assert wcc.count() == scc.count() == n


def test_blank_numeric_strings_become_null_under_ansi(spark):
    from weft.plans.customer_features import silver_customers
    from weft.plans.model import coerce_numeric

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"  # a plain cast would raise
    bronze = spark.createDataFrame([("1", "12.5"), ("2", " "), ("3", ""), ("4", "n/a")], "CustomerID string, TotalCharges string")
    got = {r["customer_id"]: r["total_charges"] for r in silver_customers(bronze).collect()}
    assert got == {"1": 12.5, "2": None, "3": None, "4": None}
    c = coerce_numeric(spark.createDataFrame([(" ", 1), ("2.5", 2)], "f string, k int"), ["f"]).collect()
    assert [r["f"] for r in c] == [None, 2.5]


def test_scc_long_paths_and_limit(spark):
    # a path of 40 into a cycle, and two cycles joined by a path
    edges = [(i, i + 1) for i in range(40)] + [(40, 41), (41, 42), (42, 40)]
    edges += [(100, 101), (101, 100), (101, 102), (102, 103), (103, 104), (104, 103)]
    ids = sorted({x for e in edges for x in e})
    g = PropertyGraph(spark.createDataFrame([(i,) for i in ids], "id long"),
                      spark.createDataFrame(edges, "src long, dst long"))
    got = {r[0]: r[1] for r in scc_labels(g).collect()}
    want = {i: i for i in ids} | {40: 40, 41: 40, 42: 40, 100: 100, 101: 100, 103: 103, 104: 103}
    assert got == want
    with pytest.raises(RuntimeError):
        scc_labels(g, max_iter=0)
