"""Two-way messages and neighbour lists in pieces."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from weft.graph import PropertyGraph
from weft.operators.degrees import neighbor_pieces, neighbors
from weft.operators.pregel import Pregel


@pytest.fixture(scope="module")
def random_graph(spark):
    rng = random.Random(9)
    edges = {(rng.choice([0, rng.randint(0, 59)]), rng.randint(0, 59)) for _ in range(150)}
    v = spark.createDataFrame([(i, i * 7 % 50) for i in range(60)], "id long, x long")
    e = spark.createDataFrame([(a, b, a - b) for a, b in edges] + [(3, 99, 0), (98, 4, 0)], "src long, dst long, w long")
    return PropertyGraph(v, e), edges


def rounds(graph, edges, to_dst, to_src, n=2):
    """Brute force of a sum of messages."""
    state = {r.id: r.x for r in graph.vertices.collect()}
    for _ in range(n):
        got = collections.Counter()
        for a, b in edges:
            if to_dst:
                got[b] += to_dst(state[a], state[b], a - b)
            if to_src:
                got[a] += to_src(state[a], state[b], a - b)
        state = {k: v + got[k] for k, v in state.items()}
    return state


# the state is broadcast up to the limit, and shuffled beyond
@pytest.mark.parametrize("case, limit", [("forward", "2000000"), ("backward", "0"), ("both", "0"), ("mixed", "0"),
                                         ("mixed", "2000000")])
def test_messages_in_both_directions(spark, random_graph, case, limit):
    g, edges = random_graph
    src, dst, w = Pregel.src("y"), Pregel.dst("y"), Pregel.edge("w")
    job = g.pregel.setMaxIter(2).withVertexColumn("y", F.col("x"), F.col("y") + F.coalesce(Pregel.msg(), F.lit(0)))
    job = job.aggMsgs(F.sum(Pregel.msg()))
    if case == "forward":
        job, want = job.sendMsgToDst(src + w), rounds(g, edges, lambda s, d, e: s + e, None)
    elif case == "backward":
        job, want = job.sendMsgToSrc(dst * 2), rounds(g, edges, None, lambda s, d, e: d * 2)
    elif case == "both":
        job = job.sendMsgToDst(src).sendMsgToSrc(dst + w)
        want = rounds(g, edges, lambda s, d, e: s, lambda s, d, e: d + e)
    else:
        job = job.sendMsgToDst(src - dst).sendMsgToSrc(src + dst)
        want = rounds(g, edges, lambda s, d, e: s - d, lambda s, d, e: s + d)
    spark.conf.set("weft.broadcastStateRows", limit)
    try:
        assert {r.id: r.y for r in job.run().collect()} == want
    finally:
        spark.conf.unset("weft.broadcastStateRows")


def test_reads_of_a_message(random_graph):
    g, _ = random_graph
    plain = g.edges.select(F.struct("src", "dst", "w").alias("edge"))
    reads = Pregel._reads(g.vertices, plain)
    assert reads(Pregel.src("x")) == {"src"} and reads(Pregel.dst("x") + Pregel.edge("w")) == {"dst"}
    assert reads(Pregel.src("x") * Pregel.dst("x")) == {"src", "dst"} and reads(F.lit("dst")) == frozenset()


@pytest.mark.parametrize("strict", [False, True])
def test_neighbor_pieces(spark, random_graph, strict):
    g, _ = random_graph
    whole = {r.id: r.neighbors for r in neighbors(g.edges, strict_parity=strict).collect()}
    got = collections.defaultdict(dict)
    for r in neighbor_pieces(g.edges, strict_parity=strict, piece=4).collect():
        assert r.neighbors is None or 1 <= len(r.neighbors) <= 4
        got[r.id][r.piece] = r.neighbors
    assert set(got) == set(whole)
    for k, pieces in got.items():
        assert sorted(pieces) == list(range(len(pieces)))
        if whole[k] is None:
            assert pieces == {0: None}
        else:
            assert sum((pieces[i] for i in sorted(pieces)), []) == sorted(whole[k])
