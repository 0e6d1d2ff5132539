"""Motif pattern forms."""

import pytest

from weft.operators.motif import parse


def test_parse_forms():
    assert parse("(a)-[e]->(b); (b)-[]->(c)") == [(False, "a", "e", "b"), (False, "b", None, "c")]
    t = parse("(a)-[]->(); !(a)-[]->(b); (x)")
    assert t[0][0] is False and t[0][3].startswith("__anon")
    assert t[1] == (True, "a", None, "b") and t[2] == (False, "x", None, None)
    with pytest.raises(ValueError):
        parse("(a)->(b)")


def test_vertex_term_and_anonymous(g):
    # every vertex with an out-edge: anonymous destination
    m = g.find("(a)-[]->()")
    assert sorted({r[0] for r in m.select("a.id").collect()}) == ["a", "b", "c", "d", "e", "f"]
    assert m.columns == ["a"]
    both = g.find("(a)-[e]->(b); (a)")
    assert both.count() == 8 and set(both.columns) == {"a", "e", "b"}


def test_self_loop_term(spark):
    from weft.graph import PropertyGraph

    v = spark.createDataFrame([(1,), (2,)], "id long")
    e = spark.createDataFrame([(1, 1), (1, 2)], "src long, dst long")
    m = PropertyGraph(v, e).find("(a)-[e]->(a)")
    assert [r[0] for r in m.select("a.id").collect()] == [1]


def test_edge_to_absent_vertex_is_not_matched(spark):
    from weft.graph import PropertyGraph

    v = spark.createDataFrame([(1,), (2,)], "id long")
    e = spark.createDataFrame([(1, 2), (2, 9)], "src long, dst long")
    assert PropertyGraph(v, e).find("(a)-[e]->(b)").count() == 1
