"""Motif search: a pattern of edge terms becomes a chain of equi-joins.

Pattern grammar (terms separated by ';')::

    (a)-[e]->(b)      edge e from a to b; names bind one element each
    (a)               vertex a on its own
    ()  []            anonymous vertex / edge (not returned)
    !(a)-[]->(b)      no edge from a to b (a and b bound elsewhere)

The same name in two terms is the same element (join); different names may
bind the same element.  Edge terms are joined on vertex ids only, and the
attribute structs of named vertices are attached at the end, so the wide
rows travel through as few joins as possible.  A negated term is a left
anti join.  Patterns whose terms share no vertex would need a cross product
and are rejected.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EDGE = re.compile(r"^(!?)\((\w*)\)-\[(\w*)\]->\((\w*)\)$")
_VERTEX = re.compile(r"^\((\w*)\)$")


def parse(pattern: str) -> list[tuple[bool, str | None, str | None, str | None]]:
    """Terms as (negated, src name, edge name, dst name); dst None = vertex term."""
    terms = []
    anon = 0
    for raw in pattern.split(";"):
        t = re.sub(r"\s+", "", raw)
        if not t:
            continue
        m = _EDGE.match(t)
        if m:
            neg, a, e, b = m.groups()
            if not a:
                a, anon = f"__anon{anon}", anon + 1
            if not b:
                b, anon = f"__anon{anon}", anon + 1
            terms.append((bool(neg), a, e or None, b))
            continue
        m = _VERTEX.match(t)
        if m and m.group(1):
            terms.append((False, m.group(1), None, None))
            continue
        raise ValueError(f"cannot parse motif term {raw!r}")
    return terms


def find(g, pattern: str) -> DataFrame:
    terms = parse(pattern)
    v, e = g.vertices, g.edges
    order: list[str] = []  # output order of named elements
    bound: set[str] = set()
    acc: DataFrame | None = None

    def note(name):
        if name and not name.startswith("__anon") and name not in order:
            order.append(name)

    for neg, a, en, b in terms:
        note(a)
        if b is not None and not neg:
            note(en)
            note(b)
    for neg, a, en, b in terms:
        if neg:
            continue
        if b is None:
            frame = v.select(F.col("id").alias(f"_id_{a}"))
            names = {a}
        else:
            cols = [F.col("src").alias(f"_id_{a}")]
            if b != a:
                cols.append(F.col("dst").alias(f"_id_{b}"))
            if en:
                cols.append(F.struct(*e.columns).alias(en))
            frame = e
            if b == a:
                frame = frame.where(F.col("src") == F.col("dst"))
            frame = frame.select(*cols)
            names = {a, b}
        if acc is None:
            acc = frame
        else:
            shared = sorted(names & bound)
            if not shared:
                raise ValueError("motif terms must share a vertex (no cross products)")
            acc = acc.join(frame, [f"_id_{x}" for x in shared])
        bound |= names
    if acc is None:
        raise ValueError("motif needs at least one positive term")
    for neg, a, en, b in terms:
        if not neg:
            continue
        if b is None or a not in bound or b not in bound:
            raise ValueError("negated terms need both endpoints bound by positive terms")
        ne = e.select(F.col("src").alias(f"_id_{a}"), F.col("dst").alias(f"_id_{b}"))
        acc = acc.join(ne, [f"_id_{a}", f"_id_{b}"], "left_anti")
    # every bound vertex must exist; named ones carry their attribute struct
    for name in sorted(bound):
        vs = v.select(F.col("id").alias(f"_id_{name}"), F.struct(*v.columns).alias(name))
        if name.startswith("__anon"):
            acc = acc.join(vs.select(f"_id_{name}"), f"_id_{name}", "left_semi")
        else:
            acc = acc.join(vs, f"_id_{name}")
    return acc.select(*order)


def walks(g, steps: int, wanted: str, at_least: int) -> DataFrame:
    """(v0 .. v<steps>, n) of every walk of ``steps`` edges with ``n`` >=
    ``at_least`` edges that meet the condition ``wanted``.

    Partial walks that the remaining edges cannot bring to ``at_least`` are
    dropped before the next join."""
    edges = g.edges.select("src", "dst", F.when(F.expr(wanted), 1).otherwise(0).alias("hit"))
    ids = g.vertices.select("id")
    edges = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    out = edges.select(F.col("src").alias("v0"), F.col("dst").alias("v1"), F.col("hit").alias("n"))
    for k in range(1, steps):
        can = out.where(F.col("n") >= at_least - (steps - k))
        out = can.join(edges, can[f"v{k}"] == edges["src"]).select(
            *[f"v{i}" for i in range(k + 1)], F.col("dst").alias(f"v{k + 1}"), (F.col("n") + F.col("hit")).alias("n"))
    return out.where(F.col("n") >= at_least)
