"""Bulk-synchronous message passing over DataFrames.

One superstep: triplets (edge joined with the source and destination
vertex state) produce messages, messages are aggregated per target vertex,
and every vertex column is updated from its old value and the aggregated
message (null when none arrived).  The edges are pinned in up to two layouts:
by ``src`` for messages that read no destination state, by ``dst`` for those
that read no source state.  In either one only the vertex state moves in a
round; a message that reads both ends joins the second state to the triplets
of the first layout.  The state's lineage is cut every few supersteps.

Usage mirrors the builder of the library API::

    ranks = (g.pregel.setMaxIter(5)
             .withVertexColumn("rank", init, update)
             .sendMsgToDst(Pregel.src("rank") / Pregel.src("outDegree"))
             .aggMsgs(F.sum(Pregel.msg()))
             .run())
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weft.operators.iterate import KeyedEdges, Rounds

_MSG = "_pregel_msg"


class Pregel:
    def __init__(self, graph):
        self._g = graph
        self._max_iter = 10
        self._cols: list[tuple[str, Column, Column]] = []
        self._to_dst: list[Column] = []
        self._to_src: list[Column] = []
        self._agg: Column | None = None
        self._every = 2

    # placeholders ---------------------------------------------------------
    @staticmethod
    def msg() -> Column:
        return F.col(_MSG)

    @staticmethod
    def src(name: str) -> Column:
        return F.col("src").getField(name)

    @staticmethod
    def dst(name: str) -> Column:
        return F.col("dst").getField(name)

    @staticmethod
    def edge(name: str) -> Column:
        return F.col("edge").getField(name)

    # builder --------------------------------------------------------------
    def setMaxIter(self, n: int) -> Pregel:
        self._max_iter = n
        return self

    def setCheckpointInterval(self, n: int) -> Pregel:
        self._every = n
        return self

    def withVertexColumn(self, name: str, init: Column, update: Column) -> Pregel:
        self._cols.append((name, init, update))
        return self

    def sendMsgToDst(self, expr: Column) -> Pregel:
        self._to_dst.append(expr)
        return self

    def sendMsgToSrc(self, expr: Column) -> Pregel:
        self._to_src.append(expr)
        return self

    def aggMsgs(self, expr: Column) -> Pregel:
        self._agg = expr
        return self

    # run ------------------------------------------------------------------
    def run(self) -> DataFrame:
        if self._agg is None or not (self._to_dst or self._to_src):
            raise ValueError("set a message and an aggregate first")
        g = self._g
        v = g.vertices
        e = g.edges
        plain = e.select(F.col("src").alias("_s"), F.col("dst").alias("_d"), F.struct(*e.columns).alias("edge"))
        state = v.select("*", *[init.alias(name) for name, init, _ in self._cols])
        reads = self._reads(state, plain)
        # (target of the message, its expression, the states that it reads)
        messages = [(end, m, reads(m)) for end, ms in (("_d", self._to_dst), ("_s", self._to_src)) for m in ms]
        layouts = {"_s": None, "_d": None}
        for key in layouts:
            if any(self._layout(r) == key for _, _, r in messages):
                layouts[key] = KeyedEdges(plain, key)
        n = max(x.n for x in layouts.values() if x)
        state = state.repartition(n, "id")
        n_vertices = v.count()
        loop = Rounds(self._every)
        try:
            for i in range(self._max_iter):
                vs = state.select(F.col("id").alias("_k"), F.struct(*state.columns).alias("_v"))
                parts = [self._triplets(layouts, vs, r, n_vertices).select(F.col(end).alias("_t"), m.alias(_MSG))
                         for end, m, r in messages]
                msgs = parts[0]
                for p in parts[1:]:
                    msgs = msgs.unionByName(p)
                agg = msgs.where(F.col(_MSG).isNotNull()).groupBy("_t").agg(self._agg.alias(_MSG))
                joined = state.join(agg, state.id == agg._t, "left").drop("_t")
                keep = [c for c in state.columns if c not in {name for name, _, _ in self._cols}]
                state = joined.select(*keep, *[upd.alias(name) for name, _, upd in self._cols])
                state = loop.step(state, i)
            return state
        finally:
            for x in layouts.values():
                if x:
                    x.unpersist()

    @staticmethod
    def _reads(state: DataFrame, plain: DataFrame):
        """A function that tells which ends' states a message reads: the
        columns that it refers to on triplets without rows."""
        ends = ("src", "dst")
        triplet = StructType([plain.schema["edge"], *[StructField(end, state.schema) for end in ends]])
        empty = state.sparkSession.createDataFrame([], triplet)

        def reads(message: Column) -> frozenset[str]:
            refs = empty.select(message)._jdf.queryExecution().analyzed().references().toSeq()
            return frozenset({refs.apply(i).name() for i in range(refs.size())} & set(ends))

        return reads

    @staticmethod
    def _layout(reads: frozenset[str]) -> str:
        return "_d" if reads == {"dst"} else "_s"

    def _triplets(self, layouts: dict, vs: DataFrame, reads: frozenset[str], n_vertices: int) -> DataFrame:
        """Edges with the states that a message reads."""
        key = self._layout(reads)
        first = "dst" if key == "_d" else "src"
        trip = layouts[key].join(vs.withColumnRenamed("_v", first), "_k", state_rows=n_vertices).drop("_k")
        if reads == {"src", "dst"}:
            trip = trip.join(vs.withColumnRenamed("_k", "_d").withColumnRenamed("_v", "dst"), "_d")
        return trip
