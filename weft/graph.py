"""Property graph over two DataFrames.

``vertices`` must have an ``id`` column; ``edges`` must have ``src`` and
``dst``.  Any other columns are attributes.  Like the API it mirrors, the
constructor does not check referential integrity: an edge may name an
absent vertex.  Degree queries see raw edges; the iterative algorithms work
on edges whose both endpoints are vertices (``valid_edges``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class PropertyGraph:
    def __init__(self, vertices: DataFrame, edges: DataFrame):
        if "id" not in vertices.columns:
            raise ValueError("vertex DataFrame needs an 'id' column")
        missing = {"src", "dst"} - set(edges.columns)
        if missing:
            raise ValueError(f"edge DataFrame needs columns {sorted(missing)}")
        self._v = vertices
        self._e = edges
        self._valid: DataFrame | None = None

    # -- basic access -----------------------------------------------------
    @property
    def vertices(self) -> DataFrame:
        return self._v

    @property
    def edges(self) -> DataFrame:
        return self._e

    @property
    def spark(self):
        return self._v.sparkSession

    def valid_edges(self) -> DataFrame:
        """Edges (src, dst) whose endpoints are both vertices (semi joins).

        Computed once per graph and checkpointed, so the algorithms run on
        the same graph (e.g. the feature table) do not repeat the two joins.
        """
        if self._valid is None:
            from weft.operators.iterate import cut

            ids = self._v.select("id")
            e = self._e.select("src", "dst")
            e = e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
            e = e.join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")
            self._valid = cut(e)
        return self._valid

    def validate(self) -> DataFrame:
        """Edges that name an absent vertex (anti joins)."""
        ids = self._v.select("id")
        a = self._e.join(ids.withColumnRenamed("id", "src"), "src", "left_anti")
        b = self._e.join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti")
        return a.unionByName(b).distinct()

    # -- degrees ----------------------------------------------------------
    @property
    def inDegrees(self) -> DataFrame:
        from weft.operators.degrees import in_degrees

        return in_degrees(self._e)

    @property
    def outDegrees(self) -> DataFrame:
        from weft.operators.degrees import out_degrees

        return out_degrees(self._e)

    @property
    def degrees(self) -> DataFrame:
        from weft.operators.degrees import degrees

        return degrees(self._e)

    def neighbors(self, strict_parity: bool = False) -> DataFrame:
        from weft.operators.degrees import neighbors

        return neighbors(self._e, strict_parity)

    # -- subgraphs --------------------------------------------------------
    def filterEdges(self, condition: str | Column) -> PropertyGraph:
        return PropertyGraph(self._v, self._e.filter(condition))

    def filterVertices(self, condition: str | Column) -> PropertyGraph:
        v = self._v.filter(condition)
        ids = v.select("id")
        e = self._e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
        e = e.join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        return PropertyGraph(v, e.select(*self._e.columns))

    def dropIsolatedVertices(self) -> PropertyGraph:
        ends = self._e.select(F.explode(F.array("src", "dst")).alias("id"))
        v = self._v.join(ends, "id", "left_semi")
        return PropertyGraph(v, self._e)

    # -- queries and algorithms ------------------------------------------
    def find(self, pattern: str) -> DataFrame:
        from weft.operators.motif import find

        return find(self, pattern)

    def bfs(self, fromExpr, toExpr, edgeFilter=None, maxPathLength: int = 10) -> DataFrame:
        from weft.operators.paths import bfs

        return bfs(self, fromExpr, toExpr, edgeFilter, maxPathLength)

    def shortestPaths(self, landmarks) -> DataFrame:
        from weft.operators.paths import shortest_paths

        return shortest_paths(self, landmarks)

    def connectedComponents(self) -> DataFrame:
        from weft.operators.components import connected_components

        return connected_components(self)

    def stronglyConnectedComponents(self, maxIter: int | None = None) -> DataFrame:
        from weft.operators.components import strongly_connected_components

        return strongly_connected_components(self, maxIter)

    def labelPropagation(self, maxIter: int) -> DataFrame:
        from weft.operators.labels import label_propagation

        return label_propagation(self, maxIter)

    def pageRank(self, resetProbability: float = 0.15, sourceId=None, maxIter=None, tol=None):
        from weft.operators.rank import page_rank

        return page_rank(self, resetProbability, sourceId=sourceId, maxIter=maxIter, tol=tol)

    def triangleCount(self) -> DataFrame:
        from weft.operators.triangles import triangle_count

        return triangle_count(self)

    @property
    def pregel(self):
        from weft.operators.pregel import Pregel

        return Pregel(self)
