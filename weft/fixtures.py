"""The seven-person example graph used by the unit tests (packaged example)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from weft.graph import PropertyGraph

# fixed values: the example graph
PEOPLE = [
    ("a", "Alice", 34),
    ("b", "Bob", 36),
    ("c", "Charlie", 30),
    ("d", "David", 29),
    ("e", "Esther", 32),
    ("f", "Fanny", 36),
    ("g", "Gabby", 60),
]
LINKS = [
    ("a", "b", "friend"),
    ("b", "c", "follow"),
    ("c", "b", "follow"),
    ("f", "c", "follow"),
    ("e", "f", "follow"),
    ("e", "d", "friend"),
    ("d", "a", "friend"),
    ("a", "e", "friend"),
]


def friends(spark: SparkSession) -> PropertyGraph:
    v = spark.createDataFrame(PEOPLE, "id string, name string, age long")
    e = spark.createDataFrame(LINKS, "src string, dst string, relationship string")
    return PropertyGraph(v, e)
