"""Table scans.  Readers are lazy: Catalyst pushes filters and the
projection into the parquet scan (``PushedFilters`` / ``ReadSchema``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def csv_dir(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV folder with a header row; malformed rows keep a ``_rescued_data`` column."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", "_rescued_data")
    return reader.csv(path)


def json_dir(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON-lines folder; rows that miss the schema land in ``_rescued_data``."""
    reader = spark.read.option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_rescued_data"
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _file(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever store Spark reads."""
    files, place = _file(spark, path)
    return files.exists(place)


def path_stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """(time of last change, bytes) of all files at or below ``path``."""
    files, place = _file(spark, path)
    found, last, size = files.listFiles(place, True), 0, 0
    while found.hasNext():
        one = found.next()
        last, size = max(last, one.getModificationTime()), size + one.getLen()
    return last, size


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``."""
    files, place = _file(spark, path)
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(_file(spark, staged)[1], place):
        raise OSError(f"could not move {staged} to {path}")
