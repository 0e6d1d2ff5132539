"""Table sinks over parquet folders (no table-format jars needed).

* ``overwrite_table`` / ``append_table``: plain writes; appends may add
  columns and are read back with ``mergeSchema``.
* ``write_feature_table``: a keyed table — the key is checked non-null and
  unique by distributed aggregates on the written rows before they are published.
* ``delete_where``: DELETE as a rewrite into a new version folder (a table
  being read must not be overwritten in place); returns the new folder.
* run records: append a run, read the latest run of a name (top-1).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.sources.tables import publish


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Append; a partitioned table must be appended with the same
    ``partition_by`` (files written outside the partition folders would
    clash with the partition column and be lost on read)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def check_key(df: DataFrame, key: str | list[str]) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    null_cond = F.lit(False)
    for k in keys:
        null_cond = null_cond | F.col(k).isNull()
    if not df.where(null_cond).limit(1).isEmpty():
        raise ValueError(f"primary key {keys} has null values")
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    if not dup.limit(1).isEmpty():
        raise ValueError(f"primary key {keys} is not unique")


def write_feature_table(df: DataFrame, path: str, key: str | list[str], description: str = "") -> str:
    """Write the table, check the key of what was written, and only then put
    it in the place of the old one; key and description are kept beside it (in
    ``_meta``, which parquet readers skip).  ``df`` is computed once."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:8]}"
    overwrite_table(df, staged)
    check_key(spark.read.parquet(staged), key)
    publish(spark, staged, path)
    meta = {"primary_keys": [key] if isinstance(key, str) else list(key), "description": description,
            "columns": df.columns}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/_meta")
    return path


def feature_table_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/_meta").first()[0])


def delete_where(spark: SparkSession, path: str, condition: str | Column) -> str:
    """Rows matching ``condition`` removed; written to a fresh version folder."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    kept = read_table(spark, path).where(~F.coalesce(cond, F.lit(False)))
    new_path = f"{path.rstrip('/')}.v{uuid.uuid4().hex[:8]}"
    kept.write.mode("overwrite").parquet(new_path)
    return new_path


def append_run(spark: SparkSession, path: str, name: str, **fields) -> None:
    """Append one run record (name, date, extra fields; new fields merge)."""
    row = {"name": name, "date": _dt.datetime.now(_dt.timezone.utc).isoformat(), **{k: str(v) for k, v in fields.items()}}
    cols = list(row)
    spark.createDataFrame([tuple(row[c] for c in cols)], ", ".join(f"`{c}` string" for c in cols)).write.mode(
        "append").parquet(path)


def latest_run(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The most recent run of ``name`` (top-1 by date)."""
    return read_table(spark, path).where(F.col("name") == name).orderBy(F.desc("date")).limit(1)
