"""The schema of a raw folder, kept beside the stream's checkpoint.

Every version is one small JSON file under ``{location}/versions``; a
run reads the newest.  The first run infers a schema from the folder (or is
given one), with hints in place of inferred types; later runs infer nothing.
A field that no version knows is kept in the rows' rescued data; ``widen``
looks at what was rescued since the newest version and writes the next one,
with a column for each such field.  Of CSV files the header of every file is
kept as well, since files of one folder may differ in their columns.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.sources.tables import path_exists

RESCUED = "_rescued_data"
MAX_NEW_FIELDS = 1000  # new columns a run adds; further fields stay rescued, the commonest come first
# tried in this order on the rescued text of a new field
FIELD_TYPES = ("bigint", "double", "boolean")


def with_hints(schema: T.StructType, hints: str | T.StructType | None) -> T.StructType:
    """``schema`` with the types of ``hints`` (DDL); fields that only the
    hints have come last."""
    if not hints:
        return schema
    hinted = T.StructType.fromDDL(hints) if isinstance(hints, str) else hints
    types = {f.name: f for f in hinted.fields}
    known = [types.get(f.name, f) for f in schema.fields]
    return T.StructType(known + [f for f in hinted.fields if f.name not in schema.fieldNames()])


class SchemaStore:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def _record(self) -> dict | None:
        if not path_exists(self.spark, f"{self.location}/versions"):
            return None
        got = self.spark.read.option("recursiveFileLookup", True).text(f"{self.location}/versions").select("value")
        records = [json.loads(r.value) for r in got.collect()]  # one row per version
        return max(records, key=lambda r: r["version"]) if records else None

    def latest(self) -> T.StructType | None:
        record = self._record()
        return T.StructType.fromJson(record["schema"]) if record else None

    def version(self) -> int:
        """Number of the newest version, -1 if there is none."""
        record = self._record()
        return record["version"] if record else -1

    def add(self, schema: T.StructType) -> None:
        version = self.version() + 1
        record = {"version": version, "written": time.time(), "schema": schema.jsonValue()}
        self.spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.text(
            f"{self.location}/versions/{version:06d}")

    def widen(self, table_path: str, hints: str | None = None) -> list[str]:
        """Write the next version if rows of ``table_path`` written since the
        newest one have rescued fields that it lacks; returns their names."""
        record = self._record()
        if record is None or not path_exists(self.spark, table_path):
            return []
        schema = T.StructType.fromJson(record["schema"])
        rows = self.spark.read.option("mergeSchema", True).parquet(table_path)
        if RESCUED not in rows.columns:
            return []
        since = F.timestamp_seconds(F.lit(record["written"]))
        fresh = rows.where(F.col(RESCUED).isNotNull() & (F.col("_metadata.file_modification_time") >= since))
        found = rescued_fields(fresh, schema.fieldNames())
        if found.fields:
            hinted = with_hints(found, hints)
            self.add(T.StructType(schema.fields + [hinted[f] for f in found.fieldNames()]))
        return found.fieldNames()

    def headers(self, path: str) -> DataFrame:
        """(file, header) of the CSV files of a folder; only files that are
        not kept yet are read."""
        kept_at = f"{self.location}/headers"
        name = F.col("_metadata.file_path").alias("file")
        files = self.spark.read.format("binaryFile").load(path).select(name)  # lists, reads no content
        kept = self.spark.read.parquet(kept_at) if path_exists(self.spark, kept_at) else None
        new = files if kept is None else files.join(kept, "file", "left_anti")
        new_files = [r.file for r in new.collect()]  # paths, which a file source lists on the driver anyway
        if new_files:
            lines = self.spark.read.text(new_files).where(
                (F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
            lines = lines.select(name, "value", F.monotonically_increasing_id().alias("_at"))
            lines.groupBy("file").agg(F.min_by("value", "_at").alias("header")).write.mode("append").parquet(kept_at)
        if not path_exists(self.spark, kept_at):
            return self.spark.createDataFrame([], "file string, header string")
        return self.spark.read.parquet(kept_at)


def rescued_fields(rows: DataFrame, known: list[str]) -> T.StructType:
    """Names and types of the fields in the rescued data of ``rows`` that are
    not ``known``: the first of FIELD_TYPES that all values fit, else string."""
    field = F.explode(F.from_json(RESCUED, "map<string,string>")).alias("name", "value")
    fits = [F.bool_and(F.col("value").try_cast(t).isNotNull()).alias(t) for t in FIELD_TYPES]
    found = (rows.select(field).where(F.col("value").isNotNull() & ~F.col("name").isin(*known, "_line"))
             .groupBy("name").agg(F.count(F.lit(1)).alias("n"), *fits)
             .orderBy(F.desc("n"), "name").limit(MAX_NEW_FIELDS).collect())
    return T.StructType([
        T.StructField(r["name"], T.StructType.fromDDL(f"x {next((t for t in FIELD_TYPES if r[t]), 'string')}")[0].dataType)
        for r in sorted(found, key=lambda r: r["name"])])
