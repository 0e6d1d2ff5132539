"""Incremental ingest with Structured Streaming.

* ``ingest_folder``: a file stream (JSON lines or CSV with header) written to
  a parquet table folder with a checkpoint (exactly-once across restarts).
  Rows are read as text and parsed once, into a map of their fields; fields of
  the stored schema are cast from it, and what is left (fields that the schema
  lacks, values that do not fit their type, rows that are no JSON) is kept in
  ``_rescued_data``.  The schema is stored beside the checkpoint
  (:mod:`weft.streaming.schema_store`); a run first widens it by the fields
  that were rescued before, so a table grows a column in the run after the one
  that met the field, and older rows read null there.
* ``stream_table``: a stream over such a table folder, transformed by the
  same function the batch path uses, written to the next table folder.

All runs use ``trigger(availableNow=True)``: process what is there, then
stop (drop the trigger for continuous running).  Every folder lives under
the session's shared checkpoint area, never on a machine-local path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from weft.streaming.schema_store import RESCUED, SchemaStore, with_hints


def infer_schema(spark: SparkSession, path: str, fmt: str, sampling_ratio: float = 1.0) -> StructType:
    """Schema of a folder from a batch read, plus the rescue column.  A
    ``sampling_ratio`` below 1 may miss fields that occur in few rows."""
    reader = spark.read.option("samplingRatio", sampling_ratio)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    schema = reader.format(fmt).load(path).schema
    fields = [f for f in schema.fields if f.name != RESCUED]
    return StructType(fields + [StructField(RESCUED, StringType(), True)])


def _declared(schema: StructType | str) -> StructType:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return StructType([f for f in schema.fields if f.name != RESCUED])


def _typed(raw: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return raw
    if isinstance(kind, (StructType, ArrayType, MapType)):
        return F.from_json(raw, kind)
    return raw.try_cast(kind)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row."""
    return F.get(F.transform(F.array(value), use), 0)


def parse_fields(rows: DataFrame, fields: Column, schema: StructType) -> DataFrame:
    """Columns of ``schema`` and the rescued data from ``fields``, a map of
    each row's texts (null where the row is no record), and ``value``, the
    row's own text."""
    rows = rows.select("value", fields.alias("_fields"))
    raw = {f.name: F.col("_fields")[f.name] for f in schema.fields}
    typed = {f.name: _typed(raw[f.name], f.dataType) for f in schema.fields}
    misfits = F.array_compact(F.array(
        F.lit(None).cast("string"),
        *[F.when(raw[f.name].isNotNull() & typed[f.name].isNull(), F.lit(f.name)) for f in schema.fields]))
    names = F.array(*[F.lit(n) for n in typed]) if typed else F.array().cast("array<string>")
    # what a lambda refers to from outside is computed anew for every entry:
    # ``_once`` binds it, and only rows with more values than fit are filtered
    left = _once(misfits, lambda bad: F.map_filter("_fields", lambda k, v: v.isNotNull() & (
        ~F.array_contains(names, k) | F.array_contains(bad, k))))
    fitting = sum((c.isNotNull().cast("int") for c in typed.values()), F.lit(0))
    more = F.size(F.array_compact(F.map_values("_fields"))) > fitting
    rescued = F.when(F.col("_fields").isNull(), F.col("value")).when(
        more, _once(left, lambda x: F.when(F.size(x) > 0, F.to_json(x))))
    return rows.select(*[c.alias(n) for n, c in typed.items()], rescued.alias(RESCUED))


def json_fields(lines: DataFrame, schema: StructType) -> DataFrame:
    return parse_fields(lines.where(F.trim("value") != ""), F.from_json("value", "map<string,string>"), schema)


def csv_fields(lines: DataFrame, headers: DataFrame, schema: StructType) -> DataFrame:
    """``lines`` with their ``file``; ``headers`` (file, header) names the
    columns of each file.  Values beyond the header are kept as ``_c<i>``, and
    a line with more values than any header as ``_line``."""
    def named(text: Column) -> Column:
        cells = F.transform(F.split(text, ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
        return F.transform(cells, lambda c, i: F.when(
            F.array_position(cells, c) == i + 1, c).otherwise(F.concat(c, F.lit("_"), i.cast("string"))))

    width = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    columns = ", ".join([*(f"c{i} string" for i in range(width + 1)), "bad string"])
    options = {"columnNameOfCorruptRecord": "bad", "mode": "PERMISSIVE"}
    header = headers.select(F.col("file").alias("_file"), F.col("header").alias("_header"), named(F.col("header")).alias("_names"))
    joined = lines.join(header, lines["file"] == header["_file"], "left")
    # a file that came after the headers were read: fail, the next run has it
    names = F.when(F.col("_names").isNull(), F.raise_error(F.lit("a CSV file without known header; run again"))).otherwise(
        F.col("_names"))
    body = joined.where((F.trim("value") != "") & (F.col("value") != F.coalesce("_header", F.lit("")))).select(
        "value", names.alias("_names"), F.from_csv("value", F.lit(columns), options).alias("_cells"))
    cells = F.array(*[F.col(f"_cells.c{i}") for i in range(width + 1)])
    label = F.transform(cells, lambda c, i: F.coalesce(F.get("_names", i), F.concat(F.lit("_c"), i.cast("string"))))
    pairs = F.map_from_arrays(label, cells)
    overlong = F.col("_cells.bad").isNotNull() & F.col(f"_cells.c{width}").isNotNull()
    fields = F.when(overlong, F.map_concat(pairs, F.create_map(F.lit("_line"), F.col("value")))).otherwise(pairs)
    return parse_fields(body, fields, schema)


def write_table_stream(df: DataFrame, table_path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    w = (
        df.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name:
        w = w.queryName(name)
    return w.start()


def ingest_folder(
    spark: SparkSession,
    path: str,
    fmt: str,
    table_path: str,
    checkpoint: str,
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
    hints: str | None = None,
    schema_location: str | None = None,
) -> StreamingQuery:
    """Start a run-once file-to-table stream; returns the running query.

    The first run stores ``schema``, or names and types inferred from all rows
    already in the folder (or from a ``sampling_ratio`` share of them) with
    the types of ``hints`` (DDL) in their place, under ``schema_location``
    (default: beside the checkpoint).  Later runs go by what is stored."""
    store = SchemaStore(spark, schema_location or f"{checkpoint.rstrip('/')}-schema")
    known = store.latest()
    if known is None:
        first = _declared(schema if schema is not None else infer_schema(spark, path, fmt, sampling_ratio))
        store.add(with_hints(first, hints))
        known = store.latest()
    elif store.widen(table_path, hints):
        known = store.latest()
    lines = spark.readStream.option("maxFilesPerTrigger", 1000).text(path)
    if fmt == "json":
        rows = json_fields(lines, known)
    elif fmt == "csv":
        rows = csv_fields(lines.select("value", F.col("_metadata.file_path").alias("file")), store.headers(path), known)
    else:
        raise ValueError(f"unknown format {fmt!r}: json or csv")
    return write_table_stream(rows, table_path, checkpoint)


def stream_table(
    spark: SparkSession,
    source_path: str,
    transform: Callable[[DataFrame], DataFrame],
    table_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start a run-once table-to-table stream through ``transform``; columns
    that the source table has gained are read, too."""
    schema = spark.read.option("mergeSchema", True).parquet(source_path).schema
    src = spark.readStream.schema(schema).parquet(source_path)
    return write_table_stream(transform(src), table_path, checkpoint)


def await_all(*queries: StreamingQuery) -> None:
    for qy in queries:
        qy.awaitTermination()
        if qy.exception() is not None:
            raise RuntimeError(f"stream {qy.id} failed: {qy.exception()}")
