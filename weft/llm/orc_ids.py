"""Token ids as ORC files: stripes with run-length encoded integers, row
indexes and Bloom filters on the document id.

``write_ids`` lays the documents out in ascending doc_id order (range
partitions, sorted inside), tokenizes them in place and writes one ORC file
per partition: ``ids`` is a list column (ORC packs its integers by run-length
encoding version 2), every ``row_stride`` documents have an index entry, and
``doc_id`` carries a Bloom filter.  ``read_ids`` reads stripes in parallel;
with ``doc_ids`` the predicate reaches the ORC reader, which skips stripes
and row groups by minimum, maximum and Bloom filter.  ``positions`` reads the
files back and numbers the ids over the whole data set.

Scale: one shuffle, of the texts by range of doc_id; the running start of
each file is a sum over one row per file.

Defined results: null text has the end id only; null doc_ids come first;
rows with equal doc_id keep the order of their text; an empty table gives
files without rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.llm.common import doc_texts, stored
from weft.llm.encode import STEP_BYTES, encoder
from weft.llm.words import table_chunks
from weft.operators.iterate import shared_path


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, keeps_blanks: bool = False,
              stripe_bytes: int = 16 << 20, row_stride: int = 1000, partitions: int | None = None) -> None:
    """ORC files of (doc_id, ids) in ascending doc_id order at ``path``."""
    kind = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encoded(batches):
        enc = encoder(tokenizer, keeps_blanks)
        place = 0
        for t in table_chunks(batches, chunk_bytes=STEP_BYTES):
            offsets, ids = enc.encode_closed(t.column(1).combine_chunks(), end_id)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
            places = pa.array(np.arange(place, place + len(lists)))
            place += len(lists)
            for batch in pa.Table.from_arrays([t.column(0), places, lists], schema=kind).to_batches(1000):
                yield batch

    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = doc_texts(docs).repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    (ordered.mapInArrow(encoded, "doc_id long, place long, ids array<int>").write
        .option("orc.compress", "ZSTD").option("orc.stripe.size", stripe_bytes)
        .option("orc.create.index", "true").option("orc.row.index.stride", row_stride)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .orc(path))


def read_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, place, ids) of the files; only ``doc_ids`` if given."""
    got = spark.read.schema("doc_id long, place long, ids array<int>").orc(path)
    return got if doc_ids is None else got.where(F.col("doc_id").isin(doc_ids))


def positions(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def digest(batches):
        for b in batches:
            lists = b.column("ids")
            values = np.asarray(lists.values, np.uint32)
            o = np.asarray(lists.offsets)
            crc = [zlib.crc32(values[x:y]) for x, y in zip(o[:-1], o[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("place"), b.column("file"),
                 pa.array(np.diff(o).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "place", "file", "n_tokens", "ids_crc32"])

    # part-00017-...: the number orders the files by doc_id
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    read = stored(
        read_ids(spark, path).select("doc_id", "place", "ids", number.alias("file"))
        .mapInArrow(digest, "doc_id long, place long, file int, n_tokens long, ids_crc32 long"), "orc-digests")
    # one row per file: the number of files is set by write_ids
    files = read.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return read.withColumn("_at", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file").select(
        "doc_id", (F.col("_before") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, **options) -> DataFrame:
    """Write the documents' ids and return ``positions`` read from the files."""
    spark = docs.sparkSession
    path = shared_path(spark, "orc-ids")
    write_ids(docs, path, tokenizer, end_id, **options)
    return positions(spark, path)
