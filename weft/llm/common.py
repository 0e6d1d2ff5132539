"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.iterate import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    Cuts the lineage with a table that outlives lost executors.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fold(key: str, mod: int):
    """crc32 of the key's text modulo ``mod`` (null where the key is null)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(mod)


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id long, text string) and ``more``; other columns are dropped."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *more)


WORD_BYTES = 6.4  # of a word with the blank before it
MOST_BITS = 30  # as many as the bucket's number, an int, can have


def bucket_bits(docs: DataFrame, words: int) -> int:
    """Bits of a bucket number so that a bucket holds about ``words`` words,
    by the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(0, min(MOST_BITS, math.ceil(math.log2(max(1.0, size / (words * WORD_BYTES))))))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or with underscores in front as many as make it new."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name
