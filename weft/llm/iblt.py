"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A paragraph is a line, cut every ``WORDS`` words.  The distinct 64-bit digests
of a text's paragraphs go into three sub-tables of cells; a cell holds how
many digests it got, the exclusive or of them and of their checks.  Tables of
two versions subtract cell by cell: what both have cancels.  Peeling then
recovers the difference: a cell with one digest left names it, and the digest
is taken out of its other two cells, which may leave one there, and so on.
Where cells remain, the pair is tried again with tables twice as large.

likeness = |A and B| / |A or B|, from the two sizes and the recovered
difference; 1 for two texts without paragraphs.  The fingerprint string is
the text's table folded to ``FOLD`` cells.

DataFrame and SQL functions only.  Scale: the texts are shuffled once, by
ranges of doc_id, to meet the next document; the digests stay in a table
bucketed by those ranges, so building, subtracting and peeling need no
further shuffle.  All rows of one doc_id share a range.

Defined results: null text is empty; rows with equal doc_id follow each other
by hash of their text; rows without doc_id come last; a table's last row is
followed by its first, a single row by itself.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import doc_texts, stored

WORDS = 12  # of a line in a paragraph
FOLD = 12
STEPS = 9  # peeling steps, each of one sub-table
CHECK = 77  # seed of the check
KEY = ["bucket", "rid", "pair", "width"]


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    parts = F.regexp_extract_all(text, F.lit(r"(?:\S++[^\S\n]*+){1,%d}+" % WORDS), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(F.rtrim(p))))


def folded(keys: Column) -> Column:
    """The table folded to FOLD cells, as hexadecimal counts and digests."""

    def cell(j: Column) -> Column:
        mine = F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(CHECK)), F.lit(FOLD)) == j)
        all_of = F.aggregate(mine, F.lit(0).cast("long"), lambda s, k: s.bitwiseXOR(k))
        return F.concat(F.lpad(F.hex(F.size(mine)), 4, "0"), F.lpad(F.hex(all_of), 16, "0"))

    return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(FOLD - 1)), cell), ""))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, rid, doc_id, text, next_text) in descending order of doc_id,
    the first row after the last.  ``rid`` counts inside a bucket."""
    rows = doc_texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [(i + 1) / buckets for i in range(buckets - 1)]
    ends = rows.agg(F.percentile_approx("doc_id", shares, F.lit(10_000))).first()[0] if shares else []
    bounds = F.array(*[F.lit(x) for x in sorted(set(ends or []))]).cast("array<bigint>")
    place = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))))
    rows = rows.withColumn("bucket", place.cast("int"))
    # the first row of a bucket is what follows the bucket above it
    tops = {r["bucket"]: r["top"] for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)
    goes = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    known = [F.lit(x) for b, to in goes.items() if tops[b] is not None for x in (tops[b], to)]
    ghost = F.create_map(*known)[F.col("doc_id")] if known else F.lit(None)
    ghost = F.when(F.col("doc_id").isNull(), F.lit(goes.get(-1))).otherwise(ghost).cast("int")
    spread = rows.withColumn("_ghost", ghost).withColumn("_to", F.explode(F.when(
        F.col("_ghost").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g"))))
        .otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g")),
                           F.struct(F.col("_ghost").alias("b"), F.lit(True).alias("g"))))))
    spread = spread.select(F.col("_to.b").alias("bucket"), F.col("_to.g").alias("_g"), "doc_id", "text")
    w = Window.partitionBy("bucket").orderBy("_g", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    out = spread.select("bucket", "_g", "doc_id", "text", F.lead("text").over(w).alias("next_text"),
                        F.row_number().over(w).cast("long").alias("rid"))
    return out.where(~F.col("_g")).drop("_g")


def _cells(keys: DataFrame, widths: dict[str, Column], attempt: int) -> DataFrame:
    """Subtracted tables: (KEY, t, cell, n, x, c) of the pairs edited and
    next, cells that cancelled left out."""
    def signed(own: str, other: str, pair: str) -> Column:
        both = F.concat(F.transform(own, lambda k: F.struct(F.lit(1).alias("s"), k.alias("k"))),
                        F.transform(other, lambda k: F.struct(F.lit(-1).alias("s"), k.alias("k"))))
        return F.struct(F.lit(pair).alias("pair"), widths[pair].cast("long").alias("width"), both.alias("keys"))

    pairs = keys.select("bucket", "rid", F.explode(F.array(signed("own", "edited", "e"), signed("own", "next", "x"))
                                                   ).alias("p"))
    pairs = pairs.where("p.width > 0").select("bucket", "rid", "p.*")
    one = pairs.select(*KEY, F.explode("keys").alias("k")).select(
        *KEY, F.col("k.s").cast("long").alias("n"), F.col("k.k").alias("x"))
    check = F.xxhash64("x", F.lit(CHECK))
    spread = one.select(*KEY, "n", "x", check.alias("c"), F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), _place(F.col("x"), t, attempt).alias("cell")) for t in range(3)])).alias("at"))
    return _added(spread.select(*KEY, "at.t", "at.cell", "n", "x", "c"))


def _place(key: Column, t: int, attempt: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(100 * attempt + t)), F.col("width"))


def _added(rows: DataFrame) -> DataFrame:
    got = rows.groupBy(*KEY, "t", "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("c").alias("c"))
    return got.where("n != 0 or x != 0 or c != 0")


def _peel(cells: DataFrame, step: int, attempt: int, keep_digests: bool) -> DataFrame:
    """Take out the digests that sub-table ``step`` mod 3 names.  They are
    counted in rows t = 3 (only this version has them) and t = 4."""
    s = step % 3
    pure = ((F.col("t") == s) & (F.abs("n") == 1) & (F.xxhash64("x", F.lit(CHECK)) == F.col("c"))
            & (F.col("cell") == _place(F.col("x"), s, attempt)))

    def row(t, cell, n, x, c) -> Column:
        return F.struct(t.cast("int").alias("t"), cell.cast("long").alias("cell"), n.cast("long").alias("n"),
                        x.cast("long").alias("x"), c.cast("long").alias("c"))

    zero = F.lit(0)
    out = [row(F.lit(t), _place(F.col("x"), t, attempt), -F.col("n"), F.col("x"), F.col("c"))
           for t in range(3) if t != s]
    named = row(F.when(F.col("n") > 0, 3).otherwise(4), F.col("x") if keep_digests else zero, F.lit(1), zero, zero)
    same = row(*[F.col(c) for c in ("t", "cell", "n", "x", "c")])
    spread = cells.select(*KEY, F.explode(F.when(pure, F.array(*out, named)).otherwise(F.array(same))).alias("r"))
    return _added(spread.select(*KEY, "r.*"))


def peeled(keys: DataFrame, widths: dict[str, Column], attempt: int, keep_digests: bool = False) -> DataFrame:
    """Rows (KEY, t, cell, n) after peeling: t 3 and 4 count what was
    recovered (with ``keep_digests`` one row each, cell the digest), t 0 to 2
    are cells that remain."""
    cells = _cells(keys, widths, attempt)
    return reduce(lambda c, i: _peel(c, i, attempt, keep_digests), range(STEPS), cells).select(*KEY, "t", "cell", "n")


def _sizes(other: str, share: float, attempt: int) -> Column:
    every = F.size("own") + F.size(other)
    return (F.ceil(every * F.lit(share)) + 6) * (1 << attempt)


def differences(keys: DataFrame, attempts: int = 8) -> DataFrame:
    """(bucket, rid, pair, differ): digests in one of the two texts only, for
    every pair that differs.  ``keys``: (bucket, rid, own, edited, next)."""
    done = None
    todo = keys.select("bucket", "rid", "own", "edited", "next", F.lit(True).alias("e"), F.lit(True).alias("x"))
    for attempt in range(attempts):
        widths = {p: F.when(F.col(p), _sizes(o, share, attempt)).otherwise(0)
                  for p, o, share in (("e", "edited", 0.35), ("x", "next", 0.6))}
        got = peeled(todo, widths, attempt).groupBy("bucket", "rid", "pair").agg(
            F.sum(F.when(F.col("t") >= 3, F.col("n")).otherwise(0)).alias("differ"),
            F.max(F.col("t") < 3).alias("left"))
        got = stored(got, "peeled")
        good = got.where(~F.col("left")).select("bucket", "rid", "pair", "differ")
        done = good if done is None else done.unionByName(good)
        bad = got.where("left").groupBy("bucket", "rid").agg(
            F.max(F.col("pair") == "e").alias("e"), F.max(F.col("pair") == "x").alias("x"))
        if bad.isEmpty():
            return done
        # few pairs: their digests are kept, so each attempt reads less
        todo = stored(todo.drop("e", "x").join(bad, ["bucket", "rid"]), "peel-again")
    raise RuntimeError("tables do not peel")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row; the edited text has its last half
    replaced by the beginning of the next document."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, n)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text")).withColumn("edited_text", F.concat(
        F.substr("text", F.lit(1), F.col("n_chars") - half), F.substr("next_text", F.lit(1), half)))
    rows = rows.select(
        "bucket", "rid", "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), digests(F.col("text")).alias("own"),
        digests(F.col("edited_text")).alias("edited"), digests(F.col("next_text")).alias("next"))
    name = f"weft_digests_{uuid.uuid4().hex[:12]}"
    rows.write.bucketBy(n, "bucket").saveAsTable(name)
    keys = spark.table(name)
    found = differences(keys.select("bucket", "rid", "own", "edited", "next"))
    wide = found.groupBy("bucket", "rid").agg(
        *[F.max(F.when(F.col("pair") == p, F.col("differ"))).alias(f"_{p}") for p in ("e", "x")])

    out = keys.select(
        "bucket", "rid", "doc_id", "n_chars", "edited_sha256", folded(F.col("own")).alias("fingerprint"),
        folded(F.col("edited")).alias("edited_fingerprint"), F.size("own").alias("_a"), F.size("edited").alias("_b"),
        F.size("next").alias("_c"))

    def near(differ: str, other: str) -> Column:
        both, d = F.col("_a") + F.col(other), F.coalesce(differ, F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - d) / (both + d))

    joined = out.join(wide, ["bucket", "rid"], "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("_e", "_b").alias("near_edited"), near("_x", "_c").alias("near_next"))
    result = stored(joined, "fingerprints")
    spark.sql(f"DROP TABLE {name}")
    return result
