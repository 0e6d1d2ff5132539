"""Filter interaction audit: what each of five filters removes in each of the
120 orders in which they can be applied.

Every document has a mask of the filters it fails.  An order is known by its
rank among the permutations of the letters in lexicographic order (its Lehmer
code read in the factorial base), so all orders that begin with the same
letters are an interval of ranks.  A document is removed at the step where an
order first names one of its failures: for its mask these are the intervals of
all beginnings that hold no failure, followed by one.  The counts of a mask are
added at the lower and taken off at the upper end of each interval (840 of
them for all masks); a prefix sum over the ranks then gives the removals of
every order and step.

Scale: texts are reduced to flags and a digest where they are read; copies are
told by digest and the least id, with sums before every shuffle, so a group of
copies or a source with a third of all rows meets as partial sums.  After that
there are at most 32 masks a part, and 600 result rows.

Defined results: null text is empty; null source is the empty part; a null
doc_id is neither smaller nor larger than another, so it never makes or fails
a copy, and has no label; rows with equal id and text are no copies of each
other; of repeated labels of an id any 1 counts; an empty table gives no rows;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTERS = "ABCDE"
STEPS = len(LETTERS)
ORDERS = factorial(STEPS)
BLANKS = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at the text alone: A (1) under 50 words,
    B (2) too few distinct words, C (4) too many capitals, D (8) symbols."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, r"[^A-Z]+", ""))
    fails = [n < 50, distinct * 100 < n * 65, capitals * 100 > F.length(text) * 5, text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, lo, hi): an order of rank lo to hi - 1 removes documents
    of the mask at the step."""
    out = []

    def follow(mask: int, step: int, rank: int, rest: list[int]) -> None:
        width = factorial(len(rest) - 1)
        for digit, letter in enumerate(rest):  # the Lehmer digit is the letter's place among those left
            lo = rank + digit * width
            if mask >> letter & 1:
                out.append((mask, step, lo, lo + width))
            elif len(rest) > 1:
                follow(mask, step + 1, lo, rest[:digit] + rest[digit + 1:])

    for mask in range(1, 1 << STEPS):
        follow(mask, 1, 0, list(range(STEPS)))
    return out


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by source and failed filters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("source", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(text).alias("mask"))
    # equal rows become one, so that no group of copies is shuffled row by row
    seen = rows.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = seen.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(1))
    told = seen.join(first, ["digest", "id"], "left")
    copy = F.col("is_first").isNull() & F.col("id").isNotNull()
    masked = told.select("id", "part", "n", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"))
    # without its texts an id has at most 32 rows a part, also one (or none) that a third of all rows carry
    masked = masked.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n = F.col("n")
    return masked.join(marks, "id", "left").groupBy("part", "mask").agg(
        F.sum(n).alias("n"), F.sum(n * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows per part, one of each order and step: kept (after the step),
    removed (by it), redundant (fails its filter, removed earlier),
    unique_fails (fails no other filter), good_lost and toxic_lost (removed
    and so labelled), shapley (removed by its filter over all orders)."""
    return totals(failure_masks(docs, labels))


def totals(masks: DataFrame) -> DataFrame:
    """The audit from (part, mask, n, good, toxic)."""
    spark = masks.sparkSession
    orders = ["".join(p) for p in permutations(LETTERS)]  # in lexicographic order
    places = spark.createDataFrame(
        [(r, s + 1, o, o[s], 1 << LETTERS.index(o[s])) for r, o in enumerate(orders) for s in range(STEPS)],
        "rank int, step int, filter_order string, letter string, bit int")
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, lo int, hi int")

    # difference arrays: counts at the ends of intervals, zeros elsewhere
    counts = ["n", "good", "toxic"]
    ends = F.explode(F.array(F.struct(F.col("lo").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("hi").alias("rank"), F.lit(-1).alias("sign")))).alias("end")
    # 840 intervals and 600 places: fixed tables
    changes = masks.join(F.broadcast(intervals), "mask").select("part", "step", *counts, ends).select(
        "part", "step", "end.rank", *[(F.col(c) * F.col("end.sign")).alias(c) for c in counts])
    per_part = masks.groupBy("part").agg(F.sum("n").alias("total"))
    cell = F.explode(F.sequence(F.lit(0), F.lit(ORDERS * STEPS - 1))).alias("cell")
    zeros = per_part.select("part", cell).select(
        "part", (F.col("cell") % STEPS + 1).alias("step"), F.floor(F.col("cell") / STEPS).cast("int").alias("rank"),
        *[F.lit(0).cast("long").alias(c) for c in counts])
    arrays = changes.unionByName(zeros).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in counts])
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    lost = arrays.select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in counts])
    lost = lost.join(F.broadcast(places), ["rank", "step"])

    bit = F.explode(F.array(*[F.lit(1 << i) for i in range(STEPS)])).alias("bit")
    fails = masks.select("part", "mask", "n", bit).groupBy("part", "bit").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("unique_fails"))
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return lost.join(fails, ["part", "bit"]).join(per_part, "part").select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "bit")).alias("shapley"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT t.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e
  FROM texts t LEFT JOIN marks m ON t.doc_id = m.doc_id),
counted AS (
  SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL),
letter AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM letter p, letter q, letter r, letter s, letter t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
cells AS (
  SELECT part, array_to_string([substr('ABCDE', x, 1) FOR x IN o], '') AS filter_order, step, o[step] AS f, n, good, toxic,
    fails[o[step]] AS failing,
    len([x FOR x IN o[1:step] IF fails[x]]) AS upto, len([x FOR x IN fails IF x]) AS all_fails FROM counted, steps),
told AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN upto = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failing AND upto = 1 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failing AND upto > 1 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failing AND all_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND upto = 1 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failing AND upto = 1 THEN toxic ELSE 0 END) AS toxic_lost FROM cells GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM told
"""
