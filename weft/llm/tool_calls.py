"""Tool-call linking for chat data.

``link`` joins calls and results by call id, orders calls behind the calls
they depend on, validates arguments against a schema per tool and serialises
each exchange as canonical JSON (sorted keys, no blanks).  DataFrame and SQL
functions only.

Scale: calls and results are reduced to one row per id map-side before the
join, so a hot id is no hot task.  The depth of a call is found by pointer
jumping: the number of joins is the logarithm of the longest chain.
Conversations are never gathered; ``in_order`` sorts by range.

Defined results: of calls or results with one id the first by place stands
for all (``n_calls`` and ``n_results`` count them); a call without result has
status ``pending``, a result without call ``orphan``; a null id links with
nothing and is left out; a call whose parent is unknown is a root (depth 1);
calls on a cycle, or behind one, have no depth and status ``cycle``; arguments
that are no JSON object have the error ``not an object``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.common import stored

# A schema: field -> (Spark SQL type, required)
Schema = dict[str, tuple[str, bool]]


def _first(rows: DataFrame, columns: list[str], count: str) -> DataFrame:
    """One row per call_id: the least (conv_id, turn, other columns)."""
    key = F.struct(*columns)
    return rows.where(F.col("call_id").isNotNull()).groupBy("call_id").agg(
        F.min(key).alias("_m"), F.count(F.lit(1)).alias(count)).select("call_id", "_m.*", count)


def errors_of(arguments: Column, schema: Schema) -> Column:
    """What is wrong with a JSON object of arguments, in order of field."""
    fields = F.array_sort(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")))
    known = F.array(*[F.lit(k) for k in sorted(schema)]).cast("array<string>")
    found = [F.transform(F.array_except(fields, known), lambda k: F.concat(F.lit("unknown: "), k))]
    for name, (kind, required) in sorted(schema.items()):
        value = F.get_json_object(arguments, f"$.{name}")
        wrong = value.isNotNull() & value.try_cast(kind).isNull()
        found.append(F.when(wrong, F.array(F.lit(f"type: {name}"))).otherwise(F.array().cast("array<string>")))
        if required:
            found.append(F.when(value.isNull(), F.array(F.lit(f"missing: {name}")))
                         .otherwise(F.array().cast("array<string>")))
    is_object = F.json_object_keys(arguments).isNotNull()
    return F.when(is_object, F.concat(*found)).otherwise(F.array(F.lit("not an object")))


def canonical(arguments: Column, schema: Schema) -> Column:
    """The known fields as typed JSON with sorted keys; absent ones left out."""
    return F.to_json(F.struct(*[F.get_json_object(arguments, f"$.{k}").try_cast(kind).alias(k)
                                for k, (kind, _) in sorted(schema.items())]))


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth) of calls (call_id, parent_id); null on cycles."""
    known = calls.select(F.col("call_id").alias("parent_id"))
    edges = calls.where("parent_id is not null").join(known, "parent_id", "left_semi")
    now = stored(calls.select("call_id").join(edges.select("call_id", "parent_id"), "call_id", "left")
                 .select("call_id", F.col("parent_id").alias("up"), F.lit(1).cast("long").alias("steps")), "depths")
    rounds = math.ceil(math.log2(max(2, now.count()))) + 1
    for _ in range(rounds):
        if now.where("up is not null").isEmpty():
            break
        above = now.select(F.col("call_id").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_more"))
        now = stored(now.join(above, "up", "left").select(
            "call_id", F.col("_up").alias("up"),
            (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps")), "depths")
    return now.select("call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """Exchanges (call_id, conv_id, turn, name, depth, status, errors,
    n_calls, n_results, json) of calls (call_id, conv_id, turn, name,
    arguments, parent_id) and results (call_id, conv_id, turn, content)."""
    call = _first(calls, ["conv_id", "turn", "name", "arguments", "parent_id"], "n_calls")
    call = call.withColumn("_call", F.lit(True)).join(depths(call.select("call_id", "parent_id")), "call_id")
    result = _first(results, ["conv_id", "turn", "content"], "n_results").select(
        "call_id", F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "content", "n_results")
    both = call.join(result, "call_id", "full_outer")
    none = F.array().cast("array<string>")
    errors, body = F.array(F.lit("unknown tool")), F.lit("{}")
    for name, schema in sorted(schemas.items()):
        here = F.col("name") == name
        errors = F.when(here, errors_of(F.col("arguments"), schema)).otherwise(errors)
        body = F.when(here, canonical(F.col("arguments"), schema)).otherwise(body)
    status = (F.when(F.col("_call").isNull(), "orphan").when(F.col("depth").isNull(), "cycle")
              .when(F.col("n_results").isNull(), "pending").otherwise("done"))
    out = both.select(
        "call_id", F.coalesce("conv_id", "_conv").alias("conv_id"), F.coalesce("turn", "_turn").alias("turn"), "name",
        "depth", status.alias("status"), F.when(F.col("_call").isNull(), none).otherwise(errors).alias("errors"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(F.col("_call").isNull(), F.lit("null")).otherwise(body).alias("_args"), "content")

    def quoted(c: str) -> Column:  # a JSON string: the array's brackets removed
        text = F.to_json(F.array(F.col(c)))
        return F.when(F.col(c).isNull(), F.lit("null")).otherwise(F.substr(text, F.lit(2), F.length(text) - 2))

    number = F.coalesce(F.col("depth").cast("string"), F.lit("null"))
    json = F.concat(F.lit('{"arguments":'), "_args", F.lit(',"call_id":'), quoted("call_id"), F.lit(',"depth":'), number,
                    F.lit(',"errors":'), F.to_json("errors"), F.lit(',"name":'), quoted("name"), F.lit(',"result":'),
                    quoted("content"), F.lit("}"))
    return out.withColumn("json", json).drop("_args", "content")


def in_order(exchanges: DataFrame) -> DataFrame:
    """Exchanges by conversation, each behind those it depends on."""
    key = ["conv_id", F.col("depth").asc_nulls_last(), "turn", "call_id"]
    return exchanges.repartitionByRange(*key).sortWithinPartitions(*key)


def exchanges_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain chats: a user turn calls the tool
    ``answer``, or ``note`` where it has under five words; the assistant's
    next turn is its result; a call depends on the user's turn before."""
    rows = conversations.select("conv_id", "turn", "role", "text").where(
        "conv_id is not null and turn is not null")

    def name(turn: Column) -> Column:
        return F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string")))

    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    calls = rows.where("role = 'user'").select(
        name(F.col("turn")).alias("call_id"), "conv_id", "turn",
        F.when(words >= 5, "answer").otherwise("note").alias("name"),
        F.to_json(F.struct(F.col("text").alias("question"), F.when(words > 0, words).alias("words"))).alias("arguments"),
        name(F.col("turn") - 2).alias("parent_id"))
    results = rows.where("role = 'assistant'").select(
        name(F.col("turn") - 1).alias("call_id"), "conv_id", "turn", F.col("text").alias("content"))
    return calls, results


SCHEMAS: dict[str, Schema] = {
    "answer": {"question": ("string", True), "words": ("int", True)},
    "note": {"question": ("string", True)},
}

ORACLE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c0 AS (
  SELECT md5(conv_id || ':' || turn) AS call_id, conv_id, turn, text,
         CASE WHEN words >= 5 THEN 'answer' ELSE 'note' END AS name,
         CASE WHEN words > 0 THEN words END AS words, md5(conv_id || ':' || (turn - 2)) AS parent_id
  FROM t WHERE role = 'user'),
c AS (
  SELECT *, count(*) OVER (PARTITION BY call_id) AS n_calls
  FROM c0
  QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY conv_id, turn, name, text) = 1),
d AS (
  SELECT call_id, CAST(1 AS BIGINT) AS depth FROM c WHERE parent_id NOT IN (SELECT call_id FROM c)
  UNION ALL
  SELECT c.call_id, d.depth + 1 FROM c JOIN d ON c.parent_id = d.call_id),
r AS (
  SELECT md5(conv_id || ':' || (turn - 1)) AS call_id, conv_id, turn, text,
         count(*) OVER (PARTITION BY md5(conv_id || ':' || (turn - 1))) AS n_results
  FROM t WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY md5(conv_id || ':' || (turn - 1)) ORDER BY conv_id, turn, text) = 1),
j AS (
  SELECT coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.conv_id, r.conv_id) AS conv_id,
         coalesce(c.turn, r.turn) AS turn, c.name, d.depth, c.text AS question, c.words, r.text AS content,
         coalesce(c.n_calls, 0) AS n_calls, coalesce(r.n_results, 0) AS n_results, c.call_id IS NULL AS orphan
  FROM c JOIN d ON c.call_id = d.call_id FULL OUTER JOIN r ON c.call_id = r.call_id),
e AS (
  SELECT *,
    CASE WHEN orphan THEN '[]'
         WHEN name = 'answer' THEN CASE WHEN question IS NULL THEN '["missing: question"]' ELSE '[]' END
         WHEN words IS NULL AND question IS NULL THEN '["missing: question"]'
         WHEN words IS NULL THEN '[]'
         WHEN question IS NULL THEN '["unknown: words","missing: question"]'
         ELSE '["unknown: words"]' END AS errors,
    CASE WHEN orphan THEN 'null'
         WHEN question IS NULL THEN '{}'
         WHEN name = 'answer' THEN '{"question":' || to_json(question) || ',"words":' || words || '}'
         ELSE '{"question":' || to_json(question) || '}' END AS args
  FROM j)
SELECT call_id, conv_id, turn, name, depth,
  CASE WHEN orphan THEN 'orphan' WHEN n_results = 0 THEN 'pending' ELSE 'done' END AS status,
  errors, n_calls, n_results,
  '{"arguments":' || args || ',"call_id":"' || call_id || '","depth":' || coalesce(CAST(depth AS VARCHAR), 'null')
  || ',"errors":' || errors || ',"name":' || coalesce('"' || name || '"', 'null') || ',"result":'
  || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS json
FROM e
"""
