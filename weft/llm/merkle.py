"""Merkle manifest of a table: one hash tree per partition value, their roots
hashed into one root, and for every row a proof that is folded back.

A leaf is the SHA-256 of a row's fields, each written as its length in bytes
and its value.  Leaves of a part ascend by id; every two consecutive nodes
become one node of the next level, the last one alone where it has no
neighbour, until one is left, the part's subroot.  The subroots, in the order
of the part's value, likewise give the root.

Trees are cut into superblocks of 2^span aligned nodes.  Upwards, every
superblock is reduced to its root, whose rows are the nodes of the next tier,
until a part has one node left.  Downwards, the nodes of a tier and the outer
nodes that their proofs need (the path of the superblock's root) are cogrouped
by superblock; one call of ``applyInPandas`` reduces the block again, joins
its siblings with the outer ones, and folds each row's leaf up to the root.

Scale: rows are hashed where they are read; what is shuffled has some 100
bytes a row, twice (range by part and id for the places, hash by superblock).
A superblock has at most 2^span rows, so a part with a third of all rows is
many groups; equal rows are spread by a tie column.  A tier is 2^span times
smaller than the one below.

Defined results: a null field is ``-``; a null part comes first; null ids come
first in their part; rows with equal id are ordered by their leaf, and equal
rows take consecutive places; a part with one row has its leaf as subroot, one
part its subroot as root, and a row without siblings the hash of nothing as
proof; an empty table gives no rows; columns that are no fields are ignored,
whatever their names.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import stored

SPAN = 10  # a superblock has 2^span nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 in hex of the values, each ``-`` if null, else bytes ``:`` text."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _numbered(nodes: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``nodes`` with ``pos``, their place in their ``part`` from 0, and ``n``,
    its number of nodes."""
    keys = [F.col("part"), *order, F.col("_tie")]
    ranged = (nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
              .sortWithinPartitions(*keys).drop("_tie").withColumn("_row", F.monotonically_increasing_id()))
    kept = stored(ranged, name).withColumn("_range", F.shiftright("_row", 33))
    # at most one row per range and one more per part
    runs = kept.groupBy("part", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("part").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.sum("_n").over(Window.partitionBy("part")).alias("n"))
    return kept.join(runs, ["part", "_range"]).withColumn(
        "pos", F.col("_before") + F.col("_row") - F.col("_first")).drop("_range", "_row", "_first", "_before")


def _grown(hashes: list[str], n: int, span: int) -> list[list[str]]:
    """The levels of a superblock of a tier of n nodes, from its nodes to its
    root."""
    out = [hashes]
    for _ in range(min(span, (int(n) - 1).bit_length())):
        below = out[-1]
        out.append([sha256("".join(below[i:i + 2]).encode()).hexdigest() for i in range(0, len(below), 2)])
    return out


def _block_root(nodes: pd.DataFrame, span: int) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    n, pos = int(nodes.n.iloc[0]), int(nodes.pos.iloc[0])
    root = _grown(nodes.hash.tolist(), n, span)[-1][0]
    return pd.DataFrame({"part": [nodes.part.iloc[0]], "pos": [pos >> span], "n": [-(-n >> span)], "hash": [root]})


def _tiers(nodes: DataFrame, span: int, name: str) -> list[DataFrame]:
    """(part, pos, n, hash) of ``nodes`` and of the tiers above them, up to
    one node a part."""
    out, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        block = F.shiftright("pos", span)
        up = out[-1].select("part", "pos", "n", "hash").groupBy("part", block).applyInPandas(
            lambda nodes: _block_root(nodes, span), "part string, pos long, n long, hash string")
        out.append(stored(up, name))
        most = -(-most >> span)
    return out


def _finish(nodes: pd.DataFrame, outer: pd.DataFrame, span: int) -> pd.DataFrame:
    """Local reduction, proof joining and folding of one superblock."""
    nodes = nodes.sort_values("pos")
    if nodes.empty:
        return nodes.assign(siblings="", sides="", subroot="", root="", folded="")
    levels = _grown(nodes.hash.tolist(), nodes.n.iloc[0], span)
    far, far_sides = outer.siblings.iloc[0], outer.sides.iloc[0]
    beyond = [far[i:i + 64] for i in range(0, len(far), 64)]
    siblings, sides, folded = [], [], []
    for i, start in enumerate(nodes.shown.tolist()):
        path, side = [], ""
        for level in levels[:-1]:
            other = i ^ 1
            if other < len(level):
                path.append(level[other])
                side += "L" if i & 1 else "R"
            else:
                side += "-"
            i >>= 1
        path += beyond
        side += far_sides
        at, node = 0, start
        for s in side:
            if s == "-":
                node = sha256(node.encode()).hexdigest()
                continue
            pair = path[at] + node if s == "L" else node + path[at]
            node = sha256(pair.encode()).hexdigest()
            at += 1
        siblings.append("".join(path))
        sides.append(side)
        folded.append(node)
    return nodes.assign(siblings=siblings, sides=sides, subroot=outer.subroot.iloc[0], root=outer.root.iloc[0],
                        folded=folded)


def _descend(tiers: list[DataFrame], outer: DataFrame, span: int, keep: list[str]) -> DataFrame:
    """The rows of ``tiers[0]`` with the path of each to the root.  ``outer``
    (part, pos, siblings, sides, subroot, root) belongs to the last tier."""
    plain = "part string, pos long, n long, hash string, shown string"
    path = "siblings string, sides string, subroot string, root string, folded string"
    for i in range(len(tiers) - 1, -1, -1):
        cols = [] if i else keep
        nodes = tiers[i] if not i else tiers[i].withColumn("shown", F.col("hash"))
        nodes = nodes.select("part", "pos", "n", "hash", "shown", *cols)
        schema = ", ".join([plain, *[f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in cols], path])
        block = F.shiftright("pos", span) if i < len(tiers) - 1 else F.col("pos")
        right = outer.select(F.col("part").alias("far_part"), F.col("pos").alias("far_pos"), "siblings", "sides",
                             "subroot", "root")
        found = nodes.groupBy("part", block).cogroup(right.groupBy("far_part", "far_pos")).applyInPandas(
            lambda own, far: _finish(own, far, span), schema)
        outer = found
    return found


def manifest(docs: DataFrame, part: str = "lang", fields: tuple[str, ...] = FIELDS,
             shown: dict[str, Column] | None = None, proofs: bool = True, span: int = SPAN) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified.

    ``shown`` replaces fields of the row that is presented for verification
    (its leaf is folded with the siblings of the manifest); ``proofs`` adds
    ``siblings``, the proof's digests from the leaf upwards, and ``sides``, a
    character per level: L or R where the sibling stands, ``-`` for none.
    """
    leaf = leaf_hash([F.col(f) for f in fields])
    presented = leaf_hash([(shown or {}).get(f, F.col(f)) for f in fields])
    # a tag before the value keeps null parts apart and first
    tag = F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit(""))
    leaves = stored(docs.select(F.col("doc_id").alias("id"), tag.alias("part"), leaf.alias("hash"),
                                presented.alias("shown")), "merkle-leaves")
    tiers = _tiers(_numbered(leaves, [F.col("id").asc_nulls_first(), F.col("hash")], "merkle-places"), span,
                   "merkle-tier")

    subroots = tiers[-1].select(F.lit("").alias("part"), F.col("part").alias("name"), "hash",
                                F.col("hash").alias("shown"))
    tops = _tiers(_numbered(subroots, [F.col("name")], "merkle-subroots"), span, "merkle-top")
    root = tops[-1].select("part", "pos", F.lit("").alias("siblings"), F.lit("").alias("sides"),
                           F.lit("").alias("subroot"), F.col("hash").alias("root"))
    paths = stored(_descend(tops, root, span, ["name"]), "merkle-paths")
    outer = paths.select(F.col("name").alias("part"), F.lit(0).cast("long").alias("pos"), "siblings", "sides",
                         F.col("hash").alias("subroot"), "root")

    done = _descend(tiers, outer, span, ["id"])
    more = ["siblings", "sides"] if proofs else []
    return done.select(F.col("id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root",
                       F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
                       *more)


ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT *, list_reduce(
      list_prepend(4294967295, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS rest
  FROM documents),
rows AS (
  SELECT doc_id, lang, text, source, n_chars,
    CASE WHEN xor(rest, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS shown_chars FROM docs),
fields AS (
  SELECT doc_id, lang, n_chars, shown_chars,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS size,
    coalesce(strlen(shown_chars::VARCHAR)::VARCHAR || ':' || shown_chars::VARCHAR, '-') AS shown_size,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail FROM rows),
hashed AS (SELECT doc_id, lang, sha256(head || size || tail) AS leaf, sha256(head || shown_size || tail) AS shown
           FROM fields),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
up AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY pos) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, lvl + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))
                         FOR i IN range((len(nodes) + 1) // 2)] FROM up WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
             FROM up WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS lvl, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT lvl + 1, [sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))
                   FOR i IN range((len(nodes) + 1) // 2)] FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT l.lang, l.pos, u.lvl AS lvl, l.pos >> u.lvl AS place, u.nodes AS nodes
  FROM leaves l JOIN up u ON l.lang IS NOT DISTINCT FROM u.lang WHERE len(u.nodes) > 1
  UNION ALL
  SELECT l.lang, l.pos, 100 + t.lvl, s.place >> t.lvl, t.nodes
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN tops t ON len(t.nodes) > 1),
paths AS (
  SELECT lang, pos, list(CASE WHEN xor(place, 1) >= len(nodes) THEN '-' WHEN place & 1 = 1 THEN 'L' || nodes[place]
                              ELSE 'R' || nodes[place + 2] END ORDER BY lvl) AS path FROM steps GROUP BY lang, pos),
told AS (
  SELECT l.doc_id, l.leaf, l.shown, s.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
    coalesce(p.path, []) AS path
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos),
folds AS (
  SELECT *, sha256(list_aggregate(list_transform(path, lambda x: x[2:]), 'string_agg', '')) AS some_proof,
    list_reduce(list_prepend(shown, path), lambda a, x:
      sha256(CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root FROM told)
SELECT doc_id, leaf, subroot, root, coalesce(some_proof, sha256('')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM folds
"""
