"""Filter audit and Merkle manifest against brute force."""

import collections
import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from weft.llm import filter_audit, merkle
from weft.llm.common import fold

CLASHES = ("id", "part", "mask", "n", "rank", "digest", "pos", "hash", "shown", "total", "bit", "root", "is_first")


@pytest.fixture(scope="module")
def clashing_docs(odd_docs):
    """The odd rows, a third of them repeated, with clashing column names."""
    some = odd_docs.unionByName(odd_docs.where("doc_id in (2, 5, 12) or doc_id is null")).unionByName(
        odd_docs.where("doc_id = 12").withColumn("source", F.lit(None).cast("string")))
    return some.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0, "x"), (2, 1, 1, "x"), (2, 0, None, "x"), (5, 0, 1, "y"), (10, 1, 0, "y"), (12, None, 1, "z"),
         (None, 1, 1, "z"), (99, 1, 1, "z")], "doc_id long, quality int, toxic int, part string")


def brute_audit(docs, labels):
    rows = docs.select("doc_id", "source", "text").collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels.collect() if r.toxic == 1 and r.doc_id is not None}
    least = {}
    for r in rows:
        if r.doc_id is not None:
            least[r.text or ""] = min(r.doc_id, least.get(r.text or "", r.doc_id))
    fails = []
    for r in rows:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {c for c, b in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t), r.doc_id is not None and r.doc_id > least[t]), strict=True) if b}
        fails.append((r.source or "", f, r.doc_id in good, r.doc_id in toxic))
    out = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        shapley = collections.Counter()
        for o in itertools.permutations("ABCDE"):
            left = list(own)
            for step, c in enumerate(o, 1):
                lost = [f for f in left if c in f[1]]
                left = [f for f in left if c not in f[1]]
                shapley[c] += len(lost)
                out[part, "".join(o), step] = [
                    len(left), len(lost), sum(c in f[1] for f in own) - len(lost), sum(f[1] == {c} for f in own),
                    sum(f[2] for f in lost), sum(f[3] for f in lost)]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def test_filter_audit(clashing_docs, labels, no_docs):
    got = filter_audit.audit(clashing_docs, labels).collect()
    assert len(got) == 600 * 2
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                               r.shapley] for r in got} == brute_audit(clashing_docs, labels)
    assert filter_audit.audit(no_docs, labels).collect() == []
    none = filter_audit.audit(clashing_docs, labels.limit(0)).collect()
    assert {(r.good_lost, r.toxic_lost) for r in none} == {(0, 0)} and len(none) == 1200


def test_removal_intervals_are_the_orders():
    """Every order removes a mask once, where it first names a failure."""
    orders = list(itertools.permutations(range(5)))
    steps = collections.defaultdict(list)
    for mask, step, lo, hi in filter_audit.removal_intervals():
        for rank in range(lo, hi):
            steps[mask, rank].append(step)
    assert dict(steps) == {
        (mask, rank): [min(i for i, x in enumerate(o, 1) if mask >> x & 1)]
        for mask in range(1, 32) for rank, o in enumerate(orders)}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, **changed):
    out = ""
    for f in merkle.FIELDS:
        v = changed.get(f, row[f])
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(out)


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def brute_manifest(docs):
    groups = collections.defaultdict(list)
    for r in docs.collect():
        chars = r.n_chars
        if chars is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0:
            chars += 1
        groups[r.lang].append((r.doc_id, leaf(r), leaf(r, n_chars=chars)))
    langs = sorted(groups, key=lambda x: b"" if x is None else b"=" + x.encode())
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = levels([x[1] for x in groups[lang]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for place, lang in enumerate(langs):
        for pos, (i, own, shown) in enumerate(groups[lang]):
            siblings, node = "", shown
            for tree, at in ((trees[lang], pos), (top, place)):
                for level in tree[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    node = digest(other + node if at & 1 else node + other)
                    siblings += other
                    at >>= 1
            out.append((str(i), own, trees[lang][-1][0], top[-1][0], digest(siblings), node, node == top[-1][0]))
    return sorted(out)


@pytest.mark.parametrize("span", [1, 2, 10])
def test_merkle_manifest(clashing_docs, no_docs, span):
    docs = clashing_docs.withColumn("n_chars", F.when(F.col("doc_id") != 7, F.col("n_chars")))
    shown = {"n_chars": F.col("n_chars") + F.when(fold("doc_id", 7) == 0, 1).otherwise(0)}
    got = merkle.manifest(docs, shown=shown, span=span).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                  for r in got) == brute_manifest(docs)
    assert all(digest(r.siblings) == r.proof_sha256 and len(r.siblings) == 64 * len(r.sides.replace("-", "")) for r in got)
    if span == 2:
        assert merkle.manifest(no_docs, shown=shown).collect() == []
        one = merkle.manifest(docs.where("doc_id = 1"), span=span).collect()
        assert [(r.leaf == r.subroot == r.root, r.proof_sha256, r.verified) for r in one] == [(True, digest(""), True)]


def test_merkle_many_rows_of_one_part(spark):
    """Partial superblocks on several tiers, and equal rows without id."""
    docs = spark.range(0, 300, 1, 7).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") > 20, "en").alias("lang"), F.lit(4).alias("n_chars"), F.lit("text").alias("text"))
    shown = {"n_chars": F.col("n_chars") + F.when(fold("doc_id", 7) == 0, 1).otherwise(0)}
    got = merkle.manifest(docs, shown=shown, span=3, proofs=False).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                  for r in got) == brute_manifest(docs)
