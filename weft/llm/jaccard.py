"""N-gram Jaccard join by prefix trees.

A document is the set of its distinct five-word shingles (64-bit hashes); two
documents link where 100 * |A and B| >= 75 * |A or B|.  The result is each
document's set size and the smallest doc_id that links reach.

1. ``shingle_index`` counts in how many documents each shingle occurs and
   orders every set by (count, hash), rarest first.  Linked sets then share
   one of their first n - ceil(0.75 n) + 1 shingles, so a document whose
   first shingles are all its own cannot link, and only the others go on,
   with the shared part of that prefix.  The counting shuffle moves packed
   sorted arrays, not rows.  It takes all shingles of sets up to ``SHORT``,
   and half of the hash space for longer ones (two bands of set sizes with an
   order each; bands overlap by the largest ratio two linked sets can have,
   so every pair shares a band).  Shingles outside the counted half come last
   in the order and are moved only where a prefix reaches them.
2. Equal sets become one class, named by its smallest doc_id.
3. Every class is tried against one leader, the one it shares most prefix
   shingles with (of the smallest ids at each), which gives trees of links.
   Pairs inside a tree need no test, so a large group of near copies costs
   about one test a copy.
4. Classes joined by tried pairs, linked or not, form blocks of bounded size.  Two blocks that share
   a prefix shingle found in different trees meet in one task, which tries
   their sets on each other; pairs are never rows.  So no link is lost.
5. A ``PrefixTree`` holds a block's sets in one order of the shingles, rarest
   first.  A walk with another set adds up the overlap node by node, once for
   all sets below a node, and leaves a branch where the shingles left on
   either side cannot reach the overlap that is needed.

Scale: a task holds one bucket of the counting shuffle, one chunk of
documents, or two blocks of sets; counts, classes, leaders and trees are
tables.  Hot shingles, classes and leaders are reduced map-side or dealt over
several tasks.

Defined results: null or blank text has no shingles and links with nothing,
also not with other such rows; with 1 to 4 words the whole sequence is the
only shingle; rows that share a doc_id are one node of the graph (a null
doc_id is no node).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.graph import PropertyGraph
from weft.llm.common import bucket_bits, doc_texts, stored
from weft.llm.words import Chunk, bucket_runs, mix, ngram_hashes, pack_sorted, release, unpack_sorted, word_chunks
from weft.operators.components import component_labels

WORDS = 5
SHORT = 256  # sets up to this size are counted in full
BLOCK = 1 << 17  # shingles in the sets of a block, or one larger set
BUCKET_WORDS = 1 << 17  # aimed words in a bucket of the counting shuffle
BROADCAST_IDS = 1_000_000
CHUNK = 4 << 20  # bytes of text in a chunk
STEP = 32  # shingles in a node of a prefix tree

PACKED = "bucket int, chunk long, shingles binary, docs binary, counts binary, sizes binary"
INDEX = "doc_id long, n_shingles long, key1 long, key2 long, prefix array<long>"


def shingles(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct shingles, by hash, then document."""
    words = chunk.word_hashes()[chunk.codes]
    n = chunk.lengths()
    doc = np.repeat(np.arange(len(n)), n)
    h = ngram_hashes(words, WORDS)
    left = (chunk.offsets[1:][doc[:len(h)]] - np.arange(len(h))) if len(h) else np.empty(0, np.int64)
    at = np.flatnonzero(left >= WORDS)
    hashes, docs = [h[at]], [doc[at]]
    for k in range(1, WORDS):
        few = np.flatnonzero(n == k)
        if len(few):
            hashes.append(mix(ngram_hashes(words, k)[chunk.offsets[few]] + np.uint64(k)))
            docs.append(few)
    h, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((d, h)) if len(hashes) > 1 else np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    if len(h):
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
        h, d = h[new], d[new]
    return h, d


def prefix_sizes(n: np.ndarray) -> np.ndarray:
    """Length of the prefix in which linked sets must meet."""
    return n - (3 * n + 3) // 4 + 1


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["bucket", "chunk", "shingles", "docs", "counts", "sizes"])


def _in_bands(h: np.ndarray, d: np.ndarray, n: np.ndarray):
    """(band hash, document) of what enters the counting shuffle, by band
    hash, and how many of each document by band.  The lowest bit of a band
    hash tells counted (0) or not, the next one the band."""
    out_h, out_d, moved = [], [], []
    need = prefix_sizes(n)
    for band, member in enumerate((n <= math.ceil(SHORT * 4 / 3), n > SHORT)):
        at = np.flatnonzero(member[d])
        hb, db = mix(h[at] + np.uint64(band + 1)) & ~np.uint64(3), d[at]
        hb |= np.uint64(2 * band)
        if band == 1:
            counted = (h[at] >> np.uint64(7)) & np.uint64(1) == 0
            have = np.bincount(db[counted], minlength=len(n))
            # the uncounted ones that a prefix reaches, by hash
            hb[~counted] |= np.uint64(1)
            rest = np.flatnonzero(~counted & (have < need)[db])
            rest = rest[np.lexsort((hb[rest], db[rest]))]
            size = np.bincount(db[rest], minlength=len(n))
            rank = np.arange(len(rest)) - (np.cumsum(size) - size)[db[rest]]
            keep = np.concatenate([np.flatnonzero(counted), rest[rank < (need - have)[db[rest]]]])
            hb, db = hb[keep], db[keep]
        out_h.append(hb)
        out_d.append(db)
        moved.append(np.bincount(db, minlength=len(n)))
    h, d = np.concatenate(out_h), np.concatenate(out_d)
    order = np.argsort(h, kind="stable")
    return h[order], d[order], moved


def _emit(batches, bits: int):
    """Sorted shingles of each chunk by bucket, and a row that describes its
    documents (bucket -1 - chunk's place, so these rows spread)."""
    part = TaskContext.get().partitionId()
    for k, chunk in enumerate(word_chunks(batches, chunk_bytes=CHUNK)):
        name = (part << 20) + k
        h, d = shingles(chunk)
        n = np.bincount(d, minlength=chunk.rows.num_rows)
        key1, key2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
        np.add.at(key1, d, h)
        np.add.at(key2, d, mix(h * np.uint64(0xC2B2AE3D27D4EB4F)))
        h, d, moved = _in_bands(h, d, n)
        ids = chunk.rows.column(0).combine_chunks()
        known = np.asarray(ids.is_valid())
        yield _batch([(-1 - name % (1 << bits), name, ids.fill_null(0).to_numpy().tobytes(),
                       known.tobytes(), np.stack([key1, key2]).tobytes(), np.stack([n, *moved]).astype(np.int64).tobytes())])
        d = d.astype(np.uint16)
        rows = [(b, name, pack_sorted(h[x:y]), d[x:y].tobytes(), None, None) for b, x, y in bucket_runs(h, bits)]
        for i in range(0, len(rows), 256):
            yield _batch(rows[i:i + 256])
        release()


def _count(batches):
    """Buckets (rows in order of bucket) -> shared shingles by chunk, with
    the number of documents; describing rows pass."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            if row[0] < 0:
                yield _batch([row])
                continue
            if held and held[0][0] != row[0]:
                yield _shared(held)
                held = []
            held.append(row)
    if held:
        yield _shared(held)


def _shared(rows: list[tuple]) -> pa.RecordBatch:
    hs = [unpack_sorted(r[2]) for r in rows]
    h = np.concatenate(hs)
    d = np.concatenate([np.frombuffer(r[3], np.uint16) for r in rows])
    chunk = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in hs])
    order = np.argsort(h, kind="stable")
    h = h[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
    count = np.repeat(np.diff(edge), np.diff(edge))
    back = np.empty(len(h), np.int64)
    back[order] = count  # by row again
    out, at = [], 0
    for r, x in zip(rows, hs, strict=True):
        c = back[at:at + len(x)]
        some = c > 1
        if some.any():
            out.append((r[0], r[1], pack_sorted(x[some]), d[at:at + len(x)][some].tobytes(),
                        np.minimum(c[some], 0xFFFFFFFF).astype(np.uint32).tobytes(), None))
        at += len(x)
    return _batch(out)


def _prefixes(batches):
    """Rows in order of chunk -> INDEX rows of its documents."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            if held and held[0][1] != row[1]:
                yield from _chunk_index(held)
                held = []
                release()
            held.append(row)
    if held:
        yield from _chunk_index(held)


def _chunk_index(rows: list[tuple]):
    about = next(r for r in rows if r[0] < 0)
    ids, known = np.frombuffer(about[2], np.int64), np.frombuffer(about[3], bool)
    key1, key2 = np.frombuffer(about[4], np.int64).reshape(2, -1)
    n, *moved = np.frombuffer(about[5], np.int64).reshape(3, -1)
    rest = [r for r in rows if r[0] >= 0]
    h = np.concatenate([np.empty(0, np.uint64), *[unpack_sorted(r[2]) for r in rest]])
    d = np.concatenate([np.empty(0, np.uint16), *[np.frombuffer(r[3], np.uint16) for r in rest]]).astype(np.int64)
    c = np.concatenate([np.empty(0, np.uint32), *[np.frombuffer(r[4], np.uint32) for r in rest]]).astype(np.int64)
    c[(h & np.uint64(1)) == 1] = 1 << 40  # uncounted: last in the order
    need = prefix_sizes(n)
    found_h, found_d = [], []
    for band in (0, 1):
        here = np.flatnonzero((h >> np.uint64(1)) & np.uint64(1) == band)
        here = here[np.lexsort((h[here], c[here], d[here]))]
        size = np.bincount(d[here], minlength=len(n))
        rank = np.arange(len(here)) - (np.cumsum(size) - size)[d[here]]
        own = moved[band] - size  # those no other document has come first
        keep = here[rank < (need - own)[d[here]]]
        found_h.append(h[keep])
        found_d.append(d[keep])
    h, d = np.concatenate(found_h), np.concatenate(found_d)
    order = np.argsort(d, kind="stable")
    h, d = h[order], d[order]
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(d, np.arange(len(n) + 1)).astype(np.int32)), pa.array(h.view(np.int64)))
    t = pa.table([pa.array(ids, mask=~known), pa.array(n), pa.array(key1), pa.array(key2), lists],
                 names=["doc_id", "n_shingles", "key1", "key2", "prefix"])
    yield from t.to_batches(2000)


def shingle_index(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key1, key2, prefix) of every document: the size
    and two 64-bit sums that name its set, and the shingles of its prefix that
    another document has, too.  One row per row of ``docs``."""
    bits = bucket_bits(docs, BUCKET_WORDS)
    sent = doc_texts(docs).mapInArrow(lambda it: _emit(it, bits), PACKED)
    shared = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_count, PACKED)
    return shared.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_prefixes, INDEX)


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles binary) of the documents named in ``ids``: sorted
    hashes, high byte first."""

    def sets(batches):
        for chunk in word_chunks(batches, chunk_bytes=CHUNK):
            h, d = shingles(chunk)
            order = np.argsort(d, kind="stable")  # keeps the order by hash
            h, d = h[order].astype(">u8"), d[order]
            at = np.searchsorted(d, np.arange(chunk.rows.num_rows + 1)).tolist()
            data = [h[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([chunk.rows.column(0).combine_chunks(), pa.array(data, pa.binary())],
                                             names=["doc_id", "shingles"])

    small = ids.count() <= BROADCAST_IDS
    some = doc_texts(docs).join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    return some.mapInArrow(sets, "doc_id long, shingles binary")


class PrefixTree:
    """Sorted sets of codes 0..vocabulary-1 in nodes of STEP codes.

    The nodes of a level are the distinct ways down to it.  Each level keeps
    its nodes' parent, codes (filled up with ``vocabulary``), last code, and
    the largest and smallest size of the sets below, and which set ends where.
    """

    def __init__(self, sets: list[np.ndarray], vocabulary: int):
        self.size = np.array([len(x) for x in sets], np.int64)
        self.vocabulary = vocabulary
        self.levels = []
        alive = np.arange(len(sets))
        parent = np.zeros(len(sets), np.int64)
        for depth in range(0, int(self.size.max(initial=0)), STEP):
            codes = np.full((len(alive), STEP), vocabulary, np.int32)
            for row, i in zip(codes, alive.tolist(), strict=True):
                part = sets[i][depth:depth + STEP]
                row[:len(part)] = part
            keys = np.concatenate([parent[:, None].astype(np.int32), codes], axis=1)
            _, first, node = np.unique(keys, axis=0, return_index=True, return_inverse=True)
            node = node.reshape(-1)
            most, least = np.zeros(len(first), np.int64), np.full(len(first), 1 << 40)
            np.maximum.at(most, node, self.size[alive])
            np.minimum.at(least, node, self.size[alive])
            ends = self.size[alive] <= depth + STEP
            reach = np.where(codes[first] < vocabulary, codes[first], -1).max(axis=1)
            self.levels.append((depth, parent[first], codes[first], reach, most, least,
                                alive[ends], node[ends]))
            alive, parent = alive[~ends], node[~ends]

    def linked(self, other: np.ndarray) -> np.ndarray:
        """Indexes of the sets that link with the sorted set ``other``."""
        has = np.zeros(self.vocabulary + 1, bool)
        has[other] = True
        m, found = len(other), []
        over_before = np.zeros(1, np.int64)
        open_before = np.ones(1, bool)
        for depth, parent, codes, reach, most, least, leaves, at in self.levels:
            over = np.zeros(len(parent), np.int64)
            go = np.flatnonzero(open_before[parent])
            if not len(go):
                break
            over[go] = over_before[parent[go]] + has[codes[go]].sum(axis=1)
            here = np.zeros(len(parent), bool)
            # what is left on either side bounds the overlap; 7 * overlap >= 3 * (both sizes) links
            left = np.maximum(most[go] - depth - STEP, 0)
            passed = np.searchsorted(other, reach[go], "right")
            here[go] = (7 * (over[go] + left) >= 3 * (most[go] + m)) & (7 * (over[go] + m - passed) >= 3 * (least[go] + m))
            full = here[at] & (7 * over[at] >= 3 * (self.size[leaves] + m))
            found.append(leaves[full])
            over_before, open_before = over, here
        return np.concatenate(found) if found else np.empty(0, np.int64)


def coded(data: list[bytes]) -> tuple[list[np.ndarray], int]:
    """Sets of shingle bytes as sorted codes in one order, the shingle in
    the fewest of these sets first; the number of codes."""
    sizes = [len(x) // 8 for x in data]
    every = np.frombuffer(b"".join(data), ">u8").astype(np.uint64)
    known, code, count = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.empty(len(known), np.int32)
    rank[np.lexsort((known, count))] = np.arange(len(known))
    return [np.sort(x) for x in np.split(rank[code], np.cumsum(sizes)[:-1])], len(known)


def _of_sides(rows: list[tuple]) -> list[tuple[int, int]]:
    """(leader, member) links of the rows (side, id, root, shingles) of a
    task: sets of side 1, or of side 0 where there is none, are tried on the
    tree of side 0.  Sets of one root are not tried on each other."""
    sets, vocabulary = coded([r[3] for r in rows])
    base = [i for i, r in enumerate(rows) if r[0] == 0]
    probes = [i for i, r in enumerate(rows) if r[0] == 1] or base
    if not base:
        return []
    tree = PrefixTree([sets[i] for i in base], vocabulary)
    out = set()
    for i in probes:
        for k in tree.linked(sets[i]).tolist():
            x, y = rows[base[k]], rows[i]
            if x[2] != y[2]:
                out.add((min(x[1], y[1]), max(x[1], y[1])))
    return sorted(out)


def _met(rows: DataFrame) -> DataFrame:
    """Links of rows (task columns t1..t4, side, id, root, shingles)."""
    task = ["t1", "t2", "t3", "t4"]

    def links(batches):
        key, held = None, []
        for b in batches:
            out = []
            for row in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                if row[:4] != key:
                    out += _of_sides(held) if held else []
                    key, held = row[:4], []
                held.append(row[4:])
            yield _pairs(out)
        if held:
            yield _pairs(_of_sides(held))
        release()

    return (rows.select(*task, "side", "id", "root", "shingles").repartition(*task).sortWithinPartitions(*task)
            .mapInArrow(links, "leader long, member long").distinct())


def verify(pairs: DataFrame, sets: DataFrame, node: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (leader, member) whose sets link.  The members
    of a leader go to tasks in blocks; ``node`` (id, n) has the sizes."""
    sized = pairs.join(node.withColumnRenamed("id", "member"), "member")
    parts = sized.groupBy("leader").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    zero = F.lit(0).cast("long")
    dealt = sized.join(parts, "leader").select(
        F.col("leader").alias("t1"), F.pmod(F.xxhash64("member"), F.col("parts")).alias("t2"),
        F.lit(1).alias("side"), F.col("member").alias("id"))
    heads = parts.select(
        F.col("leader").alias("t1"), F.explode(F.sequence(zero, F.col("parts") - 1)).alias("t2"),
        F.lit(0).alias("side"), F.col("leader").alias("id"))
    rows = dealt.unionByName(heads).join(sets, "id")
    return _met(rows.select("t1", "t2", zero.alias("t3"), zero.alias("t4"), "side", "id",
                            F.col("id").alias("root"), "shingles"))


def verify_blocks(rows: DataFrame, clusters: DataFrame, sets: DataFrame, node: DataFrame) -> DataFrame:
    """Links between different trees.  ``rows`` (shingle, id, root) are the
    prefix shingles found in more than one tree, ``clusters`` (id, root) what
    the tried pairs join, linked or not."""
    led = node.join(clusters.withColumnRenamed("root", "leader"), "id").join(rows.select("id", "root").distinct(), "id")
    parts = led.groupBy("leader").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    blocks = led.join(parts, "leader").select(
        "id", "root", "leader", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    blocks = stored(blocks, "blocks")
    at = rows.join(blocks.select("id", "leader", "part"), "id").select("shingle", "leader", "part").distinct()
    one = at.select("shingle", F.col("leader").alias("t1"), F.col("part").alias("t2"))
    two = at.select("shingle", F.col("leader").alias("t3"), F.col("part").alias("t4"))
    tasks = one.join(two, "shingle").where("t1 < t3 or (t1 = t3 and t2 <= t4)").select(
        "t1", "t2", "t3", "t4").distinct()
    tasks = stored(tasks, "block-pairs")
    full = stored(blocks.join(sets.withColumnRenamed("doc_id", "id"), "id"), "block-sets")
    left = tasks.join(full.withColumnsRenamed({"leader": "t1", "part": "t2"}), ["t1", "t2"]).withColumn("side", F.lit(0))
    right = tasks.where("t1 != t3 or t2 != t4").join(
        full.withColumnsRenamed({"leader": "t3", "part": "t4"}), ["t3", "t4"]).withColumn("side", F.lit(1))
    return _met(left.unionByName(right))


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)],
                                      names=["leader", "member"])


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    index = stored(shingle_index(docs), "shingle-index")
    some = index.where("n_shingles > 0 and doc_id is not null")
    class_key = ["n_shingles", "key1", "key2"]
    classes = stored(some.groupBy(*class_key).agg(F.min("doc_id").alias("id")), "classes")
    prefixes = some.where(F.size("prefix") > 0).join(
        classes.select(F.col("id").alias("doc_id"), *class_key), ["doc_id", *class_key], "left_semi")
    rows = prefixes.select(F.explode("prefix").alias("shingle"), F.col("doc_id").alias("id"),
                           F.col("n_shingles").alias("n")).distinct()
    rows = stored(rows, "prefix-shingles")
    met = rows.groupBy("shingle").agg(F.min("id").alias("leader"), F.max("id").alias("_last")).where("leader < _last")
    rows = stored(rows.join(met.select("shingle", "leader"), "shingle"), "shared-shingles")
    sets = stored(sets_of(docs, rows.select(F.col("id").alias("doc_id")).distinct()), "shingle-sets")

    node = stored(rows.select("id", "n").distinct(), "nodes")
    heads = node.select(F.col("id").alias("leader"), F.col("n").alias("_nl"))
    edges = rows.where("id != leader").groupBy("leader", "id", "n").agg(F.count(F.lit(1)).alias("_c"))
    edges = edges.join(heads, "leader").where(4 * F.least("n", "_nl") >= 3 * F.greatest("n", "_nl"))
    pairs = edges.groupBy(F.col("id").alias("member")).agg(
        F.max_by("leader", F.struct("_c", -F.col("leader"))).alias("leader"))
    pairs = stored(pairs, "pairs")
    links = stored(verify(pairs, sets.withColumnRenamed("doc_id", "id"), node), "links")
    forest = _roots(node, links)
    placed = rows.drop("leader").join(forest, "id")
    apart = placed.groupBy("shingle").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b")
    apart = stored(placed.join(apart.select("shingle"), "shingle", "left_semi"), "apart")
    more = stored(verify_blocks(apart, _roots(node, pairs), sets, node), "more-links")
    forest = stored(_joined_roots(forest, more), "trees")

    of_class = classes.join(forest, "id", "left").select(
        *class_key, F.coalesce("root", "id").alias("component_id"))
    return index.join(of_class, class_key, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        .alias("component_id"))


def _roots(node: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, root) of the forest ``pairs`` (leader, member), leader < member
    and one leader a member, by pointer jumping."""
    now = stored(node.select("id").join(pairs.select(F.col("member").alias("id"), "leader"), "id", "left").select(
        "id", F.coalesce("leader", "id").alias("root")), "roots")
    while True:
        up = now.select(F.col("id").alias("root"), F.col("root").alias("_up"))
        step = stored(now.join(up, "root").select("id", F.col("_up").alias("root"), (F.col("_up") != F.col("root"))
                                                  .alias("_moved")), "roots")
        now = step.select("id", "root")
        if step.where("_moved").isEmpty():
            return now


def _joined_roots(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(id, root) after the links ``more`` between trees."""
    if more.isEmpty():
        return roots
    ends = more.join(roots.select(F.col("id").alias("leader"), F.col("root").alias("src")), "leader").join(
        roots.select(F.col("id").alias("member"), F.col("root").alias("dst")), "member")
    ends = stored(ends.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(),
                  "root-links")
    graph = PropertyGraph(ends.select(F.col("src").alias("id")).union(ends.select("dst")).distinct(), ends)
    again = component_labels(graph).select(F.col("id").alias("root"), "component")
    return roots.join(again, "root", "left").select("id", F.coalesce("component", "root").alias("root"))
