"""N-gram Jaccard join over prefix trees of globally ordered shingle sets.

A document is its set of distinct word shingles. Sets are ordered globally, rarest shingle
first (number of documents by class, then hash). Two sets that reach the threshold share a
shingle within their prefixes (all but the last ``ceil(t * n)`` shingles, plus one), so

1. every shingle's number of documents is counted exactly over packed block messages;
2. a document whose unique shingles fill its prefix can link with nothing and is done;
3. of the rest, equal sets become one node, and nodes that share a prefix shingle fall into
   one cluster (star edges to the smallest node of a shingle, never pairs);
4. each cluster's sets go into a prefix tree (shared beginnings are stored and counted once).
   A set walks the tree with its overlap so far; a subtree is left where the shingles that
   remain on either side, or its set sizes, cannot reach the threshold any more, and a set
   that is already connected to the walking one needs no count;
5. the links found are joined into components.

A cluster of more than ``CHUNK_SETS`` sets is dealt into chunks. First every chunk is linked in
itself and with the cluster's first chunk, three copies of a set in all. Then components are
taken, and only sets that share a prefix shingle with another component are compared again,
those outside a cluster's largest component with the others: the links left out are between
sets that are connected already. A group of near copies is about linear so; what is left of a
cluster without a large component is compared pairwise, in chunks of ``LATE_SETS``.

Defined cases: rows are nodes, so repeated rows link with each other; null and empty texts, and
texts without words, have an empty set and link with nothing; with fewer words than a shingle
the whole sequence is the one shingle; a component's id is its smallest doc_id (null if it has
none); extra columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, files_for, materialize, read, text_bytes
from .components import components
from .fingerprints import (Size, answer, answers_of, blocks_of, distinct, emit, join_answers,
                           pack_array, send, truncated, unpack_array, unpack_texts)
from .textblock import Texts, ascii_lower, byte_sums, prefix_sums, range_hash

#: Sets of a chunk in the first round, and in the second.
CHUNK_SETS, LATE_SETS = 128, 2000
WORDS_PER_BYTE = 1 / 6

_SETS = "doc_id long, text_key binary, n_shingles long, node binary, shingles binary, prefix array<long>"
_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
_NAMES = ["doc_id", "text_key", "n_shingles", "node", "shingles", "prefix"]


def shingles(t: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, ordered by document and hash."""
    lower = Texts(t.ids, t.null_id, ascii_lower(t.data), t.starts, t.ends)
    begin, end, doc = lower.words()
    sums = prefix_sums(range_hash(byte_sums(lower.data), begin, end))
    size = np.bincount(doc, minlength=len(t))
    first = np.cumsum(size) - size
    i = np.arange(max(0, len(begin) - words + 1))
    i = i[doc[i] == doc[i + words - 1]]
    short = np.nonzero((size > 0) & (size < words))[0]
    h = np.concatenate([range_hash(sums, i, i + words),
                        range_hash(sums, first[short], first[short] + size[short])])
    d = np.concatenate([doc[i], short])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return d[new], h[new]


def frequency_class(order: np.ndarray, group: np.ndarray, source: np.ndarray,
                    aux: list[bytes]) -> np.ndarray:
    """Decision: 0 for shingles of one document, else a class that grows with the number."""
    n = np.concatenate([unpack_array(a)[0] for a in aux]).astype(np.float64)[order] + 1
    total = np.bincount(group, weights=n)
    out = np.zeros(len(order), dtype=np.uint8)
    out[order] = np.minimum(255, np.floor(6 * np.log2(total)))[group]
    return out


def least_overlap(percent: int, a: int, b: int) -> int:
    """Smallest intersection at which 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class Node:
    """Of a prefix tree: the shingles on the edge into it, and what lies below."""
    __slots__ = ("path", "members", "last", "children", "sets", "low", "high", "below", "first")

    def __init__(self, path: tuple):
        self.path, self.members = path, frozenset(path)
        self.last = path[-1] if path else -1
        self.children: list[Node] = []
        self.sets: list[int] = []


def build_tree(sets: list[list[int]], sizes: list[int]) -> Node:
    """Prefix tree of ``sets`` (ranks in ascending order); ``sizes`` are their whole sizes."""
    order = sorted(range(len(sets)), key=sets.__getitem__)

    def grow(low: int, high: int, depth: int) -> Node:
        """Node over order[low:high], whose sets agree below ``depth``."""
        a, b = sets[order[low]], sets[order[high - 1]]
        end, most = depth, min(len(a), len(b))
        while end < most and a[end] == b[end]:
            end += 1
        node = Node(tuple(a[depth:end]))
        at = low
        while at < high and len(sets[order[at]]) == end:
            node.sets.append(order[at])
            at += 1
        pending = []
        while at < high:
            head, stop = sets[order[at]][end], at + 1
            while stop < high and sets[order[stop]][end] == head:
                stop += 1
            pending.append((at, stop, end))
            at = stop
        work.append((node, pending))
        return node

    work: list[tuple[Node, list]] = []
    root = grow(0, len(order), 0)
    done = []
    while work:
        node, pending = work.pop()
        done.append(node)
        for span in pending:
            node.children.append(grow(*span))
    for node in reversed(done):  # children were begun after their parents
        below = [sizes[i] for i in node.sets]
        node.low = min(below + [c.low for c in node.children])
        node.high = max(below + [c.high for c in node.children])
        node.first = min(node.sets + [c.first for c in node.children])
        node.below = max([0] + [len(c.path) + c.below for c in node.children])
    return root


class Forest:
    """Union-find over set numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def link(sets: list[list[int]], sizes: list[int], percent: int, left: int) -> Forest:
    """Components of sets by links of at least ``percent``. If ``left`` > 0, only links
    between the first ``left`` sets and the others are looked for."""
    forest = Forest(len(sets))
    cross = 0 < left < len(sets)
    tree = build_tree(sets[:left], sizes[:left]) if cross else build_tree(sets, sizes)
    find = forest.find
    for q in range(left if cross else 1, len(sets)):
        own, ranks, n = frozenset(sets[q]), sets[q], sizes[q]
        low, high = -(-percent * n // 100), 100 * n // percent
        stack = [(tree, 0)]
        while stack:
            node, overlap = stack.pop()
            if node.high < low or node.low > high or node.first >= q:
                continue
            overlap += len(node.members & own)
            if node.sets:
                for s in node.sets:
                    if s < q and find(s) != find(q) and overlap >= least_overlap(percent, n, sizes[s]):
                        forest.union(s, q)
            if node.children:
                left_here = len(ranks) - bisect_right(ranks, node.last) if node.path else len(ranks)
                need = least_overlap(percent, n, max(low, node.low))
                if overlap + min(node.below, left_here) >= need:
                    for c in node.children:
                        if not c.children and len(c.sets) == 1 and find(c.sets[0]) == find(q):
                            continue
                        stack.append((c, overlap))
    return forest


def _settle(percent: int, words: int, bits: int, keyed: bool) -> Callable:
    def run(block_id: int, left: pa.Table, right: pa.Table) -> pa.Table:
        t, _ = unpack_texts(left.column("payload")[0].as_py())
        doc, h = shingles(t, words)
        unique, place, _ = distinct(truncated(h, bits))
        cls = answers_of(right, len(unique))[place]
        n = np.bincount(doc, minlength=len(t))
        alone = np.bincount(doc[cls == 0], minlength=len(t))
        prefix = n - -(-percent * n // 100) + 1 - alone
        first = np.cumsum(n) - n
        rows = []
        for i, doc_id in enumerate(t.id_list()):
            if n[i] == 0 or prefix[i] < 1:
                rows.append((doc_id, None, int(n[i]), None, None, None))
                continue
            own = h[first[i]:first[i] + n[i]]
            c = cls[first[i]:first[i] + n[i]]
            shared = own[c > 0][np.lexsort((own[c > 0], c[c > 0]))]
            key = hashlib.md5(t.text(i)).digest() if keyed else None
            rows.append((doc_id, key, int(n[i]), hashlib.blake2b(own.tobytes(), digest_size=16).digest(),
                         shared.tobytes() + np.sort(c[c > 0]).tobytes(),
                         shared[: prefix[i]].view(np.int64).tolist()))
        columns = list(zip(*rows)) if rows else [[]] * len(_NAMES)
        return pa.table([pa.array(c, k) for c, k in zip(columns, _TYPES)], names=_NAMES)
    return run


def _join_groups(percent: int) -> Callable:
    """Rows sorted by (cluster, low, high): one prefix-tree join for each run of equals."""
    names = ["a", "b"]

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        low, high = rows[0][1], rows[0][2]
        rows.sort(key=lambda r: (r[3] != low, r[4]))
        left = sum(r[3] == low for r in rows) if low != high else 0
        if low != high and not 0 < left < len(rows):
            return None
        forest = link(_ranked([r[6] for r in rows]), [r[5] for r in rows], percent, left)
        pairs = [(rows[i][4], rows[forest.find(i)][4]) for i in range(len(rows)) if forest.find(i) != i]
        if not pairs:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in
                             ("cluster", "low", "high", "chunk", "node", "n", "shingles"))):
                if held and row[:3] != held[0][:3]:
                    out = solve(held)
                    if out is not None:
                        yield out
                    held = []
                held.append(row)
        if held:
            out = solve(held)
            if out is not None:
                yield out
    return run


def _ranked(packed: list[bytes]) -> list[list[int]]:
    """Each set's shingles as ranks in the global order (class, then hash)."""
    sizes = [len(p) // 9 for p in packed]
    h = np.concatenate([np.frombuffer(p, dtype=np.uint64, count=n) for p, n in zip(packed, sizes)])
    c = np.concatenate([np.frombuffer(p, dtype=np.uint8, offset=8 * n) for p, n in zip(packed, sizes)])
    order = np.lexsort((h, c))
    new = np.append(False, (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1]))
    rank = np.zeros(len(h), dtype=np.int64)
    rank[order] = np.cumsum(new[: len(h)])
    return [r.tolist() for r in np.split(rank, np.cumsum(sizes)[:-1])]


def shingle_sets(docs: DataFrame, words: int, percent: int, keyed: bool = False) -> DataFrame:
    """One row per document; ``node`` is null where it can link with nothing. ``text_key`` is the
    text's MD5, if asked for, else null."""
    size = Size.of(docs, text_bytes(docs), WORDS_PER_BYTE)
    bits, buckets = size.filter_bits, size.buckets
    blocks = blocks_of(docs, size.partitions)

    def send_shingles(block_id: int, payload: bytes) -> Iterator[tuple[int, int, bytes]]:
        t, _ = unpack_texts(payload)
        keys, _, n = distinct(truncated(shingles(t, words)[1], bits))
        yield from send(block_id, keys, bits, buckets, lambda part: pack_array(n[part] - 1))

    classes = answer(emit(blocks, send_shingles), size, frequency_class)
    return join_answers(blocks, classes, _settle(percent, words, bits, keyed), _SETS)


def prefix_clusters(sets: DataFrame, files: int) -> DataFrame:
    """(node, root): nodes that share prefix shingles, directly or through others. Every
    shingle ties its nodes to the smallest of them."""
    tokens = sets.select("node", F.explode("prefix").alias("token"))
    hubs = tokens.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("far")) \
        .filter(F.col("hub") != F.col("far")).select("token", "hub")
    edges = tokens.join(hubs, "token").filter(F.col("node") != F.col("hub")) \
        .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    return components(edges, files)


def _linked(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the links found in ``groups`` (cluster, low, high, chunk, node, n, shingles)."""
    key = ["cluster", "low", "high"]
    return groups.repartition(*key).sortWithinPartitions(*key) \
        .mapInArrow(_join_groups(percent), "a binary, b binary")


def _dealt(sets: DataFrame, placed: DataFrame, spans: Column) -> DataFrame:
    """Each set of ``placed`` (node, root, chunk, ...) once for every (low, high) pair of chunks in
    its ``spans``."""
    of = placed.select("node", F.col("root").alias("cluster"), "chunk", spans.alias("spans"))
    return sets.select("node", F.col("n_shingles").alias("n"), "shingles").join(of, "node") \
        .select("cluster", "chunk", "node", "n", "shingles", F.explode("spans").alias("s")) \
        .select("cluster", "s.low", "s.high", "chunk", "node", "n", "shingles")


def _span(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).cast("int").alias("low"), F.greatest(a, b).cast("int").alias("high"))


def _up_to(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def first_round(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """Every chunk in itself and with the cluster's first one."""
    zero, chunk = F.lit(0), F.col("chunk")
    return _dealt(sets, placed, F.when(chunk == 0, F.transform(_up_to(F.col("chunks")), lambda k: _span(zero, k)))
                  .otherwise(F.array(_span(chunk, chunk), _span(zero, chunk))))


def _open(sets: DataFrame, parted: DataFrame) -> DataFrame:
    """The rows of ``parted`` (node, root, part) that share a prefix shingle with a set of another
    part: no other can have a link that matters."""
    tokens = sets.select("node", "prefix").join(parted.select("node", "part"), "node") \
        .select("node", "part", F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")) \
        .filter(F.col("low") != F.col("high")).select("token")
    return parted.join(tokens.join(shared, "token").select("node").distinct(), "node")


def _only(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of ``nodes``, chosen from ``rows`` before equal sets are put together."""
    return rows.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def second_round(rows: DataFrame, placed: DataFrame, found: DataFrame, late_sets: int, files: int) -> DataFrame:
    """In clusters of three chunks and more, the sets outside the largest component of ``found``
    with all sets of other components, as far as they share prefix shingles. ``rows`` are the
    sets, equal ones any number of times; each table of nodes in between takes ``files``."""
    part = components(found, files).withColumnRenamed("root", "part")
    # tables of their own: where they are small, Spark sends them to the sets, not the sets to them
    parted = materialize(placed.filter(F.col("chunks") > 2).select("node", "root").join(part, "node", "left")
                         .select("node", "root", F.coalesce("part", "node").alias("part")).coalesce(files), "cluster-parts")
    parted = materialize(_open(_only(rows, parted), parted).coalesce(files), "open-parts")
    sizes = parted.groupBy("root", "part").agg(F.count(F.lit(1)).alias("k"))
    main = materialize(
        sizes.groupBy("root").agg(F.sum("k").alias("total"), F.max(F.struct("k", "part")).alias("m"))
        .select("root", F.col("m.part").alias("main"), F.ceil(F.col("m.k") / late_sets).alias("mains"),
                F.ceil((F.col("total") - F.col("m.k")) / late_sets).alias("rests")).coalesce(files), "open-clusters")
    rest, bucket = F.col("part") != F.col("main"), F.xxhash64("node")
    dealt = parted.join(main, "root").withColumn("chunk", F.when(
        rest, F.col("mains") + F.pmod(bucket, F.col("rests"))).otherwise(F.pmod(bucket, F.col("mains"))).cast("int"))
    rests = F.transform(_up_to(F.col("rests")), lambda i: _span(F.col("chunk"), F.col("mains") + i))
    mains = F.transform(_up_to(F.col("mains")), lambda i: _span(F.col("chunk"), i))
    spans = F.when(rest, F.concat(mains, rests)).otherwise(rests)
    dealt = materialize(dealt.select("node", "root", "chunk", spans.alias("spans")).coalesce(files), "open-chunks")
    return _dealt(_only(rows, dealt), dealt, F.col("spans"))


def links(rows: DataFrame, percent: int, chunk_sets: int = CHUNK_SETS, late_sets: int = LATE_SETS) -> DataFrame:
    """(a, b): links of at least ``percent`` between the sets of ``rows`` (node, n_shingles, shingles,
    prefix), enough of them to connect what all would."""
    sets = rows.dropDuplicates(["node"])
    files = files_for(rows.count())
    clusters = prefix_clusters(sets, files)
    # the few clusters of several chunks are a small table of their own, so that a cluster of
    # many sets is no hot key of the join
    large = materialize(
        clusters.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk_sets)).cast("int").alias("chunks"))
        .filter(F.col("chunks") > 1).coalesce(files), "large-clusters")
    placed = clusters.join(large, "root", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))) \
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    found = checkpoint(_linked(first_round(sets, placed), percent))
    if large.filter(F.col("chunks") > 2).isEmpty():
        return found
    return found.unionByName(_linked(second_round(rows, placed, found, late_sets, files), percent))


def _placed(rows: DataFrame, percent: int, chunk_sets: int, late_sets: int) -> tuple[DataFrame, int]:
    """(doc_id, text_key, n_shingles, root) of the rows of ``shingle_sets`` that can link, and
    the files that a table of them takes."""
    linkable = rows.filter(F.col("node").isNotNull())
    sets = linkable.select("node", "n_shingles", "shingles", "prefix")
    files = files_for(sets.count())
    found = components(links(sets, percent, chunk_sets, late_sets), files)
    return linkable.select("doc_id", "text_key", "n_shingles", "node").join(found, "node", "left") \
        .withColumn("root", F.coalesce("root", "node")), files


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    chunk_sets: int = CHUNK_SETS, late_sets: int = LATE_SETS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: components of links with
    100 * intersection >= percent * union."""
    rows = materialize(shingle_sets(docs, words, percent), "shingle-sets")
    placed, files = _placed(rows, percent, chunk_sets, late_sets)
    # a table of its own, so that a component of many rows can be split in the join
    smallest = checkpoint(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")).coalesce(files))
    linked = placed.join(smallest, "root").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter(F.col("node").isNull()) \
        .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the smallest doc_id, then
    of the smallest MD5 of its text; of several such rows, which are the same document, any one.
    Rows that link with nothing all stay, rows without words and equal ones too, and so do rows
    without doc_id, which can't be told apart; the latter don't stand for others."""
    rows = materialize(shingle_sets(docs.select("doc_id", "text"), words, percent, keyed=True), "shingle-sets")
    placed, files = _placed(rows, percent, CHUNK_SETS, LATE_SETS)
    placed = placed.filter(F.col("doc_id").isNotNull())
    row = F.struct("doc_id", "text_key")
    stays = checkpoint(placed.groupBy("root").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") > 1).select("root", "first").coalesce(files))
    ruled = checkpoint(placed.join(stays, "root").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
                       .agg(F.max(row == F.col("first")).alias("_kept"), F.count(F.lit(1)).alias("_rows"))
                       .filter(~F.col("_kept") | (F.col("_rows") > 1)).coalesce(files))
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_key": F.unhex(F.md5(F.col("text").cast("string")))})
    others = keyed.join(ruled, ["_id", "_key"], "left_anti")
    repeated = ruled.filter("_kept").select("_id", "_key")
    once = keyed.join(repeated, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return others.unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 4-word shingles at a Jaccard similarity of 0.85."""
    return near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=85)


OP7_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
    SELECT DISTINCT r, array_to_string(words[i:i + 3], ' ') AS shingle
    FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (
    SELECT a.r AS a, b.r AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
    SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.r = p.a JOIN sizes y ON y.r = p.b
    WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (
    SELECT r, r AS t FROM docs
    UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.t)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM docs d LEFT JOIN sizes s USING (r)
JOIN (SELECT reach.r, min(t.doc_id) AS component_id FROM reach JOIN docs t ON t.r = reach.t GROUP BY reach.r) c
    ON c.r = d.r
"""
