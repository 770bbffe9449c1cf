"""N-gram Jaccard self-join with an LSH forest and exact verification.

1. Texts with the same set of word shingles become one node with a count, so
   copies are never paired with each other.
2. Each of ``TREES`` prefix trees labels a node with ``LONGEST`` min-hashes. Two
   nodes meet in a tree when they share a prefix of its labels. The prefixes are
   shortened on the data, per node and tree: a node starts with its whole labels
   and, while a pair at the threshold is not yet expected to meet it with the
   target recall, gives up one more label in the tree where the next bucket is
   smallest (:func:`matched_prefixes`). Bucket sizes are counted on the tries of
   the nodes that share a prefix with another at all; every other bucket has one
   node. A node among many stays deep in the trees whose buckets are large.
3. A bucket holds the nodes that ask at its depth and all others that share its
   prefix. Buckets are cut into blocks of bounded size; a block pair compares
   the whole signatures of those who ask with the rest and emits a spanning
   forest of the likely pairs, never the pairs themselves.
4. Components of the forest are candidate clusters. Within a cluster, blocks
   again, every pair's exact Jaccard similarity is computed from the shingle
   sets. Links are counted per node; a spanning forest of the links gives the
   classes.

A bucket or cluster that holds a third of the rows is spread over all its
block pairs; nothing is capped or sampled.

Defined cases: null or wordless text has no shingles and links to nothing;
equal rows are copies of each other; ``n_links`` counts the other documents at
or over the threshold, copies included; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, fresh, ship_package, staged
from marginlens.llm.components import components
from marginlens.llm.shingles import mix, shingle_hashes, word_hashes

SIMILARITY = (4, 5)      # 0.8 as a fraction: exact integer comparison
TREES, LONGEST = 16, 8
TARGET_RECALL = 0.9995   # of pairs exactly at the threshold
CHEAP = 64               # nodes of a bucket that is asked for at any prefix
LIKELY = 0.6             # signature agreement from which a pair is looked at (threshold - 5.6 deviations)
SIGNATURE_BLOCK, SET_BLOCK = 512, 256  # rows of a block
SET_BLOCK_BYTES = 32 << 20

_rng = np.random.default_rng(11)
_XOR = _rng.integers(0, 1 << 32, TREES * LONGEST, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, TREES * LONGEST, dtype=np.uint32) | np.uint32(1)


def prefix_length(similarity: float, target: float = TARGET_RECALL, trees: int = TREES, longest: int = LONGEST) -> int:
    """The prefix that suffices when it is the same in all trees: no tree needs a shorter one."""
    for depth in range(longest, 0, -1):
        if 1 - (1 - similarity ** depth) ** trees >= target:
            return depth
    return 1


def matched_prefixes(sizes: np.ndarray, least: int, similarity: float, target: float = TARGET_RECALL,
                     cheap: int = CHEAP) -> np.ndarray:
    """Prefix length per tree (rows of ``sizes``: bucket sizes at the lengths ``least`` and up).

    From the whole label downwards, always in the tree whose next bucket is
    smallest: as long as that has at most ``cheap`` nodes, and then until a
    neighbour at ``similarity`` is met in one of the trees with probability
    ``target``. (A small bucket is small because no one is there or because it
    is the neighbour; stopping there would favour the trees without one.)
    """
    trees, lengths = sizes.shape
    missed = np.log1p(-similarity ** np.arange(least, least + lengths))  # log-probability that a tree misses it
    at = np.full(trees, lengths - 1)
    total, wanted = missed[at].sum(), np.log1p(-target)
    heap = [(int(sizes[t, at[t] - 1]), t) for t in range(trees) if at[t]]
    heapq.heapify(heap)
    while heap and (heap[0][0] <= cheap or total > wanted):
        _, t = heapq.heappop(heap)
        at[t] -= 1
        total += missed[at[t]] - missed[at[t] + 1]
        if at[t]:
            heapq.heappush(heap, (int(sizes[t, at[t] - 1]), t))
    return at + least


def signature(shingles: np.ndarray) -> np.ndarray:
    """``TREES * LONGEST`` min-hashes; half of the functions see either half of a shingle's bits."""
    best = np.full(TREES * LONGEST, 0xFFFFFFFF, np.uint32)
    half = len(best) // 2
    for a in range(0, len(shingles), 2048):
        part = shingles[a:a + 2048]
        for part32, own in (((part & np.uint64(0xFFFFFFFF)).astype(np.uint32), slice(0, half)),
                            ((part >> np.uint64(32)).astype(np.uint32), slice(half, None))):
            values = (part32[None, :] ^ _XOR[own, None]) * _MUL[own, None]
            best[own] = np.minimum(best[own], values.min(1))
    return best


def bucket_keys(sig: np.ndarray, depth: int) -> np.ndarray:
    """One 64-bit key per tree: the tree and the first ``depth`` labels."""
    labels = sig.reshape(TREES, LONGEST).astype(np.uint64)
    key = np.arange(1, TREES + 1, dtype=np.uint64)
    for k in range(depth):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + labels[:, k])
    return key.view(np.int64)


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(docs: DataFrame, depth: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                ids, keys, sigs = [], [], []
                for text in part.column(2):
                    s = np.unique(shingle_hashes(word_hashes(text.as_py())))
                    if len(s):
                        sig = signature(s)
                        ids.append(set_id(s))
                        keys.append(bucket_keys(sig, depth))
                        sigs.append((sig & 0xFF).astype(np.uint8).tobytes())
                    else:
                        ids.append(None), keys.append(None), sigs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(sigs, pa.binary())], names=["doc_id", "text_key", "set_id", "keys", "sig"])

    return docs.mapInArrow(run, "doc_id long, text_key long, set_id binary, keys array<long>, sig binary")


def _blocks(rows: DataFrame, key: str, block: int, weight: str | None = None, block_bytes: int = 0,
            payload: DataFrame | None = None) -> DataFrame:
    """Deal the rows of every key with at least two rows to its block pairs.

    Adds ``left``, ``right`` (the block pair) and ``own`` (the row's block).
    A key of ``b`` blocks sends each row to ``b`` pairs. ``payload`` (by
    ``node``) joins only the rows that are dealt.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                   F.sum(weight if weight else F.lit(0)).alias("_bytes"))
    n_blocks = F.ceil(F.col("_n") / block)
    if weight:
        n_blocks = F.greatest(n_blocks, F.ceil(F.col("_bytes") / block_bytes))
    sizes = staged(counts.filter("_n > 1").select(key, n_blocks.cast("int").alias("_b")), f"{key}_blocks")
    dealt = rows.join(sizes.hint("merge"), key).withColumn("own", F.pmod(F.hash("node"), F.col("_b")))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    dealt = dealt.withColumns({"left": F.least("own", "_other"), "right": F.greatest("own", "_other")})
    dealt = dealt.drop("_b", "_other")
    if payload is not None:
        dealt = dealt.join(payload.hint("merge"), "node")
    order = [key, "left", "right"]
    return dealt.repartition(*order).sortWithinPartitions(*order, "own", "node")


def _groups(batches, columns: list[str]):
    """Runs of equal (first three columns) as dicts of Python lists; spans batches."""
    def flat():
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)))

    for _, rows in itertools.groupby(flat(), key=lambda r: r[:3]):
        yield dict(zip(columns, map(list, zip(*rows))))


class _Forest:
    """Union-find that remembers the edges that joined two parts."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[b] = a
            self.edges.append((x, y))


def _compared(own: list[int]) -> tuple[slice, slice]:
    """Rows of the left and right block; equal when the pair is a block with itself."""
    cut = next((i for i, b in enumerate(own) if b != own[0]), None)
    whole = slice(0, len(own))
    return (whole, whole) if cut is None else (slice(0, cut), slice(cut, len(own)))


def _trie_key(depth) -> F.Column:
    """The bucket of a node's first ``depth`` labels in a tree (``key``: the least length, ``tail``: further labels)."""
    longer = F.xxhash64("key", F.substr("tail", F.lit(1), depth - F.col("least")))
    return F.when(depth == F.col("least"), F.col("key")).otherwise(longer)


def buckets(nodes: DataFrame, least: int, cheap: int = CHEAP) -> DataFrame:
    """``node, key, asks``: the members of every bucket that some node asks for."""
    rows = nodes.select("node", F.posexplode("keys").alias("tree", "key"))
    shared = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared_prefixes")
    tail = F.substr("sig", F.col("tree") * LONGEST + least + 1, F.lit(LONGEST - least))
    tries = staged(rows.join(shared.hint("merge"), "key").join(nodes.select("node", "sig").hint("merge"), "node")
                   .select("node", "tree", "key", "n", tail.alias("tail"), F.lit(least).alias("least")), "tries")

    # sizes of the deeper buckets, and every node's prefix lengths from them
    deeper = tries.withColumn("depth", F.explode(F.sequence(F.lit(least + 1), F.lit(LONGEST))))
    deeper = deeper.select("node", "tree", "depth", _trie_key(F.col("depth")).alias("key"))
    sizes = deeper.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sized = deeper.join(sizes.hint("merge"), "key").select("node", "tree", "depth", "n").unionByName(
        tries.select("node", "tree", F.col("least").alias("depth"), "n"))
    per_node = sized.groupBy("node").agg(F.collect_list(F.struct("tree", "depth", "n")).alias("sizes"))  # trees times lengths

    def shorten(batches):
        for batch in batches:
            out = [[], [], []]
            for node, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = np.ones((TREES, LONGEST - least + 1), np.int64)
                for x in listed:
                    n[x["tree"], x["depth"] - least] = x["n"]
                for t, d in enumerate(matched_prefixes(n, least, SIMILARITY[0] / SIMILARITY[1], cheap=cheap).tolist()):
                    if n[t, 0] > 1:
                        out[0].append(node), out[1].append(t), out[2].append(d)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
                                             names=["node", "tree", "wanted"])

    asked = staged(per_node.mapInArrow(shorten, "node long, tree int, wanted int"), "matched_prefixes")
    held = tries.join(asked.hint("merge"), ["node", "tree"])
    wanted = held.select(_trie_key(F.col("wanted")).alias("key")).distinct()
    members = held.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(LONGEST))))
    members = members.select("node", _trie_key(F.col("depth")).alias("key"), (F.col("depth") == F.col("wanted")).alias("asks"))
    return staged(members.join(wanted.hint("merge"), "key", "left_semi"), "bucket_members")


def likely_pairs(nodes: DataFrame, least: int) -> DataFrame:
    """Spanning forests (``a, b``) of the pairs that share a matched prefix and most of their signature."""
    columns = ["key", "left", "right", "own", "node", "asks", "sig"]

    def run(batches):
        edges: list[tuple[int, int]] = []
        for g in _groups(batches, columns):
            left, right = _compared(g["own"])
            if g["left"][0] != g["right"][0] and left == right:
                continue  # only one of the two blocks has rows
            sigs = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(len(g["node"]), -1)
            asks = np.array(g["asks"])
            forest = _Forest(len(sigs))
            for i in range(left.start, left.stop):
                lo = max(i + 1, right.start)
                others = np.arange(lo, right.stop)
                if not asks[i]:
                    others = others[asks[lo:right.stop]]
                agree = (sigs[others] == sigs[i]).mean(1)
                for j in others[agree >= LIKELY].tolist():
                    forest.join(i, j)
            edges += [(g["node"][i], g["node"][j]) for i, j in forest.edges]
            if len(edges) > 50_000:
                yield _edge_batch(edges)
                edges = []
        yield _edge_batch(edges)

    dealt = _blocks(buckets(nodes, least), "key", SIGNATURE_BLOCK, payload=nodes.select("node", "sig"))
    return dealt.select(*columns).mapInArrow(run, "a long, b long")


def _edge_batch(edges: list) -> pa.RecordBatch:
    a, b = zip(*edges) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def intersections(sets: list[np.ndarray], left: slice, right: slice) -> np.ndarray:
    """Sizes of the pairwise intersections, left rows by right rows."""
    lengths = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), lengths)
    shared = np.bincount(column, minlength=len(values)) > 1
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n_left, n_right = left.stop - left.start, right.stop - right.start
    total = np.zeros((n_left, n_right), np.float32)
    width = 4096
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (a, a + width))
        x = np.zeros((len(sets), width), np.float32)
        x[row[lo:hi], column[lo:hi] - a] = 1
        total += x[left] @ x[right].T  # counts below 2**24 are exact
    return total.astype(np.int64)


def exact_links(members: DataFrame) -> DataFrame:
    """``node, n_links, a, b`` from ``cluster, node, copies, shingles`` rows.

    A row is either a node's partial number of linked documents (``a`` null)
    or an edge of the links' spanning forest (``node`` null).
    """
    columns = ["cluster", "left", "right", "own", "node", "copies", "shingles"]
    num, den = SIMILARITY

    def run(batches):
        for g in _groups(batches, columns):
            left, right = _compared(g["own"])
            if g["left"][0] != g["right"][0] and left == right:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in g["shingles"]]
            size = np.array([len(s) for s in sets])
            copies = np.array(g["copies"])
            both = intersections(sets, left, right)
            # |A & B| / |A | B| >= num / den, in integers
            linked = (num + den) * both >= num * (size[left][:, None] + size[right][None, :])
            if left == right:
                np.fill_diagonal(linked, False)
            count = np.zeros(len(sets), np.int64)
            count[left] += linked @ copies[right]
            if left != right:
                count[right] += linked.T @ copies[left]
            forest = _Forest(len(sets))
            for i, j in zip(*np.nonzero(linked)):
                forest.join(left.start + int(i), right.start + int(j))
            some = np.flatnonzero(count).tolist()
            none = [None] * len(forest.edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g["node"][i] for i in some] + none, pa.int64()),
                 pa.array(count[some].tolist() + none, pa.int64()),
                 pa.array([None] * len(some) + [g["node"][i] for i, _ in forest.edges], pa.int64()),
                 pa.array([None] * len(some) + [g["node"][j] for _, j in forest.edges], pa.int64())],
                names=["node", "n_links", "a", "b"])

    dealt = _blocks(members.withColumn("_size", F.octet_length("shingles")), "cluster", SET_BLOCK, "_size",
                    SET_BLOCK_BYTES)
    return dealt.select(*columns).mapInArrow(run, "node long, n_links long, a long, b long")


def _with_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingle set of each wanted node, from its representative row.

    A merge join at every size: the wanted list grows with the corpus.
    """
    rows = docs.join(wanted.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "node", "cluster",
                                   "copies", "set_id").hint("merge"),
                     F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    rows = rows.select("node", "cluster", "copies", "set_id", "text")

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                sets = [np.unique(shingle_hashes(word_hashes(t.as_py()))) for t in part.column(4)]
                keep = pa.array([set_id(s) == i.as_py() for s, i in zip(sets, part.column(3))])
                out = pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(3)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "cluster", "copies", "shingles"])
                yield out.filter(keep)

    return rows.mapInArrow(run, "node long, cluster long, copies long, shingles binary").dropDuplicates(["node"])


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, class_id, n_links, keeper``.

    ``class_id`` is the least id of the documents connected by links;
    ``keeper`` the (id, text key) of the one that represents the class.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    depth = prefix_length(SIMILARITY[0] / SIMILARITY[1])
    sketch = staged(_sketch(own, depth), "sketch")
    first = F.min(F.struct("doc_id", "text_key"))
    groups = (sketch.filter(F.col("set_id").isNotNull()).groupBy("set_id")
              .agg(first.alias("first"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
                   F.first("keys").alias("keys"), F.first("sig").alias("sig")))
    nodes = staged(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")

    clusters = components(likely_pairs(nodes, depth)).select("node", F.col("root").alias("cluster"))
    wanted = staged(nodes.join(clusters, "node")
                    .select("node", "cluster", "copies", "set_id", "first.doc_id", "first.text_key"), "wanted")
    links = staged(exact_links(staged(_with_sets(own, wanted), "sets")), "links")
    counts = links.filter("node IS NOT NULL").groupBy("node").agg(F.sum("n_links").alias("n_links"))
    roots = components(links.filter("a IS NOT NULL").select("a", "b"))
    named = (nodes.select("node", "set_id", "copies", "first", "least_id").join(roots, "node", "left").join(counts, "node", "left")
             .select("set_id", "first", "least_id", F.coalesce("root", "node").alias("root"),
                     (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = staged(named, "named")
    classes = named.groupBy("root").agg(F.min("first").alias("keeper"), F.min("least_id").alias("class_id"))
    classes = staged(named.join(staged(classes, "class_ids"), "root").select("set_id", "keeper", "class_id", "n_links"),
                     "classes")
    return (sketch.select("doc_id", "text_key", "set_id").join(classes, "set_id", "left")
            .select("doc_id", "text_key", F.when(F.col("n_links").isNull(), F.col("doc_id"))
                    .otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("keeper", F.struct("doc_id", "text_key")).alias("keeper")))


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their class, all columns.

    Rows equal in id and text collapse to one of them.
    """
    lost, key = fresh(docs, "_lost_id"), fresh(docs, "_text_key")
    own = F.struct("doc_id", "text_key")
    losers = staged(jaccard_classes(docs, id_col, text_col).filter(~own.eqNullSafe(F.col("keeper")))
                    .select(F.col("doc_id").alias(lost), F.col("text_key").alias(key)).distinct(), "losers")
    tagged = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    on = tagged[id_col].cast("long").eqNullSafe(losers[lost]) & (tagged[key] == losers[key])
    return tagged.join(losers.hint("merge"), on, "left_anti").dropDuplicates([id_col, key]).select(*docs.columns)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(driver_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
