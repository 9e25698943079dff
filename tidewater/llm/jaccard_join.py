"""N-gram Jaccard self-join by chosen paths.

Texts become sets of five-word shingles. Equal sets are one node. Each node is
embedded as ``T`` minimum hashes (position, value), a set whose overlap follows
the Jaccard similarity. A run samples each token of a set with probability
1/(THRESHOLD * T) by a hash that all sets share, and the set goes into the
bucket of every token sampled: two sets at the threshold are expected to meet
in one bucket per run. Buckets over ``SMALL`` are split again by sampling on
the path so far, up to ``DEPTH`` levels; what is still large then (groups of
near copies) is dealt into pairs of bounded chunks. Buckets are searched by
brute force on the embedded sets. ``runs()`` gives the repetitions that make
the chance of missing a pair at the threshold less than 1 - TARGET_RECALL.

A bucket only reports a spanning forest of its similar sets, never all pairs.
The forests' components are candidate groups; inside each group the exact
Jaccard similarity of all its texts decides, again chunk by chunk, and gives
each text's number of links and the exact spanning forest. Connected
components run as joins over written tables, nothing is collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import share, shared, small_batches, written
from .words import Scanner, alnum_table, mix, pieces, seeds

SHINGLE = 5
THRESHOLD = 0.8
T = 64                          # minimum hashes per set
TARGET_RECALL = 0.999           # of pairs exactly at the threshold
SMALL = 200                     # sets in a bucket that is searched whole
CHUNK = 800                     # texts on one side of an exact comparison
DEPTH = 3
FILTER_BITS = 16                # per candidate, of the bitmap that keeps texts of no candidate out of a shuffle
MAX_FILTER = 1 << 27            # bits of a bitmap, 16 MB: beyond 8 million candidates all texts are shuffled
SCREEN = THRESHOLD - 3.5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / T)


def runs(target: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs for the target recall: shared buckets of a pair at the threshold survive ``depth`` levels as a
    branching process with one expected child per level."""
    alive = 1.0
    for _ in range(depth - 1):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 / (1 - target)) / alive)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of a piece, first shingle per document); a text of 1-4 words is one shingle."""
    factors = seeds(SHINGLE, 31)
    n = len(hashes)
    count = np.diff(first)
    padded = np.concatenate([hashes, np.zeros(SHINGLE, np.uint64)])
    end = np.repeat(first[1:], count)
    total = np.zeros(n, np.uint64)
    at = np.arange(n)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            total += np.where(at + k < end, padded[k:k + n], np.uint64(0)) * factors[k]
    start = np.repeat(first[:-1], count)
    keep = (at + SHINGLE <= end) | (at == start)
    out = mix(total)[keep]
    return out, np.concatenate([[0], np.cumsum(keep)])[first]


def text_sets(column, scanner: Scanner):
    """Yield the sorted distinct shingle hashes of each text of an Arrow column."""
    for lo, hi, offsets, data in pieces(column):
        w = scanner.scan(offsets, data)
        s, first = shingle_hashes(w.hash, w.first)
        for d in range(hi - lo):
            yield np.unique(s[first[d]:first[d + 1]])


def _embed(docs: DataFrame) -> DataFrame:
    """(key) row key, (node) id of the shingle set, (sig) T minimum hashes; the text goes no further."""
    def work(batches):
        scanner = Scanner(alnum_table())
        factors = seeds(T, 41)
        for batch in batches:
            nodes, sigs = [], []
            for lo, hi, offsets, data in pieces(batch.column(2)):
                w = scanner.scan(offsets, data)
                s, first = shingle_hashes(w.hash, w.first)
                n = hi - lo
                full = np.flatnonzero(np.diff(first) > 0)
                sig = np.zeros((n, T), np.uint32)
                if len(full):
                    with np.errstate(over="ignore"):
                        for k in range(T):
                            h = s * factors[k]
                            h ^= h >> np.uint64(29)
                            h *= np.uint64(0xBF58476D1CE4E5B9)
                            sig[full, k] = (np.minimum.reduceat(h, first[full]) >> np.uint64(16)).astype(np.uint32)
                node = np.zeros(n, np.uint64)
                with np.errstate(over="ignore"):
                    for d in full:
                        own = np.unique(s[first[d]:first[d + 1]])
                        node[d] = mix(mix(own).sum(dtype=np.uint64) + np.uint64(len(own)))
                nodes.append(node)
                sigs.extend(r.tobytes() for r in sig)
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.concatenate(nodes).view(np.int64)), pa.array(sigs, pa.binary())],
                    names=["doc_id", "key", "node", "sig"])

    return docs.select("doc_id", "key", "text").mapInArrow(work, "doc_id long, key long, node long, sig binary")


def _paths(rows: DataFrame, level: int) -> DataFrame:
    """(path, node): the buckets that each set (node, sig, path so far) goes into at ``level``."""
    n_runs = runs() if level == 1 else 1
    least = np.uint64(min((1 << 64) - 1, int((1 << 64) / (THRESHOLD * T))))

    def work(batches):
        salt = seeds(T * n_runs, 50 + level).reshape(n_runs, T)
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, T).astype(np.uint64)
            node, path = batch.column("node").to_numpy(), batch.column("path").to_numpy().view(np.uint64)
            for r in range(n_runs):
                with np.errstate(over="ignore"):
                    u = mix((sig + np.arange(T, dtype=np.uint64) * np.uint64(1 << 32)) * salt[r] + path[:, None])
                row, token = np.nonzero(u < least)
                with np.errstate(over="ignore"):
                    to = mix(u[row, token] + path[row] + np.uint64(r) * np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([pa.array(to.view(np.int64)), pa.array(node[row])], names=["path", "node"])

    return rows.select("path", "node", "sig").mapInArrow(work, "path long, node long")


def _groups(batches, key: int):
    """Yield runs of rows with equal (sorted) key columns as tables, across batches."""
    held, own = [], None
    for batch in batches:
        if not len(batch):
            continue
        k = np.stack([batch.column(i).to_numpy() for i in range(key)], 1)
        edges = np.append(np.flatnonzero(np.append(True, (k[1:] != k[:-1]).any(1))), len(k))
        for a, b in zip(edges[:-1], edges[1:]):
            if own is not None and own != tuple(k[a]):
                yield own, pa.Table.from_batches(held)
                held = []
            own = tuple(k[a])
            held.append(batch.slice(a, b - a))
    if own is not None:
        yield own, pa.Table.from_batches(held)


class _Forest:
    """Union by smallest member over local numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _spanning(similar: np.ndarray, rows: np.ndarray, cols: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph whose edges are the true entries of ``similar`` (rows x cols)."""
    forest, edges = _Forest(n), []
    for i in range(len(rows)):
        for j in np.flatnonzero(similar[i]).tolist():
            if forest.join(int(rows[i]), int(cols[j])):
                edges.append((int(rows[i]), int(cols[j])))
    return edges


def _candidates(buckets: DataFrame) -> DataFrame:
    """(a, b): spanning forests of the sets that look similar, per bucket. From (path, i, j, side, node, sig).

    ``i`` < ``j`` are two chunks of a large bucket, compared with each other; equal ones a bucket compared with itself.
    """
    def work(batches):
        for (_, i, j), group in _groups(batches, 3):
            side, node = group["side"].to_numpy(), group["node"].to_numpy()
            if len(node) < 2:
                continue
            sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint32).reshape(-1, T)
            rows = np.flatnonzero(side == i)
            cols = np.flatnonzero(side == j)
            if not len(rows) or not len(cols):
                continue
            need = math.ceil(SCREEN * T)
            similar = np.empty((len(rows), len(cols)), bool)
            right = np.ascontiguousarray(sig[cols].T)
            for k, r in enumerate(rows):
                same = np.zeros(len(cols), np.uint8)
                for p in range(T):
                    same += right[p] == sig[r, p]
                similar[k] = same >= need
            found = _spanning(similar, rows, cols, len(node))
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    ordered = buckets.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j").select(
        "path", "i", "j", "side", "node", "sig")
    return ordered.mapInArrow(work, "a long, b long").where("a <> b")


def _chunked(rows: DataFrame, group: str, size: str, limit: int) -> DataFrame:
    """Rows of a group with ``size`` members, once per pair of chunks that their chunk takes part in."""
    chunks = F.ceil(F.col(size) / limit).cast("int")
    side = F.pmod(F.xxhash64(F.lit("chunk"), "node"), chunks).cast("int")
    return (rows.withColumn("_g", chunks).withColumn("side", side)
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
            .withColumn("i", F.least("side", "_o")).withColumn("j", F.greatest("side", "_o")).drop("_g", "_o"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp) for the nodes of (a, b) edges; comp is the component's smallest node.

    Edges point from the greater node ``a`` to the smaller ``b``. A round moves
    every edge to the least neighbour of its ``b`` and then joins the neighbours
    of every ``a`` to the least of them, until the edges are stars: no ``b``
    points on and no ``a`` points twice. Least neighbours are combined before
    they are shuffled, and written: a join then is of two plain shuffles, which
    Spark splits where a hub's edges are many.
    """
    spark = edges.sparkSession
    now = written(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        low = written(spark, now.groupBy("a").agg(F.min("b").alias("m")), name)
        large = written(spark, now.join(low.withColumnRenamed("a", "b"), "b", "left").select(
            "a", F.coalesce("m", "b").alias("b"), F.col("m").isNotNull().alias("moved")), name)
        n, moved = large.agg(F.count(F.lit(1)), F.count_if("moved")).first()
        if not moved and n == low.count():
            return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
        low = written(spark, large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(spark, small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)


def exact_links(sets: list, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Which pairs (rows x cols) of shingle sets have Jaccard similarity of at least THRESHOLD."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1                          # a shingle of one set adds to no intersection
    number = np.cumsum(shared) - 1
    keep = shared[which]
    owner, which = owner[keep], number[which[keep]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    both = np.zeros((len(rows), len(cols)), np.float32)
    at_row = np.full(len(sets), -1)
    at_row[rows] = np.arange(len(rows))
    at_col = np.full(len(sets), -1)
    at_col[cols] = np.arange(len(cols))
    width = max(64, min(4096, (4 << 20) // max(len(rows), len(cols))))
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(which, [lo, lo + width])
        o, w = owner[a:b], which[a:b] - lo
        left, right = np.zeros((len(rows), width), np.float32), np.zeros((len(cols), width), np.float32)
        r, c = at_row[o] >= 0, at_col[o] >= 0
        left[at_row[o[r]], w[r]] = 1
        right[at_col[o[c]], w[c]] = 1
        both += left @ right.T
    union = size[rows][:, None] + size[cols][None, :] - both
    return both * 5 >= union * 4 if THRESHOLD == 0.8 else both >= THRESHOLD * union


def _verified(groups: DataFrame) -> DataFrame:
    """(a, b, links) from (comp, i, j, side, node, text): b null: a's links in this comparison; else an edge of the forest."""
    def work(batches):
        scanner = Scanner(alnum_table())
        for (_, i, j), group in _groups(batches, 3):
            node, side = group["node"].to_numpy(), group["side"].to_numpy()
            rows, cols = np.flatnonzero(side == i), np.flatnonzero(side == j)
            if len(node) < 2 or not len(rows) or not len(cols):
                continue
            sets = list(text_sets(group["text"], scanner))
            similar = exact_links(sets, rows, cols)
            if i == j:
                np.fill_diagonal(similar, False)
                links, who = similar.sum(1), rows
            else:
                links, who = np.concatenate([similar.sum(1), similar.sum(0)]), np.concatenate([rows, cols])
            edges = _spanning(similar, rows, cols, len(node))
            a = np.array([e[0] for e in edges], np.int64)
            b = np.array([e[1] for e in edges], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[who], node[a]])),
                 pa.array(np.concatenate([node[who], node[b]]), mask=np.arange(len(who) + len(a)) < len(who)),
                 pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]).astype(np.int64))], names=["a", "b", "links"])

    ordered = groups.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").select(
        "comp", "i", "j", "side", "node", "text")
    return ordered.mapInArrow(work, "a long, b long, links long")


def _maybe_in(keys: DataFrame):
    """(condition, broadcast): true for every ``key`` in the written table ``keys`` and for few others.

    A bitmap that grows with the keys up to ``MAX_FILTER`` bits; beyond them
    the condition is true for every row and there is no broadcast.
    """
    bits = 1 << max(20, (FILTER_BITS * max(keys.count(), 1) - 1).bit_length())
    if bits > MAX_FILTER:
        return F.lit(True), None
    words = (keys.groupBy(F.floor(F.pmod("key", F.lit(bits)) / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(key, {bits}) % 64 AS int))")).alias("v"))).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)     # bits / 64 rows at most
    bitmap[words["w"].to_numpy()] = words["v"].to_numpy()
    fixed = share(keys.sparkSession, bitmap)

    @F.pandas_udf("boolean")
    def maybe(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bitmap = shared(fixed)
        for key in keys:
            at = key.to_numpy() % bits
            yield pd.Series((bitmap[at // 64] >> (at % 64)) & 1 == 1)

    return maybe("key"), fixed


def similar_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, comp, class_id, n_links, n_copies) for (doc_id, text), one row per row of ``docs``.

    ``class_id`` is the smallest doc_id of the row's near-duplicate class (null
    only if all its ids are null), ``n_links`` the number of other texts at
    Jaccard >= THRESHOLD, ``n_copies`` the number of other rows with an equal
    shingle set, ``key`` a hash of the row, ``comp`` the class's internal id. Words are runs of 0-9, a-z (A-Z
    lower-cased) and non-ASCII characters. Texts without words (null, empty)
    are copies of each other and link to none. An empty table gives an empty
    result; other columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("key", F.xxhash64(F.lit("row"), "doc_id", "text"))
    rows = written(spark, _embed(base), "sets")
    # One row per distinct set; copies combine before the shuffle.
    reps = written(spark, rows.where("node <> 0").groupBy("node").agg(
        F.min("key").alias("key"), F.first("sig").alias("sig")), "nodes")
    entries = _paths(reps.withColumn("path", F.lit(0).cast("long")), 1)
    forests = []
    for level in range(1, DEPTH + 1):
        entries = written(spark, entries, f"paths{level}")
        sizes = written(spark, entries.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"buckets{level}")
        last = level == DEPTH
        bucket = entries.join(sizes if last else sizes.where(F.col("n") <= SMALL), "path").join(reps.select("node", "sig"), "node")
        # At the last level large buckets are dealt into chunks, small ones are one chunk.
        forests.append(written(spark, _candidates(_chunked(bucket, "path", "n", CHUNK)).distinct(), f"forest{level}"))
        if last or not sizes.where(F.col("n") > SMALL).limit(1).count():
            break
        entries = _paths(entries.join(sizes.where(F.col("n") > SMALL), "path").join(reps.select("node", "sig"), "node"), level + 1)
    edges = forests[0]
    for f in forests[1:]:
        edges = edges.unionByName(f)
    candidate = written(spark, components(edges, "candidates"), "groups")
    sizes = candidate.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    chosen = written(spark, candidate.join(sizes, "comp").join(reps.select("node", "key"), "node"), "chosen")
    # The text of one row per candidate node; rows with equal keys are equal.
    maybe, bitmap = _maybe_in(chosen)
    texts = (base.where(maybe).join(chosen, "key").dropDuplicates(["key"])
             .select("comp", "n", "node", "text"))
    found = written(spark, _verified(_chunked(texts, "comp", "n", CHUNK)), "verified")
    if bitmap is not None:
        bitmap.unpersist()
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(found.where("b IS NOT NULL").select("a", "b"), "links")
    ids = rows.groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    known = ids.join(classes, "node", "left").join(links, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lows = known.groupBy("comp").agg(F.min("low").alias("class_id"))
    facts = known.join(lows, "comp").select("node", "comp", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                                            (F.col("copies") - 1).alias("n_copies"))
    return rows.select("doc_id", "key", "node").join(facts, "node").select("doc_id", "key", "comp", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per near-duplicate class: the smallest doc_id (nulls last), then the smallest row hash."""
    spark = docs.sparkSession
    classes = similar_classes(docs.select("doc_id", "text"))
    best = classes.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m")).select(F.col("m.key").alias("_key"))
    best = written(spark, best, "kept")
    key = F.xxhash64(F.lit("row"), F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key")).join(best, "_key")
    # Rows that are equal in id and text share a key: one of them stays.
    return (rows.withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy("_key")))
            .where("_n = 1").select("_row.*"))
