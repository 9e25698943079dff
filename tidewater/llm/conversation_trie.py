"""Prefix trie of conversations, built by truncation peeling.

A conversation is the sequence of its turns; a node at depth d is a distinct
sequence of first d turns. The trie is peeled from its deepest level: the
conversations that end at depth d and the nodes that survived from depth d + 1,
with their last turn stripped, are regrouped by what is left of them; each
group is a node, found and summed up in the same step, and survives to the next
level. Turns travel as digests, never as text; a prefix is named by the chained
digest of its turns.

A level is one aggregation with map-side combine, so neither a first turn that
most conversations share nor the root gathers its rows in one task. Where few
sequences are as deep as that, several levels are peeled at once: rows are
grouped by their prefix above the band of levels and each group is peeled
inside its task. A band holds at most ``BAND_ROWS`` (sequence, level) pairs in
all, so no group is larger; the number of Spark steps follows the rows, not the
length of the longest conversation.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BAND_ROWS = 20_000              # (sequence, level) pairs of a band of more than one level
EMPTY = hashlib.sha256(b"").hexdigest()

CONTRIBUTION = ("depth int, key binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
                "ends string, keys array<binary>, sizes array<long>")
KIND = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, KIND[k]) for n, k in (x.split() for x in schema.split(", "))])


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its turns in order, as (digest of role and text, code points of the text).

    Turns are ordered by ``turn`` (null first), equal ones by role and digest.
    Null role or text counts as empty. Rows without a conv_id belong to no
    conversation.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    name = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turn = F.struct("turn", role.alias("role"), name.alias("digest"), F.length(text).cast("long").alias("size"))
    return (conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")))


def rebuilt(seqs: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Sequences whose first h turns are those of the first conversation of their block of ids; h = crc32(decimal id) % most.

    The head is all of that conversation if it has fewer turns, and empty if
    there is none; a conversation's own turns after its first h follow.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    heads = seqs.where(c % block == 0).select(c.alias("_first"), F.slice("turns", 1, most - 1).alias("_head"))
    joined = seqs.withColumn("_first", c - c % block).join(heads, "_first", "left")
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_head", F.lit(1), h))
    return joined.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _chain(batches):
    """Sequences -> (conv_id, depth, key, keys, sizes): the name of every prefix, and of the whole."""
    schema = _arrow("conv_id long, depth int, key binary, keys array<binary>, sizes array<long>")
    for batch in batches:
        out = []
        for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
            at, keys = b"", []
            for t in turns:
                at = hashlib.md5(at + t["digest"]).digest()
                keys.append(at)
            out.append((conv, len(turns), at, keys, [t["size"] for t in turns]))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)


def _ends(batches):
    """Rows sorted by (key, conv_id) -> one contribution per key; the digest of the ids streams, so memory is constant."""
    schema, open_, done = _arrow(CONTRIBUTION), None, []

    def close():
        row, n, ids = open_
        done.append((row["depth"], row["key"], row["conv_id"], n, 0, 0, 0, ids.hexdigest(), row["keys"], row["sizes"]))

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], f.type) for i, f in enumerate(schema)], schema=schema)
        done.clear()
        return batch

    for batch in batches:
        for row in batch.to_pylist():
            if open_ is not None and open_[0]["key"] == row["key"]:
                open_[1] += 1
                open_[2].update(b",%d" % row["conv_id"])
                continue
            if open_ is not None:
                close()
            open_ = [row, 1, hashlib.sha256(b"%d" % row["conv_id"])]
        if done:
            yield flush()
    if open_ is not None:
        close()
        yield flush()


def _peel(lo: int, hi: int):
    """Contributions below one prefix of depth ``lo`` -> their nodes of depths lo + 1 to hi, each truncated from the one below."""
    names = [x.split()[0] for x in CONTRIBUTION.split(", ")]
    schema = _arrow(CONTRIBUTION)

    def run(table: pa.Table) -> pa.Table:
        at: dict[int, list] = {}
        for r in table.select(names).to_pylist():
            at.setdefault(r["depth"], []).append(r)
        done = []
        for d in range(hi, lo, -1):
            nodes: dict[bytes, dict] = {}
            for r in at.pop(d, ()):
                x = nodes.setdefault(r["key"], r)
                if x is not r:
                    for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                        x[c] += r[c]
                    x["conv_id"] = min(x["conv_id"], r["conv_id"])
                    x["ends"] = x["ends"] or r["ends"]
            for x in nodes.values():
                x["n_leaves"] = x["n_leaves"] if x["n_children"] else 1
                x["saved_tokens"] += (x["n_convs"] - 1) * x["sizes"][d - 1]
                x["ends"] = x["ends"] or EMPTY
                done.append(x)
                if d - 1 > lo:
                    at.setdefault(d - 1, []).append({**x, "depth": d - 1, "key": x["keys"][d - 2], "n_children": 1, "ends": None})
        # A node's own names end with itself; the level above needs them only of the top of the band.
        cut = lambda r, c: r[c][:r["depth"]] if r["depth"] == lo + 1 else r[c][max(r["depth"] - 2, 0):r["depth"]]
        return pa.table([pa.array([cut(r, n) if n in ("keys", "sizes") else r[n] for r in done], f.type) for n, f in zip(names, schema)], schema=schema)
    return run


def _above(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes of ``depth`` with their last turn stripped: contributions to the level above."""
    key = F.element_at("keys", depth - 1) if depth > 1 else F.lit(b"")
    return nodes.select(F.lit(depth - 1).alias("depth"), key.alias("key"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
                        "saved_tokens", F.lit(None).cast("string").alias("ends"), "keys", "sizes")


def _level(parts: DataFrame, depth: int) -> DataFrame:
    """All contributions to one level -> its nodes."""
    size = F.coalesce(F.try_element_at("sizes", F.lit(depth)), F.lit(0)) if depth else F.lit(0)
    return (parts.groupBy("key").agg(
                F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
                F.max("ends").alias("ends"), F.first("keys").alias("keys"), F.first("sizes").alias("sizes"))
            .select(F.lit(depth).alias("depth"), "key", "conv_id", "n_convs", "n_children",
                    F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1).cast("long").alias("n_leaves"),
                    (F.col("saved_tokens") + (F.col("n_convs") - 1) * size).alias("saved_tokens"),
                    F.coalesce("ends", F.lit(EMPTY)).alias("ends"),
                    F.slice("keys", 1, max(depth, 1)).alias("keys"), F.slice("sizes", 1, max(depth, 1)).alias("sizes")))


def bands(lengths: dict[int, int], limit: int) -> list[tuple[int, int]]:
    """(lo, hi] bands from the deepest level to 1, given how many sequences have each length.

    A band of several levels has at most ``limit`` (sequence, level) pairs.
    """
    alive, out, d = 0, [], max(lengths, default=0)
    while d > 0:
        hi, rows = d, 0
        while d > 0:
            now = alive + lengths.get(d, 0)
            if d < hi and rows + now > limit:
                break
            alive, rows, d = now, rows + now, d - 1
        out.append((d, hi))
    return out


def prefix_trie(seqs: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """The trie's nodes, from (conv_id, turns) as :func:`sequences` gives them.

    Returns per node conv_id (smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves (itself if it has no children),
    saved_tokens (over its subtree, (n_convs - 1) times the code points of each
    node's last text) and ends_sha256 (of the ids of the conversations that end
    at it, ascending, comma-joined). Equal conversations share all nodes; one
    without turns belongs to the root alone; no conversations give no rows. A
    conversation's digests, 24 bytes a turn, travel in one row.
    """
    spark = seqs.sparkSession
    whole = seqs.mapInArrow(_chain, "conv_id long, depth int, key binary, keys array<binary>, sizes array<long>")
    # Equal conversations merge; their ids stream through one task, eight bytes each beside the names.
    ended = written(spark, whole.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_ends, CONTRIBUTION), "trie-ends")
    lengths = {r["depth"]: r["n"] for r in ended.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}      # a row per length
    levels, up = [], None
    for lo, hi in bands(lengths, band_rows):
        parts = ended.where(F.col("depth").between(lo + 1, hi))
        parts = parts if up is None else parts.unionByName(up)
        if hi - lo == 1:
            nodes = _level(parts, hi)
        else:
            above = F.element_at("keys", lo) if lo else F.lit(b"")
            nodes = parts.groupBy(above.alias("_above")).applyInArrow(_peel(lo, hi), CONTRIBUTION)
        nodes = written(spark, nodes, "trie-level")
        levels.append(nodes)
        up = _above(nodes.where(F.col("depth") == lo + 1), lo + 1)
    parts = ended.where("depth = 0")
    levels.append(written(spark, _level(parts if up is None else parts.unionByName(up), 0), "trie-level"))
    own = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    above = F.when(F.col("depth") > 1, F.element_at("keys", -2)).when(F.col("depth") == 1, F.lit(b""))
    every = None
    for x in levels:
        x = x.select("key", above.alias("above"), *own)
        every = x if every is None else every.unionByName(x)
    parents = every.where("n_children > 0").select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return every.join(parents, "above", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
