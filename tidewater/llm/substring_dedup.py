"""Substring dedup: word windows that also occur in a document with a smaller id are cut out.

Words are runs of bytes other than ASCII white space, unchanged. Every window
of ``WINDOW`` consecutive words of a document gets a Rabin-Karp hash: a
polynomial over its 64-bit word hashes modulo 2**64, rolled along the document
by prefix sums. Spark counts the windows over the whole corpus; overlapping
repeated windows merge into maximal removal intervals.

How it runs:

1. *Blocks.* Each scan task packs its documents into blocks of ``BLOCK_BYTES``
   of text (one document at least), written once as compressed Arrow streams.
2. *Windows.* Per block the hashes are sorted and each distinct hash keeps the
   smallest id that has it, so a passage in a third of all documents costs one
   entry per block, not one per document. Entries are dealt into buckets by
   their highest bits.
3. *Counting.* A bucket compares the entries of all blocks and returns one bit
   per entry: whether another block holds the window with a smaller id.
4. *Removal.* A block meets its bits, hashes its windows again, adds what
   repeats inside the block, and merges the windows into intervals.

Nothing depends on the number of documents that share a window but the count
of blocks. A bucket holds the windows of about ``BUCKET_BYTES`` of text. With
both sizes as below a (block, bucket) cell has about 5e12 / corpus bytes
entries; beyond some 50 GB of text raise both sizes with the square root of
the corpus, so that cells stay worth their row.

Two windows count as equal when ``64 + 8 * CHECK_BYTES`` hash bits agree: with
72 bits and 8e9 windows (30 GB of Parquet) 0.007 false matches are expected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from ..sources.tables import materialize
from .common import small_batches
from .words import Scanner, mix, pieces

WINDOW = 50                     # words of a window
BLOCK_BYTES = 4 << 20           # of text per block (one document at least): a worker holds about 40 times as much while it hashes one
BUCKET_BYTES = 8 << 20          # of text whose windows meet in one bucket, on average
CHECK_BYTES = 1                 # of a second hash, beside 64 bits of the first
ADDED = ("n_words", "n_removed", "spans", "kept")
CELL = "_bucket int, _block long, n long, first long, base long, keys binary, check binary, low binary"


def word_table() -> np.ndarray:
    """Byte table for :class:`Scanner`: white space (0x20, 0x09-0x0D) is 0, everything else counts as it is."""
    t = np.arange(256, dtype=np.uint8)
    t[[0x20, *range(0x09, 0x0E)]] = 0
    t[0] = 0x20                 # a NUL is part of a word; 0x20 is free, since no word holds a space
    return t


class Windows:
    """Distinct window hashes of a block, sorted, with the smallest id of each; and where every window is."""

    __slots__ = ("keys", "check", "low", "entry", "start", "id")


def _hash_windows(scanner: Scanner, words, width: int):
    """(document row of the piece, first word, hash, second hash) of every window of a piece."""
    first = words.first
    counts = np.diff(first)
    valid = np.maximum(counts - width + 1, 0)
    rows = np.repeat(np.arange(len(counts)), valid)
    if not len(rows):
        z = np.zeros(0, np.uint64)
        return rows, np.zeros(0, np.int64), z, z
    at = np.repeat(first[:-1] - (np.cumsum(valid) - valid), valid) + np.arange(len(rows))
    n, out = len(words.hash), []
    with np.errstate(over="ignore"):
        for salt in (np.uint64(0), np.uint64(0xD6E8FEB86659FD93)):
            p = np.zeros(n + 1, np.uint64)
            np.cumsum(mix(words.hash ^ salt) * scanner.power[:n], out=p[1:])
            out.append(mix((p[at + width] - p[at]) * scanner.inverse[at]))
    return rows, at, out[0], out[1]


def _block_windows(scanner: Scanner, texts, ids, width: int) -> tuple[Windows, list]:
    """The windows of a block's documents and its pieces (first row, offsets, bytes, words), in row order.

    A row without an id (null) has no windows: no id is smaller or larger.
    """
    known = np.asarray(ids.is_valid())
    ids = np.asarray(ids.fill_null(0).cast(pa.int64()))
    parts, rows, starts, keys, checks = [], [], [], [], []
    base = 0
    for lo, hi, offsets, data in pieces(texts):
        words = scanner.scan(offsets, data)
        r, at, h, c = _hash_windows(scanner, words, width)
        ok = known[lo + r]
        words.hash = None           # no longer needed
        parts.append((lo, offsets, data, words))
        rows.append(lo + r[ok]); starts.append(base + at[ok]); keys.append(h[ok]); checks.append(c[ok])
        base += len(words.start)
    w = Windows()
    rows, w.start, keys, check = (np.concatenate(x) if x else np.zeros(0, t) for x, t in (
        (rows, np.int64), (starts, np.int64), (keys, np.uint64), (checks, np.uint64)))
    check &= np.uint64((1 << (8 * CHECK_BYTES)) - 1)
    w.id = ids[rows]
    order = np.lexsort((check, keys))
    k, c = keys[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    heads = np.flatnonzero(new)
    w.keys, w.check = k[heads], c[heads]
    w.low = np.minimum.reduceat(w.id[order], heads) if len(heads) else np.zeros(0, np.int64)
    w.entry = np.empty(len(k), np.int64)
    w.entry[order] = np.cumsum(new) - 1
    return w, parts


def _cells(keys: np.ndarray, buckets: int) -> np.ndarray:
    """First entry of each bucket among sorted keys, and the end: buckets are equal ranges of the key."""
    step = -(-(1 << 64) // buckets)
    edges = np.array([b * step for b in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _planes(x: np.ndarray, n: int = 8) -> bytes:
    """The ``n`` low bytes of uint64 numbers, plane by plane: planes of zeros cost nothing once compressed."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _unplanes(raw: bytes, count: int, n: int = 8) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    if raw:
        out[:, :n] = np.frombuffer(raw, np.uint8).reshape(n, count).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


# ---- the four steps -------------------------------------------------------------

def _pack(text: str):
    """Rows of the table -> blocks of whole rows as one compressed Arrow stream each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
                w.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_pydict({"_block": pa.array([number], pa.int64()), "_bytes": pa.array([size], pa.int64()),
                                               "_rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        for batch in batches:
            lengths = np.cumsum(np.asarray(pc.binary_length(batch.column(text)).fill_null(0).cast(pa.int64())))
            lo = 0
            while lo < batch.num_rows:
                done = lengths[lo - 1] if lo else 0
                hi = max(int(np.searchsorted(lengths, done + BLOCK_BYTES - size, side="right")), lo if held else lo + 1)
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                    size += int(lengths[hi - 1] - done)
                if hi < batch.num_rows:
                    yield block()
                    number, held, size = number + 1, [], 0
                lo = hi
        if held:
            yield block()
    return run


def _rows(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all().combine_chunks()


def _deal(key: str, text: str, width: int, buckets: int):
    """Blocks -> (block, bucket) cells of distinct windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(word_table())
        for batch in batches:
            for block, raw in zip(batch.column("_block"), batch.column("_rows")):
                rows = _rows(raw.as_py())
                w, _ = _block_windows(scanner, rows[text], rows[key].combine_chunks(), width)
                base = int(w.low.min()) if len(w.low) else 0
                cut = _cells(w.keys, buckets)
                out = {"_bucket": [], "_block": [], "n": [], "first": [], "base": [], "keys": [], "check": [], "low": []}
                for b in np.flatnonzero(np.diff(cut)):
                    lo, hi = cut[b], cut[b + 1]
                    out["_bucket"].append(int(b)); out["_block"].append(block.as_py()); out["n"].append(int(hi - lo))
                    out["first"].append(int(w.keys[lo].view(np.int64))); out["base"].append(base)
                    out["keys"].append(_planes(np.diff(w.keys[lo:hi])))
                    out["check"].append(_planes(w.check[lo:hi], CHECK_BYTES))
                    out["low"].append(_planes((w.low[lo:hi] - base).astype(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), (pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 3))], list(out))
    return run


def _compare(cells: pa.Table) -> pa.Table:
    """All cells of a bucket -> per cell, a bit per entry: a smaller id has the window in another block."""
    keys, checks, lows, counts = [], [], [], []
    for c in cells.to_pylist():
        first = np.array([c["first"]], np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            keys.append(np.cumsum(np.concatenate([first, _unplanes(c["keys"], c["n"] - 1)]), dtype=np.uint64))
        checks.append(_unplanes(c["check"], c["n"], CHECK_BYTES))
        lows.append(_unplanes(c["low"], c["n"]).astype(np.int64) + c["base"])
        counts.append(c["n"])
    keys, checks, lows = np.concatenate(keys), np.concatenate(checks), np.concatenate(lows)
    order = np.lexsort((checks, keys))
    k, c = keys[order], checks[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    least = np.minimum.reduceat(lows[order], np.flatnonzero(new))
    hit = np.empty(len(k), bool)
    hit[order] = lows[order] > least[np.cumsum(new) - 1]
    at, blocks, bits = 0, [], []
    for n, block in zip(counts, cells["_block"].to_pylist()):
        if hit[at:at + n].any():
            blocks.append(block)
            bits.append(np.packbits(hit[at:at + n]).tobytes())
        at += n
    bucket = cells["_bucket"][0].as_py()
    return pa.table({"_block": pa.array(blocks, pa.int64()), "_bucket": pa.array([bucket] * len(blocks), pa.int32()), "bits": pa.array(bits, pa.binary())})


def _kept_text(parts: list, gone: np.ndarray, n_rows: int) -> pa.Array:
    """Per document its kept words joined by one space; ``gone`` marks removed words in the block's word order."""
    out, sizes, base = [], np.zeros(n_rows, np.int64), 0
    for lo, offsets, data, words in parts:
        kept = np.flatnonzero(~gone[base:base + len(words.start)])
        base += len(words.start)
        doc = np.searchsorted(words.first, kept, side="right") - 1
        more = np.zeros(len(kept), bool)                # a later word of the document is kept: white space follows this one
        more[:-1] = doc[1:] == doc[:-1]
        start, end = words.start[kept], words.end[kept]
        step = np.zeros(len(data) + 2, np.int8)
        step[start] += 1
        step[end + more] -= 1
        text = data.copy()
        text[end[more]] = 0x20
        out.append(text[np.cumsum(step[:len(data)]) > 0])
        sizes[lo:lo + len(offsets) - 1] = np.bincount(doc, end - start + more, minlength=len(offsets) - 1)
    data = np.concatenate(out) if out else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(np.append(0, np.cumsum(sizes)).tobytes()), pa.py_buffer(data.tobytes()))


def _intervals(gone: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per document (``first`` word each) its maximal runs of removed words, as [start, end) counted in the document."""
    n = len(gone)
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    opens = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone)[:-1]))
    shuts = np.flatnonzero(gone & (edge[1:] | ~np.append(gone, False)[1:])) + 1
    per = np.searchsorted(opens, np.append(first, n)).astype(np.int32)
    start = np.repeat(first, np.diff(per))
    return pa.ListArray.from_arrays(pa.array(per), pa.StructArray.from_arrays([pa.array(opens - start), pa.array(shuts - start)], ["start", "end"]))


def _cut(key: str, text: str, width: int, buckets: int, schema: pa.Schema):
    """A block's rows and its bits -> its documents with their removals."""
    def run(blocks: pa.Table, bits: pa.Table) -> pa.Table:
        scanner, done = Scanner(word_table()), []
        held = [(b.as_py(), np.frombuffer(raw.as_py(), np.uint8)) for b, raw in zip(bits["_bucket"], bits["bits"])]
        for raw in blocks["_rows"]:
            rows = _rows(raw.as_py())
            w, parts = _block_windows(scanner, rows[text], rows[key].combine_chunks(), width)
            cell = _cells(w.keys, buckets)
            elsewhere = np.zeros(len(w.keys), bool)
            for b, packed in held:
                elsewhere[cell[b]:cell[b + 1]] = np.unpackbits(packed, count=int(cell[b + 1] - cell[b]))
            hit = w.start[elsewhere[w.entry] | (w.id > w.low[w.entry])]
            first, n = [], 0                            # of each document, counted in the block
            for _, _, _, words in parts:
                first.append(n + words.first[:-1])
                n += len(words.start)
            first = np.concatenate(first).astype(np.int64)
            step = np.zeros(n + width + 1, np.int32)
            step[hit] += 1
            step[hit + width] -= 1
            gone = np.cumsum(step[:n]) > 0
            end, before = np.append(first[1:], n), np.append(0, np.cumsum(gone))
            done.append(pa.Table.from_arrays(
                [*rows.columns, pa.array(end - first), pa.array(before[end] - before[first]), _intervals(gone, first), _kept_text(parts, gone, rows.num_rows)],
                names=schema.names).cast(schema))
        return pa.concat_tables(done) if done else schema.empty_table()
    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_removed`` (long), ``spans`` (maximal removal intervals in words, end exclusive) and ``kept``.

    ``kept`` is the document without the removed words, joined by one space.
    Windows are judged on the input, not on what is left. ``key`` is an integer
    column: rows of the same id never remove from each other, and a row with a
    null id keeps all its words and removes none. Null and empty texts have no
    words and an empty ``kept``; a text shorter than a window loses nothing;
    texts are read whole at any length. An empty table gives an empty result.
    Columns of ``docs`` named like an added column are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED])
    path = fresh_path(spark, "llm-blocks")
    docs.mapInArrow(_pack(text), "_block long, _bytes long, _rows binary").write.option("compression", "uncompressed").parquet(path)
    blocks = spark.read.parquet(path)
    buckets = max(1, -(-(blocks.agg(F.sum("_bytes")).first()[0] or 0) // BUCKET_BYTES))
    cells = blocks.select("_block", "_rows").mapInArrow(_deal(key, text, width, buckets), CELL)
    bits = materialize(spark, cells.groupBy("_bucket").applyInArrow(_compare, "_block long, _bucket int, bits binary"), "llm-bits")
    schema = T.StructType(docs.schema.fields + T._parse_datatype_string(
        "n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string").fields)
    return (blocks.select("_block", "_rows").groupBy("_block").cogroup(bits.groupBy("_block"))
            .applyInArrow(_cut(key, text, width, buckets, to_arrow_schema(schema)), schema))
