"""Benchmark decontamination by an FM-index over each training shard.

A shard is a run of documents of about ``SHARD_BYTES`` bytes inside one task.
Its words become integers: 1..V for words of the benchmark, 0 for a run of
other words or the end of a document (no test phrase contains either, so
nothing is lost). Over that sequence the shard gets

* a suffix array (prefix doubling, only unresolved groups are sorted again),
* the Burrows-Wheeler transform in a wavelet matrix with rank counts,
* every ``SAMPLE``-th text position kept for locating.

All distinct test phrases are searched backwards at once, one rank step per
word; phrases whose interval runs empty drop out. Occurrences are located by
walking to a sampled position, and their word spans merge by a running sum.
Document texts never leave their task. The benchmark is the only broadcast
data; it is dealt in parts of at most ``PART_BYTES`` bytes, one pass each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share, shared, small_batches
from .words import Scanner, alnum_table, pieces

WINDOW = 10                     # words; an item of fewer words is one phrase
SHARD_BYTES = 2 << 20
SAMPLE = 8
PART_BYTES = 32 << 20           # item text searched per pass


class Phrases:
    """Distinct windows of the benchmark items, as word hashes, with the items each belongs to."""

    def __init__(self, items: list, texts: list, window: int = WINDOW):
        scanner = Scanner(alnum_table())
        rows, owners = {}, []
        column = pa.array(texts, pa.large_string())
        for lo, hi, offsets, data in pieces(column):
            w = scanner.scan(offsets, data)
            for d in range(lo, hi):
                h = w.hash[w.first[d - lo]:w.first[d - lo + 1]]
                for k in range(max(len(h) - window, 0) + 1 if len(h) else 0):
                    key = h[k:k + window].tobytes()
                    if key not in rows:
                        rows[key] = len(rows)
                        owners.append(set())
                    owners[rows[key]].add(str(items[d]))
        hashes = [np.frombuffer(k, np.uint64) for k in rows]
        self.owners = [sorted(o) for o in owners]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        self.length = np.array([len(h) for h in hashes], np.int64)
        self.ids = np.zeros((len(hashes), window), np.int64)        # right-aligned, 0 before the first word
        for i, h in enumerate(hashes):
            self.ids[i, window - len(h):] = np.searchsorted(self.vocabulary, h) + 1

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """1..V for words of the benchmark, else 0."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        # Most words are told apart by the low bits alone; the rest are looked up.
        if not hasattr(self, "_maybe"):
            self._maybe = np.zeros(1 << 20, bool)
            self._maybe[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        out = np.zeros(len(hashes), np.int64)
        can = np.flatnonzero(self._maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[can])
        at[at == len(self.vocabulary)] = 0
        same = self.vocabulary[at] == hashes[can]
        out[can[same]] = at[same] + 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order; a suffix that is a prefix of another comes first."""
    n = len(text)
    bits = max(1, int(text.max(initial=0) + 1).bit_length())
    h = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text + 1, np.zeros(h, np.int64)])
    for k in range(h):
        key = (key << bits) | padded[k:k + n]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    rank = np.empty(n + 1, np.int64)            # of a suffix: place of its group's first; the empty suffix is lowest
    rank[n] = -1

    def number(places, new_group):
        """Ranks of the suffixes at ``places`` (ascending) of sa, given where groups start."""
        start = places[np.maximum.accumulate(np.where(new_group, np.arange(len(places)), 0))]
        rank[sa[places]] = start
        size = np.diff(np.append(np.flatnonzero(new_group), len(places)))
        return places[np.repeat(size > 1, size)]

    open_ = number(np.arange(n), np.append(True, ordered[1:] != ordered[:-1])) if n else np.zeros(0, np.int64)
    while len(open_):
        s = sa[open_]
        own, then = rank[s], rank[np.minimum(s + h, n)]
        order = np.lexsort((then, own))
        s, own, then = s[order], own[order], then[order]
        sa[open_] = s
        open_ = number(open_, np.append(True, (own[1:] != own[:-1]) | (then[1:] != then[:-1])))
        h *= 2
    return sa


class WaveletMatrix:
    """Rank of any symbol in any prefix, one bit of the symbol per level."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        lo = np.zeros_like(at)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            one_lo, one_at = ones[lo], ones[at]
            lo = np.where(bit, zeros + one_lo, lo - one_lo)
            at = np.where(bit, zeros + one_at, at - one_at)
        return at - lo


class FMIndex:
    """Backward search and location over one shard's symbols."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        # A closing symbol below all others makes every rotation a suffix.
        text = np.append(text + 1, 0)
        self.text_len = len(text)
        sa = suffix_array(text)
        bwt = text[sa - 1]                      # sa 0 wraps to the closing symbol
        bits = max(1, int(text.max()).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=(1 << bits)))])
        self.tree = WaveletMatrix(bwt, bits)
        self.bwt = bwt
        marked = sa % sample == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.marked, self.samples = marked, sa[marked]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase numbers, first, end of suffix interval) of the right-aligned phrases that occur."""
        live = np.arange(len(phrases))
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.text_len, np.int64)
        top = len(self.before) - 2
        for step in range(phrases.shape[1]):
            todo = length[live] > step
            c = phrases[live, -1 - step] + 1
            ok = todo & (c <= top)
            c = np.where(ok, c, 0)
            both = self.tree.rank(np.concatenate([c, c]), np.concatenate([lo, hi]))
            new_lo, new_hi = self.before[c] + both[:len(c)], self.before[c] + both[len(c):]
            lo, hi = np.where(todo, np.where(ok, new_lo, 0), lo), np.where(todo, np.where(ok, new_hi, 0), hi)
            keep = hi > lo
            live, lo, hi = live[keep], lo[keep], hi[keep]
            if not len(live):
                break
        return live, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step back until a sampled one."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_, rows = np.arange(len(rows)), rows.copy()
        while len(open_):
            hit = self.marked[rows]
            out[open_[hit]] = self.samples[self.marks[rows[hit]]] + steps[open_[hit]]
            open_, rows = open_[~hit], rows[~hit]
            c = self.bwt[rows]
            rows = self.before[c] + self.tree.rank(c, rows)
            steps[open_] += 1
        return out


def shard_hits(phrases: Phrases, hashes: np.ndarray, first: np.ndarray):
    """(hit flag per word, [(document, phrase)]) for the words of a shard; ``first``: word ranges of documents."""
    hit = np.zeros(len(hashes) + 1, np.int64)
    code = phrases.encode(hashes)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    edge = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, bool)
    known = code > 0
    # One 0 stands for each gap: before a known word that starts a document or follows an unknown word.
    gap = known & (edge | ~np.append(False, known[:-1])) if len(known) else known
    at = np.flatnonzero(known)
    if not len(at) or not len(phrases.length):
        return hit[:-1] > 0, np.zeros((0, 2), np.int64)
    place = np.arange(len(at)) + np.cumsum(gap[at])
    text = np.zeros(place[-1] + 1, np.int64)
    text[place] = code[at]
    word = np.full(len(text), -1, np.int64)
    word[place] = at
    index = FMIndex(text)
    live, lo, hi = index.search(phrases.ids, phrases.length)
    count = hi - lo
    which = np.repeat(live, count)
    rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
    start = word[index.locate(rows)]
    np.add.at(hit, start, 1)
    np.add.at(hit, start + phrases.length[which], -1)
    pairs = np.unique(np.stack([doc[start], which], 1), axis=0) if len(start) else np.zeros((0, 2), np.int64)
    return np.cumsum(hit[:-1]) > 0, pairs


def _parts(benchmark: DataFrame):
    """The benchmark in parts of bounded size, read part by part; whole if it fits one."""
    items = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = int(total // PART_BYTES + 1)
    for k in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` plus n_words (long), spans (array of byte first/end to remove) and items (array of item ids as strings).

    Words are runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters. A
    phrase is ``window`` consecutive words of an item, or the whole item if it
    has fewer but some. Every word inside an occurrence is hit; neighbouring
    hit words make one span. Null texts have no words; equal rows get equal
    results; an empty table or benchmark gives no hits. Columns of ``docs``
    named like an added column are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_words", "n_hit", "spans", "items")
    result = None
    for part in _parts(benchmark):
        phrases = share(spark, Phrases([r["item_id"] for r in part], [r["text"] for r in part], window))
        result = _one_pass(docs if result is None else result, phrases, result is not None)
    return result


def _one_pass(docs: DataFrame, phrases, again: bool) -> DataFrame:
    """One search over all texts; ``again``: docs already have spans and items, which are merged with the new."""
    from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    span = StructType([StructField("first", LongType()), StructField("end", LongType())])
    schema = docs.schema if again else StructType(docs.schema.fields + [
        StructField("n_words", LongType()), StructField("n_hit", LongType()),
        StructField("spans", ArrayType(span)), StructField("items", ArrayType(StringType()))])
    arrow = to_arrow_schema(schema)
    at = docs.columns.index("text")

    def work(batches):
        scanner, p = Scanner(alnum_table()), shared(phrases)
        for batch in batches:
            texts = batch.column(at)
            n_words, n_hit, spans, items = [], [], [], []
            for lo, hi, offsets, data in pieces(texts, SHARD_BYTES):
                w = scanner.scan(offsets, data)
                hit, pairs = shard_hits(p, w.hash, w.first)
                found = {}
                for d, k in pairs.tolist():
                    found.setdefault(d, set()).update(p.owners[k])
                for d in range(hi - lo):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    own = hit[a:b]
                    old = set(batch.column("items")[lo + d].as_py()) if again else set()
                    byte = []
                    if d in found:
                        if again:
                            for x in batch.column("spans")[lo + d].as_py():
                                own |= (w.start[a:b] - offsets[d] >= x["first"]) & (w.end[a:b] - offsets[d] <= x["end"])
                        turn = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                        byte = [{"first": int(w.start[a + i] - offsets[d]), "end": int(w.end[a + j - 1] - offsets[d])}
                                for i, j in zip(turn[::2], turn[1::2])]
                        n_hit.append(int(own.sum()))
                    elif again:
                        byte = batch.column("spans")[lo + d].as_py()
                        n_hit.append(batch.column("n_hit")[lo + d].as_py())
                    else:
                        n_hit.append(0)
                    n_words.append(b - a)
                    spans.append(byte)
                    items.append(sorted(found.get(d, set()) | old))
            columns = batch.columns[:-4] if again else batch.columns
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow)]
                + [pa.array(v, arrow.field(n).type) for n, v in
                   (("n_words", n_words), ("n_hit", n_hit), ("spans", spans), ("items", items))], schema=arrow)

    return docs.mapInArrow(work, schema)


def remove_spans(marked: DataFrame) -> DataFrame:
    """Texts of ``contamination`` without their spans (a line feed stays in their place); helper columns go.

    ``n_chars``, where there is one, follows the new text. Documents of which no word is left go.
    """
    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for t, s in zip(texts, spans):
            if t is None or not len(s):
                out.append(t)
                continue
            raw, at, keep = t.encode(), 0, []
            for x in s:
                keep.append(raw[at:x["first"]])
                at = x["end"]
            out.append(b"\n".join([*keep, raw[at:]]).decode())
        return pd.Series(out)

    has = F.size("spans") > 0
    left = marked.where(~has | (F.col("n_hit") < F.col("n_words")))
    text = F.when(has, cut("text", "spans")).otherwise(F.col("text"))
    cols = [c for c in marked.columns if c not in ("n_words", "n_hit", "spans", "items")]
    out = left.select(*[text.alias(c) if c == "text" else F.when(has, F.length(text)).otherwise(F.col(c)).cast(marked.schema[c].dataType).alias(c)
                        if c == "n_chars" else F.col(c) for c in cols])
    return out
