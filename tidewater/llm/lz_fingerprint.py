"""Lempel-Ziv phrase fingerprints.

A text is parsed (LZ78) into dictionary phrases: the shortest stretch that is
not yet in the dictionary becomes the next phrase. Texts that compress well
against each other share many phrases. The phrase set is hashed and kept as a
minimum-hash signature: the hash range is cut into ``BINS`` bins, each keeps 16
bits of its smallest hash. Likeness of two signatures is the share of equal
bins among those filled in either, an estimate of the phrase sets' Jaccard
similarity; equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .words import mix, seeds

BINS = 128                      # a power of two
BUCKET_BYTES = 12 << 20         # text per range of ids in compare_with_next
MAX_BUCKETS = 20_000            # bound on the range cuts that pass through the driver


class Parser:
    """Parses texts and signs phrase sets; keeps the power table between texts."""

    def __init__(self, bins: int = BINS):
        self.bins, self.shift = bins, np.uint64(64 - (bins.bit_length() - 1))
        self.base = int(seeds(1, 3)[0])
        self.power = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        n = max(2 * n, 1 << 16)
        self.power = np.cumprod(np.full(n, self.base, np.uint64), dtype=np.uint64)
        self.inverse = np.cumprod(np.full(n, pow(self.base, -1, 1 << 64), np.uint64), dtype=np.uint64)

    @staticmethod
    def phrases(text: str, known: dict, open_: str = "") -> str:
        """Go on parsing; adds phrases to ``known`` in text order, returns the unfinished one."""
        w = open_
        for c in text:
            w += c
            if w not in known:
                known[w] = None
                w = ""
        return w

    def sign(self, text: str, known: dict) -> np.ndarray:
        """Signature (uint16 per bin, 0: empty bin) of the phrases, which lie one after the other in ``text``."""
        sig = np.zeros(self.bins, np.uint16)
        if not known:
            return sig
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if len(code) >= len(self.power):
            self._grow(len(code))
        size = np.fromiter(map(len, known), np.int64, len(known))
        stop = np.cumsum(size)
        start = stop - size
        run = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code + np.uint64(1)) * self.power[:len(code)], out=run[1:])
        h = np.sort(mix((run[stop] - run[start]) * self.inverse[start] + size.astype(np.uint64)))
        which = h >> self.shift
        first = np.concatenate([[True], which[1:] != which[:-1]])
        low = (h[first] << np.uint64(64 - int(self.shift))) >> np.uint64(48)
        sig[which[first].astype(np.int64)] = np.maximum(low, np.uint64(1)).astype(np.uint16)
        return sig

    def signature(self, text: str) -> np.ndarray:
        known: dict = {}
        self.phrases(text, known)
        return self.sign(text, known)

    def both(self, text: str, other: str) -> tuple[np.ndarray, str, np.ndarray]:
        """Signature of ``text``; ``text`` with its second half replaced from ``other``; that text's signature.

        The texts share their first half, which is parsed once.
        """
        half = len(text) // 2
        head, tail = text[:len(text) - half], other[:half]
        known: dict = {}
        open_ = self.phrases(head, known)
        known2 = dict(known)
        self.phrases(text[len(head):], known, open_)
        self.phrases(tail, known2, open_)
        edited = head + tail
        return self.sign(text, known), edited, self.sign(edited, known2)


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those filled in either; two empty signatures are alike."""
    filled = (a != 0) | (b != 0)
    n = int(filled.sum())
    return float(((a == b) & filled).sum() / n) if n else 1.0


def lz_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``fingerprint`` (hex). Null text counts as empty; empty texts share the empty fingerprint."""
    @F.pandas_udf("string")
    def fingerprint(texts: pd.Series) -> pd.Series:
        parser = Parser()
        return pd.Series([as_text(parser.signature(t)) for t in texts])

    small_batches(docs.sparkSession)
    return docs.withColumn("fingerprint", fingerprint(F.coalesce(F.col(text), F.lit(""))))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and likeness to that text and to the next document.

    From (doc_id, text). The next document is the one with the next smaller
    doc_id (null ids last, ties by text hash), after the last the first. Ids
    are cut into ranges of about equal counts; a task streams one sorted range,
    and the first row of the range below it travels along as a guest, so texts
    move once. A single document is its own next; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    small_batches(spark, 200)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = base.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    want = int(min(MAX_BUCKETS, total // BUCKET_BYTES + 1))
    cuts = sorted(set(base.agg(F.percentile_approx("doc_id", [i / want for i in range(1, want)] or [0.5],
                                                   max(10_000, 20 * want)).alias("q")).first()["q"] or []))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        """0 for null ids, then upwards by id."""
        known = ids.notna()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(cuts, ids[known].astype("int64"), side="left") + 1
        return pd.Series(out)

    keyed = base.select("*", range_of("doc_id").alias("bucket"), F.xxhash64("text").alias("tie"))
    # One row per range: at most MAX_BUCKETS + 2.
    first = sorted((r["bucket"], r["m"]["doc_id"], r["m"]["tie"]) for r in keyed.groupBy("bucket").agg(
        F.max(F.struct("doc_id", "tie")).alias("m")).collect())
    places = [r[0] for r in first]
    goes = [(b, i, t, places[(k + 1) % len(places)]) for k, (b, i, t) in enumerate(first)]
    head = spark.createDataFrame(goes, "_b int, _i long, _t long, _to int")
    guests = (keyed.join(F.broadcast(head), F.expr("bucket = _b AND doc_id <=> _i AND tie = _t"))
              .dropDuplicates(["_to"]).select("doc_id", "text", F.col("_to").alias("bucket"), "tie", F.lit(1).alias("guest")))
    rows = (keyed.withColumn("guest", F.lit(0)).unionByName(guests)
            .repartitionById(len(cuts) + 2, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
            .select("doc_id", "text", "bucket", "guest"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def work(batches):
        parser = Parser()
        last, done = None, []       # last: (bucket, id, text) that waits for its next document

        for batch in batches:
            for i, text, bucket, guest in zip(*(c.to_pylist() for c in batch.columns)):
                if last is not None and last[0] == bucket:
                    own, edited, sig = parser.both(last[2], text)
                    done.append([last[1], len(last[2]), hashlib.sha256(edited.encode()).hexdigest(), own, sig, likeness(own, sig), text if guest else None])
                    if len(done) > 1:
                        prior = done[-2]
                        if prior[6] is None:
                            prior[6] = own
                last = None if guest else (bucket, i, text)
                if guest and done:
                    done[-1][6] = parser.signature(text)
                    yield finish(done)
                    done = []
            if len(done) > 1:
                yield finish(done[:-1])
                done = done[-1:]

    def finish(done):
        cols = zip(*((r[0], r[1], r[2], as_text(r[3]), as_text(r[4]), r[5], likeness(r[3], r[6])) for r in done))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return rows.mapInArrow(work, schema)
