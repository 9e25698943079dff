"""Language-model scores: a log-bilinear neural model over word classes, with exact corpus counts below it.

Tokens are words between white space (A-Z lower-cased) plus one end per
document. Counts of every training token are summed over the whole corpus.
The ``SHORTLIST`` most frequent tokens are classes of their own, every other
word belongs to one of ``SHAPES`` classes by its last two bytes. The neural
part predicts the class of a token from the classes of the ``CONTEXT`` tokens
before it: the context's vectors, each scaled by a vector of its position, add
up to a predicted vector, whose products with the class vectors plus a bias are
the scores. It is trained by noise-contrastive estimation in numpy on every
training token, ``EPOCHS`` times: the blocks of a pass all start from the same
parameters, which are then averaged by tokens. Scoring normalises over all classes. Within a
shape class a word has its share of the smoothed corpus counts, with one part
for words never seen, so the log-probabilities are normalised over the whole
vocabulary.

Spark: documents are dealt into blocks of bounded text; a block reports each
of its distinct words once, counts are summed by word and go back to the blocks
that use the word, and a block is scored together with its own counts. No
vocabulary is broadcast or collected; only the shortlist, the class totals and
the model (all of fixed size) pass through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import share, shared, small_batches, written
from .words import Scanner, mix, pieces, seeds, space_table

SHORTLIST = 191                 # most frequent tokens with a class of their own (the end is always one)
SHAPES = 64
CLASSES = SHORTLIST + 1 + SHAPES
DIM = 24
CONTEXT = 5
NOISE = 20                      # noise classes that a training token counts against
DRAWS = 80                      # noise classes drawn per batch; each counts NOISE / DRAWS times per token
EPOCHS = 1
CHUNK_TOKENS = 4 << 20          # tokens of a block whose contexts are held at once
FAN_IN = 32                     # blocks' parameters that one task adds up
BATCH = 2048
RATE = 0.1
BLOCK_BYTES = 24 << 20
MAX_PARTITIONS = 50_000
END = np.uint64(0xE0D0E0D0E0D0E0D1)     # stands for the end token; words hash elsewhere


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def shapes(w, data_low: np.ndarray) -> np.ndarray:
    """Class of a word by its last two bytes, 0..SHAPES-1."""
    last = data_low[w.end - 1].astype(np.uint64)
    before = np.where(w.end - w.start > 1, data_low[np.maximum(w.end - 2, 0)], 0).astype(np.uint64)
    return (mix(last * np.uint64(257) + before + np.uint64(11)) % np.uint64(SHAPES)).astype(np.int64)


def _documents(column, scanner):
    """Yield (first row, rows, token hashes, token shapes, first token per row): words of each document, then its end."""
    for lo, hi, offsets, data in pieces(column):
        w = scanner.scan(offsets, data)
        n = hi - lo
        doc = np.repeat(np.arange(n), np.diff(w.first))
        place = np.arange(len(w.hash)) + doc
        hashes = np.full(len(w.hash) + n, END, np.uint64)
        shape = np.full(len(w.hash) + n, -1, np.int64)
        hashes[place] = w.hash
        shape[place] = shapes(w, w.low)
        yield lo, n, hashes, shape, w.first + np.arange(n + 1)


class Classes:
    """Token hashes to classes: shortlist places, then shapes."""

    def __init__(self, shortlist: np.ndarray):
        self.order = np.argsort(shortlist)
        self.sorted = shortlist[self.order]

    def __call__(self, hashes: np.ndarray, shape: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], SHORTLIST + 1 + shape)


def contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[tokens, CONTEXT] classes before each token, nearest first; CLASSES before a document's first token."""
    n = len(classes)
    start = np.repeat(first[:-1], np.diff(first))
    out = np.empty((n, CONTEXT), np.int64)
    for k in range(CONTEXT):
        at = np.arange(n) - (k + 1)
        out[:, k] = np.where(at >= start, classes[np.maximum(at, 0)], CLASSES)
    return out


NAMES = ("r", "c", "q", "b")


class LogBilinear:
    """Context vectors R, position vectors C, class vectors Q and biases b."""

    def __init__(self, prior: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.r = rng.normal(0, 0.1, (CLASSES + 1, DIM)).astype(np.float32)
        self.c = np.full((CONTEXT, DIM), 0.5, np.float32)
        self.q = rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
        self.prior = prior
        self.b = np.log(prior).astype(np.float32)
        self.past = {k: np.full_like(getattr(self, k), 1e-6) for k in NAMES}

    def train(self, context: np.ndarray, target: np.ndarray, seed: int = 6, epochs: int = EPOCHS) -> None:
        """Tell each token from NOISE classes drawn from the prior (Adagrad steps on shuffled batches)."""
        rng = np.random.default_rng(seed)
        edges = np.cumsum(self.prior)
        log_noise = np.log(NOISE * self.prior).astype(np.float32)
        place = np.arange(CONTEXT) * (CLASSES + 1)

        def step(name, grad):
            self.past[name] += grad * grad
            getattr(self, name)[...] -= RATE * grad / np.sqrt(self.past[name])

        def summed(keys, rows, n):
            """Rows added up by key: sorted once, then summed run by run."""
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            out = np.zeros((n, rows.shape[1]), np.float32)
            out[keys[first]] = np.add.reduceat(rows[order % len(rows)], first, axis=0)
            return out

        for _ in range(epochs):
            order = rng.permutation(len(target))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                ctx, t, n = context[rows].astype(np.int64), target[rows].astype(np.int64), len(rows)
                # A context's prediction is a sum over positions, so one table per position serves all tokens.
                tables = (self.r * self.c[:, None, :]).reshape(-1, DIM)
                keys = (ctx + place).T                                  # CONTEXT, batch
                hat = tables[keys[0]]
                for k in range(1, CONTEXT):
                    hat += tables[keys[k]]
                # One set of noise classes per batch: its scores are one matrix product.
                noise = np.minimum(np.searchsorted(edges, rng.random(DRAWS) * edges[-1]), CLASSES - 1)
                s_t = (hat * self.q[t]).sum(1) + self.b[t] - log_noise[t]
                s_n = hat @ self.q[noise].T
                s_n += self.b[noise] - log_noise[noise]
                g_t = 1 / (1 + np.exp(-s_t)) - 1
                np.negative(s_n, out=s_n)
                np.exp(s_n, out=s_n)
                s_n += 1
                g_n = np.divide(np.float32(NOISE / DRAWS), s_n, out=s_n)
                g_hat = g_t[:, None] * self.q[t] + g_n @ self.q[noise]
                gq = summed(t, g_t[:, None] * hat, CLASSES) + summed(noise, g_n.T @ hat, CLASSES)
                gb = np.bincount(t, g_t, CLASSES) + np.bincount(noise, g_n.sum(0), CLASSES)
                by = summed(keys.ravel().astype(np.uint16), g_hat, CONTEXT * (CLASSES + 1)).reshape(CONTEXT, CLASSES + 1, DIM)
                gr, gc = (by * self.c[:, None, :]).sum(0), (by * self.r).sum(1)
                for name, g in (("q", gq), ("b", gb.astype(np.float32)), ("r", gr), ("c", gc)):
                    step(name, g / n)

    def packed(self) -> np.ndarray:
        """Parameters and the running squares of their steps in one array."""
        return np.concatenate([x.ravel() for k in NAMES for x in (getattr(self, k), self.past[k])]).astype(np.float64)

    def unpack(self, values: np.ndarray) -> None:
        at = 0
        for k in NAMES:
            for x in (getattr(self, k), self.past[k]):
                x[...] = values[at:at + x.size].reshape(x.shape)
                at += x.size

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target class, normalised over all classes."""
        tables = [self.r * c for c in self.c]
        out = np.empty(len(target), np.float32)
        for at in range(0, len(target), 16384):
            ctx, t = context[at:at + 16384], target[at:at + 16384]
            hat = tables[0][ctx[:, 0]]
            for k in range(1, CONTEXT):
                hat += tables[k][ctx[:, k]]
            s = hat @ self.q.T
            s += self.b
            own = s[np.arange(len(t)), t]
            top = s.max(1)
            s -= top[:, None]
            np.exp(s, out=s)
            out[at:at + 16384] = own - top - np.log(s.sum(1))
        return out


def _counts(docs: DataFrame) -> DataFrame:
    """(block, h, shape, n): distinct words per block with their training count in it (0: only held out)."""
    schema = "block int, h long, shape int, n long"

    def work(batches):
        scanner = Scanner(space_table())
        block, parts = None, []

        def summed():
            h = np.concatenate([p[0] for p in parts])
            order = np.argsort(h)
            h = h[order]
            s, n = (np.concatenate([p[k] for p in parts])[order] for k in (1, 2))
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            return h[first], s[first], np.add.reduceat(n, first)

        def flush():
            h, s, n = summed()
            for at in range(0, len(h), 50_000):
                cut = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h[cut]), block, np.int32)), pa.array(h[cut].view(np.int64)),
                     pa.array(s[cut].astype(np.int32)), pa.array(n[cut].astype(np.int64))], names=["block", "h", "shape", "n"])

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            train = batch.column(2).to_numpy(zero_copy_only=False)
            edges = np.append(np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])), len(blocks))
            for a, b in zip(edges[:-1], edges[1:]):
                if block != blocks[a]:
                    if parts:
                        yield from flush()
                    block, parts = int(blocks[a]), []
                for lo, n, hashes, shape, first in _documents(batch.column(1).slice(a, b - a), scanner):
                    counted = np.repeat(train[a + lo:a + lo + n], np.diff(first)).astype(np.int64)
                    order = np.argsort(hashes)
                    h = hashes[order]
                    start = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
                    parts.append((h[start], shape[order][start], np.add.reduceat(counted[order], start) if len(h) else counted))
                    if len(parts) > 16:
                        parts = [summed()]
        if parts:
            yield from flush()

    return docs.select("block", "text", F.expr("NOT held_out").alias("train")).mapInArrow(work, schema)


def _encoded(docs: DataFrame, parts: int, fixed) -> DataFrame:
    """(block, classes): every training document as a byte per token, in a fixed order within its block."""
    def work(batches):
        scanner, classes = Scanner(space_table()), shared(fixed)
        for batch in batches:
            out = []
            for _, n, hashes, shape, first in _documents(batch.column(2), scanner):
                c = classes(hashes, shape).astype(np.uint8)
                out += [c[first[i]:first[i + 1]].tobytes() for i in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["block", "k", "classes"])

    rows = docs.where(~F.col("held_out")).select("block", F.xxhash64("doc_id", "text").alias("k"), "text")
    return (rows.mapInArrow(work, "block int, k long, classes binary")
            .repartitionById(parts, F.col("block") % parts).sortWithinPartitions("block", "k", "classes").select("block", "classes"))


def _trained(encoded: DataFrame, blocks: int, model: LogBilinear, seed: int) -> LogBilinear:
    """One pass over all training tokens: each block learns from ``model``, the results are averaged by tokens.

    Sums go up in steps of FAN_IN blocks, so at most FAN_IN sets of parameters reach the driver.
    """
    names, schema = ["block", "n", "sums"], "block int, n long, sums binary"
    start = share(encoded.sparkSession, model)

    def row(block, n, sums):
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([n], pa.int64()), pa.array([sums.tobytes()], pa.binary())], names=names)

    def learn(batches):
        block, own, n, held, size = None, None, 0, [], 0

        def chunk():
            c = np.frombuffer(b"".join(held), np.uint8).astype(np.int16)
            first = np.append(0, np.cumsum([len(x) for x in held]))
            own.train(contexts(c, first).astype(np.int16), c, seed * 1_000_003 + block, 1)

        for batch in batches:
            for at, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != block:
                    if held:
                        chunk()
                    if block is not None:
                        yield row(block, n, own.packed() * n)
                    block, own, n, held, size = at, shared(start), 0, [], 0
                held.append(doc)
                n += len(doc)
                size += len(doc)
                if size >= CHUNK_TOKENS:
                    chunk()
                    held, size = [], 0
        if held:
            chunk()
        if block is not None:
            yield row(block, n, own.packed() * n)

    def add(batches):
        block, n, sums = None, 0, 0.0
        for batch in batches:
            for at, m, x in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if block is not None and at != block:
                    yield row(block, n, sums)
                    n, sums = 0, 0.0
                block, n, sums = at, n + m, sums + np.frombuffer(x)
        if block is not None:
            yield row(block, n, sums)

    rows = encoded.mapInArrow(learn, schema)
    while blocks > FAN_IN:
        blocks = -(-blocks // FAN_IN)
        rows = (rows.select((F.col("block") % blocks).cast("int").alias("block"), F.col("block").alias("_from"), "n", "sums")
                .repartitionById(blocks, "block").sortWithinPartitions("block", "_from").select("block", "n", "sums").mapInArrow(add, schema))
    parts = sorted(rows.collect(), key=lambda r: (r["block"], r["n"]))
    model.unpack(sum(np.frombuffer(r["sums"]) for r in parts) / sum(r["n"] for r in parts))
    return model


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null text counts as empty (its end is its only token); a null id is not
    held out; equal rows get equal scores; an empty table gives an empty
    result. Scores are sums of log10 probabilities. Other columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    total = base.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    blocks = int(total // BLOCK_BYTES + 1)
    parts = min(blocks, MAX_PARTITIONS)
    dealt = (base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
             .repartitionById(parts, F.col("block") % parts).sortWithinPartitions("block"))
    # A word has at most one row per block, so no word is hot; ``lead`` marks one row of each word.
    by_word = Window.partitionBy("h")
    own = written(spark, _counts(dealt).select(
        "block", "h", "shape", F.sum("n").over(by_word).alias("c"),
        (F.col("block") == F.min("block").over(by_word)).alias("lead")), "block-words")
    words = own.where("lead")
    top = words.where(F.col("h") != int(END.view(np.int64))).orderBy(F.col("c").desc(), "h").limit(SHORTLIST).collect()
    # The end's class always exists; unused shortlist places get hashes that no word has.
    spare = seeds(SHORTLIST - len(top), 99)
    shortlist = np.concatenate([np.array([r["h"] for r in top], np.int64).view(np.uint64), spare, [END]])
    in_list = [int(x) for x in shortlist.view(np.int64)]
    sums = words.groupBy("shape").agg(
        F.sum("c").alias("all"), F.count_if(F.col("c") > 0).alias("kinds"),
        F.sum(F.when(~F.col("h").isin(in_list), F.col("c"))).alias("c"),
        F.count_if(~F.col("h").isin(in_list) & (F.col("c") > 0)).alias("v")).collect()
    n_all, v_all = sum(r["all"] for r in sums), sum(r["kinds"] for r in sums)
    rare = np.ones(SHAPES)                                      # smoothed total of each shape, one part for unseen words
    seen = np.zeros(CLASSES)
    for r in sums:
        if r["shape"] >= 0:
            rare[r["shape"]] += (r["c"] or 0) + r["v"]
            seen[SHORTLIST + 1 + r["shape"]] = r["c"] or 0
    seen[:len(top)] = [r["c"] for r in top]
    seen[SHORTLIST] = max([r["all"] for r in sums if r["shape"] == -1], default=0)
    model = LogBilinear((seen + 0.5) / (seen + 0.5).sum())
    classes = Classes(shortlist)
    if n_all:
        block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
        encoded = written(spark, _encoded(base.withColumn("block", block), parts, share(spark, classes)), "class-documents")
        for epoch in range(EPOCHS):
            model = _trained(encoded, blocks, model, epoch)
    return _scored(dealt, own, parts, share(spark, (model, classes, rare, n_all, v_all)))


def _scored(dealt: DataFrame, own: DataFrame, parts: int, fixed) -> DataFrame:
    """Score each block with the corpus counts of its own words.

    The counts arrive sorted before the block's documents in the same stream.
    """
    # At most one row per distinct word of a block, packed: no rows are paired here.
    packed = own.groupBy("block").agg(F.collect_list("h").alias("hs"), F.collect_list("c").alias("cs"))
    none = F.array().cast("array<bigint>")
    rows = dealt.select("block", F.lit(1).alias("kind"), "doc_id", "text", "held_out", none.alias("hs"), none.alias("cs")).unionByName(
        packed.select("block", F.lit(0).alias("kind"), F.lit(None).cast(dealt.schema["doc_id"].dataType).alias("doc_id"),
                      F.lit("").alias("text"), F.lit(False).alias("held_out"), "hs", "cs"))
    ordered = rows.repartitionById(parts, F.col("block") % parts).sortWithinPartitions("block", "kind")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def work(batches):
        scanner = Scanner(space_table())
        model, classes, rare, n_all, v_all = shared(fixed)
        known = count = np.zeros(0)
        log10 = np.log(10.0)

        def score(ids, held, texts):
            parts = []
            for lo, n, hashes, shape, first in _documents(texts, scanner):
                at = np.searchsorted(known, hashes)
                c = count[at]
                base = np.log((c + 1) / (n_all + v_all + 1)) / log10
                cls = classes(hashes, shape)
                lp = model.log_probabilities(contexts(cls, first), cls).astype(np.float64)
                listed = cls <= SHORTLIST
                lp += np.where(listed, 0.0, np.log((c + 1) / rare[np.where(listed, 0, shape)]))
                starts = first[:-1]
                parts.append((np.diff(first), np.add.reduceat((c > 0).astype(np.int64), starts),
                              np.add.reduceat(base, starts), np.add.reduceat(lp / log10, starts)))
            cols = [np.concatenate([p[k] for p in parts]) for k in range(4)]
            return pa.RecordBatch.from_arrays(
                [ids, held, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(np.full(len(ids), n_all), pa.int64()), pa.array(cols[2]), pa.array(cols[3])], names=names)

        for batch in batches:
            kind = batch.column(0).to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, kind[1:] != kind[:-1])), len(kind))
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                if kind[a]:
                    yield score(part.column(1).cast(pa.int64()), part.column(3), part.column(2))
                else:
                    last = part.slice(len(part) - 1)
                    h = last.column(4).flatten().to_numpy().view(np.uint64)
                    order = np.argsort(h)
                    known, count = h[order], last.column(5).flatten().to_numpy()[order].astype(np.float64)

    return ordered.select("kind", "doc_id", "text", "held_out", "hs", "cs").mapInArrow(work, schema)
