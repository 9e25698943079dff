"""Substring dedup, conversation trie and Merkle manifest against plain Python versions."""

import hashlib
import random
import re
import zlib

import pytest
from llm_rows import same_rows

DOCS = "doc_id long, text string, source string, n_words int, `a b` string"


# ---- substring dedup ----------------------------------------------------------------

def plain_repeats(docs, width):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    low = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            if i is not None:
                low[tuple(w[k:k + width])] = min(low.get(tuple(w[k:k + width]), i), i)
    out = []
    for i, w in words:
        gone = {p for k in range(len(w) - width + 1) if i is not None and low[tuple(w[k:k + width])] < i for p in range(k, k + width)}
        spans, kept = [], [p for p in range(len(w)) if p not in gone]
        for p in sorted(gone):
            if spans and spans[-1][1] == p:
                spans[-1][1] = p + 1
            else:
                spans.append([p, p + 1])
        out.append((i, len(w), len(gone), [tuple(s) for s in spans], " ".join(w[p] for p in kept)))
    return sorted(out, key=str)


def repeats(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, [(x.start, x.end) for x in r.spans], r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_bytes, bucket_bytes", [(8 << 20, 8 << 20), (600, 300)])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, block_bytes, bucket_bytes):
    from tidewater.llm import substring_dedup as sd

    monkeypatch.setattr(sd, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(sd, "BUCKET_BYTES", bucket_bytes)
    rnd = random.Random(5)
    vocabulary = ["a", "B", "b", "é", "\x00", "\x1f", "naïve", "語", "x" * 40]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    docs = []
    for i in range(60):
        own = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 40))]
        if i % 3:
            own[len(own) // 2:len(own) // 2] = passage[rnd.randrange(0, 10):]
        sep = rnd.choice([" ", "\n", " \t ", "\x0b"])
        docs.append((i % 50, sep.join(own) + rnd.choice(["", " ", "\r\n"])))        # ten ids occur twice
    docs += [(None, " ".join(passage)), (None, " ".join(passage)), (-7, " ".join(passage * 3)), (100, None), (101, ""), (102, " \n"),
             (103, " ".join(passage * 40)), (104, "a " * 3000), (105, "a"), (2**40, " ".join(passage)), (2**40, " ".join(passage))]
    rows = [(i, t, "s", 9, "x") for i, t in docs]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    out = sd.remove_repeats(df, width=8)
    assert out.columns == ["doc_id", "text", "source", "a b", "n_words", "n_removed", "spans", "kept"]
    assert repeats(out) == plain_repeats(docs, 8)


def test_substring_dedup_of_an_empty_table(spark):
    from tidewater.llm.substring_dedup import remove_repeats

    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_substring_dedup_oracle(spark, oracle, sf):
    from tidewater.llm.queries import ORACLE, QUERIES

    got = QUERIES["op11_substring_dedup"](spark, sf)
    assert same_rows(got) == oracle(ORACLE["op11_substring_dedup"], sf)
    assert got.where("n_removed > 0").count() > 0


# ---- conversation trie ----------------------------------------------------------------

def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c // 100 * 100, [])[:h] + v[h:]
    nodes = {}
    for c, v in whole.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        subtree = [q for q in nodes if q[:len(p)] == p]
        kids = [q for q in subtree if len(q) == len(p) + 1]
        leaves = [q for q in subtree if not any(x[:len(q)] == q and len(x) > len(q) for x in subtree)]
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1]) if q else 0) for q in subtree)
        ends = ",".join(str(c) for c in sorted(members) if whole[c] == list(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("band_rows", [1, 60, 20_000])
def test_trie_equals_brute_force(spark, band_rows):
    from tidewater.llm.conversation_trie import prefix_trie, rebuilt, sequences

    rnd = random.Random(3)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(305, 320)]:                    # block 300 has no first conversation
        for t in range(rnd.randrange(1, 7)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "é語", "", None, "hi there"])))
    rows += [(200, t, "user", "same") for t in range(35)]                            # long, and shared by its block
    rows += [(201, t, "user", "same") for t in range(35)] + [(202, t, "user", "same") for t in range(33)]
    rows += [(7, None, "user", "first"), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (None, 0, "user", "nobody"), (401, None, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    assert trie(prefix_trie(rebuilt(sequences(df)), band_rows)) == plain_trie(rows)


def test_trie_of_an_empty_table(spark):
    from tidewater.llm.conversation_trie import prefix_trie, rebuilt, sequences

    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(rebuilt(sequences(empty))).collect() == []


def test_bands_bound_their_rows():
    from tidewater.llm.conversation_trie import bands

    lengths = {1: 50, 2: 40, 3: 30, 9: 2, 400: 1}
    out = bands(lengths, 300)
    assert [b for b in reversed(out)][0][0] == 0 and all(a[0] == b[1] for a, b in zip(out, out[1:])) and out[0][1] == 400
    alive = lambda d: sum(n for k, n in lengths.items() if k >= d)                   # noqa: E731
    assert all(hi - lo == 1 or sum(alive(d) for d in range(lo + 1, hi + 1)) <= 300 for lo, hi in out)
    assert len(out) < 8 and bands({}, 10) == []


def test_trie_oracle(spark, oracle, sf):
    from tidewater.llm.queries import ORACLE, QUERIES

    assert same_rows(QUERIES["op12_conversation_trie"](spark, sf)) == oracle(ORACLE["op12_conversation_trie"], sf)


# ---- Merkle manifest ----------------------------------------------------------------

def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_tree(leaves):
    """Root of a list of digests and, per leaf, its sibling segments (left, right) from below."""
    paths, place, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // 16 * 16:p // 16 * 16 + 16]
            paths[i].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        nodes = [h(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
        place = [p // 16 for p in place]
    return nodes[0], paths


def plain_proofs(rows):
    by = {}
    for key, source, leaf in rows:
        by.setdefault(source, []).append((key is not None, key or 0, leaf))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = [plain_tree([x[2] for x in sorted(by[s])]) for s in order]
    root, above = plain_tree([s[0] for s in subs])
    out = []
    for s, (sub, paths), up in zip(order, subs, above):
        for (known, key, leaf), path in zip(sorted(by[s]), paths):
            out.append((key if known else None, s, leaf, sub, path + up))
    return root, out


def shown(df):
    return [(r.row.doc_id, r.row.source, r.row.leaf, r.subroot, [(x.l, x.r) for x in r.path]) for r in df.collect()]


def test_merkle_equals_brute_force(spark):
    from tidewater.llm.merkle import build, proofs

    rows = [(i, "hot", h(str(i))) for i in range(400)] + [(i, f"s{i % 18}é", h(str(i))) for i in range(60)]
    rows += [(None, None, h("n")), (None, "hot", h("n")), (5, "hot", h("again")), (9, "", h("x")), (9, "", h("x")), (1, "alone", h("y"))]
    rows += [(77, "same", h("z"))] * 40                                              # equal rows: equal digests at every level
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, leaf string, subroot string").repartition(4)
    tree = build(df)
    root, plain = plain_proofs(rows)
    assert tree.root == root
    assert sorted(shown(proofs(tree)), key=str) == sorted(plain, key=str)
    few = tree.leaves.where("row.doc_id in (0, 77, 399)").withColumn("path", tree.leaves.s)
    assert sorted(shown(proofs(tree, few)), key=str) == sorted((x for x in plain if x[0] in (0, 77, 399)), key=str)
    assert proofs(tree, few.withColumn("rank", few.s + 10**9)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 16, 17])
def test_merkle_small_tables(spark, n):
    from tidewater.llm.merkle import build, proofs

    rows = [(i, "a", h(str(i))) for i in range(n)]
    tree = build(spark.createDataFrame(rows, "doc_id long, source string, leaf string"))
    if n == 0:
        assert tree.root is None and proofs(tree).collect() == []
    else:
        root, plain = plain_proofs(rows)
        assert tree.root == root and sorted(shown(proofs(tree)), key=str) == sorted(plain, key=str)


def test_merkle_descent_gathers_no_level_for_a_broadcast(spark):
    from tidewater.llm.merkle import build, proofs

    rows = [(i, f"s{i % 20 * (i % 3 > 0)}", h(str(i))) for i in range(1500)]         # two levels of sources, up to three of leaves
    got = proofs(build(spark.createDataFrame(rows, "doc_id long, source string, leaf string")))
    assert sorted(shown(got), key=str) == sorted(plain_proofs(rows)[1], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_merkle_oracle(spark, oracle, sf):
    from tidewater.llm.queries import ORACLE, QUERIES

    got = QUERIES["op13_merkle_manifest"](spark, sf)
    assert same_rows(got) == oracle(ORACLE["op13_merkle_manifest"], sf)
    assert 0 < got.where("verified").count() < got.count()


def test_ranks_of_a_hot_group_and_repeated_rows(spark):
    from tidewater.llm.ranks import ranked

    rows = [("hot", i) for i in range(500)] + [("hot", 7)] * 300 + [(None, None), (None, 3), ("b", None)]
    got = ranked(spark.createDataFrame(rows, "g string, k long").repartition(5), ["g"], ["k"], "r").collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.r, r.k))
    assert len(got) == len(rows)
    for g, v in by.items():
        v.sort(key=lambda x: x[0])
        assert [x[0] for x in v] == list(range(len(v)))
        assert [x[1] for x in v] == sorted((k for s, k in rows if s == g), key=lambda k: (k is not None, k or 0))
