"""The chosen-path join against all pairs, and its edge cases."""

import re

import numpy as np
import pytest

import tidewater.llm.jaccard_join as m
from tidewater.llm.queries import QUERIES


def shingles(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(docs):
    """{id: (class id, links to other texts, copies)} from every pair of distinct sets."""
    by_set = {}
    for i, t in docs:
        by_set.setdefault(shingles(t), []).append(i)
    sets = list(by_set)
    up, links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    index = {}
    for k, s in enumerate(sets):
        for g in s:
            index.setdefault(g, []).append(k)
    shared = {}
    for own in index.values():
        for x, a in enumerate(own):
            for b in own[x + 1:]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if n * 5 >= (len(sets[a]) + len(sets[b]) - n) * 4:
            links[a] += 1
            links[b] += 1
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    low = {}
    for k, s in enumerate(sets):
        low[find(k)] = min([low.get(find(k), 10**18), *by_set[s]])
    return {i: (low[find(k)], links[k], len(by_set[s]) - 1) for k, s in enumerate(sets) for i in by_set[s]}


def test_query_equals_all_pairs(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in QUERIES["op5_jaccard_join"](spark, sf).collect()}
    assert got == brute(docs) and any(v[1] for v in got.values())


@pytest.fixture(scope="module")
def hot():
    """A group of near copies larger than buckets and chunks (made small below), copies of one of them, and others."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 500, 120)]
    docs = []
    for i in range(70):
        t = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 5)):
            t[k] = f"x{i}"
        docs.append((i, " ".join(t)))
    docs += [(100 + i, docs[7][1].upper() + " !") for i in range(40)]
    docs += [(200 + i, " ".join(f"u{k}" for k in rng.integers(0, 9000, 60))) for i in range(60)]
    docs += [(300, None), (301, ""), (302, "one two"), (303, "One, two."), (304, "three"), (305, "w1 " * 5000)]
    return docs


def test_large_groups_are_split_and_whole(spark, hot, monkeypatch):
    monkeypatch.setattr(m, "SMALL", 12)
    monkeypatch.setattr(m, "CHUNK", 16)
    df = spark.createDataFrame(hot, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in m.similar_classes(df).collect()}
    assert got == brute(hot)


def test_one_of_each_group_stays(spark, hot):
    rows = [(i, t, 9) for i, t in hot] + [(0, hot[0][1], 9), (None, "three", 9), (None, "another text", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node long")
    left = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in m.keep_one(df).collect())
    first = {v[0] for v in brute(hot).values()}
    assert left == sorted([-1, *first]) and m.keep_one(df).columns == ["doc_id", "text", "node"]


def test_empty_table(spark):
    assert m.similar_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_hubs(spark):
    pairs = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 40)] + [(500, 501)]
    got = {r["node"]: r["comp"] for r in m.components(spark.createDataFrame(pairs, "a long, b long"), "t").collect()}
    assert got == {**{k: 0 for k in range(31)}, **{100 + k: 100 for k in range(40)}, 500: 500, 501: 500}


def test_components_of_random_forests_and_hubs(spark):
    rng = np.random.default_rng(8)
    ids = rng.permutation(10**6)[:600].astype(np.int64) - 500_000
    pairs = [(int(ids[rng.integers(0, k)]), int(ids[k])) for k in range(1, 300)]            # one tree
    pairs += [(int(ids[k]), int(ids[300])) for k in range(301, 500)] * 2                    # a hub, every edge twice
    pairs += [(int(ids[k]), int(ids[k])) for k in range(500, 520)]                          # loops say nothing
    low = {int(i): int(ids[:300].min()) for i in ids[:300]} | {int(i): int(ids[300:500].min()) for i in ids[300:500]}
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r["node"]: r["comp"] for r in m.components(df, "t").collect()} == low
    assert m.components(df.where("a = b"), "t").count() == 0


def test_bitmap_grows_with_its_keys_and_gives_way(spark, monkeypatch, tmp_path):
    keys, rest = list(range(0, 60_000, 2)), list(range(1, 60_000, 2))
    df = spark.range(60_000).selectExpr("id", "xxhash64(id) AS key")
    df.where("id % 2 = 0").write.parquet(str(tmp_path / "keys"))
    maybe, _ = m._maybe_in(spark.read.parquet(str(tmp_path / "keys")))
    got = {r["id"] for r in df.where(maybe).collect()}
    assert got >= set(keys) and len(got & set(rest)) < len(rest) * 0.08
    monkeypatch.setattr(m, "MAX_FILTER", 1 << 10)
    maybe, bitmap = m._maybe_in(spark.read.parquet(str(tmp_path / "keys")))
    assert bitmap is None and df.where(maybe).count() == 60_000
