"""Decontamination against a brute-force search, and its edge cases."""

import hashlib
import re

import numpy as np
import pytest

from tidewater.llm.decontaminate import FMIndex, Phrases, contamination, remove_spans, suffix_array
from tidewater.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """{doc: (n_words, n_hit, item ids)} by looking every document window up."""
    owners = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            owners.setdefault(tuple(w[k:k + window]), set()).add(str(i))
    lengths = {len(k) for k in owners}
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                own = owners.get(tuple(w[k:k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found))
    return out


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 60, 500):
        for symbols in (1, 2, 4):
            t = rng.integers(0, symbols, n)
            assert suffix_array(t).tolist() == sorted(range(n), key=lambda i: t.tolist()[i:])


def test_index_finds_and_locates_every_occurrence():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 5, 700)
    index = FMIndex(text)
    phrases = rng.integers(1, 6, (60, 4))
    length = rng.integers(1, 5, 60)
    for i, n in enumerate(length):
        phrases[i, :4 - n] = 0
    live, lo, hi = index.search(phrases, length)
    found = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(live, lo, hi)}
    for p in range(60):
        want = phrases[p, 4 - length[p]:].tolist()
        assert found.get(p, []) == [k for k in range(len(text) - len(want) + 1) if text[k:k + len(want)].tolist() == want]


def test_query_equals_brute_force(spark, sf):
    got = {r["doc_id"]: r for r in QUERIES["op3_decontaminate"](spark, sf).collect()}
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert len(got) == len(want) and sum(bool(w[1]) for w in want.values()) > 0
    for i, (n, h, found) in want.items():
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, h, len(found), h > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


@pytest.fixture
def small(spark):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = [(1, f"before {passage.upper()} after", 1), (2, None, 2), (3, "", 3), (4, "short item", 4),
            (4, "short item", 4), (None, passage, 5), (6, "über\nalpha beta gamma", 6), (7, "x " * 4000 + passage, 7)]
    return (spark.createDataFrame(docs, "doc_id long, text string, items long"),
            spark.createDataFrame([(10, passage), (2, passage), (3, None), (5, "SHORT, item!")], "item_id long, text string"))


def test_edges_and_removal(spark, small, monkeypatch):
    docs, bench = small
    marked = contamination(docs, bench)
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], tuple(r["items"])) for r in marked.collect())
    assert got == [(-1, 12, 12, ("10", "2")), (1, 14, 12, ("10", "2")), (2, 0, 0, ()), (3, 0, 0, ()),
                   (4, 2, 2, ("5",)), (4, 2, 2, ("5",)), (6, 4, 0, ()), (7, 4012, 12, ("10", "2"))]
    left = {r["doc_id"]: r["text"] for r in remove_spans(marked).collect()}
    assert left == {1: "before \n after", 2: None, 3: "", 6: "über\nalpha beta gamma", 7: "x " * 4000 + "\n"}
    # The benchmark in several passes gives the same.
    import tidewater.llm.decontaminate as m
    monkeypatch.setattr(m, "PART_BYTES", 20)
    again = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], tuple(r["items"])) for r in contamination(docs, bench).collect())
    assert again == got


def test_empty_tables(spark, small):
    docs, bench = small
    assert contamination(docs.limit(0), bench).count() == 0
    assert contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_phrases_of_short_items():
    p = Phrases([1, 2, 3], ["a b", "", None], window=3)
    assert p.length.tolist() == [2] and p.owners == [["1"]]
