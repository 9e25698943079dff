"""Mixing, sharding and line dedup: against SQL, their laws, and edge cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm_rows import same_rows
from tidewater.llm import line_dedup, mixing, oracles, sharding
from tidewater.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op1_mix_sources", "op10_line_dedup", "op7_chat_format"])
def test_query_equals_sql(spark, sf, oracle, name):
    assert same_rows(QUERIES[name](spark, sf)) == oracle(oracles.SQL[name], sf)


@pytest.mark.parametrize("name", ["op1_mix_sources", "op10_line_dedup"])
def test_no_python_in_the_plan(spark, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def filled(caps, weights, goal):
    """Targets by pouring: share what is left among the open sources until none overflows."""
    target, open_ = [0.0] * len(caps), set(range(len(caps)))
    while open_:
        left = goal - sum(caps[i] for i in range(len(caps)) if i not in open_)
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / w > caps[i]}
        for i in open_:
            target[i] = caps[i] if i in over else left * weights[i] / w
        if not over:
            break
        open_ -= over
    return target


def test_targets_and_takes(spark):
    rng = np.random.default_rng(2)
    rows = [(k, s, int(n)) for k, (s, n) in enumerate(zip(rng.choice(["a", "b", "ö", "z"], 400, p=[.7, .1, .1, .1]), rng.integers(0, 90, 400)))]
    rows += [(900, None, 50), (901, None, 0), (902, "zero", 0), (903, "tiny", 3), (None, "b", 40), (None, "b", 40)]
    df = spark.createDataFrame([(i, s, n, 7, "x") for i, s, n in rows], "doc_id long, source string, size long, b long, place string")
    out = mixing.mix(df).toPandas()
    assert list(out.columns) == ["doc_id", "source", "size", "b", "place", "source_size", "target", "taken"] and len(out) == len(rows)
    names = sorted({s for _, s, _ in rows if s}, key=lambda s: s.encode()) + [None]
    sizes = [sum(n for _, s, n in rows if s == x) for x in names]
    want = filled([2 * n for n in sizes], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5 * sum(sizes))
    for name, size, target in zip(names, sizes, want):
        own = out[out.source.isna()] if name is None else out[out.source == name]
        assert (own.source_size == size).all() and np.allclose(own.target, target)
        assert abs(own.taken.sum() - target) <= 0.02 * target + 3
    assert (out.taken <= 2 * out["size"]).all() and (out.taken >= 0).all()
    assert same_rows(mixing.mix(df)) == same_rows(mixing.mix(df.repartition(7)))
    assert mixing.mix(df.limit(0)).count() == 0
    times = mixing.repeat_documents(mixing.mix(df)).groupBy("doc_id").count().toPandas()
    assert times["count"].max() <= 4


def test_kept_words_of_whole_documents_meet_the_targets(spark):
    rng = np.random.default_rng(4)
    rows = [("tiny", int(n)) for n in (4, 6, 9)] + [(f"s{k:02}", int(n)) for k in range(10) for n in rng.integers(300, 900, 60)]
    rows += [("hot", int(n)) for n in rng.integers(300, 900, 6000)] + [("hot", 40_000), ("s03", 5000)] + [(None, 400)] * 30 + [("none", 0)]
    df = spark.createDataFrame([(k, s, n) for k, (s, n) in enumerate(rows)], "doc_id long, source string, size long")
    mixed = mixing.mix(df).toPandas()
    docs = mixing.repeat_documents(mixing.mix(df))
    assert docs.columns == [*df.columns, "source_size", "target", "taken"]
    kept = docs.toPandas()
    assert kept.doc_id.value_counts().max() <= 2 and (kept["size"] > 0).all()
    for source, own in mixed.groupby("source", dropna=False):
        mine = kept[kept.source.isna()] if pd.isna(source) else kept[kept.source == source]
        assert abs(mine["size"].sum() - own.target.iloc[0]) <= own["size"].max()
    assert same_rows(docs.drop("taken")) == same_rows(mixing.repeat_documents(mixing.with_targets(df.repartition(5))))


def test_whole_documents_follow_the_words_taken(spark, sf):
    """A document of which the mix takes nothing doesn't appear, one taken once or twice appears as often; in the pipeline too."""
    import corpus_pipeline
    rng = np.random.default_rng(6)
    words = {k: int(n) for k, n in enumerate(rng.integers(1, 9, 2400))}
    source = {k: "abccccdddd"[k % 10] for k in words}
    docs = spark.createDataFrame([(k, "w " * n, "en", source[k], 2 * n) for k, n in words.items()], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.mix(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))).toPandas().set_index("doc_id")
    assert ((mixed.taken == 0).sum() > 100) and ((mixed.taken == mixed["size"]).sum() > 100)
    kept = mixing.repeat_documents(spark.createDataFrame(mixed.reset_index())).toPandas().doc_id.value_counts()
    whole = mixed[mixed.taken % mixed["size"] == 0]
    assert all(kept.get(k, 0) == r.taken // r["size"] for k, r in whole.iterrows())
    out = corpus_pipeline.mix(spark, docs, sf).toPandas()
    for s in "abcd":
        assert abs(sum(words[k] for k in out.doc_id if source[k] == s) - mixed.taken[mixed.source == s].sum()) <= 8


def test_pipeline_takes_its_documents_from_the_mix(spark, sf, monkeypatch):
    import corpus_pipeline
    real = mixing.mix
    odd = lambda docs, *a, **k: real(docs, *a, **k).withColumn("taken", F.when(F.col("size") % 2 == 1, 2 * F.col("size")).otherwise(0).cast("long"))
    monkeypatch.setattr(mixing, "mix", odd)
    rows = [(k, "w " * n, "en", "a", 2 * n) for k, n in enumerate([3, 4, 5, 6, 7, 7])] + [(None, "x y z", "en", None, 5)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert same_rows(corpus_pipeline.mix(spark, docs, sf)) == sorted(map(str, same_rows(docs.where("n_chars not in (8, 12)")) * 2))


def test_quotas_are_highest_quotients(spark):
    targets = [("a", 0, 1000, 53.2), ("b", 1, 500, 20.1), ("c", 2, 300, 11.7), ("d", 3, 9, 9.0)]
    df = spark.createDataFrame(targets, "source string, place long, source_size long, target double")
    got = {r["place"]: list(r["upto"]) for r in mixing.source_quotas(df, shards=4).collect()}
    house = int(sum(t[3] for t in targets))
    seats = sorted(((t / (2 * k + 1), -p) for _, p, _, t in targets for k in range(200)), reverse=True)
    for s in range(1, 5):
        first = seats[:house * s // 4]
        assert [got[p][s - 1] for p in range(4)] == [min(sum(1 for _, q in first if -q == p), 2 * n) for p, n in ((0, 1000), (1, 500), (2, 300), (3, 9))]


@pytest.mark.parametrize("bits,dims", [(1, 2), (3, 2), (2, 3), (4, 4)])
def test_curve_visits_every_cell_by_single_steps(bits, dims):
    place = sharding.hilbert_order(bits, dims)
    at = np.argsort(place)
    assert sorted(place) == list(range(1 << (bits * dims)))
    cells = np.stack([(at >> (bits * (dims - 1 - d))) & ((1 << bits) - 1) for d in range(dims)], 1)
    assert (np.abs(np.diff(cells, axis=0)).sum(1) == 1).all()


def check_law(out, n):
    counts = out.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert counts["count"].sum() == n and counts["count"].max() - counts["count"].min() <= (1 if len(counts) == 8 else n)
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all() and (counts["nunique"] == counts["count"]).all()


def test_shards_of_the_query(spark, sf):
    out = QUERIES["op9_hilbert_shards"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    check_law(out, len(docs))
    import zlib
    both = out.merge(docs, on="doc_id")
    assert (both["size"] == [len(t.encode()) + 1 for t in both.text]).all() and (both.text_crc32 == [zlib.crc32(t.encode()) for t in both.text]).all()
    assert set(out.law) == {"rows"} and out.grown_shard.isna().all()
    # The curve prunes: a shard spans fewer sizes than the table does.
    spans = both.groupby("shard")["size"].agg(lambda s: s.quantile(.9) - s.quantile(.1))
    assert spans.median() < both["size"].quantile(.9) - both["size"].quantile(.1)


def test_shard_edges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLICE", 10)
    rows = [(k % 50, "en", "hot", "same") for k in range(300)] + [(None, None, None, None)] * 20 + [(10**12, "é" * 9, "s", "x" * 100)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, lang string, source string, text string, shard long")
    out = sharding.hilbert_shards(df, 8, F.length(F.coalesce("text", F.lit(""))), F.col("text"))
    assert out.columns == ["doc_id", "lang", "source", "text", "_place", "shard", "slot"]
    check_law(out.toPandas(), 321)
    assert sharding.hilbert_shards(df.limit(0), 8, F.length("text"), F.col("text")).count() == 0
    check_law(sharding.hilbert_shards(df.limit(3), 8, F.length("text"), F.col("text")).toPandas(), 3)


def test_places_are_those_of_a_plain_sort_by_curve_index(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLICE", 3)
    rng = np.random.default_rng(9)
    names = [f"https://site{k:02}.example" for k in range(16)] + [None, "é", ""]
    rows = [(k, rng.choice(["de", "en", "fr"]), names[min(int(rng.integers(0, 30)), 18)], "w" * int(rng.integers(0, 400))) for k in range(900)]
    rows += [(10**14, "en", names[3], "an outlying id")] + [rows[5]] * 4
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").repartition(5)
    out = sharding.hilbert_shards(df, 8, F.length("text"), F.col("text")).toPandas()
    n, side = len(rows), 1 << sharding.BITS

    def text_levels(values):
        values = [(v or "").encode() for v in values]
        start = {v: sum(w < v for w in values) * side // n for v in set(values)}
        dense = {level: i for i, level in enumerate(sorted({0, *start.values()}))}
        return [dense[start[v]] for v in values]

    def number_levels(values):
        cuts = {sorted(values)[-(-i * n // side) - 1] for i in range(1, side)}
        return [sum(c < v for c in cuts) for v in values]

    ids, langs, sources, texts = zip(*rows)
    curve = sharding.hilbert_order(sharding.BITS, 4)
    cells = zip(text_levels(langs), text_levels(sources), number_levels([len(t) for t in texts]), number_levels(ids))
    want = sorted((curve[((a * side + b) * side + c) * side + d], i, t) for (a, b, c, d), i, t in zip(cells, ids, texts))
    got = out.sort_values("_place")
    assert list(got._place) == list(range(n))
    assert list(zip(got.doc_id, got.text)) == [(i, t) for _, i, t in want]
    # Sources with a common prefix still prune: few shards hold all of them.
    assert out.groupby("shard").source.nunique().median() < out.source.nunique()


def test_line_dedup_edges(spark, oracle):
    rows = [(k, f"s{k % 14}", f"own line {k}\nshared by all\n\n  \nby few" if k % 14 < 9 else f"own line {k}\nshared by all", 1) for k in range(60)]
    rows += [(100, None, None, 1), (101, None, "", 1), (102, "s1", "shared by all", 1), (102, "s1", "shared by all", 1),
             (None, "s2", "tail\nshared by all", 1), (103, "s3", "z " * 30000 + "\nshared by all", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, n_lines long")
    out = line_dedup.remove_boilerplate(df)
    want = oracle(oracles.SQL["op10_line_dedup"], documents=pd.DataFrame(rows, columns=["doc_id", "source", "text", "n"]).astype({"doc_id": "Int64"}))
    assert same_rows(out.select("doc_id", "n_lines", "n_removed", "text")) == want
    assert line_dedup.remove_boilerplate(df.limit(0)).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(h, h, f"site{k}") for h in range(20, 140) for k in range(h)] * 2
    df = spark.createDataFrame(rows, "_h1 long, _h2 long, _site string").withColumn("_salt", F.pmod(F.xxhash64("_site"), F.lit(line_dedup.SALTS)).cast("int"))
    assert sorted(r[0] for r in line_dedup.boilerplate_lines(df, 100).collect()) == list(range(100, 140))
