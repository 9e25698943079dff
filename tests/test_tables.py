"""Versioned tables: merges, crashes between write and publish, column growth, clean-up; landing files."""

import pytest

from tidewater.session import fresh_path
from tidewater.sources import landing as ld
from tidewater.sources import tables as tb


def frame(spark, rows, cols="k string, v long"):
    return spark.createDataFrame(rows, cols)


def content(spark, path):
    return sorted(tuple(r) for r in tb.read_table(spark, path).collect())


def test_first_load_has_at_least_the_asked_buckets(spark):
    path = fresh_path(spark, "t")
    tb.upsert(spark, frame(spark, [(f"k{i}", 0) for i in range(200)]), path, "k", buckets=8)
    facts = tb.upsert(spark, frame(spark, [(f"k{i}", 1) for i in range(5)] + [(None, 9)]), path, "k", buckets=64)
    assert facts["baldes"] == 8 and facts["baldes_reescritos"] <= 5
    assert content(spark, path) == sorted([(f"k{i}", int(i < 5)) for i in range(200)])


@pytest.mark.parametrize("old, new", [(1, 1), (1, 7), (3, 4), (5, 23), (8, 9), (8, 64)])
def test_a_split_sends_rows_only_to_descendants(spark, old, new):
    rows = spark.range(3000).select(tb.bucket_of("id", old).alias("a"), tb.bucket_of("id", new).alias("b")).distinct().collect()
    below = tb.descendants(old, new)
    assert sorted(b for x in below.values() for b in x) == list(range(new))
    assert all(r.b in below[r.a] for r in rows) and {r.b for r in rows} == set(range(new))


def test_buckets_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(tb, "BUCKET_BYTES", 50_000)
    path = fresh_path(spark, "t")
    wide = lambda lo, hi: spark.range(lo, hi).selectExpr("concat('k', id) AS k", "id AS v", "sha2(string(id), 256) AS w")
    assert tb.upsert(spark, wide(0, 1), path, "k")["baldes"] == 1
    first = tb.upsert(spark, wide(0, 100), path, "k")
    grown = tb.upsert(spark, wide(0, 20_000), path, "k")
    assert first["baldes"] == 1 and grown["baldes"] > 20
    m = tb._manifest(spark, path)
    assert len(m["baldes"]) == m["total_baldes"] and max(x["bytes"] for x in m["baldes"].values()) <= 50_000
    # A small increment splits a few buckets and leaves the rest where they are.
    more = tb.upsert(spark, wide(20_000, 20_400), path, "k", )
    assert more["baldes"] >= grown["baldes"] and more["baldes_reescritos"] <= grown["baldes"]
    few = tb.upsert(spark, wide(5, 8).withColumn("v", tb.F.lit(-1).cast("long")), path, "k")
    assert few["baldes_reescritos"] <= 3 + (few["baldes"] - more["baldes"])
    plain = {f"k{i}": -1 if 5 <= i < 8 else i for i in range(20_400)}
    assert {r.k: r.v for r in tb.read_table(spark, path).collect()} == plain and tb.read_table(spark, path).count() == len(plain)


def test_a_task_writes_a_piece_of_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(tb, "BUCKET_BYTES", 400_000)
    monkeypatch.setattr(tb, "WRITER_BYTES", 30_000)
    rows = lambda lo, hi, v: spark.range(lo, hi).selectExpr("concat('k', id) AS k", f"{v} AS v", "sha2(string(id), 256) AS w")
    for write in (lambda p: tb.upsert(spark, rows(0, 15_000, 1), p, "k"), lambda p: tb.replace(spark, rows(0, 15_000, 1), p, "k"),
                  lambda p: [tb.upsert(spark, rows(0, 9000, 0), p, "k"), tb.upsert(spark, rows(500, 15_000, 1), p, "k"), tb.upsert(spark, rows(0, 500, 1), p, "k")]):
        path = fresh_path(spark, "t")
        write(path)
        m, files = tb._manifest(spark, path), {}
        for b, x in m["baldes"].items():
            files[b] = [n for n in tb.list_names(spark, f"{path}/versoes/{x['pasta']}/{tb.BUCKET}={b}") if n.startswith("part-")]
            assert len(files[b]) >= 0.5 * x["bytes"] / tb.WRITER_BYTES
        tasks = [(m["baldes"][b]["pasta"], n[:10]) for b in files for n in files[b]]
        assert len(files) > 3 and len(tasks) == len(set(tasks))
        assert tb.read_table(spark, path).where("v = 1").count() == tb.read_table(spark, path).select("k").distinct().count() == 15_000


def test_replace_by_key_keeps_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(tb, "BUCKET_BYTES", 20_000)
    path = fresh_path(spark, "t")
    df = spark.range(5000).selectExpr("concat('k', id) AS k", "id AS v")
    tb.replace(spark, df, path, "k")
    n = tb._manifest(spark, path)["total_baldes"]
    assert n > 3
    facts = tb.upsert(spark, frame(spark, [("k7", -7)]), path, "k")
    assert facts["baldes_reescritos"] <= 1 + facts["baldes"] - n
    assert tb.read_table(spark, path).where("k = 'k7'").collect()[0].v == -7 and tb.read_table(spark, path).count() == 5000


def test_new_columns_are_kept_for_all_buckets(spark):
    path = fresh_path(spark, "t")
    tb.upsert(spark, frame(spark, [("a", 1), ("b", 2), ("c", 3)]), path, "k", buckets=4)
    more = frame(spark, [("a", 5, "x")], "k string, v long, w string")
    with pytest.raises(ValueError):
        tb.upsert(spark, more, path, "k")
    tb.upsert(spark, more, path, "k", allow_new_columns=True)
    assert tb.read_table(spark, path).columns == ["k", "v", "w"]
    assert content(spark, path) == [("a", 5, "x"), ("b", 2, None), ("c", 3, None)]


def test_later_row_by_order_wins_whichever_comes_first(spark):
    path = fresh_path(spark, "t")
    tb.upsert(spark, frame(spark, [("a", 5), ("b", 1), ("c", 1)]), path, "k", order=["v"])
    tb.upsert(spark, frame(spark, [("a", 3), ("b", 2), ("c", 1)]), path, "k", order=["v"])
    assert content(spark, path) == [("a", 5), ("b", 2), ("c", 1)]


def test_a_crash_before_publishing_leaves_the_table_as_it_was(spark, monkeypatch):
    path = fresh_path(spark, "t")
    tb.upsert(spark, frame(spark, [("a", 1), ("b", 1)]), path, "k", buckets=2)
    real = tb._publish
    monkeypatch.setattr(tb, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tb.upsert(spark, frame(spark, [("a", 2), ("c", 2)]), path, "k")
    assert content(spark, path) == [("a", 1), ("b", 1)]
    monkeypatch.setattr(tb, "_publish", real)
    tb.upsert(spark, frame(spark, [("a", 3), ("c", 3)]), path, "k")
    assert content(spark, path) == [("a", 3), ("b", 1), ("c", 3)]


def keys_of_bucket(spark, bucket, buckets, n=1):
    return [r.k for r in spark.range(500).selectExpr("concat('k', id) AS k").where(tb.bucket_of("k", buckets) == bucket).limit(n).collect()]


def interleaved(spark, monkeypatch, path, other):
    """Runs ``other`` between the next writer's write and its publication, once."""
    real, waiting = tb._publish, [other]

    def publish(*a):
        if waiting:
            waiting.pop()()
        return real(*a)
    monkeypatch.setattr(tb, "_publish", publish)


def test_writers_of_different_buckets_both_stand(spark, monkeypatch):
    path = fresh_path(spark, "t")
    (a,), (b,) = keys_of_bucket(spark, 0, 4), keys_of_bucket(spark, 1, 4)
    tb.upsert(spark, frame(spark, [(f"k{i}", 0) for i in range(500)]), path, "k", buckets=4)
    interleaved(spark, monkeypatch, path, lambda: tb.upsert(spark, frame(spark, [(b, 2)]), path, "k"))
    facts = tb.upsert(spark, frame(spark, [(a, 1)]), path, "k")
    assert facts["tentativas"] == 1 and tb._manifest(spark, path)["versao"] == 3
    assert content(spark, path) == sorted((f"k{i}", 1 if f"k{i}" == a else 2 if f"k{i}" == b else 0) for i in range(500))


def test_writers_of_one_bucket_merge_one_after_the_other(spark, monkeypatch):
    path = fresh_path(spark, "t")
    a, b = keys_of_bucket(spark, 2, 4, 2)
    tb.upsert(spark, frame(spark, [(f"k{i}", 0) for i in range(500)]), path, "k", buckets=4)
    interleaved(spark, monkeypatch, path, lambda: tb.upsert(spark, frame(spark, [(a, 5), (b, 5)]), path, "k", order=["v"]))
    facts = tb.upsert(spark, frame(spark, [(a, 3), (b, 7)]), path, "k", order=["v"])
    assert facts["tentativas"] == 2
    got = dict(content(spark, path))
    assert (got[a], got[b], len(got)) == (5, 7, 500)
    assert len(tb.list_names(spark, f"{path}/versoes")) == 3            # the beaten attempt's folder is gone


def test_first_loads_at_once_merge(spark, monkeypatch):
    path = fresh_path(spark, "t")
    interleaved(spark, monkeypatch, path, lambda: tb.upsert(spark, frame(spark, [("a", 1), ("b", 1)]), path, "k"))
    tb.upsert(spark, frame(spark, [("b", 2), ("c", 2)]), path, "k")
    assert content(spark, path) == [("a", 1), ("b", 2), ("c", 2)]


def test_a_merge_during_a_replace_merges_again(spark, monkeypatch):
    path = fresh_path(spark, "t")
    tb.upsert(spark, frame(spark, [("a", 1), ("b", 1)]), path, "k")
    interleaved(spark, monkeypatch, path, lambda: tb.replace(spark, frame(spark, [("z", 9)]), path, "k"))
    tb.upsert(spark, frame(spark, [("b", 2)]), path, "k")
    assert content(spark, path) == [("b", 2), ("z", 9)]


def test_a_writer_that_is_always_beaten_fails_cleanly(spark, monkeypatch):
    path = fresh_path(spark, "t")
    tb.upsert(spark, frame(spark, [("a", 0)]), path, "k")
    real, others = tb._publish, [0]

    def publish(*args):                                                 # before every publication of ours, another one's
        monkeypatch.setattr(tb, "_publish", real)
        others[0] += 1
        tb.upsert(spark, frame(spark, [("a", others[0])]), path, "k")
        monkeypatch.setattr(tb, "_publish", publish)
        return real(*args)
    monkeypatch.setattr(tb, "_publish", publish)
    monkeypatch.setattr(tb, "ATTEMPTS", 2)
    with pytest.raises(tb.CommitConflict):
        tb.upsert(spark, frame(spark, [("a", 100)]), path, "k")
    monkeypatch.setattr(tb, "_publish", real)
    assert others == [2] and content(spark, path) == [("a", 2)]


def test_threads_that_merge_at_once_lose_nothing(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = fresh_path(spark, "t")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: tb.upsert(spark, frame(spark, [(f"w{i}-{j}", i) for j in range(5)]), path, "k", buckets=2), range(3)))
    assert content(spark, path) == sorted((f"w{i}-{j}", i) for i in range(3) for j in range(5))


def test_put_if_absent_keeps_the_first(spark):
    path = f"{fresh_path(spark, 'put')}/x.json"
    assert tb.put_if_absent(spark, path, "one") and not tb.put_if_absent(spark, path, "two")
    assert tb.read_text(spark, path) == "one" and tb.list_names(spark, path.rsplit("/", 1)[0]) == ["x.json"]


def test_old_versions_and_staging_are_removed(spark):
    path = fresh_path(spark, "t")
    for i in range(6):
        tb.replace(spark, frame(spark, [("a", i)]), path)
    assert content(spark, path) == [("a", 5)]
    assert len(tb.list_names(spark, f"{path}/versoes")) == len(tb.list_names(spark, f"{path}/manifesto")) == tb.KEPT_VERSIONS + 1
    from tidewater.session import work_dir
    tb.upsert(spark, frame(spark, [("a", 7)]), fresh_path(spark, "t"), "k")
    assert not [n for n in tb.list_names(spark, work_dir(spark)) if n.startswith("upsert-stage")]


def test_no_part_file_of_a_day_is_lost(spark):
    landing = fresh_path(spark, "landing")
    rows = [(f"{i}", "2026-07-01") for i in range(10)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        ld.write_landing(spark, frame(spark, rows, "leitura_id string, data string"), landing, "tms", "tms_leituras_temperatura")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    ld.write_landing(spark, frame(spark, [("x", "2026-07-01")], "leitura_id string, data string"), landing, "tms", "tms_leituras_temperatura")
    back = ld.read_landing_batch(spark, landing, "tms", "tms_leituras_temperatura", ("leitura_id",))
    assert sorted(r.leitura_id for r in back.collect()) == sorted([r[0] for r in rows] + ["x"])
