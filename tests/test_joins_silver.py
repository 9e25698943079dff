"""Skew-safe joins, latest-by-key, quarantine accounting, bucketed upsert."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import silver as sv
from tidewater.operators.joins import heavy_hitters, lookup_join
from tidewater.session import fresh_path
from tidewater.sources import layers
from tidewater.sources import tables as tb
from tidewater.spec import EVENT_TABLES


def _fact(spark):
    # a third of the rows on one key, plus null keys and keys missing from the dim
    rows = [(i, "HOT") for i in range(300)] + [(1000 + i, f"K{i % 50}") for i in range(500)] + \
           [(2000 + i, None) for i in range(100)] + [(3000 + i, "MISSING") for i in range(20)]
    return spark.createDataFrame(rows, "id int, k string")


def _dim(spark):
    return spark.createDataFrame([("HOT", "h")] + [(f"K{i}", f"v{i}") for i in range(50)], "k string, v string")


def test_heavy_hitters_by_share_of_a_partition(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = {r.k: r._salts for r in heavy_hitters(_fact(spark), "k").collect()}
    assert hot == {"HOT": -(-300 // (920 * 0.5 / parts))}                     # K0..K49 hold 10 rows each, NULL is no key
    every = heavy_hitters(_fact(spark), "k", share=0.05).collect()            # a piece of less than 6 rows
    assert len(every) == 52 < parts / 0.05


def test_salted_lookup_join_equals_plain_join(spark):
    f, d = _fact(spark), _dim(spark)
    for share in (0.5, 0.05):
        hot = heavy_hitters(f, "k", share)
        for how in ("left", "inner", "left_anti", "left_semi"):
            got = lookup_join(f, d, "k", how, hot)
            want = f.join(d, "k", how)
            cols = sorted(want.columns)
            assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str), (share, how)


def test_hot_keys_may_be_a_list(spark):
    f, d = _fact(spark), _dim(spark)
    for hot in ([], ["HOT", "K1"]):
        got = lookup_join(f, d, "k", "left", hot).select("id", "k", "v")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, f.join(d, "k", "left").select("id", "k", "v").collect()), key=str)


def test_two_hundred_hot_keys_make_no_large_task(spark):
    """Each of 200 keys holds more than a fair partition's share; no task of the join gets twice the median."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(400_000).select("id", F.when(F.col("id") % 4 < 3, F.concat(F.lit("H"), F.pmod(F.xxhash64("id"), F.lit(200)).cast("string")))
                                           .otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("k"))
        dim = fact.select("k").distinct().withColumn("v", F.lit(1))
        hot = heavy_hitters(fact, "k", share=0.1)
        assert hot.where("k LIKE 'H%'").count() == 200 and hot.count() == 200
        joined = lookup_join(fact, dim, "k", "left", hot)
        per = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(per) == 400_000 and len(per) == 64 and per[-1] <= 2 * per[len(per) // 2]
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("planning", "planning")
        lookup_join(fact, dim, "k", "left", heavy_hitters(fact, "k"))
        assert jobs.getJobIdsForGroup("planning") == []                       # nothing is counted to make the plan
    finally:
        spark.sparkContext.setJobGroup("after", "after")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_by_key_takes_newest_ingest(spark):
    df = spark.createDataFrame([("A", "2026-07-01", "old"), ("A", "2026-07-02", "new"), ("B", "2026-07-01", "only"),
                                (None, "2026-07-03", "nokey")], "k string, d string, v string")
    out = dict((r.k, r.v) for r in sv.latest_by_key(df, "k", ["d"]).collect())
    assert out == {"A": "new", "B": "only"}


def test_wanted_columns_are_those_of_the_same_rows(spark):
    rows = [(f"K{i % 40}", "2026-07-01" if i % 3 else None, i % 5, chr(97 + i % 7) if i % 11 else None, i, i % 4 > 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, d string, a int, b string, c int, _ok boolean")
    whole = {r.k: r.asDict() for r in sv.latest_by_key(df, "k", ["d"], keep=F.col("_ok")).collect()}
    for wanted in ([], ["k"], ["b"], ["d", "a"], ["c"]):
        out = sv.latest_by_key(df, "k", ["d"], keep=F.col("_ok"), columns=wanted)
        assert out.columns == ["k"] + [c for c in ("d", "a", "b", "c") if c in wanted]
        assert {r.k: r.asDict() for r in out.collect()} == {k: {c: v for c, v in r.items() if c == "k" or c in wanted} for k, r in whole.items()}
    with pytest.raises(ValueError, match="no such columns"):
        sv.latest_by_key(df, "k", ["d"], columns=["x"])


def test_sku_validity_shuffles_only_what_it_reads(spark, sf):
    from __spark_entry__ import queries

    plan = queries()["sku_validity"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    best = next(x for x in plan.splitlines() if "max(" in x)
    assert "produto_id" in best and "quantidade" not in best.split("max(")[1] and "preco_unitario" not in best.split("max(")[1]


def test_quarantine_plus_trusted_equals_input(spark, sf):
    for t in ("crm_atendimento", "crm_itens_pedido", "crm_pedidos"):
        b = layers.bronze(spark, sf, t)
        spec = EVENT_TABLES[t]
        assert sv.trusted(b, spec).count() + sv.quarantine(b, spec).count() == b.count()


def test_on_error_fail_raises(spark):
    import pytest
    spec = EVENT_TABLES["crm_pedidos"]
    bad = spark.createDataFrame([("P1", "C", "R", "ontem", "1,00", "x", "2026-07-01")],
                                "pedido_id string, cliente_id string, representante_id string, data_pedido string, "
                                "valor_total string, status_pedido string, data string")
    with pytest.raises(Exception):
        sv.cleanse(bad, spec, on_error="fail").collect()


def test_upsert_idempotent_and_bucket_scoped(spark, sf):
    path = fresh_path(spark, "upsert-test")
    orders = layers.silver(spark, sf, "crm_pedidos")
    tb.upsert(spark, orders.where("status_pedido <> 'aberto'"), path, "pedido_id", buckets=16)
    inc = orders.where("status_pedido = 'aberto'").limit(3)   # a tiny increment touches few buckets
    facts = tb.upsert(spark, inc, path, "pedido_id", buckets=16)
    assert facts["baldes_reescritos"] <= 3
    once = sorted(map(tuple, tb.read_table(spark, path).collect()), key=str)
    tb.upsert(spark, inc, path, "pedido_id", buckets=16)
    twice = sorted(map(tuple, tb.read_table(spark, path).collect()), key=str)
    assert once == twice
    assert tb.read_table(spark, path).count() == orders.where("status_pedido <> 'aberto'").count() + 3


def test_read_or_empty(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert tb.read_or_empty(spark, str(tmp_path / "nope.json"), schema).count() == 0


def test_flagship_unchanged_when_hot_keys_are_salted(spark, sf):
    """LOTE-X holds a seventh of all dispatch notes: it is hot at any size; salting more keys changes nothing."""
    from tidewater.operators.joins import SHARE_SETTING
    from tidewater.plans.catalog import QUERIES, hot_lots

    assert [r.lote_id for r in hot_lots(spark, sf).collect()] == ["LOTE-X"]
    plain = sorted(map(tuple, QUERIES["cold_chain"](spark, sf).collect()), key=str)
    spark.conf.set(SHARE_SETTING, "0.001")
    try:
        assert hot_lots(spark, sf).count() > 5
        salted = sorted(map(tuple, QUERIES["cold_chain"](spark, sf).collect()), key=str)
    finally:
        spark.conf.unset(SHARE_SETTING)
    assert salted == plain


def test_fefo_unchanged_when_centre_days_are_salted(spark, sf):
    from tidewater.operators.joins import SHARE_SETTING
    from tidewater.plans.catalog import QUERIES

    plain = sorted(map(tuple, QUERIES["fefo_compliance"](spark, sf).collect()), key=str)
    spark.conf.set(SHARE_SETTING, "0.001")          # every repeated (centre, day) and lot becomes hot
    try:
        salted = sorted(map(tuple, QUERIES["fefo_compliance"](spark, sf).collect()), key=str)
    finally:
        spark.conf.unset(SHARE_SETTING)
    assert salted == plain
