"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks.

Every source's words form an axis, cut into blocks of equal length. Seats (one
seat = one block taken once) go to sources by highest quotients target/(2k+1).
The method is house-monotone, so the seats of the first s mix shards are the
apportionment of a smaller house, and each mix shard gets its own integer
quota. A quota is filled by whole passes over the source's blocks plus a seeded
choice of blocks for the rest. Everything is DataFrame and SQL functions.

Steps and their sizes: one row per source (targets, quotas); per source hash
buckets of bounded size for the running word count, so no source, however hot,
is ordered in one task; then the rows themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)             # by rank of the source, repeating
SHARE = 1.5                     # of all words
LIMIT = 2                       # a target stops at this multiple of its source
MIX_SHARDS = 8
BLOCKS = 256                    # blocks in the smallest positive target
SEED = 20240607
ONE = 1 << 20                   # of a document: shares of documents are multiples of 1/ONE
BUCKET_DIGITS = 2               # hex digits of the seeded order that make a bucket, at least
BUCKET_ROWS = 500_000           # expected rows of a bucket, at most: more digits for more rows
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, cap, target) from (source, size) rows.

    Sharing by weight with limits is filling up to one common level: the
    sources with the smallest cap/weight stop at their cap, the others get
    level * weight. Running sums over the sources in that order give the level
    for every number of stopped sources; the first that fits is the one.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(by_name) - 1) % len(WEIGHTS)) + 1)
    base = totals.select("source", "source_size", (F.row_number().over(by_name) - 1).alias("place"),
                         weight.cast("long").alias("weight"), (F.lit(LIMIT) * F.col("source_size")).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_rows = Window.partitionBy()
    run = base.select("*", F.sum("cap").over(by_ratio).alias("c"), F.sum("weight").over(by_ratio).alias("w"),
                      F.sum("source_size").over(all_rows).alias("total"), F.sum("weight").over(all_rows).alias("all_w"))
    # Level when the sources before this one have stopped at their caps.
    before = (F.lit(SHARE) * F.col("total") - (F.col("c") - F.col("cap"))) / (F.col("all_w") - (F.col("w") - F.col("weight")))
    tried = run.select("*", F.when(before <= F.col("cap") / F.col("weight"), before).alias("fit"))
    level = F.max("fit").over(Window.partitionBy())     # later ones that fit are lower
    return (tried.select("source", "place", "source_size", "weight", "cap", level.alias("level"))
            .withColumn("target", F.when(F.col("level").isNull(), F.col("cap").cast("double"))
                        .otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))))
            .drop("level"))


def source_quotas(targets: DataFrame, shards: int = MIX_SHARDS) -> DataFrame:
    """Per source: block length ``b``, ``blocks`` and the cumulative seats ``upto`` (array, by mix shard).

    For each house only seats near the divisor can be in doubt; those few per
    source are ranked by quotient, the seats below them are certain.
    """
    one = Window.partitionBy()
    t = (targets.withColumn("all", F.sum("target").over(one))
         .withColumn("b", F.greatest(F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(one) / BLOCKS), F.lit(1)).cast("long"))
         .withColumn("n_sources", F.count(F.lit(1)).over(one)))
    house = t.where("target > 0").select("*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("s"))
    house = house.withColumn("h", F.floor(F.floor(F.col("all") / F.col("b")) * F.col("s") / shards))
    exact = F.col("target") * F.col("h") / F.col("all")
    doubt = (F.ceil(2 * F.col("n_sources") * F.col("target") / F.col("all")) + 2).cast("long")
    house = (house.withColumn("sure", F.greatest(F.floor(exact + 0.5).cast("long") - doubt, F.lit(0)))
             .withColumn("open", F.col("h") - F.sum("sure").over(Window.partitionBy("s"))))
    seats = house.select("*", F.explode(F.sequence(F.col("sure"), F.col("sure") + 2 * doubt)).alias("k"))
    best = Window.partitionBy("s").orderBy((F.col("target") / (2 * F.col("k") + 1)).desc(), "place", "k")
    won = seats.withColumn("r", F.row_number().over(best))
    upto = (won.groupBy("place", "s", "sure").agg(F.count_if(F.col("r") <= F.col("open")).alias("more"))
            .groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("s", (F.col("sure") + F.col("more")).alias("q")))),
                                              lambda x: x["q"]).alias("upto")))
    blocks = F.ceil(F.col("source_size") / F.col("b")).cast("long")
    none = F.array_repeat(F.lit(0).cast("long"), shards)
    return (t.join(upto, "place", "left").withColumn("blocks", blocks)
            .withColumn("upto", F.transform(F.coalesce("upto", none), lambda q: F.least(q, LIMIT * F.col("blocks"))))
            .drop("all", "n_sources"))


def mix(docs: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """``docs`` (with ``source`` and a long ``size``) plus source_size, target and ``taken``.

    ``taken`` is the number of the row's words that the mix takes, repeats
    counted: the overlap of its stretch of the source's axis with each block,
    times how often the block is taken (0, 1 or 2). Rows of size 0 take 0; null
    sources are one source; equal rows are interchangeable; an empty table
    gives an empty result. Columns named like an added column are replaced.
    """
    docs = docs.drop("source_size", "target", "taken")
    plan = source_quotas(source_targets(docs.select("source", "size")))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    digits = max(BUCKET_DIGITS, math.ceil(math.log(max(docs.count(), 1) / BUCKET_ROWS, 16)))
    keyed = (docs.select(F.struct(*docs.columns).alias("_row"), "source", "size", order.alias("_o"))
             .withColumn("_b", F.substring("_o", 1, digits)))
    buckets = keyed.groupBy("source", "_b").agg(F.sum("size").alias("_w"))
    run = Window.partitionBy("source").orderBy("_b")
    starts = (buckets.withColumn("_s", F.sum("_w").over(run) - F.col("_w")).alias("x")
              .join(plan.alias("p"), F.expr("x.source <=> p.source"))
              .select(F.col("x.source").alias("_src"), F.col("_b").alias("_sb"), "_s", "p.source_size", "p.target",
                      "b", "blocks", "place", F.element_at("upto", -1).alias("q")))
    inside = Window.partitionBy("source", "_b").orderBy("_o", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (keyed.join(starts, F.expr("source <=> _src AND _b = _sb"))
           .withColumn("_end", F.col("_s") + F.sum("size").over(inside)))
    taken = F.expr(f"""
        CASE WHEN size = 0 THEN 0L ELSE aggregate(
          sequence((_end - size) div b, (_end - 1) div b), 0L,
          (acc, j) -> acc + (least(_end, (j + 1) * b) - greatest(_end - size, j * b))
            * (q div blocks + CASE WHEN pmod(pmod(j, blocks) * pmod(2147483647L, blocks) + {seed} + place, blocks)
                                        < q % blocks THEN 1 ELSE 0 END)) END""")
    return cut.select("_row.*", "source_size", "target", taken.cast("long").alias("taken"))


def with_targets(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``source`` and a long ``size``) plus source_size and target; ``repeat_documents`` mixes such rows first."""
    plan = source_targets(docs.select("source", "size")).select(F.col("source").alias("_src"), "source_size", "target")
    return docs.drop("source_size", "target").join(plan, F.expr("source <=> _src")).drop("_src")


def document_repeats(mixed: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Rows of a mix plus ``times``: how often the whole document appears, from the words of it that the mix takes.

    A row's share is taken / size. Per source, longest documents first and in
    seeded order among equals, the first i rows appear floor(their shares +
    offset) times together, the offset seeded per source in [0, 1). So a row of
    which nothing is taken never appears, one taken whole or twice appears once
    or twice; as sizes only fall along the order, the kept words of a source
    stay within one of its longest documents of the words taken, and meet them
    on average over the offsets. Shares are whole multiples of 1/ONE, summed
    exactly in any order. Rows without ``taken`` are mixed first; rows of size 0
    appear 0 times.
    """
    if "taken" not in mixed.columns:
        return document_repeats(mix(mixed, key, seed), key, seed).select(*mixed.columns, "times")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    digits = max(0, math.ceil(math.log(max(mixed.count(), 1) / BUCKET_ROWS, 16)))
    share = F.expr(f"CASE WHEN size > 0 THEN taken * {ONE}L div size ELSE 0L END")
    keyed = (mixed.select(F.struct(*mixed.columns).alias("_row"), "source", "size", share.alias("_n"), order.alias("_o"))
             .withColumn("_b", F.substring("_o", 1, digits)))
    # Running shares in three steps: sizes of a source, buckets of a size, rows of a bucket.
    buckets = keyed.groupBy("source", "size", "_b").agg(F.sum("_n").alias("_n"))
    sizes = buckets.groupBy("source", "size").agg(F.sum("_n").alias("_n"))
    longer = sizes.select(F.col("source").alias("_zs"), F.col("size").alias("_zz"),
                          (F.sum("_n").over(Window.partitionBy("source").orderBy(F.col("size").desc())) - F.col("_n")).alias("_longer"))
    inside = buckets.select(F.col("source").alias("_src"), F.col("size").alias("_sz"), F.col("_b").alias("_sb"),
                            (F.sum("_n").over(Window.partitionBy("source", "size").orderBy("_b")) - F.col("_n")).alias("_before"))
    starts = (inside.join(longer, F.expr("_src <=> _zs AND _sz = _zz"))
              .select("_src", "_sz", "_sb", (F.col("_longer") + F.col("_before")).alias("_start")))
    upto = F.sum("_n").over(Window.partitionBy("source", "size", "_b").orderBy("_o", "_n").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("source")), F.lit(ONE))
    placed = (keyed.withColumn("_upto", upto).join(starts, F.expr("source <=> _src AND size = _sz AND _b = _sb"))
              .withColumn("_end", F.col("_start") + F.col("_upto") + offset))
    times = F.expr(f"CAST(_end div {ONE}L - (_end - _n) div {ONE}L AS INT)")
    return placed.select("_row.*", times.alias("times"))


def repeat_documents(mixed: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Rows of a mix as whole documents: a row appears once, twice or not at all, by :func:`document_repeats`."""
    rows = document_repeats(mixed.select(F.struct(*mixed.columns).alias("_doc"), *[c for c in mixed.columns if c in {key, "source", "size", "taken"}]), key, seed)
    return rows.select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_t")).select("_doc.*")
