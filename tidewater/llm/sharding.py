"""Sharding along a Hilbert curve over metadata columns.

Four metadata columns are quantised to 2**BITS levels each: numbers at
approximate quantiles found in one mergeable aggregate, texts at cuts between
whole values, by the running row counts of their distinct values in byte order
(values that share a long prefix still get levels of their own). A row's cell in that grid gets its
place on the Hilbert curve; rows sort by (curve place, id) and the sorted
sequence is cut into ``n_shards`` runs whose counts differ by at most one (law
``rows``). Neighbours on the curve are close in every dimension, so the files
of a shard have narrow min/max ranges in all columns and whole files can be
skipped by filters on any of them.

No global sort runs in one task: places come from a histogram over cells (at
most 2**(4*BITS) of them) and finer slices of the id range inside each cell,
and a row's number is counted only inside its slice. A cell that holds many
rows (a hot source) is split by the id dimension and by the slices, whose
number grows with the input.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS = 4                        # levels per dimension: 2**BITS
DIMENSIONS = 4                  # lang, source, size, id: the cell table has 2**(BITS*DIMENSIONS) rows
ROWS_PER_SLICE = 200_000        # expected rows of an average slice of a fully loaded grid line
ACCURACY = 2000                 # of the approximate quantiles


def hilbert_order(bits: int, dims: int) -> np.ndarray:
    """Curve place of every grid cell; entry c is for the cell whose coordinates are c's base-2**bits digits.

    Coordinates become the curve's transposed index by undoing the excess
    turns from the highest bit down (exchange or invert the lower bits), then
    Gray decoding across the dimensions.
    """
    side, cells = 1 << bits, 1 << (bits * dims)
    code = np.arange(cells)
    x = [(code >> (bits * (dims - 1 - d))) & (side - 1) for d in range(dims)]
    q = side >> 1
    while q > 1:
        low = q - 1
        for d in range(dims):
            up = (x[d] & q) != 0
            turn = np.where(up, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ turn)
            if d:
                x[d] = x[d] ^ turn
        q >>= 1
    for d in range(1, dims):
        x[d] = x[d] ^ x[d - 1]
    flips = np.zeros(cells, dtype=np.int64)
    q = side >> 1
    while q > 1:
        flips = np.where((x[dims - 1] & q) != 0, flips ^ (q - 1), flips)
        q >>= 1
    x = [v ^ flips for v in x]
    place = np.zeros(cells, dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            place = (place << 1) | ((x[d] >> b) & 1)
    return place


def text_cuts(rows: DataFrame, columns: list[str]) -> list[list[str]]:
    """Per text column, the whole values (fewer than 2**BITS) that begin a new level; null counts as ''.

    A value's level is the share of rows with smaller values. Distinct values
    lie in ranges of their own order, so running counts meet in no one task,
    however many values there are; only the cuts come to the driver.
    """
    spark = rows.sparkSession
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_dim"), F.coalesce(F.col(c), F.lit("")).alias("_value")) for i, c in enumerate(columns)]))
    counts = rows.select(each.alias("_e")).select("_e.*").groupBy("_dim", "_value").agg(F.count(F.lit(1)).alias("_n"))
    dealt = (counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_dim", "_value")
             .withColumn("_range", F.spark_partition_id()))
    dealt = written(spark, dealt, "values")
    ranges = dealt.groupBy("_dim", "_range").agg(F.sum("_n").alias("_rn"))          # one row per range and column at most
    of_dim = Window.partitionBy("_dim")
    starts = ranges.select("_dim", "_range", (F.sum("_rn").over(of_dim.orderBy("_range")) - F.col("_rn")).alias("_start"),
                           F.sum("_rn").over(of_dim).alias("_total"))
    inside = F.sum("_n").over(Window.partitionBy("_dim", "_range").orderBy("_value")) - F.col("_n")
    levels = (dealt.withColumn("_inside", inside).join(starts, ["_dim", "_range"])
              .withColumn("_level", F.floor((F.col("_start") + F.col("_inside")) * F.lit(1 << BITS) / F.col("_total"))))
    cuts: list[list[str]] = [[] for _ in columns]
    for r in levels.where("_level > 0").groupBy("_dim", "_level").agg(F.min("_value").alias("_value")).collect():
        cuts[r["_dim"]].append(r["_value"])
    return [sorted(x) for x in cuts]


def level(value: Column, cuts: list, inclusive: bool = False) -> Column:
    """How many cuts lie below ``value`` (or at it, if ``inclusive``); null is level 0."""
    total = F.lit(0)
    for c in cuts:
        total = total + F.when(value >= F.lit(c) if inclusive else value > F.lit(c), 1).otherwise(0)
    return total


def hilbert_shards(docs: DataFrame, n_shards: int, size: Column, tie: Column,
                   lang: str = "lang", source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` plus ``_place`` (long, 0-based rank), ``shard`` (int) and ``slot`` (long, gapless from 0).

    ``size`` is a numeric column, ``tie`` any column that orders rows of equal
    id. Nulls in any dimension count as its lowest level; equal rows take
    consecutive places; an empty table gives an empty result. Columns of
    ``docs`` named like an added column are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("_place", "shard", "slot")
    coded = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_id"),
                        F.struct(F.col(lang).alias("d0"), F.col(source).alias("d1"), size.cast("double").alias("d2"),
                                 F.col(key).cast("double").alias("d3")).alias("_dims"),
                        tie.alias("_tie"))
    side = 1 << BITS
    parts = [i / side for i in range(1, side)]
    stats = coded.agg(F.count(F.lit(1)).alias("n"), F.min("_dims.d3").alias("lo"), F.max("_dims.d3").alias("hi"),
                      *[F.percentile_approx(f"_dims.{d}", parts, ACCURACY).alias(d) for d in ("d2", "d3")]).first()
    n = stats["n"]
    sizes, ids = ([float(v) for v in sorted(set(stats[d] or []))] for d in ("d2", "d3"))
    texts = text_cuts(docs, [lang, source])
    levels = [level(F.coalesce(F.col(f"_dims.d{i}"), F.lit("")), texts[i], inclusive=True) for i in range(2)]
    levels += [level(F.col("_dims.d2"), sizes), level(F.col("_dims.d3"), ids)]
    cell = F.lit(0)
    for x in levels:
        cell = cell * side + x
    # Slices of the id range: monotone in the id, so slices and ids give one order. They are linear between the id's
    # quantiles, so an outlying id stretches no slice but those of the last level. Null ids spread by the tie.
    fine = max(1, -(-n // (ROWS_PER_SLICE * side)))
    edges = [stats["lo"] or 0.0, *ids, stats["hi"] or 0.0]
    at = F.get(F.array(*[F.lit(float(e)) for e in edges[:-1]]), F.col("_idlevel"))
    span = F.get(F.array(*[F.lit(max(b - a, 0.0) + 1.0) for a, b in zip(edges, edges[1:])]), F.col("_idlevel"))
    slice_ = F.coalesce(F.col("_idlevel") * fine + F.floor((F.col("_dims.d3") - at) / span * fine),
                        -1 - F.pmod(F.xxhash64("_tie"), F.lit(side * fine)))
    # A fixed table of 2**(BITS*DIMENSIONS) rows: small enough to broadcast at any input size.
    order = spark.createDataFrame(
        [(c, int(p)) for c, p in enumerate(hilbert_order(BITS, DIMENSIONS))], "_cell int, _curve int")
    placed = (coded.withColumn("_cell", cell.cast("int")).withColumn("_idlevel", levels[3].cast("int"))
              .withColumn("_slice", slice_.cast("long"))
              .join(F.broadcast(order), "_cell").drop("_cell", "_idlevel", "_dims"))
    counts = placed.groupBy("_curve", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    cells = (counts.groupBy("_curve").agg(F.sum("_n").alias("_cn"))
             .select("_curve", (F.sum("_cn").over(Window.orderBy("_curve")) - F.col("_cn")).alias("_base")))
    inside = Window.partitionBy("_curve").orderBy("_slice")
    starts = (counts.join(F.broadcast(cells), "_curve")       # at most one row per grid cell
              .select("_curve", "_slice",
                      (F.col("_base") + F.sum("_n").over(inside) - F.col("_n")).alias("_start")))
    rank = Window.partitionBy("_curve", "_slice").orderBy(F.col("_id").asc_nulls_first(), "_tie")
    whole = F.lit(max(n, 1)).cast("long")
    return (placed.join(starts, ["_curve", "_slice"])
            .withColumn("_place", F.col("_start") + F.row_number().over(rank) - 1)
            .withColumn("shard", (((F.col("_place") + 1) * n_shards - 1) / whole).cast("long").cast("int"))
            .withColumn("slot", F.col("_place") - F.floor(whole * F.col("shard") / F.lit(n_shards)).cast("long"))
            .select("_row.*", "_place", "shard", "slot"))
