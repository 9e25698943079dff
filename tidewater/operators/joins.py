"""Join helpers that stay safe when one key holds a large share of the rows.

* Catalogue sides carry no broadcast hint: Spark broadcasts a side by its
  measured bytes (``autoBroadcastJoinThreshold``), at planning or, for a side
  that only turns out small, at run time; else AQE splits skewed partitions of
  the shuffle join (both settings are pinned in ``session.prepare``).
* :func:`heavy_hitters` finds the keys of a large side that hold more than a
  share of a fair partition's rows, whatever the size of the table, with a
  map-side combined aggregate. There can be no more such keys than partitions
  divided by that share, so the set is small by proof and is never collected:
  it stays a step of the plan that uses it.
* :func:`lookup_join` joins a large fact to a side that is unique on the key.
  A hot key gets as many salts as it holds fair partitions, and the unique side
  is replicated as often for it; NULL keys (which never match but would all
  hash to one reducer) are spread over all partitions. The result equals a
  plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than this share of rows / shuffle partitions.
HOT_SHARE = 0.5
SHARE_SETTING = "tidewater.skew.share"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_hitters(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """(key, _salts): keys with more than ``share`` of a fair partition's rows, and how many pieces to cut each into.

    Lazy and bounded: n keys with more than share * rows / partitions rows each
    need n < partitions / share. The count is partially aggregated before the
    shuffle, so a key with a third of all rows costs one row per input partition.
    """
    share = share or float(df.sparkSession.conf.get(SHARE_SETTING, str(HOT_SHARE)))
    parts = _partitions(df)
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    piece = counts.agg(F.sum("_n")).scalar() * F.lit(share / parts)
    return (counts.where(F.col(key).isNotNull() & (F.col("_n") > piece))
            .select(key, F.least(F.ceil(F.col("_n") / piece), F.lit(4 * parts)).cast("int").alias("_salts")))


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
                hot: DataFrame | list | None = None, hot_part=None) -> DataFrame:
    """``fact JOIN dim USING (key)`` where ``dim`` is unique on ``key``.

    ``hot`` are the hot keys (from :func:`heavy_hitters`, possibly on a base
    table upstream of ``fact``, or a list of known keys, [] for none); if
    omitted they are found on ``fact``.
    ``hot_part`` maps the key column to the part that ``hot`` is expressed in
    (e.g. a prefix of a composite key), for when hot groups are detected on a
    cheaper, coarser key upstream.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    parts = _partitions(fact)
    hot = heavy_hitters(fact, key) if hot is None else hot
    if isinstance(hot, list):       # plain keys: as many salts as may be, since nothing is known of their shares
        hot = fact.sparkSession.createDataFrame([(k, parts) for k in hot], T.StructType([fact.schema[key], T.StructField("_salts", T.IntegerType())]))
    hot = F.broadcast(hot.select(F.col(hot.columns[0]).alias("_hk"), "_salts"))     # fewer rows than partitions / share
    probe = (hot_part or (lambda k: k))(F.col(key))
    salts = F.coalesce("_salts", F.lit(1))
    spread = F.xxhash64(*[F.col(c) for c in fact.columns])
    salt = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(parts))).otherwise(F.pmod(spread, salts)).cast("int")
    f = fact.join(hot, probe == F.col("_hk"), "left").withColumn("_salt", salt).drop("_hk", "_salts")
    d = dim.join(hot, probe == F.col("_hk"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_hk", "_salts")
    # hash(key) leads the join keys: the sort-merge join then sorts on a long
    # prefix instead of string keys that share their first bytes.
    f = f.withColumn("_h", F.xxhash64(key))
    d = d.withColumn("_h", F.xxhash64(key))
    return f.join(d, ["_h", key, "_salt"], how).drop("_salt", "_h")
