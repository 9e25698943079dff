"""Merkle manifest of a dataset, kept as content-addressed records, with inclusion proofs.

A leaf is the SHA-256 of a row. Per source the leaves, in order of their ids,
are hashed in runs of ``FAN`` until one node remains, the subroot; subroots in
order of their source give the root the same way. What is stored are records
digest -> children, one table per level, equal digests once.

Proofs come by descent. The place of a leaf (its source's rank and its rank in
the source) is a path of base-16 digits. Requests start at the root; at each
level the digest at hand is looked up in the records, the next digit selects a
child, the children that were not selected become a segment of the path, and
the segments are reversed at the end. Requests that share their digits so far
travel as one row (a node), so the root is no hot key, and only nodes with a
request below them are followed; the last record of a path serves its up to
``FAN`` requests in one join. No level is gathered in the driver for a
broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .ranks import ranked

FAN = 16                        # children per node
BITS = 4                        # of a digit
PATH = "array<struct<l: string, r: string>>"


def digest(*texts) -> Column:
    """SHA-256, in lowercase hex, of texts put one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(c: Column) -> Column:
    """A value in a form that no other value has: ``-`` for null, else its byte count, a colon and the value."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def _height(n: Column) -> Column:
    """Levels of runs above ``n`` nodes."""
    return sum((F.when(n > FAN ** k, 1).otherwise(0) for k in range(15)), F.lit(0))


@dataclass
class Manifest:
    """A stored tree: ``leaves`` (the given columns, source rank ``s``, place ``rank``), ``sources`` (s, n, height, subroot),
    ``top`` and ``below`` (records by level, from the level above the leaves upwards), ``root`` (None of an empty table)."""

    leaves: DataFrame
    sources: DataFrame
    below: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def _levels(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs upon runs of (s, rank, n, digest) until each s has one node: the written levels, and the last nodes (s, digest)."""
    spark, levels = nodes.sparkSession, []
    last = nodes.where("n = 1").select("s", "digest")
    while most > 1:
        # At most FAN children meet; a hot source is spread over its runs.
        run = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        up = (nodes.where("n > 1")
              .groupBy("s", F.shiftright("rank", BITS).alias("rank"), F.ceil(F.col("n") / FAN).cast("long").alias("n"))
              .agg(run.alias("run")).select("s", "rank", "n", F.col("run.digest").alias("children"))
              .withColumn("digest", digest(F.array_join("children", ""))))
        nodes = written(spark, up, "merkle-level")
        levels.append(nodes)
        last = last.unionByName(nodes.where("n = 1").select("s", "digest"))
        most = -(-most // FAN)
    return levels, last


def build(rows: DataFrame, source: str = "source", key: str = "doc_id", leaf: str = "leaf") -> Manifest:
    """The manifest over rows that carry a leaf digest.

    Sources are ordered null first and by their UTF-8 bytes; inside a source
    rows go by ``key``, null first, and equal keys by their digest. Repeated
    rows are leaves of their own. An empty table has no root.
    """
    spark = rows.sparkSession
    # Names of this module's own: any column of rows may be called as they like.
    given = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(source).alias("_source"), F.col(key).alias("_key"), F.col(leaf).alias("digest"))
    leaves = ranked(given, ["_source"], ["_key", "digest"], "rank")
    sizes = leaves.groupBy("_source").agg(F.count(F.lit(1)).alias("n"))
    sources = written(spark, ranked(sizes, [], ["_source"], "s"), "merkle-sources")
    facts = sources.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("n")).first()
    named = sources.withColumnRenamed("_source", "_named")
    leaves = written(spark, leaves.join(named, F.col("_source").eqNullSafe(F.col("_named"))).select("row", "s", "rank", "n", "digest"), "merkle-leaves")
    below, roots = _levels(leaves.select("s", "rank", "n", "digest"), facts["most"] or 0)
    sources = written(spark, sources.join(roots, "s").select("s", "n", _height(F.col("n")).alias("height"), F.col("digest").alias("subroot")), "merkle-subroots")
    top, last = _levels(sources.select(F.lit(0).cast("long").alias("s"), F.col("s").alias("rank"), F.lit(facts["n"]).cast("long").alias("n"),
                                       F.col("subroot").alias("digest")), facts["n"])
    root = last.first()
    return Manifest(leaves, sources, [_records(x) for x in below], [_records(x) for x in top], root["digest"] if root else None)


def _records(level: DataFrame) -> DataFrame:
    """The level's records: equal digests have equal children, so any copy serves."""
    return level.groupBy("digest").agg(F.first("children").alias("children"))


def _segment(children: str, pos: str) -> Column:
    """The children that were not selected: those to the left and those to the right of ``pos``, joined."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), F.col(pos)), "").alias("l"),
                    F.array_join(F.slice(children, F.col(pos) + 2, F.lit(FAN)), "").alias("r"))


def _meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join whose sides are shuffled and merged. Spark counts an array as one element and a level as no larger than the one
    above it; a broadcast chosen by such a size would bring a whole level, with its paths, to the driver."""
    return left.join(right.hint("merge"), on, how)


def _down(state: DataFrame, records: DataFrame, wanted: DataFrame, on: list[str], keep: list[str]) -> DataFrame:
    """One digit further: look the digests up, select the children with a request below, note the others."""
    opened = (_meet(state, records, "digest").select(*keep, "place", "path", "children", F.posexplode("children").alias("pos", "child"))
              .select(*keep, (F.col("place") * FAN + F.col("pos")).alias("place"), F.col("child").alias("digest"),
                      F.concat("path", F.array(_segment("children", "pos"))).alias("path")))
    return _meet(opened, wanted, on, "left_semi")


def proofs(tree: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Inclusion proofs of the requested leaves: columns of ``requests``, ``subroot`` and ``path``.

    ``requests`` are rows with (s, rank) as in ``tree.leaves`` (all of these by
    default). ``path`` lists per level, from the leaf upwards, the siblings to
    the left and to the right, joined; a leaf that is its own root has none. A
    request for a place that does not exist gives no row. Columns of
    ``requests`` named like an added one are replaced.
    """
    requests = tree.leaves if requests is None else requests
    spark = requests.sparkSession
    columns = [c for c in requests.columns if c.lower() not in ("s", "rank", "subroot", "path")]
    requests = requests.select("s", "rank", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in columns]).alias("_own"))
    state = spark.range(1 if tree.root else 0).select(
        F.lit(tree.root).cast("string").alias("digest"), F.lit(0).cast("long").alias("place"), F.array().cast(PATH).alias("path"))
    runs = written(spark, requests.groupBy("s", F.shiftright("rank", BITS).alias("run")).agg(F.lit(1).alias("_one")), "merkle-requests")
    for k in range(len(tree.top) - 1, -1, -1):
        wanted = runs.select(F.shiftright("s", BITS * k).alias("place")).distinct()
        state = _down(state, tree.top[k], wanted, ["place"], [])
        if k:
            state = written(spark, state, "merkle-down")
    state = _meet(state.withColumnRenamed("place", "s"), tree.sources.select("s", "height", "subroot"), "s")
    state = written(spark, state.select("s", "height", "subroot", F.lit(0).cast("long").alias("place"), "digest", "path"), "merkle-top")
    at = None
    for k in range(len(tree.below) - 1, 0, -1):         # heights above a run
        here = state.where(F.col("height") == k + 1)
        at = here if at is None else at.unionByName(here)
        wanted = runs.select("s", F.shiftright("run", BITS * (k - 1)).alias("place")).distinct()
        at = _down(at, tree.below[k], wanted, ["s", "place"], ["s", "height", "subroot"])
        if k > 1:           # a plan of one level at a time; the last level, which has a row per run, goes on unwritten
            at = written(spark, at, "merkle-down")
    # A run's record, or the lone leaf of a source, which is its subroot.
    ends = state.where("height = 0").withColumn("children", F.array("digest"))
    if tree.below:
        runs_here = state.where("height = 1")
        at = runs_here if at is None else at.unionByName(runs_here)
        ends = ends.unionByName(_meet(at, tree.below[0], "digest"), allowMissingColumns=True)
    ends = ends.select("s", F.col("place").alias("run"), "height", "subroot", "children", "path")
    found = (_meet(requests.withColumn("run", F.shiftright("rank", BITS)), ends, ["s", "run"])
             .withColumn("_pos", (F.col("rank") % FAN).cast("int")).where(F.col("_pos") < F.size("children")))
    whole = F.when(F.col("height") > 0, F.concat("path", F.array(_segment("children", "_pos")))).otherwise(F.col("path"))
    return found.select("s", "rank", *[F.col(f"_own.`{c}`") for c in columns], "subroot", F.reverse(whole).alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings give."""
    return F.aggregate(path, leaf, lambda at, x: digest(x["l"], at, x["r"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, joined."""
    return F.aggregate(path, F.lit(""), lambda at, x: F.concat(at, x["l"], x["r"]))
