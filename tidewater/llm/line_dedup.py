"""Cross-site boilerplate lines by distinct-site spread.

Each line gets a 128-bit hash. HyperLogLog sketches of the sites that carry a
line are built per task and merged by aggregation. Lines whose estimate lies
clearly over or under the threshold are decided by it; lines near it get exact
distinct counts. Lines seen on at least ``MIN_SITES`` sites are boilerplate
and leave every document. Only hashes are shuffled up to that point; the text
moves once, for the rewrite. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SITES = 10
LG_K = 11                       # sketch precision: relative standard error 1.04 / sqrt(2**LG_K) = 2.3 %
BAND = 0.15                     # estimates within this share of the threshold are counted exactly
SALTS = 16                      # a line hash that many documents carry is spread over so many tasks


def _hashes(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias("_h1"), F.xxhash64(F.lit("second"), c).alias("_h2")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def salted(hashes: DataFrame) -> DataFrame:
    """Rows of distinct line hashes, once per salt."""
    return hashes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(_h1, _h2) of lines on at least ``min_sites`` distinct sites, from (_h1, _h2, _site, _salt) rows.

    ``_salt`` (0 to SALTS - 1) spreads the rows of one line in the exact recount.
    """
    key = ["_h1", "_h2"]
    spread = (lines.groupBy(*key).agg(F.hll_sketch_agg("_site", LG_K).alias("sketch"))
              .select(*key, F.hll_sketch_estimate("sketch").alias("sites"))
              .where(F.col("sites") >= min_sites * (1 - BAND)))
    near = spread.where(F.col("sites") <= min_sites * (1 + BAND)).select(*key)
    exact = (lines.join(salted(near), [*key, "_salt"], "left_semi").groupBy(*key, "_site").agg(F.lit(1).alias("one"))
             .groupBy(*key).agg(F.count("one").alias("sites")).where(F.col("sites") >= min_sites).select(*key))
    return spread.where(F.col("sites") > min_sites * (1 + BAND)).select(*key).unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, key: str = "doc_id") -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, plus n_lines and n_removed (long).

    A line is the text between line feeds, compared exactly; empty lines stay,
    and so do lines of white space only. A null text counts as one empty line
    and stays null; a null source counts as one site; equal rows are treated
    alike; an empty table gives an empty result. Columns named n_lines or
    n_removed are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    row_key = F.xxhash64(F.lit("row"), F.col(key), F.col("text"))
    lines = (docs.select(row_key.alias("_row"), F.coalesce(F.col("source"), F.lit("\0null")).alias("_site"),
                         F.explode(F.array_distinct(_lines(F.col("text")))).alias("_line"))
             .where(F.trim("_line") != "")
             .select("_row", "_site", F.pmod("_row", F.lit(SALTS)).cast("int").alias("_salt"), *_hashes(F.col("_line"))))
    bad = boilerplate_lines(lines.select("_h1", "_h2", "_site", "_salt"), min_sites)
    # Few lines are boilerplate, but one of them may be in a third of all documents: spread it by salt.
    hits = (lines.join(salted(bad), ["_h1", "_h2", "_salt"])
            .groupBy("_row").agg(F.collect_set("_h1").alias("_bad")))
    whole = docs.select(F.struct(*docs.columns).alias("_all"), row_key.alias("_row"))
    found = whole.join(hits, "_row", "left")
    split = _lines(F.col("_all.text"))
    kept = F.filter(split, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_bad"), F.xxhash64(x)))
    text = F.when(F.col("_bad").isNull(), F.col("_all.text")).otherwise(F.array_join(kept, "\n"))
    n = F.size(split).cast("long")
    left = F.when(F.col("_bad").isNull(), n).otherwise(F.size(kept).cast("long"))
    return found.select(*[text.alias("text") if c == "text" else F.col(f"_all.`{c}`").alias(c) for c in docs.columns],
                        n.alias("n_lines"), (n - left).alias("n_removed"))
