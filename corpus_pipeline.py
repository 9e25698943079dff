"""A corpus pipeline of five stages over ``documents``.

1. quality: documents that the co-trained classifier rejects go.
2. near_duplicates: one document of each near-duplicate class stays.
3. decontaminate: benchmark passages are cut out; documents of which nothing is left go.
4. mix: sources are brought to their target weights; documents are left out or repeated.
5. shard: documents get a shard and a slot along a Hilbert curve over their metadata.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; each works on all
that the stage before it kept, written as Parquet and read again. All but the
last return the columns of ``docs``, whatever they are; ``doc_id``, ``text``,
``lang``, ``source`` and ``n_chars`` have to be among them. Nulls, empty texts,
repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import table, written

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewater.llm.quality import fit_quality, score_quality

    own = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "source", "lang", "n_chars", "text")
    model = fit_quality(own.drop("_doc"), table(spark, sf_dir, "labels"))
    return score_quality(own, model).where("keep").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewater.llm.jaccard_join import keep_one

    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewater.llm.decontaminate import contamination, remove_spans

    clash = [c for c in docs.columns if c.lower() in ("n_words", "n_hit", "spans", "items", "_more")]
    own = docs.select(*[c for c in docs.columns if c not in clash], F.struct(*clash).alias("_more")) if clash else docs
    left = remove_spans(contamination(own, table(spark, sf_dir, "benchmark")))
    return left.select(*[F.col(f"_more.`{c}`").alias(c) if c in clash else F.col(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewater.llm import mixing

    # The key tells texts under one id, or under none, apart. Words are counted once and mixed without the texts.
    text, source = F.col("text"), F.col("source")
    key = F.xxhash64("doc_id", text, source, text.isNull(), source.isNull())
    sizes = written(spark, docs.select(key.alias("doc_id"), "source", mixing.word_count(text).alias("size")), "sizes")
    mixed = written(spark, mixing.mix(sizes), "mixed")
    # Rows of one key are equal to the mix: what they appear together is dealt out evenly.
    times = (mixing.document_repeats(mixed).groupBy(F.col("doc_id").alias("_k")).agg(F.count(F.lit(1)).alias("_rows"), F.sum("times").alias("_times"))
             .where("_times > 0"))
    number = F.row_number().over(Window.partitionBy("_k").orderBy("_doc.lang", "_doc.n_chars"))
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), key.alias("_k")).withColumn("_i", number).join(times, "_k")
    own = F.expr("CAST(_times div _rows + CASE WHEN _i <= _times % _rows THEN 1 ELSE 0 END AS INT)")
    return rows.select("_doc", F.explode(F.array_repeat(F.lit(0), own)).alias("_t")).select("_doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewater.llm.sharding import hilbert_shards

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return hilbert_shards(docs, SHARDS, F.octet_length(text) + 1, F.crc32(text)).drop("_place")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: The stages learn, sample by hash and follow a curve: SQL can't express them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
