"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return exactly
the columns of their input. Rows with nulls pass by the rules of each operator: a null text is an
empty one, and a row without an id is never a duplicate of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import line_dedup, parity_join, positional_index, raking, ranking
from marketlake.llm.common import listed, pack, row_key, shared_dir, stored, unpack
from marketlake.llm.queries import fold, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3; empty texts are scored like any other."""
    labels = table(spark, sf_dir, "labels")
    ranked = ranking.rank_quality(docs, labels, train=fold("doc_id", 5) != 0)
    return ranked.filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many documents share; `n_chars` is counted anew."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("bigint"))
    return cleaned.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the one with the smallest id.

    Rows that share an id are compared like any others: of equal or linked ones one stays, and one
    with an unrelated text stays too. Rows without an id stay.
    """
    rows = docs.select(
        pack(docs), *row_key("doc_id", "text"), F.col("text").alias("_text")
    )
    by_id = rows.groupBy("_id").agg(
        F.count("*").alias("_n"), F.min("_th").alias("_least"), F.max("_th").alias("_most")
    )
    shared = stored(by_id.filter((F.col("_n") > 1) & F.col("_id").isNotNull()))
    if shared.isEmpty():
        named = rows.withColumn("_name", F.col("_id"))
        repeated = None
    else:
        # The first text of an id goes by the id, others by a number beyond all ids.
        marked = rows.join(shared.select(F.col("_id").alias("_shared"), "_least"),
                           F.col("_id") == F.col("_shared"), "left")
        beyond = F.xxhash64("_id", "_th").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
        named = marked.withColumn(
            "_name", F.when(F.col("_th") != F.col("_least"), beyond).otherwise(F.col("_id"))
        ).select("_row", "_id", "_th", "_text", "_shared", "_name")
        repeated = F.col("_shared").isNotNull()
    with_id = named.filter(F.col("_id").isNotNull())
    classes = parity_join.jaccard_classes(
        with_id.select(F.col("_name").alias("doc_id"), F.col("_text").alias("text"))
    )
    # Few are dropped, so the texts that stay are not shuffled.
    later = classes.filter(F.col("doc_id") != F.col("component_id"))
    later = listed(later.select(F.col("doc_id").alias("_later")).distinct())
    chosen = with_id.join(later, F.col("_name") == F.col("_later"), "left_anti")
    if repeated is not None:
        once = chosen.filter(repeated).dropDuplicates(["_name"])
        chosen = chosen.filter(~repeated).select("_row").union(once.select("_row"))
    unnamed = named.filter(F.col("_id").isNull()).select("_row")
    return unpack(chosen.select("_row").union(unnamed), docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside an occurrence of a benchmark window."""
    judged = positional_index.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter("n_hit = 0").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents, with their topic, tokens, weight and probability.

    A document is there as many times as the sample has copies of it.
    """
    mixed = raking.mix_sources(docs).filter("sampled")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))
    repeated = mixed.select(pack(mixed), times.alias("_time"))
    return unpack(repeated, [c for c in mixed.columns if c not in ("sampled", "copies")])


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# No SQL: the classifier is fitted. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
