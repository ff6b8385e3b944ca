"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

1. quality: documents that the classifier, trained on the labels, scores below its threshold go.
2. near-duplicates: of each component of the n-gram Jaccard join (five words, 80 %) one row stays,
   the smallest by doc_id (nulls last) and text hash; rows without words all stay, once each.
3. decontamination: documents that contain a benchmark item go.
4. mixing: the rows that the mix takes, one for each copy, shard by shard.
5. tokens: the mix is written as token ids and described as read back.

Stages keep the columns of documents up to the mix. Null and empty texts have no words: the first
stage judges them by the bias, and the mix, which is one of words, leaves them out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainlattice.llm import decontamination, jaccard_join, mixing, quality_model, token_output
from chainlattice.llm.common import durable, table
from chainlattice.llm.queries import held_out

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out())
    weights = quality_model.train(table(spark, sf_dir, "documents", "doc_id", "text"), labels)
    return quality_model.score(docs.select(*COLUMNS), weights, column="__score").where(F.col("__score") >= quality_model.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard_join.link(docs.select("doc_id", "text"), width=5, percent=80)
    kept = groups.where("is_first").select(F.col("doc_id").alias("own_id"), F.col("print").alias("own_print")).distinct()
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("__print"))
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("__print") == F.col("own_print"))
    once = Window.partitionBy("doc_id", "__print").orderBy(F.lit(0))
    return rows.join(kept, same, "left_semi").withColumn("__copy", F.row_number().over(once)).where("__copy = 1").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("mixing", mix), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
