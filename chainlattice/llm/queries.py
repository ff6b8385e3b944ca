"""Queries of the training-data operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import change_applier, decontamination, jaccard_join, license_scan, line_dedup, mixing, pii, prefix_trie, quality_model, quality_rules, secret_scan, token_output, url_filter
from . import spans as S
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup(table(spark, sf_dir, "documents", "doc_id", "text"), tails=True)
    return done.select("doc_id", "n_lines", "n_removed", "n_chunks", F.sha2("text", 256).alias("text_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.samples(spark)))
    return found.select(
        "doc_id",
        *[S.count(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(S.listed(F.col("base")), 256).alias("base_sha256"),
        S.listed(S.by_start(F.concat("base", "added"))).alias("spans"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        *[S.count(F.col("base"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(S.listed(F.col("base")), 256).alias("base_sha256"),
        S.listed(S.by_kind(F.concat("base", "added"))).alias("spans"),
    )


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents", "doc_id", "text"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    weights = quality_model.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out()))
    scored = quality_model.score(docs, weights)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def op11_change_applier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_applier.apply(table(spark, sf_dir, "client_changes"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    words, listed = F.col("places.first_word"), lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*c))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(words).cast("long").alias("first_word"),
        F.array_max(words).cast("long").alias("last_word"),
        listed("places.label").alias("base_labels"),
        listed("places.label", "matches.label").alias("labels"),
        "score",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.col("conv_id")
    seqs = prefix_trie.sequences(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return prefix_trie.trie(prefix_trie.rebuilt(seqs, own - own % 100, (F.crc32(own.cast("string").cast("binary")) % 6).cast("int")))


QUERIES = {"op13_prefix_trie": op13_prefix_trie, "op11_change_applier": op11_change_applier, "op12_license_scan": op12_license_scan, "op1_line_dedup": op1_line_dedup, "op7_decontamination": op7_decontamination, "op2_jaccard_join": op2_jaccard_join, "op3_secret_scan": op3_secret_scan, "op4_pii": op4_pii, "op5_mix": op5_mix, "op6_token_output": op6_token_output, "op8_quality_rules": op8_quality_rules, "op10_quality_model": op10_quality_model, "op9_url_filter": op9_url_filter}
ORACLE_SQL = {"op2_jaccard_join": jaccard_join.ORACLE, "op9_url_filter": url_filter.ORACLE}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
