"""One query per text operator: (spark, folder of the given tables) to a DataFrame of digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rallybook.llm import (
    decontaminate,
    divergence,
    exact_dedup,
    hard_negatives,
    licenses,
    mixing,
    near_dedup,
    neighbours,
    quality_rules,
    token_counts,
    toxicity,
    url_filter,
    weak_quality,
)
from rallybook.llm.oracle import ORACLE_SQL  # noqa: F401, read with the queries
from rallybook.sources.scratch import work_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.repeated_passages(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    folder = work_folder(spark)
    token_counts.write_token_files(table(spark, sf_dir, "documents"), f"{folder}/tokens", nameless=True)
    head = token_counts.ID_TOKENS
    found = token_counts.separator_scan(spark, f"{folder}/tokens", head=head)
    return found.select(
        token_counts.from_id_tokens(F.col("first")).alias("doc_id"), (F.col("n_tokens") - head).alias("n_tokens")
    )


def op4_mixing(spark, sf_dir):
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "held_out", "score", "predicted")


def op6_licenses(spark, sf_dir):
    rows = licenses.license_matches(table(spark, sf_dir, "documents"))
    names = F.sort_array(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    first = F.array_min(F.transform("matches", lambda m: m["word"]))
    return rows.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"), first.alias("first_word")
    )


def op7_decontamination(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_url_filter(spark, sf_dir):
    pages = f"parquet.`{sf_dir}/pages.parquet`"
    day = F.date_from_unix_date("n").alias("day")
    captures = spark.sql(url_filter.CAPTURES_SQL.format(pages=pages)).select("page_id", "url", day)
    hosts = url_filter.HOSTS_SQL.format(pages=pages)
    entries = spark.sql(f"with hosts as ({hosts}) {url_filter.ENTRIES_SQL}").select("pattern", day, "listed")
    rows = url_filter.filtered(captures, entries)
    return rows.select("page_id", "host", F.col("day").alias("fetched"), "n_active", "matched", "blocked")


def op9_weak_quality(spark, sf_dir):
    return weak_quality.classified(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    rows = quality_rules.judged(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    moved = F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False))
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(moved, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_neighbours(spark, sf_dir):
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_decontamination": op7_decontamination,
    "op8_url_filter": op8_url_filter,
    "op9_weak_quality": op9_weak_quality,
    "op10_quality_rules": op10_quality_rules,
    "op11_divergence": op11_divergence,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_neighbours": op13_neighbours,
}
