"""Queries of the near-duplicate, decontamination and archive operators (1, 2, 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.llm.common import table
from tonalert.llm.decontaminate import contaminated
from tonalert.llm.registry import register
from tonalert.llm.sql import BENCHMARK_SQL, NEAR_SQL, WARC_SQL
from tonalert.llm.superminhash import near_duplicates
from tonalert.llm.warc import read_archives, write_archives


@register("op6_benchmark_decontamination", BENCHMARK_SQL)
def op6_benchmark_decontamination(spark, sf_dir):
    hits = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words", F.size("hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"))


@register("op1_superminhash", NEAR_SQL)
def op1_superminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row_hash")


@register("op2_warc_packages", WARC_SQL)
def op2_warc_packages(spark, sf_dir):
    records = read_archives(write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
