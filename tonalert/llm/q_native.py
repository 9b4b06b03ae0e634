"""Queries of the operators that use DataFrame functions only (4, 5, 7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.llm import quality_rules as qr
from tonalert.llm.common import stored, table, text_or_empty
from tonalert.llm.line_dedup import drop_lines, keep_bitmaps
from tonalert.llm.registry import register
from tonalert.llm.sharding import shards_by_bytes
from tonalert.llm.sql import LINE_SQL, QUALITY_SQL


@register("op4_quality_rules", QUALITY_SQL)
def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    features = stored(qr.with_features(docs).drop("text"), "quality-features")
    rules = qr.thresholds(features, table(spark, sf_dir, "labels"))
    return qr.with_verdict(features, rules).select("doc_id", *qr.COUNTS, "base_failed", "kept")


@register("op5_sharding")
def op5_sharding(spark, sf_dir):
    return shards_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op7_line_dedup", LINE_SQL)
def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_lines(docs, keep_bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))
