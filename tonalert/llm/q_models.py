"""Queries of the tokenizer and of the trained scorers (3, 8, 9, 10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.llm import compression_quality, lm_score, toxicity
from tonalert.llm.bpe import Tokenizer
from tonalert.llm.common import doc_fold, table
from tonalert.llm.registry import register
from tonalert.llm.sql import LM_SQL


def tokenizer(spark) -> Tokenizer:
    import public_tokenizers

    return Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def bpe_digests(tok: Tokenizer, docs):
    both = tok.decode(tok.encode(docs.select("doc_id", "text")).drop("text"))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    return bpe_digests(tokenizer(spark), table(spark, sf_dir, "documents"))


def _judged(scores, modulus, held_out, cut):
    fold = doc_fold(modulus)
    return scores.select("doc_id", (fold == held_out).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


@register("op3_compression_quality")
def op3_compression_quality(spark, sf_dir):
    scores = compression_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), doc_fold(3) != 1)
    return _judged(scores, 3, 1, 0.5)


@register("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    scores = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), doc_fold(4) != 2)
    return _judged(scores, 4, 2, 0.3)


@register("op10_lm_scores", LM_SQL)
def op10_lm_scores(spark, sf_dir):
    scores = lm_score.scored(table(spark, sf_dir, "documents"), doc_fold(5) != 1)
    return scores.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))
