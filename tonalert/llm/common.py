"""Helpers shared by the pipeline operators: table reading, shared-folder tables, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalert.session import scratch_path

# ASCII white space that separates words: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once, lineage cut,
    and no executor holds the only copy."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def doc_fold(modulus: int, doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a NULL id counts as the empty string)."""
    key = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % modulus
