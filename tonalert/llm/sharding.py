"""Operator 5, sharding by sampled splitters (DataFrame functions only).

Law ``bytes``: documents are put in the order of (hash of the text, hash of the id), and shard i
gets those whose middle byte lies in the i-th of N equal parts of all bytes, so two shards differ by
about one document. Equal texts are neighbours; a group of copies larger than a shard is divided.

That order is never sorted in one place. A size-weighted sample of keys (each row is drawn with a
probability in proportion to its size, decided by a hash) gives quantile boundaries; rows are dealt to the
ranges between them, ranges that hold more than MAX_ROWS rows are divided again by a sample of their
own, and only then are rows ranked, each range by itself. Range totals, one row per range, turn
ranks into places in the whole order.

The boundaries change nothing in the result, only how the work is divided. Edge cases: a NULL text has
size 1 and the checksum of the empty text; NULL ids and repeated rows are put in place like others
(rows equal in text and id by their place in the input); no rows give no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tonalert.llm.common import stored, text_or_empty
from tonalert.operators.joins import checked_broadcast

SHARDS = 8
PARTS = 64  # most ranges that one range is divided into at a time
DRAWS = 16  # sampled keys per new range
MAX_ROWS = 1_000_000  # a range with more rows is divided again
MIN_RANGES = 64
_KEY = ["text_hash", "id_hash", "rid"]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the order key of every row: one pass over the texts."""
    t = text_or_empty()
    return docs.select(
        "doc_id", (F.octet_length(t).cast("bigint") + 1).alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("text_hash"), F.xxhash64("doc_id").alias("id_hash"), F.monotonically_increasing_id().alias("rid"))


def _key():
    return F.struct(*_KEY)


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def splitters(rows: DataFrame, totals: DataFrame, seed: int) -> DataFrame:
    """Per range of ``totals`` (range, bytes, parts) its ascending boundaries, at most parts - 1.
    The sample has about DRAWS * parts keys per range, PARTS * DRAWS at most in expectation."""
    drawn = rows.join(checked_broadcast(totals, materialize=False), "range")
    u = F.pmod(F.xxhash64(F.lit(seed), *_KEY), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = drawn.where(u * F.col("bytes") < F.col("size") * F.col("parts") * DRAWS)
    per = drawn.groupBy("range").agg(F.first("parts").alias("parts"), F.sort_array(F.collect_list(_key())).alias("keys"))
    at = F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda i: F.get("keys", (i * F.size("keys") / F.col("parts")).cast("int")))
    return per.where("parts > 1").select("range", F.array_distinct(at).alias("cuts"))


def divided(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Ranges with boundaries become one range per gap; names keep the order."""
    df = rows.join(checked_broadcast(cuts, materialize=False), "range", "left")
    place = F.size(F.filter("cuts", lambda c: c <= _key()))
    name = F.when(F.col("cuts").isNull(), F.col("range")).otherwise(F.concat("range", F.lit("."), F.lpad(place.cast("string"), 2, "0")))
    return df.select("doc_id", "size", "text_crc32", *_KEY, name.alias("range"))


def ranges(rows: DataFrame, min_ranges: int = MIN_RANGES, max_rows: int = MAX_ROWS) -> DataFrame:
    """``rows`` with ``range``: names in the order of the key, none with more than ``max_rows`` rows.
    Rows that are equal in text and id are told apart by their place, so every range can be divided."""
    rows = rows.withColumn("range", F.lit("r"))
    want = F.greatest(F.lit(min_ranges), F.ceil(F.col("rows") * 2 / max_rows))
    level = 0
    while True:
        totals = _totals(rows)
        parts = F.least(F.lit(PARTS), want if level == 0 else F.ceil(F.col("rows") * 2 / max_rows)).cast("int")
        large = totals if level == 0 else totals.where(F.col("rows") > max_rows)
        large = stored(large.select("range", "bytes", parts.alias("parts")), "shard-ranges")
        if large.isEmpty():
            return rows
        rows = stored(divided(rows, stored(splitters(rows, large, level), "shard-cuts")), "shard-rows")
        level += 1


def shards_by_bytes(docs: DataFrame, shards: int = SHARDS, min_ranges: int = MIN_RANGES, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL: not a key law)."""
    rows = ranges(stored(sized(docs), "shard-sized"), min_ranges, max_rows)
    # One row per range; the running totals over them give each range its place in the order.
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    places = stored(_totals(rows).select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), F.sum("bytes").over(W.partitionBy()).alias("total")), "shard-places")
    inside = W.partitionBy("range").orderBy(*_KEY)
    upto = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    placed = rows.select("*", upto.alias("in_bytes"), (F.row_number().over(inside) - 1).alias("in_rows")).join(
        checked_broadcast(places, materialize=False), "range")
    middle = (F.col("bytes_before") + F.col("in_bytes")) * 2 + F.col("size")
    shard = F.floor(middle.cast("decimal(38,0)") * shards / (F.col("total") * 2)).cast("int")
    placed = stored(placed.select("doc_id", "size", "text_crc32", F.least(F.lit(shards - 1), shard).alias("shard"),
                                  (F.col("rows_before") + F.col("in_rows")).alias("place")), "shard-placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
