"""Structured Streaming forms.

R1 is stateless (the alert chain is row-wise), so it runs in append mode with no state store.
R3 keeps one count per (window, label) in the state store; the watermark lets Spark drop late
rows and evict finished windows, so state stays bounded by the watermark delay.
R2 (``operators.alerts.entity_sentiment``) also runs on a stream as it is: an aggregation whose
state is one row per (entity, tag), so it grows with the distinct entities, not with the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tonalert.functions import labels as L
from tonalert.operators.alerts import alerts_from_text
from tonalert.operators.metrics import bce_with_logits


def stream_alerts(stream: DataFrame, key: str = "doc_id", text: str = "text", tags: str = "ner_tags",
                  coded: bool = True) -> DataFrame:
    """The alert chain over a stream of ``(key, text, tags)`` rows."""
    return alerts_from_text(stream, key, text, tags, coded)


def sentiment_windows(df: DataFrame, ts: str = "ts", label: str = "label", every: str = "1 day",
                      late: str | None = "3 days") -> DataFrame:
    """Row counts by label per tumbling window; rows later than ``late`` behind the newest
    event time are dropped (streams only; in batch the watermark is a no-op)."""
    if late is not None and df.isStreaming:
        df = df.withWatermark(ts, late)
    return df.groupBy(F.window(ts, every).alias("w"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def bursts(df: DataFrame, ts: str = "ts", label: str = "label", gap: str = "1 hour", late: str | None = "1 day") -> DataFrame:
    """R3 as bursts: per label, runs of rows with no pause of more than ``gap`` between them: (label, first, last, n). On a
    stream rows later than ``late`` behind the newest event time are dropped and closed runs leave the state."""
    if late is not None and df.isStreaming:
        df = df.withWatermark(ts, late)
    runs = df.where(F.col(ts).isNotNull()).groupBy(F.session_window(ts, gap).alias("s"), F.col(label).alias("label"))
    return runs.agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n")).select("label", "first", "last", "n")


def metric_states(df: DataFrame, step: str, x: str, y: str) -> DataFrame:
    """Per step the sums behind accuracy and loss (G1, G4): rows, hits, rows with a loss, losses. Sums of parts add up."""
    right = F.when(L.class_binary(L.sigmoid(x)) == F.col(y), 1).otherwise(0)
    loss = bce_with_logits(x, L.loss_label(y))
    return df.groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.sum(right).alias("right"), F.count(loss).alias("n_loss"), F.sum(loss).alias("loss"))


def log_metrics_stream(stream: DataFrame, path: str, checkpoint: str, step: str, x: str, y: str) -> StreamingQuery:
    """G10 as rows come in: each micro-batch writes its sums to a folder of its own number under ``path``. A batch that is
    run again after a failure overwrites its own folder, so nothing counts twice. Runs what is available, then stops."""
    def write(batch: DataFrame, number: int) -> None:
        metric_states(batch, step, x, y).write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def metric_log(spark: SparkSession, path: str, step: str) -> DataFrame:
    """The log so far (step, accuracy, loss, n), as ``metrics.log_metrics`` gives it over all rows seen."""
    s = spark.read.parquet(path).groupBy(step).agg(*[F.sum(c).alias(c) for c in ("n", "right", "n_loss", "loss")])
    return s.select(step, (F.col("right") / F.col("n")).alias("accuracy"), (F.col("loss") / F.col("n_loss")).alias("loss"), "n")


SHIFT_SCHEMA = "entity string, tag string, window_start timestamp, mentions bigint, negatives bigint, before_mentions bigint, before_negatives bigint"


def shift_alerts(mentions: DataFrame, ts: str = "ts", every: str = "1 day", least: int = 5, shift: float = 0.3) -> DataFrame:
    """R2 as alerts, in batch: windows of an entity in which the share of negative mentions differs by ``shift`` or more from that of
    the window before it that has mentions; both need ``least`` of them. ``mentions``: (ts, entity, tag, negative)."""
    per = mentions.where(F.col(ts).isNotNull()).groupBy("entity", "tag", F.window(ts, every)["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("mentions"), F.sum(F.col("negative").cast("bigint")).alias("negatives"))
    w = Window.partitionBy("entity", "tag").orderBy("window_start")
    rows = per.select("*", F.lag("mentions").over(w).alias("before_mentions"), F.lag("negatives").over(w).alias("before_negatives"))
    change = F.abs(F.col("negatives") / F.col("mentions") - F.col("before_negatives") / F.col("before_mentions"))
    return rows.where((F.col("mentions") >= least) & (F.col("before_mentions") >= least) & (change >= shift - 1e-12))


def shift_alerts_stream(mentions: DataFrame, ts: str = "ts", every_seconds: int = 86_400, late: str = "1 day", least: int = 5, shift: float = 0.3,
                        idle_windows: int = 30) -> DataFrame:
    """R2 on a stream: ``shift_alerts`` as windows close behind the watermark.

    The state of an entity is bounded: the windows that the watermark still leaves open (``late`` over the window's length, and two) and the
    last closed one. An entity without mentions for ``idle_windows`` windows loses its state, so the states are those of
    recent entities; its next window has none before it."""
    def update(key, frames, state):
        return _close_windows(key, frames, state, every_seconds, least, shift, idle_windows)

    rows = mentions.withWatermark(ts, late).where(F.col(ts).isNotNull()).select(
        "entity", "tag", F.col(ts).alias("ts"), F.col("negative").cast("bigint").alias("negative"))
    return rows.groupBy("entity", "tag").applyInPandasWithState(
        update, SHIFT_SCHEMA, "starts array<bigint>, counts array<bigint>, negatives array<bigint>, last array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def _close_windows(key, frames, state, every, least, shift, idle_windows):
    """Adds an entity's mentions to its open windows and yields the alerts of those that the watermark has passed."""
    import pandas as pd

    starts, counts, negatives, last = (list(x) for x in state.get) if state.exists else ([], [], [], [])
    open_windows = {s: [n, k] for s, n, k in zip(starts, counts, negatives)}
    if not state.hasTimedOut:
        for frame in frames:
            for t, negative in zip(frame["ts"], frame["negative"]):
                s = int(t.timestamp()) // every * every
                w = open_windows.setdefault(s, [0, 0])
                w[0] += 1
                w[1] += 0 if pd.isna(negative) else int(negative)
    watermark = state.getCurrentWatermarkMs() / 1000
    out = []
    for s in sorted(s for s in open_windows if s + every <= watermark):
        n, k = open_windows.pop(s)
        if last and s - last[0] <= idle_windows * every and n >= least and last[1] >= least and abs(k / n - last[2] / last[1]) >= shift - 1e-12:
            out.append((*key, pd.Timestamp(s, unit="s"), n, k, last[1], last[2]))
        last = [s, n, k]
    if open_windows or last and last[0] + (idle_windows + 1) * every > watermark:
        rows = sorted((s, *v) for s, v in open_windows.items())
        state.update(([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], last))
        due = min([s + every for s in open_windows] or [last[0] + (idle_windows + 1) * every])
        state.setTimeoutTimestamp(int(max(due * 1000, watermark * 1000 + 1)))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=["entity", "tag", "window_start", "mentions", "negatives", "before_mentions", "before_negatives"])


def windows_flat(df: DataFrame) -> DataFrame:
    """Window start as text (engine-neutral), label and count."""
    return df.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "label", "n")


def run_available(query_df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now and stop: exactly-once into a file sink with a
    checkpoint, restartable after a failure from the checkpoint."""
    q = (query_df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .option("path", sink_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """A file stream with a declared schema (no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)
