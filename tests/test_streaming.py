import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.operators.alerts import alerts_from_text, alerts_from_words
from tonalert.streaming import streams as ST

from conftest import SF_SMALL

ROWS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("ner_tags", T.ArrayType(T.IntegerType())),
])


def test_stream_alerts_equal_batch(spark, tmp_dir):
    from tonalert.plans.q_streams import _stream_rows

    rows = _stream_rows(spark, SF_SMALL).select("doc_id", "text", F.col("ner_tags").cast("array<int>"))
    src = os.path.join(tmp_dir, "src")
    rows.repartition(4).write.parquet(src)
    stream = ST.read_stream(spark, src, ROWS_SCHEMA, max_files=1)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    ST.run_available(ST.stream_alerts(stream), out, ckpt)
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in alerts_from_text(spark.read.schema(ROWS_SCHEMA).parquet(src)).collect())
    assert streamed == batch and len(batch) > 0
    # A restart from the same checkpoint adds nothing (exactly-once file sink).
    ST.run_available(ST.stream_alerts(ST.read_stream(spark, src, ROWS_SCHEMA)), out, ckpt)
    assert spark.read.parquet(out).count() == len(batch)


def test_untagged_stream_equals_batch(spark, tmp_dir):
    kinds = {"the": "MISC", "de": "LOC", "der": "ORG"}
    src = os.path.join(tmp_dir, "plain")
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(3).write.parquet(src)
    schema = T.StructType(ROWS_SCHEMA.fields[:2])
    out, ckpt = os.path.join(tmp_dir, "plain-out"), os.path.join(tmp_dir, "plain-ckpt")
    ST.run_available(alerts_from_words(ST.read_stream(spark, src, schema, max_files=1), kinds), out, ckpt)
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in alerts_from_words(spark.read.schema(schema).parquet(src), kinds).collect())
    assert streamed == batch and any("No specific entities" not in r[3] for r in batch)


EV_SCHEMA = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("label", T.StringType())])


def test_windows_drop_late_rows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ev")
    base = dt.datetime(2024, 1, 10)
    first = [(base + dt.timedelta(hours=h), "view") for h in range(0, 24 * 6, 6)]
    spark.createDataFrame(first, EV_SCHEMA).coalesce(1).write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(EV_SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    q = (ST.sentiment_windows(stream, "ts", "label", "1 day", "3 days").writeStream.format("memory")
         .queryName("win_test").outputMode("append").start())
    q.processAllAvailable()
    # Late file: 5 rows on a day that is already more than 3 days behind the newest event.
    late = [(base + dt.timedelta(hours=1), "view")] * 5
    spark.createDataFrame(late, EV_SCHEMA).coalesce(1).write.parquet(os.path.join(src, "b"))
    q.processAllAvailable()
    newer = [(base + dt.timedelta(days=12), "view")]
    spark.createDataFrame(newer, EV_SCHEMA).coalesce(1).write.parquet(os.path.join(src, "c"))
    q.processAllAvailable()
    q.stop()
    got = {r["w"]["start"]: r["n"] for r in spark.sql("SELECT * FROM win_test").collect()}
    assert got[base] == 4  # the 5 late rows were dropped


def test_windows_batch_form(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts", F.col("event_type").alias("label"))
    flat = ST.windows_flat(ST.sentiment_windows(ev, "ts", "label", "1 day"))
    assert flat.agg(F.sum("n")).first()[0] == ev.count()


def test_entity_sentiment_on_a_stream_equals_batch(spark, tmp_dir):
    """R2 as a streaming aggregation (state per entity, complete mode): after every file of the
    stream is processed, the roll-up equals the batch one."""
    from tonalert.operators.alerts import entity_sentiment
    from tonalert.plans import fixtures as fx

    rows = fx.alerts_input(spark, SF_SMALL).select("doc_id", "entities", "sentiment", "sentiment_score")
    src = os.path.join(tmp_dir, "alerts")
    rows.repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = ST.read_stream(spark, src, schema, max_files=1)
    cols = ["entity", "tag", "mentions", "negatives"]
    q = (entity_sentiment(stream).select(*cols).writeStream.format("memory").queryName("r2_stream")
         .outputMode("complete").option("checkpointLocation", os.path.join(tmp_dir, "r2ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.table("r2_stream").collect())
    batch = sorted(tuple(r) for r in entity_sentiment(spark.read.parquet(src)).select(*cols).collect())
    assert streamed == batch and len(batch) > 0


def test_metrics_of_a_stream_count_each_row_once(spark, tmp_dir):
    """A batch that is run again after a failure between its write and its commit replaces itself."""
    from tonalert.operators import metrics as M

    schema = "step long, x double, y long"
    rows = [(k % 3, (k % 7 - 3) / 2, 2 * (k % 2)) for k in range(60)] + [(None, 0.5, 2), (1, None, 0), (1, 0.25, None)]
    src, log, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "log", "ckpt"))
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(src)
    stream = lambda: ST.read_stream(spark, src, T._parse_datatype_string(schema), max_files=1)
    ran = []

    def failing(batch, number):
        ST.metric_states(batch, "step", "x", "y").write.mode("overwrite").parquet(f"{log}/batch={number}")
        ran.append(number)
        if number == 2:
            raise RuntimeError("lost after the write")

    q = stream().writeStream.foreachBatch(failing).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
        raise AssertionError("the batch did not fail")
    except Exception as e:
        assert "lost after the write" in str(e)
    ST.log_metrics_stream(stream(), log, ckpt, "step", "x", "y")
    ST.log_metrics_stream(stream(), log, ckpt, "step", "x", "y")  # nothing new
    assert ran == [0, 1, 2] and len([d for d in os.listdir(log) if d.startswith("batch=")]) == 5
    got = {r["step"]: (r["n"], r["accuracy"], r["loss"]) for r in ST.metric_log(spark, log, "step").collect()}
    want = {r["step"]: (r["n"], r["accuracy"], r["loss"]) for r in M.log_metrics(spark.read.schema(schema).parquet(src), "step", "x", "y").collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and all(abs(a - b) < 1e-12 for a, b in zip(got[k][1:], want[k][1:]))


def test_bursts_of_a_stream_close_behind_the_watermark(spark, tmp_dir):
    base = dt.datetime(2024, 1, 1)
    minutes = [0, 5, 9, 60, 61, 200, 2000, 5000]
    files = [[(base + dt.timedelta(minutes=m), "view") for m in part] for part in (minutes[:4], minutes[4:6], minutes[6:])]
    src = os.path.join(tmp_dir, "bursts")
    for k, part in enumerate(files):
        spark.createDataFrame(part, EV_SCHEMA).coalesce(1).write.parquet(os.path.join(src, str(k)))
    every = spark.read.schema(EV_SCHEMA).parquet(*[os.path.join(src, str(k)) for k in range(3)])
    batch = sorted(tuple(r) for r in ST.bursts(every, gap="20 minutes").collect())
    assert [(r[1], r[2], r[3]) for r in batch] == [(base + dt.timedelta(minutes=a), base + dt.timedelta(minutes=b), n) for a, b, n in
                                                   ((0, 9, 3), (60, 61, 2), (200, 200, 1), (2000, 2000, 1), (5000, 5000, 1))]
    stream = spark.readStream.schema(EV_SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    out, ckpt = os.path.join(tmp_dir, "bursts-out"), os.path.join(tmp_dir, "bursts-ckpt")
    ST.run_available(ST.bursts(stream, gap="20 minutes", late="1 day"), out, ckpt)
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == batch[:-1]  # the last one is still open


MENTIONS = "ts timestamp, entity string, tag string, negative int"


def test_shift_alerts_of_a_stream_equal_batch(spark, tmp_dir):
    import random

    rng = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=h, minutes=rng.randrange(60)), rng.choice("ab"), "PER", int(rng.random() < (0.8 if h // 24 % 3 == 0 else 0.1))) for h in range(24 * 12) for _ in range(2)]
    rows += [(base + dt.timedelta(days=d), "gone", "LOC", 1) for d in (0, 0, 0, 0, 0, 1, 1, 1, 1, 1)] + [(base + dt.timedelta(hours=3), None, None, None)]
    rows += [(base + dt.timedelta(days=40), "end", "PER", 0)]
    rows.sort(key=lambda r: r[0])
    src = os.path.join(tmp_dir, "mentions")
    for k in range(0, len(rows), 50):  # in time order but for a shuffle within each file
        part = rows[k:k + 50]
        rng.shuffle(part)
        spark.createDataFrame(part, MENTIONS).coalesce(1).write.parquet(os.path.join(src, f"{k:05d}"))
    every = spark.read.schema(MENTIONS).parquet(os.path.join(src, "*"))
    batch = sorted(map(tuple, ST.shift_alerts(every).select(*[c.split()[0] for c in ST.SHIFT_SCHEMA.split(", ")]).collect()), key=repr)
    assert len(batch) > 5
    out, ckpt = os.path.join(tmp_dir, "shift-out"), os.path.join(tmp_dir, "shift-ckpt")
    for _ in range(2):  # the second run starts again from the checkpoint
        stream = spark.readStream.schema(MENTIONS).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
        q = ST.run_available(ST.shift_alerts_stream(stream), out, ckpt)
    got = sorted(map(tuple, spark.read.schema(ST.SHIFT_SCHEMA).parquet(out).collect()), key=repr)
    assert got == batch


def test_state_of_an_entity_is_bounded():
    """Only open windows and the last closed one are kept, whatever the number of mentions; idle entities go."""
    import pandas as pd

    class State:
        def __init__(self):
            self.value, self.exists, self.hasTimedOut, self.watermark, self.removed, self.due = None, False, False, 0, False, None

        get = property(lambda self: self.value)

        def getCurrentWatermarkMs(self):
            return self.watermark

        def update(self, v):
            self.value, self.exists = v, True

        def remove(self):
            self.value, self.exists, self.removed = None, False, True

        def setTimeoutTimestamp(self, ms):
            assert ms > self.watermark
            self.due = ms

    state, hour = State(), 3600
    for k in range(500):
        t = pd.Timestamp(k * hour, unit="s")
        list(ST._close_windows(("a", "PER"), [pd.DataFrame({"ts": [t] * 20, "negative": [k % 2] * 20})], state, hour, 5, 0.3, 10))
        state.watermark = max(0, (k - 3) * hour * 1000)
        assert len(state.value[0]) <= 6 and len(state.value[3]) <= 3
    for _ in range(20):
        state.hasTimedOut, state.watermark = True, state.due
        list(ST._close_windows(("a", "PER"), [], state, hour, 5, 0.3, 10))
        if state.removed:
            break
    assert state.removed and not state.exists
