import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.operators import models as MD
from tonalert.sources import io as IO


def toy_loader():
    def model(texts):
        return [("positive" if "good" in (t or "") else "negative", float(len(t or ""))) for t in texts]
    return model


def test_score_batches_slices_and_keeps_rows(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    df = spark.range(0, 53).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "good day").otherwise("bad").alias("t"))
    fields = [T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())]
    out = MD.score_batches(df, toy_loader, "t", fields, batch=5).collect()
    assert len(out) == 53
    assert all((r["label"] == "positive") == (r["k"] % 2 == 0) and r["score"] == len(r["t"]) for r in out)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_train_save_load(spark, tmp_dir):
    rows = [(i, ["happy", "love", "x"] if i % 2 else ["sad", "cry", "x"], 2 if i % 2 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, tokens array<string>, target int")
    vocab = spark.createDataFrame([("happy", [1.0, 0.0]), ("love", [0.5, 0.1]), ("sad", [-1.0, 0.0]), ("cry", [-0.5, 0.3])], "word string, vector array<float>")
    df = MD.with_features(df, vocab, "k")
    model = MD.train_sentiment(df, max_iter=50)
    ev = MD.evaluate_sentiment(model, df).first()
    assert ev["n"] == 60 and ev["accuracy"] == 1.0
    path = os.path.join(tmp_dir, "model")
    MD.save_model(model, path)
    again = MD.load_model(path)
    a = sorted(r["p"] for r in MD.predict_sentiment(model, df).collect())
    b = sorted(r["p"] for r in MD.predict_sentiment(again, df).collect())
    assert a == b


def png_bytes(w, h):
    raw = b"".join(b"\x00" + b"\xff\x00\x00" * w for _ in range(h))
    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def size_captioner():
    def model(blobs):
        out = []
        for b in blobs:
            w, h = struct.unpack(">II", bytes(b)[16:24])
            out.append((f"an image of {w}x{h}",))
        return out
    return model


def test_caption_images_and_split_copy(spark, tmp_dir):
    src = os.path.join(tmp_dir, "imgs")
    os.makedirs(src)
    for i, name in enumerate(["a.png", "b.PNG", "c.jpg", "notes.txt"]):
        with open(os.path.join(src, name), "wb") as f:
            f.write(png_bytes(i + 1, 2))
    imgs = IO.read_images(spark, src, exts=(".jpg", ".png"), ignore_case=True)
    caps = {r["image_name"]: r["caption"] for r in MD.caption_images(imgs, size_captioner).collect()}
    assert caps == {"a.png": "an image of 1x2", "b.PNG": "an image of 2x2", "c.jpg": "an image of 3x2"}
    only_jpg = IO.read_images(spark, src, exts=(".jpg",))
    assert [os.path.basename(r["path"]) for r in only_jpg.collect()] == ["c.jpg"]
    manifest = spark.createDataFrame([("a.png", "train"), ("b.PNG", "test"), ("c.jpg", "val")], "image_name string, split string")
    out = os.path.join(tmp_dir, "by_split")
    IO.write_images_by_split(imgs, manifest, out)
    back = {r["image_name"]: r["split"] for r in spark.read.parquet(out).collect()}
    assert back == {"a.png": "train", "b.PNG": "test", "c.jpg": "val"}


def test_generate_alerts_with_generator(spark):
    df = spark.createDataFrame([(1, "Entidades: x", "Alert ref")], "doc_id long, input_text string, target_text string")

    def gen():
        return lambda xs: [(x.upper(),) for x in xs]

    r = MD.generate_alerts(df, gen).first()
    assert (r["prediction"], r["reference"]) == ("ENTIDADES: X", "Alert ref")


def test_tag_tokens_gazetteer(spark):
    gaz = spark.createDataFrame([("John", "PER"), ("Smith", "PER"), ("Paris", "LOC")], "tok string, kind string")
    df = spark.createDataFrame([(1, ["John", "Smith", "in", "Paris", "Paris"])], "doc_id long, tokens array<string>")
    for limit in (1 << 20, 0):  # looked up in place, and by the listed tokens only
        tags = [r["tag"] for r in MD.tag_tokens(df, gaz, limit=limit).orderBy("pos").collect()]
        assert tags == ["B-PER", "I-PER", "O", "B-LOC", "I-LOC"]


def make_counting_loader(path):
    def loader():
        with open(path, "a") as f:
            f.write("1\n")
        return lambda xs: [(len(x),) for x in xs]
    return loader


def test_model_loaded_once_per_worker_not_per_partition(spark, tmp_dir):
    path = os.path.join(tmp_dir, "loads.txt")
    df = spark.range(0, 3200, numPartitions=32).select(F.col("id").cast("string").alias("t"))
    out = MD.score_batches(df, make_counting_loader(path), "t", [T.StructField("n", T.LongType())]).collect()
    assert len(out) == 3200
    loads = sum(1 for _ in open(path))
    assert 1 <= loads < 32


def test_latest_model_only(spark):
    import sys

    first, second = MD._model(lambda: object(), "a"), MD._model(lambda: object(), "b")
    assert first is not second and sys._tonalert_model == ("b", second)


def test_unknown_words_and_unlisted_images(spark, tmp_dir):
    vocab = spark.createDataFrame([("a", [1.0, 3.0]), ("b", [3.0, 5.0])], "word string, vector array<float>")
    df = spark.createDataFrame([(1, ["a", "b", "b", "z"]), (2, ["z"]), (3, [])], "doc_id long, tokens array<string>")
    got = {r["doc_id"]: [round(x, 4) for x in r["features"].toArray()] for r in MD.with_features(df, vocab).collect()}
    assert got == {1: [2.3333, 4.3333], 2: [0.0, 0.0], 3: [0.0, 0.0]}
    images = spark.createDataFrame([("p/a.jpg", b"1"), ("p/b.jpg", b"2")], "path string, content binary")
    out = os.path.join(tmp_dir, "unlisted")
    IO.write_images_by_split(images, spark.createDataFrame([("a.jpg", "train")], "image_name string, split string"), out)
    assert {r["image_name"]: r["split"] for r in spark.read.parquet(out).collect()} == {"a.jpg": "train", "b.jpg": "unlisted"}


def test_scorers_keep_rows_without_a_reference(spark):
    scored = spark.createDataFrame([(1, 3.0), (2, 3.0)], "doc_id long, x double")
    ref = spark.createDataFrame([(1, "positive")], "doc_id long, sentiment string")
    got = {r["doc_id"]: r["agree"] for r in MD.compare_scorers(scored, ref).collect()}
    assert got == {1: 1, 2: None}


def test_poison_rows_cost_a_few_calls_each():
    calls = []

    def model(values):
        calls.append(len(values))
        if any(v % 100 == 7 for v in values):
            raise KeyError(7)
        return [(v + 1,) for v in values]

    out = MD._scored_rows(model, list(range(1024)))
    assert [r for r, e in out if e is None] == [(v + 1,) for v in range(1024) if v % 100 != 7]
    assert [i for i, (r, e) in enumerate(out) if e] == [v for v in range(1024) if v % 100 == 7] and out[7] == (None, "KeyError: 7")
    assert len(calls) <= 1 + 2 * 10 * 11  # two calls for each halving, ten halvings for each of eleven rows
    assert MD._scored_rows(lambda v: [(0,)], [1, 2]) == [(( 0,), None)] * 2 and MD._scored_rows(model, []) == []


def test_failing_rows_end_the_job_only_without_an_error_column(spark):
    df = spark.createDataFrame([(1, "ok"), (2, None), (3, "fine")], "id long, t string")
    fields = [T.StructField("n", T.LongType()), T.StructField("s", T.StringType())]
    loader = lambda: lambda xs: [(len(x), x.upper()) for x in xs]
    rows = {r["id"]: (r["n"], r["s"], r["why"]) for r in MD.score_batches(df, loader, "t", fields, error="why").collect()}
    assert rows[1] == (2, "OK", None) and rows[3] == (4, "FINE", None) and rows[2][:2] == (None, None) and "NoneType" in rows[2][2]
    with pytest.raises(Exception, match="NoneType"):
        MD.score_batches(df, loader, "t", fields).collect()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_doc_vectors_are_added_up_where_the_row_is(spark):
    vocab = spark.createDataFrame([("a", 0, [1.0, 3.0]), ("b", 1, [3.0, 5.0]), ("b", 2, [5.0, 9.0]), ("c", 3, [0.0, -4.0])], "word string, idx long, vector array<float>")
    rows = [(1, ["a", "b", "z", None]), (1, ["c"]), (None, ["a"]), (None, ["c", "c"]), (2, ["z"]), (3, None), (4, []), (5, ["a", "c"] * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    want = {1: ([2.25, 3.25], 4), None: ([1 / 3, -5 / 3], 3), 5: ([0.5, -0.5], 100_000)}
    for limit in (MD.VECTOR_LIMIT_BYTES, 150, 0):  # all in place, the first words in place, all joined
        got = {r["doc_id"]: (list(r["features"].toArray()), r["n_known"]) for r in MD.doc_vectors(df, vocab, limit=limit).collect()}
        assert got.keys() == want.keys()
        for k, (v, n) in want.items():
            assert got[k][1] == n and got[k][0] == pytest.approx(v, abs=1e-9)
    assert "explode" not in _plan(MD.doc_vectors(df, vocab)) and "explode" in _plan(MD.doc_vectors(df, vocab, limit=0))
    assert MD.doc_vectors(df, vocab.limit(0)).count() == 0


def test_score_batches_sends_back_what_is_kept(spark):
    df = spark.createDataFrame([(1, None, "a good day"), (None, 2.5, None), (3, float("nan"), "x")], "k long, v double, t string").repartition(1)
    fields = [T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())]
    out = MD.score_batches(df, toy_loader, "t", fields, batch=2, keep=["k"])
    assert out.columns == ["k", "label", "score"]
    assert sorted((r["k"] or 0, r["label"], r["score"]) for r in out.collect()) == [(0, "negative", 0.0), (1, "positive", 10.0), (3, "negative", 1.0)]
    assert MD.score_batches(df, toy_loader, "t", fields).columns == ["k", "v", "t", "label", "score"]
    with pytest.raises(Exception, match="1 results for 3 rows"):
        MD.score_batches(df, lambda: lambda values: [("a", 1.0)], "t", fields).collect()


def test_doc_vectors_over_rows_that_come_from_a_join(spark):
    from pyspark.sql.functions import broadcast

    vocab = spark.createDataFrame([("a", [1.0]), ("b", [3.0])], "word string, vector array<float>")
    docs = spark.createDataFrame([(1, "A b"), (1, "a"), (2, "z")], "doc_id long, raw string")
    split = spark.createDataFrame([(1, "train"), (2, "test")], "doc_id long, split string")
    rows = docs.join(broadcast(split), "doc_id").select("doc_id", "split", F.split(F.lower("raw"), " ").alias("tokens"))
    got = sorted((r["doc_id"], r["split"], round(float(r["features"][0]), 6)) for r in MD.with_features(rows, vocab).collect())
    assert got == [(1, "train", 1.666667), (1, "train", 1.666667), (2, "test", 0.0)]
