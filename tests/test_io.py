import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.sources import io as IO


def test_read_tweets_latin1_and_quotes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    with open(p, "wb") as f:
        f.write('0,1,"Mon Apr 06",NO_QUERY,user1,"caf\xe9 ""quoted"", ok"\n'.encode("latin-1"))
        f.write('4,2,"Tue",NO_QUERY,u2,"plain"\n'.encode("latin-1"))
    rows = IO.read_tweets(spark, p).collect()
    assert rows[0]["text"] == 'café "quoted", ok' and rows[0]["target"] == 0 and rows[1]["ids"] == 2


def test_csv_roundtrip_with_arrays(spark, tmp_dir):
    df = spark.createDataFrame([(1, ["a", "b,c"], "x\ny", "test"), (2, [], "", "train"), (3, ["z"], "q", "validation")],
                               "k int, toks array<string>, s string, split string")
    IO.write_table(df, os.path.join(tmp_dir, "csv"), fmt="csv")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("toks", T.StringType()),
                           T.StructField("s", T.StringType()), T.StructField("split", T.StringType())])
    back = {r["k"]: r for r in IO.read_table_csv(spark, os.path.join(tmp_dir, "csv"), schema, multi_line=True).collect()}
    assert json.loads(back[1]["toks"]) == ["a", "b,c"] and back[1]["s"] == "x\ny"
    IO.write_by_split(df, os.path.join(tmp_dir, "split"))
    dirs = sorted(os.listdir(os.path.join(tmp_dir, "split")))
    assert "dir=test" in dirs and "dir=train" in dirs
    routed = {r["k"]: r["dir"] for r in spark.read.parquet(os.path.join(tmp_dir, "split")).collect()}
    assert routed == {1: "test", 2: "train", 3: "train"}


def test_ingest_once_keeps_first_write(spark, tmp_dir):
    p = os.path.join(tmp_dir, "once")
    IO.ingest_once(spark.range(3), p)
    IO.ingest_once(spark.range(10), p)
    assert spark.read.parquet(p).count() == 3


def test_captions_tag_names_and_tagged(spark, tmp_dir):
    cp = os.path.join(tmp_dir, "results.csv")
    with open(cp, "w") as f:
        f.write("image_name| comment_number| comment\n1.jpg| 0| A dog .\n2.jpg| 1| Two cats\n")
    caps = IO.read_captions(spark, cp, multi_line=True).collect()
    assert [(r["image_name"], r["comment"]) for r in caps] == [("1.jpg", "A dog ."), ("2.jpg", "Two cats")]
    info = {"features": {f: {"feature": {"names": names}} for f, names in
                         {"pos_tags": ["NN", "VB"], "chunk_tags": ["O", "B-NP"], "ner_tags": ["O", "B-PER", "I-PER"]}.items()}}
    ip = os.path.join(tmp_dir, "dataset_info.json")
    with open(ip, "w") as f:
        json.dump(info, f, indent=2)
    names = {(r["feature"], r["idx"]): r["name"] for r in IO.read_tag_names(spark, ip).collect()}
    assert names[("ner_tags", 2)] == "I-PER" and names[("pos_tags", 0)] == "NN" and len(names) == 7
    tagged = spark.createDataFrame([("0", ["EU"], [1], [2], [3], "train"), ("1", ["x"], [0], [0], [0], "test")],
                                   IO.TAGGED_SCHEMA)
    tagged.write.partitionBy("split").parquet(os.path.join(tmp_dir, "tagged"))
    back = IO.read_tagged(spark, os.path.join(tmp_dir, "tagged"))
    assert back.filter(F.col("split") == "test").count() == 1


def test_missing_policy(spark, tmp_dir):
    missing = os.path.join(tmp_dir, "nope")
    assert IO.on_missing(lambda: spark.read.parquet(missing), "skip") is None
    with pytest.raises(FileNotFoundError):
        IO.on_missing(lambda: spark.read.parquet(missing), "error")


def test_read_vocab(spark, tmp_dir):
    p = os.path.join(tmp_dir, "vocab")
    with pytest.raises(FileNotFoundError):
        IO.read_vocab(spark, p)
    IO.ingest_once(spark.createDataFrame([("a", 0, [1.0])], IO.VOCAB_SCHEMA), p)
    assert [tuple(r) for r in IO.read_vocab(spark, p).collect()] == [("a", 0, [1.0])]


def test_images_are_chosen_when_listed(spark, tmp_dir):
    for name in ("a.jpg", "b.JPG", "c.png", "d.txt"):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(b"x")
    names = lambda df: sorted(os.path.basename(r["path"]) for r in df.collect())
    assert names(IO.read_images(spark, tmp_dir)) == ["a.jpg"]
    assert names(IO.read_images(spark, tmp_dir, (".jpg", ".png"), ignore_case=True)) == ["a.jpg", "b.JPG", "c.png"]


def test_split_files_without_multi_line(spark, tmp_dir):
    p = os.path.join(tmp_dir, "one.csv")
    with open(p, "w") as f:
        f.write("k,v\n" + "".join(f"{i},x\n" for i in range(1000)))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    assert IO.read_table_csv(spark, p, schema).count() == IO.read_table_csv(spark, p, schema, multi_line=True).count() == 1000


def test_ingest_takes_each_file_once_also_after_a_crash(spark, tmp_dir):
    src, target = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(src)

    def add(name, text):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)

    read = lambda paths: spark.read.text(paths)
    rows = lambda: sorted(r[0] for r in IO.read_ingested(spark, target).collect())
    add("a", "1\n2\n")
    assert IO.ingest_new(spark, src, target, read) == 1 and IO.ingest_new(spark, src, target, read) == 0 and rows() == ["1", "2"]
    add("b", "3\n")

    def lost(paths):
        read(paths).write.parquet(os.path.join(target, "staging", "half", "rows"))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        IO.ingest_new(spark, src, target, lost)
    assert rows() == ["1", "2"]
    add("c", "4\n")
    assert IO.ingest_new(spark, src, target, read) == 2 and rows() == ["1", "2", "3", "4"]
    os.utime(os.path.join(src, "a"), (1, 1))  # a file that was replaced counts as new
    assert IO.ingest_new(spark, src, target, read) == 1 and rows() == ["1", "1", "2", "2", "3", "4"]


def test_ingest_once_replaces_a_write_that_did_not_end(spark, tmp_dir):
    path = os.path.join(tmp_dir, "once")
    IO.ingest_once(spark.range(3), path)
    os.unlink(os.path.join(path, "_SUCCESS"))
    IO.ingest_once(spark.range(5), path)
    IO.ingest_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5


def test_rejects_keep_file_and_text(spark, tmp_dir):
    for name, lines in (("a.csv", ["1,x,2.5", "two,x,1", '3,"a,b",']), ("b.csv", ["4,y,oops", "5,z", "6,w,1,9", ""])):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join(["id,name,v", *lines]) + "\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.DoubleType())])
    good, bad = IO.read_with_rejects(spark, tmp_dir, schema, header="id,name,v")
    assert sorted(map(tuple, good.collect())) == [(1, "x", 2.5), (3, "a,b", None)]
    assert sorted((os.path.basename(r["file"]), r["line"]) for r in bad.collect()) == [("a.csv", "two,x,1"), ("b.csv", "4,y,oops"), ("b.csv", "5,z"), ("b.csv", "6,w,1,9")]
    assert {os.path.basename(r["file"]): r["n"] for r in IO.reject_counts(bad).collect()} == {"a.csv": 1, "b.csv": 3}
    with open(os.path.join(tmp_dir, "latin"), "wb") as f:
        f.write("7,caf\xe9,1\n".encode("latin-1"))
    good, bad = IO.read_with_rejects(spark, os.path.join(tmp_dir, "latin"), schema, encoding="ISO-8859-1")
    assert [r["name"] for r in good.collect()] == ["caf\xe9"] and bad.count() == 0
