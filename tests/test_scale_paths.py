"""The paths taken at scale: shuffle joins when a side is too big to broadcast, and no extra
repartition when the input already has enough partitions."""

from pyspark.sql import functions as F

from tonalert.operators import joins as J
from tonalert.operators import vocab as V
from tonalert.sources.io import spread


def _has_broadcast(df):
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def test_checked_broadcast_falls_back_to_shuffle_join(spark):
    big = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    small = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        yes = big.join(J.checked_broadcast(small), "k")
        no = big.join(J.checked_broadcast(small, limit=0), "k")
        assert _has_broadcast(yes) and not _has_broadcast(no)
        assert sorted(yes.collect()) == sorted(no.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_known_words_are_the_same_in_place_and_joined(spark):
    """Also where keys repeat or are NULL."""
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("é", 7), (None, 3), ("c", None), ("b", 5)], "word string, idx int")
    rows = [(1, ["b", "a", "z"]), (2, ["z"]), (1, ["a", "a"]), (None, ["é", None, "b"]), (None, []), (3, None), (None, ["a"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    want = sorted([(1, [1, 0]), (2, []), (1, [0, 0]), (None, [7, 1]), (None, []), (3, []), (None, [0])], key=repr)
    for limit in (1 << 20, 0):
        assert sorted(map(tuple, V.known_indices(docs, vocab, limit=limit).collect()), key=repr) == want


def test_top_words_are_those_of_the_whole_vocabulary(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i % 7))) for i in range(50)], "doc_id long, text string")
    whole = sorted(map(tuple, V.build_vocab(docs).where("idx < 4").collect()))
    assert sorted(map(tuple, V.top_vocab(docs, 4).collect())) == whole
    monkeypatch.setattr(V, "TOP_WORDS", 3)
    assert sorted(map(tuple, V.top_vocab(docs, 4).collect())) == whole and V.top_vocab(docs, 0).count() == 0


def test_spread_only_when_too_few_partitions(spark):
    many = spark.range(0, 100, numPartitions=32)
    assert spread(many) is many
    one = spark.range(0, 100, numPartitions=1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    hashed = spread(one, 4, key="id")
    assert hashed.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in hashed.collect()) == list(range(100))


def test_measured_bytes_of_nested_types(spark):
    """Texts inside arrays, structs and maps, and vectors, count with what they hold."""
    from pyspark.ml.functions import array_to_vector

    n, text = 50, F.repeat(F.lit("x"), 1000)
    df = spark.range(n)
    wide = {
        "array<string>": F.array_repeat(text, 4), "struct": F.struct(text.alias("a"), F.struct(text.alias("b"), text.alias("c"), text.alias("d")).alias("s")),
        "array<struct>": F.array_repeat(F.struct(text.alias("a"), F.col("id")), 4), "map": F.create_map(text, F.array(text, text, text)),
        "array<array>": F.array_repeat(F.array_repeat(F.lit(1.0), 125), 4), "vector": array_to_vector(F.array_repeat(F.lit(1.0), 500)),
    }
    for name, c in wide.items():
        assert 4000 * n <= J.measured_bytes(df.select(c.alias("c"))) <= 4400 * n, name
    nothing = df.select(*[F.lit(None).cast(t).alias("c") for t in ("array<string>", "struct<a:string>", "map<string,int>", "string")])
    assert J.measured_bytes(nothing) == 32 * n
    assert J.measured_bytes(df.where("id < 0")) == 0


def test_vectors_beyond_the_limit_are_not_broadcast(spark, monkeypatch):
    from tonalert.operators import models as M

    monkeypatch.setattr(M, "checked_broadcast", lambda df, **options: J.checked_broadcast(df, limit=100_000, **options))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vocab = spark.range(200).select(F.col("id").cast("string").alias("word"), F.array_repeat(F.lit(1.0), 100).alias("vector"))
        docs = spark.createDataFrame([(1, ["1", "2", "x"])], "doc_id long, tokens array<string>")
        means = M.doc_vectors(docs, vocab)
        assert not _has_broadcast(means) and means.first()["n_known"] == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
