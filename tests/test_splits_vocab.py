import hashlib

from pyspark.sql import functions as F

from tonalert.operators import splits as S
from tonalert.operators import vocab as V


def md5_order(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k))


def test_split_exact_sizes_and_membership(spark):
    df = spark.range(0, 1237).withColumnRenamed("id", "k")
    out = {r["k"]: r["split"] for r in S.split_exact(df, "k", 0.8, 42).collect()}
    order = md5_order(range(1237), 42)
    n = round(0.8 * 1237)
    assert sum(v == "train" for v in out.values()) == n
    assert all(out[k] == "train" for k in order[:n]) and all(out[k] == "test" for k in order[n:])


def test_shuffle_positions(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "k")
    got = {r["k"]: r["pos"] for r in S.shuffle(df, "k", 9).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == md5_order(range(300), 9)


def test_split_groups_and_nested(spark):
    df = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 37).alias("g"))
    out = S.split_groups(df, "g", (0.8, 0.1, 0.1), 42)
    per_group = out.groupBy("g").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r["n"] == 1 for r in per_group)
    sizes = {r["split"]: r["c"] for r in out.select("g", "split").distinct().groupBy("split").agg(F.count("*").alias("c")).collect()}
    assert sizes == {"train": int(0.8 * 37), "val": int(0.1 * 37), "test": 37 - int(0.8 * 37) - int(0.1 * 37)}
    nested = S.split_nested(df.select("k"), "k", 0.1, 0.8, 42)
    c = {r["split"]: r["count"] for r in nested.groupBy("split").count().collect()}
    assert c == {"train": int(0.8 * 50), "val": 50 - int(0.8 * 50)}
    assert S.sample_fraction(df, "k", 0.1, 3).count() == 50


def test_words_to_idx_unknown_and_padding(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, idx int")
    docs = spark.createDataFrame([(1, ["b", "zz", "a", "b"]), (2, ["q"]), (3, [])], "doc_id long, tokens array<string>")
    got = {r["doc_id"]: list(r["ids"]) for r in V.words_to_idx(docs, vocab).collect()}
    assert got == {1: [1, 0, 1], 2: [0], 3: [0]}
    known = V.known_indices(docs, vocab).withColumn("batch", F.lit(0))
    padded = {r["doc_id"]: (list(r["padded"]), r["length"]) for r in V.pad_sequences(known).collect()}
    assert padded == {1: ([1, 0, 1], 3), 2: ([0, 0, 0], 1), 3: ([0, 0, 0], 1)}


def test_longest_first_within_partitions(spark):
    df = spark.createDataFrame([(1, [1]), (2, [1, 2, 3]), (3, [1, 2])], "k int, ids array<int>").coalesce(1)
    assert [r["k"] for r in V.longest_first(df).collect()] == [2, 3, 1]


def test_union_splits(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([(2,)], "k int")
    out = sorted((r["k"], r["split"]) for r in S.union_splits({"train": a, "test": b}).collect())
    assert out == [(1, "train"), (2, "test")]


def test_batches_fixed_size_in_hash_order(spark):
    df = spark.range(0, 203).withColumnRenamed("id", "k")
    got = {r["k"]: (r["batch"], r["slot"]) for r in S.batches(df, "k", 64, 5).collect()}
    order = md5_order(range(203), 5)
    assert [got[k] for k in order] == [(i // 64, i % 64) for i in range(203)]


def test_longest_first_by_batch(spark):
    rows = [(1, 0, [1]), (2, 0, [1, 2, 3]), (3, 0, [1, 2, 3]), (4, 1, []), (5, 1, [7, 8])]
    df = spark.createDataFrame(rows, "k long, batch long, ids array<int>")
    got = {r["k"]: r["place"] for r in V.longest_first(df, "ids", batch_col="batch", key="k").collect()}
    assert got == {2: 1, 3: 2, 1: 3, 5: 1, 4: 2}


def test_attach_vectors_only_used_ones(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 5)], "word string, idx long")
    vectors = spark.createDataFrame([(0, [0.5]), (1, [1.5]), (2, [2.5]), (3, [3.5])], "vec_id long, embedding array<float>")
    got = {r["word"]: (r["idx"], None if r["vector"] is None else list(r["vector"]))
           for r in V.attach_vectors(vocab, vectors).collect()}
    assert got == {"a": (0, [0.5]), "b": (1, [1.5]), "c": (5, None)}


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(i if i else None, f"r{i}") for i in range(10)], "k bigint, v string")
    for out in (S.split_exact(df, "k"), S.shuffle(df, "k"), S.batches(df, "k", 3), S.assign_ranges(df, "k", 1, lambda n: [0, n], ["a", "b", "c"])):
        assert sorted(r["v"] for r in out.collect()) == [f"r{i}" for i in range(10)]
    sizes = sorted(r["count"] for r in S.split_exact(df, "k").groupBy("split").count().collect())
    assert sizes == [2, 8]
    assert {r["split"] for r in S.split_exact(df.limit(0), "k").collect()} == set()
    assert S.shuffle(df.limit(0), "k").count() == 0


def test_split_is_one_narrow_pass(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = S.split_exact(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Union" not in plan and "Join" not in plan


def test_every_word_is_numbered(spark):
    df = spark.createDataFrame([("b a a c",), ("a b",), (None,)], "text string")
    assert sorted(map(tuple, V.build_vocab(df).collect())) == [("a", 0, 3), ("b", 1, 2), ("c", 2, 1)]


def test_numbers_follow_the_order_over_partitions(spark):
    df = spark.range(5000).repartition(7)
    rows = V.number_rows(df.withColumn("o", -df["id"]), "o").collect()
    assert sorted((r["idx"], r["id"]) for r in rows) == [(i, 4999 - i) for i in range(5000)]


def test_fitted_vectors_of_synonyms_lie_close(spark, tmp_path):
    """Words that stand in the same places are nearest neighbours; the sums match a plain loop."""
    import hashlib
    import random
    from collections import Counter

    from tonalert.operators import vocab as V
    from tonalert.sources import io as IO

    rng = random.Random(2)
    pairs = [("car", "auto"), ("big", "large"), ("ship", "boat")]
    docs = []
    for _ in range(400):
        k = rng.randrange(3)
        w = rng.choice(pairs[k])
        docs.append([f"l{k}{rng.randrange(4)}", f"m{k}{rng.randrange(4)}", w, f"n{k}{rng.randrange(4)}", f"o{k}{rng.randrange(4)}", f"x{rng.randrange(40)}"])
    docs += [[], None, ["alone"], [None, "car"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, tokens array<string>")
    sums = Counter()
    for t in docs:
        for i, w in enumerate(t or []):
            for j in range(max(0, i - 2), min(len(t), i + 3)):
                if i != j and w is not None and t[j] is not None:
                    h = hashlib.md5(t[j].encode()).hexdigest()
                    sums[w, int(h[:8], 16) % 64] += 1 if int(h[8:16], 16) % 2 else -1
    got = {(r["word"], r["dim"]): r["total"] for r in V.context_sums(df).collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in sums.items() if v}

    path = str(tmp_path / "vectors")
    calls = []
    fit = lambda: calls.append(1) or V.fit_vectors(df)
    rows = IO.read_vocab_or_fit(spark, path, fit).collect()
    assert IO.read_vocab_or_fit(spark, path, fit).count() == len(rows) and calls == [1]  # the second call reads what the first wrote
    (tmp_path / "vectors" / "_SUCCESS").unlink()
    assert IO.read_vocab_or_fit(spark, path, fit).count() == len(rows) and calls == [1, 1]  # a write that did not end is made again
    vec = {r["word"]: r["vector"] for r in rows}
    assert "alone" not in vec and sorted(r["idx"] for r in rows) == list(range(len(rows))) and all(len(v) == 64 for v in vec.values())
    for a, b in pairs:
        near = max((w for w in vec if w != a), key=lambda w: sum(x * y for x, y in zip(vec[a], vec[w])))
        assert near == b


def test_context_sums_shuffle_no_pairs_of_words(spark):
    rows = [(["a", "b", None, "a"],), (None,), ([],), (["x"],), (["a", "b"] * 20_000,)]
    out = V.context_sums(spark.createDataFrame(rows, "tokens array<string>"))
    assert "near" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = out.groupBy("word").agg(F.sum(F.abs("total")).alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["word"] for r in got} == {"a", "b"} and all(r["n"] <= 2 for r in got)
