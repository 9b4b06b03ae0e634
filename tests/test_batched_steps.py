"""Steps that work on whole Arrow batches, or once per word, instead of token by token."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tonalert.functions import entities as E
from tonalert.functions import text as T
from tonalert.operators import vocab as V


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_spans_are_decoded_and_cleaned_by_batches(spark):
    """No expression runs per token, and odd rows read as before."""
    rows = [
        (1, ["a", "b", "", None, " Zoë ", "x"], [1, 2, 2, 2, 7, 0]),
        (2, None, [1, 2]),
        (3, ["a"], None),
        (4, ["in", "THE", "!?", "é", "éa", "—", "٣٤"], [1, 1, 1, 1, 1, 1, 1]),
        (5, ["p", "q", "r", "s"], [2, 1, 4, 1 << 40]),
        (6, ["", None, "k l"], [3, 5, 8]),
        (7, [], []),
        (8, ["", ""], [1, 2]),
    ]
    df = spark.createDataFrame(rows, "k int, t array<string>, g array<bigint>")
    out = df.select("k", E.extract_entities("t", "g").alias("e"))
    assert "lambdafunction" not in _plan(out)
    assert "lambdafunction" not in _plan(out.select(E.clean_entities("e")))
    got = {r["k"]: None if r["e"] is None else [tuple(x) for x in r["e"]] for r in out.collect()}
    assert got == {
        1: [("a b", "PER"), ("Zoë", "MISC")], 2: [], 3: None,
        4: [(w, "PER") for w in ["in", "THE", "!?", "é", "éa", "—", "٣٤"]],
        5: [("q", "PER")], 6: [], 7: [], 8: [("", "PER")],
    }
    clean = {r["k"]: None if r["c"] is None else [x["entity"] for x in r["c"]] for r in out.select("k", E.clean_entities("e").alias("c")).collect()}
    assert clean == {1: ["a b", "Zoë"], 2: [], 3: None, 4: ["éa", "٣٤"], 5: [], 6: [], 7: [], 8: []}


@pytest.mark.parametrize("names", [["B-PER", "I-PER", None, "B-LOC", "I-ORG", "X"]])
def test_named_tags(spark, names):
    df = spark.createDataFrame([(list("abcdef"), names)], "t array<string>, g array<string>").repartition(1)
    (got,) = df.select(E.extract_entities("t", "g", coded=False)).first()
    assert [tuple(e) for e in got] == [("a b", "PER"), ("d", "LOC")]


def test_tokens_are_split_at_spaces_only(spark):
    """T16 does not collapse white space that is split right after; its tokens are those of the joined form."""
    texts = ["  a b\n\nc  ", "", None, "so!!!  what??\t**sad** day,,, \U0001F600\U0001F600", "x " * 3 + " 1000   ... y", "**a b\n** c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    one = df.select(T.normalize_tweet("t").alias("n"))
    assert _plan(one).count("javaWhitespace") < _plan(df.select(T.words(T.normalize_text("t")))).count("javaWhitespace") - 1
    for r in df.select(T.normalize_tweet("t").alias("n"), T.words(T.normalize_text("t")).alias("j")).collect():
        assert r["n"] == r["j"]


def test_vector_sums_are_made_once_per_word(spark):
    """F9 j04_idx_to_vector: what is worked out of a vector goes along with it."""
    voc = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.25])], "idx bigint, vector array<float>").withColumn("s", F.lit(3.0) * F.col("idx"))
    ids = spark.createDataFrame([(7, [1, 0, 1, 9]), (None, [0])], "doc_id bigint, ids array<bigint>")
    got = V.idx_to_vector(ids, voc, carry=("s",)).orderBy("doc_id", "pos").select("doc_id", "pos", "idx", "s", F.size("vector")).collect()
    assert [tuple(r) for r in got] == [(None, 0, 0, 0.0, 2), (7, 0, 1, 3.0, 2), (7, 1, 0, 0.0, 2), (7, 2, 1, 3.0, 2), (7, 3, 9, None, None)]


def test_tags_are_counted_in_the_tasks():
    """F8 e09_learned_tagger: one pass gives words by tag and pairs of tags, as sums; unpaired or NULL places do not count."""
    import pyarrow as pa

    from tonalert.operators import taggers as TG

    batch = pa.RecordBatch.from_arrays([
        pa.array([["a", "b", "a", "c"], None, ["a", None, "b"], [], ["a"]], pa.list_(pa.string())),
        pa.array([["O", "X", "O"], ["O"], ["X", "O", None, "O"], ["X"], None], pa.list_(pa.string()))], names=["tokens", "tags"])
    got = sorted((tuple(r.values()) for part in TG._tag_counts([batch]) for r in part.to_pylist()), key=repr)
    assert got == sorted([("a", None, "O", 2), ("a", None, "X", 1), ("b", None, "X", 1),
                          (None, "", "O", 1), (None, "O", "X", 1), (None, "X", "O", 1), (None, "", "X", 1)], key=repr)


def test_marks_behind_a_word_are_not_scanned(monkeypatch):
    """op9_toxicity: a plain token with marks behind it is read without the scan for disguises; logarithms are kept."""
    from tonalert.llm import toxicity as X

    scanned = []
    monkeypatch.setattr(X, "disguised", lambda t: scanned.append(t) or False)
    assert X._read("hello,", None) == "hello" and X._read("word...", None) == "word" and not scanned
    assert X._read("(hello)", None) == "hello" and scanned == ["(hello)"]
    model = X.CharModel({"^^a": 2, "^ab": 1})
    first = model.log("^^", "a")
    model.uni = {}
    assert model.log("^^", "a") == first
