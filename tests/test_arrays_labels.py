import math

import pytest
from pyspark.sql import functions as F

from tonalert.functions import arrays as A
from tonalert.functions import labels as L
from tonalert.operators import tables as tb

from conftest import one_col


def test_parse_quoted_tokens_misaligns_like_python(spark):
    df = one_col(spark, ["['EU' \"'s\" 'of' 'x']", "[]"])
    got = [list(r[0]) for r in df.select(A.parse_quoted_tokens("c")).collect()]
    assert got == [["EU", 's" ', " "], []]
    assert [r[0] for r in df.select(A.build_sentence("c")).collect()] == ['EU s"   ', ""]


def test_parse_int_list_all_or_nothing(spark):
    df = one_col(spark, ["[3 0 x]", "[1  2\t3]", "[]", "[[7]]"])
    assert [list(r[0]) for r in df.select(A.parse_int_list("c")).collect()] == [[], [1, 2, 3], [], [7]]


def test_zip_shortest(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [1, 2])], "t array<string>, g array<int>")
    z = df.select(A.zip_shortest("t", "g").alias("z")).first()["z"]
    assert [(x["a"], x["b"]) for x in z] == [("a", 1), ("b", 2)]


def test_fix_length_mask_and_unmask(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "ids array<int>")
    r = df.select(A.fix_length("ids", 5).alias("f"), A.attention_mask("ids", 5).alias("m"),
                  A.unmask_labels(A.fix_length("ids", 5, -100)).alias("u"),
                  A.fix_length(F.sequence(F.lit(1), F.lit(9)), 4).alias("t")).first()
    assert list(r["f"]) == [5, 6, 7, 0, 0] and list(r["m"]) == [1, 1, 1, 0, 0]
    assert list(r["u"]) == [5, 6, 7, 0, 0] and list(r["t"]) == [1, 2, 3, 4]


def test_decode_tags_and_text(spark):
    df = spark.createDataFrame([([0, 2, None], ["O", "B", "I"], [9])], "c array<int>, names array<string>, bad array<int>")
    r = df.select(A.decode_tags("c", ["O", "B", "I"]).alias("d"), A.decode_tags("c", "names").alias("e"), A.array_text("bad").alias("j")).first()
    assert list(r["d"]) == list(r["e"]) == ["O", "I", None] and r["j"] == "[9]"
    with pytest.raises(Exception, match="tag code without a name"):
        df.select(A.decode_tags("bad", ["O"])).collect()


def test_parsers_take_nulls_and_lists(spark):
    df = spark.createDataFrame([(None, None, None), ("['a', 'b']", ["x"], [1, 2])], "t string, a array<string>, i array<int>")
    rows = df.select(A.parse_quoted_tokens("t"), A.parse_int_list("t"), A.build_sentence("t"), A.parse_quoted_tokens("a", True), A.parse_int_list("i", True),
                     A.build_sentence("a", True)).collect()
    assert [tuple(r) for r in rows] == [([], [], "", [], [], ""), (["a", "b"], [], "a b", ["x"], [1, 2], "x")]


def test_label_rules(spark):
    df = spark.createDataFrame([(0.5,), (0.45,), (0.55,), (0.4499,), (0.97,), (float("nan"),)], "p double")
    rows = df.select(L.class_binary("p"), L.class_banded("p"), L.class_round("p")).collect()
    assert [tuple(r) for r in rows[:5]] == [(2, 1, 0), (0, 1, 0), (2, 1, 1), (0, 0, 0), (2, 2, 1)]
    assert abs(df.select(L.sigmoid(F.lit(0.0))).first()[0] - 0.5) < 1e-12
    t = spark.createDataFrame([(4,), (0,), (2,), (1,)], "t int")
    assert [r[0] for r in t.select(L.recode_target("t")).collect()] == [2, 0, 2, 1]
    assert [r[0] for r in t.select(L.loss_label("t")).collect()] == [4.0, 0.0, 1.0, 1.0]
    assert [r[0] for r in t.select(L.sentiment_is_one("t")).collect()] == [0, 0, 0, 1]


def test_sentiment_to_idx_raises(spark):
    ok = one_col(spark, ["positive", "negative", "neutral"])
    assert [r[0] for r in ok.select(L.sentiment_to_idx("c")).collect()] == [1, 0, 2]
    bad = one_col(spark, ["positive", "meh"])
    with pytest.raises(Exception):
        bad.select(L.sentiment_to_idx("c")).collect()


def test_cast_and_tables(spark):
    df = one_col(spark, ["1", "x", None])
    assert [r[0] for r in df.select(L.cast_label("c")).collect()] == [1, None, None]
    assert [r[0] for r in df.select(tb.fill_text("c")).collect()] == ["1", "x", ""]
    f = one_col(spark, ["a.JPG", "b.png", "c.jpg"])
    assert [r[0] for r in f.select(tb.has_suffix("c", [".jpg"])).collect()] == [False, False, True]
    assert [r[0] for r in f.select(tb.has_suffix("c", [".jpg", ".png"], ignore_case=True)).collect()] == [True, True, True]
    assert math.isclose(1.0, 1.0)
