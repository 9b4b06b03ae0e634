"""Lookup in blocks: large tables of phrases, words and emissions, against plain Python and by what they write."""

import os
import random

import pytest
from test_taggers import gazetteer, gold, plain_tags, plain_viterbi, tagged

from tonalert.operators import lookup as LK
from tonalert.operators import models as MD
from tonalert.operators import taggers as TG
from tonalert.session import shared_folder


def written(spark):
    top = f"{shared_folder(spark).removeprefix('file:')}/tonalert-io"
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet"))


def test_phrases_of_many_tokens_are_written_in_a_few_bytes_a_token(spark):
    """A level of the trie used to write every place with the words behind it (5.2 bytes a token here)."""
    rng = random.Random(2)
    listed = {" ".join(f"w{rng.randint(0, 300)}" for _ in range(n)): rng.choice(["PER", "LOC"]) for n in (1, 2, 2, 3) for _ in range(3000)}
    rows = [(k, [f"w{min(int(rng.expovariate(0.02)), 300)}" for _ in range(200)], k) for k in range(3000)]
    tagger = gazetteer(spark, listed, 0)
    before = written(spark)
    got = tagged(spark, rows, tagger)
    assert written(spark) - before < 4 * 200 * len(rows)
    assert got[::50] == sorted(((i, t, plain_tags(t, listed)) for i, t, _ in rows), key=repr)[::50]


@pytest.mark.parametrize("bits", [LK.FILTER_BITS, 9])
def test_blocks_ranges_and_a_filter_that_is_too_small(spark, monkeypatch, bits):
    monkeypatch.setattr(LK, "BLOCK_TOKENS", 60)
    monkeypatch.setattr(LK, "FILTER_BITS", bits)
    monkeypatch.setattr(LK, "HELD_ENTRIES", 5)
    monkeypatch.setattr(TG, "JOINED_WORDS", 3)
    rng = random.Random(11)
    listed = {" ".join(rng.choice("abcdé") for _ in range(rng.choice([1, 2, 3, 4, 6, 9]))): rng.choice(["PER", "LOC", "ORG"]) for _ in range(60)}
    rows = [(rng.choice([1, None, k]), rng.choice([None, *[[rng.choice(["a", "b", "c", "d", "é", "x y", "", None]) for _ in range(rng.randint(0, 40))] for _ in range(20)]]), k)
            for k in range(200)] + [(5, p.split() * 2, 1) for p in listed]
    want = sorted(((i, t, plain_tags(t, listed)) for i, t, _ in rows), key=repr)
    assert tagged(spark, rows, gazetteer(spark, listed, 0)) == want


def test_the_learned_tagger_joins_no_single_tokens(spark, monkeypatch):
    """Every token was a row of a join with the emissions."""
    monkeypatch.setattr(LK, "BLOCK_TOKENS", 40)
    schema = "doc_id long, tokens array<string>, tags array<string>"
    model = TG.Hmm.fit(spark.createDataFrame(gold(1, 100), schema), limit=0)
    scores = {r["word"]: r["scores"] for r in model.emissions.collect()}
    rows = [(i % 7 or None, t, 1) for i, t, _ in gold(2, 60)] + [(1, [], 1), (2, None, 1), (3, [None, "in", "unseen"], 1)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, x int")
    out = model.tag(df)
    assert "Generate" not in out._jdf.queryExecution().toString()
    assert out.columns == ["doc_id", "tokens", "x", "tags"]
    got = sorted(((r["doc_id"], r["tokens"], r["tags"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, t, t and plain_viterbi(t, model, scores)) for i, t, _ in rows), key=repr)


def test_kinds_of_words_are_aggregated_by_hashing_first(spark):
    """The minimum of texts alone sorted every word of every span."""
    spans = spark.createDataFrame([("a b", "PER"), ("a", "LOC"), ("b", None), ("", "ORG")], "entity string, tag string")
    for f, want in ((MD.gazetteer_from_spans, {"a": "LOC", "b": "PER"}), (MD.phrases_from_spans, {"a b": "PER", "a": "LOC", "b": None, "": "ORG"})):
        out = f(spans)
        assert "HashAggregate(keys=[tok" in out._jdf.queryExecution().toString()
        assert {r["tok"]: r["kind"] for r in out.collect()} == want
