"""Phrases and the learned tagger, on both of their ways, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tonalert.operators import taggers as TG

WAYS = [TG.TRIE_LIMIT_BYTES, 0]  # in place, and joined by prefix length or word
ROWS = "doc_id long, tokens array<string>, tags_x int"


def plain_tags(tokens, listed):
    if tokens is None:
        return None
    longest = max((len(p.split()) for p in listed), default=0)
    out, i, before = [], 0, None
    while i < len(tokens):
        for n in range(min(longest, len(tokens) - i), 0, -1):
            words = tokens[i:i + n]
            kind = None if any(w is None or " " in w for w in words) else listed.get(" ".join(words))
            if kind is not None:
                out += [("I-" if before == kind else "B-") + kind] + ["I-" + kind] * (n - 1)
                i, before = i + n, kind
                break
        else:
            out.append("O")
            i, before = i + 1, None
    return out


def gazetteer(spark, listed, limit):
    return TG.Gazetteer(spark.createDataFrame(list(listed.items()), "tok string, kind string"), limit=limit)


def tagged(spark, rows, tagger):
    out = tagger.tag(spark.createDataFrame(rows, ROWS).repartition(3)).collect()
    return sorted(((r["doc_id"], r["tokens"], r["tags"]) for r in out), key=repr)


@pytest.mark.parametrize("limit", WAYS)
def test_phrases_match_leftmost_longest(spark, limit):
    listed = {"New York": "LOC", "New York City Council": "ORG", "York": "PER", "City Council": "ORG", "Ann": "PER", "of": "MISC"}
    rows = [(1, "in New York City Council of New York City".split(), 1), (2, "New York City Hall".split(), 1), (3, "Ann Ann York New".split(), 1)]
    got = {i: tags for i, _, tags in tagged(spark, rows, gazetteer(spark, listed, limit))}
    assert got[2] == ["B-LOC", "I-LOC", "O", "O"]
    assert got[3] == ["B-PER", "I-PER", "I-PER", "O"]
    assert got[1] == ["O", "B-ORG", "I-ORG", "I-ORG", "I-ORG", "B-MISC", "B-LOC", "I-LOC", "O"]


@pytest.mark.parametrize("limit", WAYS)
def test_nested_and_overlapping_names_at_random(spark, limit):
    rng = random.Random(5)
    words = list("abcd") + ["x y", "é"]
    listed = {" ".join(rng.choice("abcdé") for _ in range(rng.choice([1, 2, 2, 3, 5]))): rng.choice(["PER", "LOC"]) for _ in range(14)}
    rows = [(rng.choice([1, 2, None, k]), rng.choice([None, *[[rng.choice([*words, None]) for _ in range(rng.randint(0, 30))] for _ in range(20)]]), k) for k in range(300)]
    rows += [(None, ["a", "b"], 1), (None, ["b", "a"], 1), (7, ["a"], 1), (7, ["b"], 1)]
    assert tagged(spark, rows, gazetteer(spark, listed, limit)) == sorted(((i, t, plain_tags(t, listed)) for i, t, _ in rows), key=repr)


@pytest.mark.parametrize("limit", WAYS)
def test_no_phrases_no_rows_and_a_long_row(spark, limit):
    assert tagged(spark, [(1, ["a"], 1), (2, [], 1)], gazetteer(spark, {"": "PER", " ": "LOC"}, limit)) == [(1, ["a"], ["O"]), (2, [], [])]
    assert tagged(spark, [], gazetteer(spark, {"a": "PER"}, limit)) == []
    tokens = ["a", "b", "a"] * 7000
    listed = {"a": "PER", "a b": "LOC", "b": "ORG"}
    assert tagged(spark, [(1, tokens, 1)], gazetteer(spark, listed, limit))[0][2] == plain_tags(tokens, listed)


def plain_viterbi(tokens, model, scores):
    k = len(model.tags)
    paths = [(model.steps[k][s] + scores.get(tokens[0], model.unknown)[s], [s]) for s in range(k)]
    for w in tokens[1:]:
        e = scores.get(w, model.unknown)
        ways = [[(paths[b][0] + model.steps[b][s], b) for b in range(k)] for s in range(k)]
        best = [max(x, key=lambda v: (v[0], -v[1])) for x in ways]
        paths = [(best[s][0] + e[s], [*paths[best[s][1]][1], s]) for s in range(k)]
    return [model.tags[s] for s in max(paths, key=lambda p: (p[0], [-s for s in p[1][::-1]]))[1]]


def gold(seed, n):
    """Sentences where a word's tag depends on the tag before: 'may' goes on a name, and is a month elsewhere."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tokens, tags = [], []
        for _ in range(rng.randint(1, 12)):
            lead, tag, then = rng.choice([("in", "O", "B-MISC"), ("ann", "B-PER", "I-PER"), ("at", "O", "O")])
            tokens += [lead, f"x{rng.randint(0, 400)}" if then == "O" else rng.choice(["may", "june"])]
            tags += [tag, then]
        rows.append((i, tokens, tags))
    return rows


@pytest.mark.parametrize("limit", WAYS)
def test_learned_tagger_takes_the_best_path(spark, monkeypatch, limit):
    monkeypatch.setattr(TG, "VITERBI_TOKENS", 50)
    schema = "doc_id long, tokens array<string>, tags array<string>"
    train, test = gold(1, 200), gold(2, 60)
    model = TG.Hmm.fit(spark.createDataFrame(train, schema), limit=limit)
    scores = {r["word"]: r["scores"] for r in model.emissions.collect()}
    assert model.tags == ["B-MISC", "B-PER", "I-PER", "O"] and len(scores) == len({w for _, t, _ in train for w in t})
    rows = [(i % 7 or None, t, 1) for i, t, _ in test] + [(1, [], 1), (2, None, 1), (3, [None, "in", "may"], 1), (4, ["in", "may"] * 300, 1)]
    got = tagged(spark, rows, model)
    assert got == sorted(((i, t, t and plain_viterbi(t, model, scores)) for i, t, _ in rows), key=repr)
    # Held-out tags: better than a list of the words' own kinds, which cannot tell 'may' from 'may'.
    words = {w: tag[2:] for _, t, g in train for w, tag in zip(t, g) if tag != "O"}
    of = {repr(t): tags for _, t, tags in got}
    right = sum(a == b for _, t, g in test for a, b in zip(of[repr(t)], g))
    by_list = sum(a == b for _, t, g in test for a, b in zip(plain_tags(t, words), g))
    assert right > 1.2 * by_list and right > 0.9 * sum(len(g) for _, _, g in test)


def test_learned_tagger_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, tokens array<string>, tags array<string>")
    assert TG.Hmm.fit(empty).tag(spark.createDataFrame([(1, ["a", "b"], 1)], ROWS)).first()["tags"] == ["O", "O"]


def test_phrases_of_more_words_than_are_joined(spark, monkeypatch):
    monkeypatch.setattr(TG, "JOINED_WORDS", 2)
    listed = {"a b c d e": "PER", "a b c": "LOC", "a b": "ORG", "b c d e a b": "MISC", "e": "LOC"}
    rng = random.Random(3)
    rows = [(k % 5, [rng.choice("abcde") if rng.random() < 0.2 else "abcde"[j % 5] for j in range(25)], k) for k in range(150)]
    want = sorted(((i, t, plain_tags(t, listed)) for i, t, _ in rows), key=repr)
    assert tagged(spark, rows, gazetteer(spark, listed, 0)) == want == tagged(spark, rows, gazetteer(spark, listed, 1 << 20))


def test_a_phrase_of_many_words_makes_one_small_row_a_word(spark):
    """The trie's rows hold a step each; with the whole phrase in every row this one took minutes and gigabytes."""
    import time

    n = 30_000
    words = [f"w{i % 7919}" for i in range(n)]
    began = time.time()
    trie = TG.phrase_trie(spark.createDataFrame([(" ".join(words), "PER"), ("w0 w1", "LOC")], "tok string, kind string"))
    rows = {r["n"]: r for r in trie.collect()}
    assert time.time() - began < 60
    assert len(rows) == n and all(rows[k]["next"] == rows[k + 1]["state"] and rows[k]["word"] == words[k - 1] for k in range(1, n))
    assert rows[2]["kind"] == "LOC" and rows[2]["more"] and rows[n]["kind"] == "PER" and not rows[n]["more"]
    state = TG.ROOT
    for k in range(1, 200):  # the fold by blocks gives the plain chain of hashes
        assert rows[k]["state"] == state
        state = spark.range(1).select(F.xxhash64(F.lit(state).cast("bigint"), F.lit(words[k - 1]))).first()[0] if k in (1, 63, 64, 65, 128) else rows[k]["next"]


def test_a_phrase_longer_than_the_joined_levels_is_found_beyond_them(spark):
    words = [f"w{i}" for i in range(3 * TG.STATE_BLOCK + 5)]
    listed = {" ".join(words): "PER", " ".join(words[:TG.JOINED_WORDS + 1]): "LOC", words[2]: "ORG"}
    rows = [(1, ["a", *words, "b"], 1), (2, words[:-1], 1), (3, words[:TG.JOINED_WORDS], 1)]
    for limit in WAYS:
        assert tagged(spark, rows, gazetteer(spark, listed, limit)) == sorted(((i, t, plain_tags(t, listed)) for i, t, _ in rows), key=repr)
