"""Operators 3, 8, 9 and 10: exactness against brute force, held-out accuracy, edge cases."""

import math
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tonalert.llm import bpe, compression_quality as cq, lm_score as lm, toxicity as tx
from tonalert.llm.common import doc_fold
from tonalert.llm.q_models import tokenizer

SF_MID = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_encode_like_the_library(vocabulary, library):
    rng = random.Random(1)
    for k in range(2500):
        letters = ["etaoinshr", "aab", " .,-!1", "éüñß日本😀", "aeh tho\n"][k % 5]
        piece = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40))).encode()
        assert vocabulary.encode(piece) == library._encode_single_piece(piece)
    assert vocabulary.encode(b"a" * 3000) == library._encode_single_piece(b"a" * 3000)


def test_appends_and_edits_are_exact(vocabulary):
    rng = random.Random(2)
    e = bpe.PrefixEncoder(vocabulary, b"thequickbrownfox" * 40)
    looked = []
    for k in range(150):
        if k % 3 == 0:
            e.append(bytes(rng.choice(b"aehtnos ") for _ in range(rng.randint(0, 6))))
        else:
            a = rng.randint(0, len(e.data))
            looked.append(e.edit(a, min(len(e.data), a + rng.randint(0, 3)), bytes(rng.choice(b"aehtnos") for _ in range(rng.randint(0, 5)))))
        assert e.last == bpe.PrefixEncoder(vocabulary, e.data).last
        assert vocabulary.decode(e.ids()) == e.data
    assert max(looked) < len(e.data) / 2  # an edit is not encoded to the end


def test_bpe_of_tables(spark, library):
    texts = [None, "", " ", "Hello  world\n\n", "<|endoftext|>", "é" * 5000, "ab " * 20000, "x\x00y", "it's 2024"]
    d = spark.createDataFrame([(i if i else None, t, "clash") for i, t in enumerate(texts)] + [(8, texts[8], "z")], "doc_id bigint, text string, ids string")
    tok = tokenizer(spark)
    out = tok.decode(tok.encode(d)).collect()
    assert out[0].__fields__ == ["doc_id", "text", "ids", "decoded"] and len(out) == 10
    for r in out:
        assert array("I", r["ids"]).tolist() == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert tok.encode(d.limit(0)).count() == 0


def test_ranks_file_is_bounded(tmp_path, monkeypatch):
    (tmp_path / "r").write_bytes(b"YQ== 0\n" * 10)
    monkeypatch.setattr(bpe, "MAX_RANKS_BYTES", 20)
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "r"))


def plain_scores(rows):
    """Token by token from plain counts, by the formulas."""
    low = {c: c + 32 for c in range(65, 91)}
    toks = [(WORD.findall((t or "").translate(low)) + [None], zlib.crc32(str("" if i is None else i).encode()) % 5 != 1) for i, t in rows]
    uni, bi, tri, starts = Counter(), Counter(), Counter(), sum(train for _, train in toks)
    for w, train in toks:
        if train:
            uni.update(w)
            bi.update(zip(["<s>", *w], w))
            tri.update(zip([("<s>",), *[(x,) for x in w]], w, w[1:]))
    n, v = sum(uni.values()), len(uni)
    out = []
    for (i, _), (w, train) in zip(rows, toks):
        base = model = 0.0
        for k, x in enumerate(w):
            p = (uni[x] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            one = w[k - 1] if k else "<s>"
            p = (bi[one, x] + lm.MASS * p) / ((uni[one] if k else starts) + lm.MASS)
            if k:
                two = w[k - 2] if k > 1 else "<s>"
                if bi[two, one] >= lm.MIN_CONTEXT:
                    p = (tri[(two,), one, x] + lm.MASS_TWO * p) / (bi[two, one] + lm.MASS_TWO)
            model += math.log10(p)
        out.append((i, train, len(w), sum(uni[x] > 0 for x in w), n, round(base, 6), round(model, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8_000_000, 200])
def test_lm_scores_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm, "RANGE_TOKENS", 50)
    rng = random.Random(4)
    rows = [(None, None), (1, ""), (2, " \n"), (3, "A a A"), (3, "A a A")]
    rows += [(i, " ".join(rng.choice(["the", "THE", "of", "é", "x1", f"w{rng.randint(0, 60)}"]) for _ in range(rng.randint(0, 90)))) for i in range(10, 60)]
    rows += [(99, "long " * 5000), (100, "the of the"), (102, "the of the end"), (103, "the of x1")]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, block int")
    got = lm.scored(d, doc_fold(5) != 1).collect()
    assert sorted(((r["doc_id"], r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got), key=repr) == plain_scores(rows)


def block_of(texts, train):
    """A block and the totals of its own training texts."""
    import numpy as np

    raw = [t.encode() for t in texts]
    hashes, first = lm.text_tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]).astype(np.int64))
    vocabulary, token = np.unique(hashes, return_inverse=True)
    row = {"doc_ids": lm.pack(np.arange(len(texts))), "id_null": lm.pack(np.zeros(len(texts), bool)), "train": lm.pack(np.array(train)),
           "first": lm.pack(first), "vocabulary": lm.pack_sorted(vocabulary), "token": lm.pack(token.astype("u4"))}
    b = lm.Block(row)
    flags = b.training()
    words, pairs = np.bincount(b.token[flags], minlength=len(vocabulary)), np.bincount(b.pair_of[flags], minlength=len(b.pair))
    triple, _, ends, of = b.triples(pairs)
    return b, words, pairs, np.bincount(of[flags[ends]], minlength=len(triple)), int(flags.sum())


def test_failure_arcs_of_more_than_one_step_are_walked(monkeypatch):
    """'a b' has a state; 'c' never follows it, nor 'b', so the way leads from 'a b' over 'b' to the state without memory."""
    import numpy as np

    texts = ["a b d"] * 5 + ["c e", "a b c"]
    b, words, pairs, triples, tokens = block_of(texts, [True] * 6 + [False])
    m = lm.Automaton(b, words, pairs, triples, tokens, int((words > 0).sum()), 6)
    at = int(b.first[6]) + 2  # the token 'c' of the last text
    assert b.vocabulary[b.token[at]] == b.vocabulary[b.token[b.first[5]]]
    assert (m.arc[2][at], m.arc[1][at]) == (-1, -1) and m.arc[0][at] >= 0
    state = m.target[m.arc[1][at - 1]]  # after 'a b'
    chain = [int(state)]
    while chain[-1]:
        chain.append(int(m.fail[chain[-1]]))
    assert [int(m.order[s]) for s in chain] == [2, 1, 0]
    only = m.read()[6]
    p0 = lambda c: (c + 0.5) / (tokens + 0.5 * (int((words > 0).sum()) + 1))
    after_start = (5 + lm.MASS * p0(5)) / (6 + lm.MASS)
    b_after_a = (5 + lm.MASS_TWO * (5 + lm.MASS * p0(5)) / (5 + lm.MASS)) / (5 + lm.MASS_TWO)  # '<start> a' has a state as well
    c_after_ab = lm.MASS_TWO / (5 + lm.MASS_TWO) * lm.MASS / (5 + lm.MASS) * p0(1)
    end_after_c = lm.MASS / (1 + lm.MASS) * p0(6)
    assert only == pytest.approx(sum(map(math.log10, (after_start, b_after_a, c_after_ab, end_after_c))), abs=1e-9)
    assert np.all(m.weight <= 1e-12) and np.all(m.fail_weight <= 0)


def test_lm_without_rows_or_training(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert lm.scored(d.limit(0), F.lit(True)).count() == 0
    r = lm.scored(d, F.lit(False)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and r["score"] == pytest.approx(0.0)


def test_lm_beats_unigrams_on_held_out_texts(spark):
    d = spark.read.parquet(f"{SF_MID}/documents.parquet")
    r = lm.scored(d, doc_fold(5) != 1).where("NOT train").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def accuracy(spark, scores, label, fold, cut):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    held = scores.where(fold).join(labels, "doc_id").select("doc_id", ((F.col("score") >= cut).cast("int")).alias("p"), F.col(label).alias("y")).collect()
    return sum(r["p"] == r["y"] for r in held) / len(held), [r for r in held if r["p"] != r["y"]]


def test_compression_classifier_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    scores = cq.scored(d, labels, doc_fold(3) != 1)
    assert scores.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    assert accuracy(spark, scores, "quality", doc_fold(3) == 1, 0.5)[0] > 0.95


def test_toxicity_on_held_out_rows(spark):
    d, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    scores = tx.scored(d, labels, doc_fold(4) != 2)
    share, wrong = accuracy(spark, scores, "toxic", doc_fold(4) == 2, 0.3)
    assert share > 0.9 and not [r for r in wrong if r["y"] == 0]


@pytest.mark.parametrize("module, label", [(cq, "quality"), (tx, "toxic")])
def test_classifiers_take_nulls_and_missing_classes(spark, module, label):
    texts = [None, "", " ", "word " * 30, "x" * 100_000, "same", "same"]
    d = spark.createDataFrame([(i if i != 5 else None, t, 0.5) for i, t in enumerate(texts)], "doc_id bigint, text string, score double")
    few = spark.createDataFrame([(3, 1), (6, None), (None, 1), (77, 0)], f"doc_id bigint, {label} int")
    for labels in (few, few.limit(0)):
        rows = module.scored(d, labels, F.lit(True)).collect()
        assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows)
    assert module.scored(d.limit(0), few, F.lit(True)).count() == 0


def insult_model():
    words = ["idiot", "stupid", "loser", "pathetic", "the", "other", "worthless", "people", "are", "reading", "noon", "book", "moron"]
    grams = Counter()
    for w in words:
        w = f"^^{w}^"
        grams.update(w[i:i + 3] for i in range(len(w) - 2))
    return tx.CharModel({g: n * 50 for g, n in grams.items()})


@pytest.mark.parametrize("disguised, plain", [
    ("1d10t", "idiot"), ("$tup1d", "stupid"), ("l0ser", "loser"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"),
    ("m-o-r-0-n", "moron"), ("p@thet1c", "pathetic"), ("looooser", "loser"), ("idiot", "idiot"), ("b00k", "book"), ("l 0 s 3 r", "loser")])
def test_disguised_words_are_restored(disguised, plain):
    model = insult_model()
    assert tx.restore(disguised, model) == plain
    assert plain in tx.tokens(f"You, {disguised.upper()}! and others", tx._memo(model))


@pytest.mark.parametrize("text", ["you are a s t u p i d person", "s,t,u,p,i,d", "s / t / u / p / i / d", "I s-t-u-p-i-d a", "st/up/id", "x s't'u'p'i'd"])
def test_spaced_words_beside_words_of_one_letter(text):
    assert "stupid" in tx.tokens(text, tx._memo(insult_model()))


def test_disguise_is_told_in_linear_time():
    import time

    assert tx.disguised("a1b") and tx.disguised("$tupid") and tx.disguised("aaab") and tx.disguised("a.b") and tx.disguised("x" * 9000 + "1y")
    assert not any(map(tx.disguised, ["", "abc", "123", "a1", "1a", "abc.", ".a", "é", "...a"]))
    began = time.perf_counter()
    for token in ("a" + "1" * 1_000_000, "1" * 1_000_000, "a" + "." * 1_000_000, "ab" * 500_000, "a1" * 300_000 + "é"):
        tx.disguised(token)
    assert time.perf_counter() - began < 5


def test_sample_skips_unusable_rows_and_spreads_over_long_texts(spark):
    from tonalert.llm.training import labelled_sample

    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [(i, None if i % 3 else ("" if i % 2 else f"short {i}")) for i in range(300)] + [(500 + i, long + f" é{i}") for i in range(5)]
    labels = [(i, 1) for i in range(300)] + [(500 + i, 0) for i in range(5)] + [(9000 + i, 0) for i in range(50)]
    out = labelled_sample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), "toxic", F.lit(True), 20, 4096).collect()
    assert sum(r["y"] for r in out) == 20 and len(out) == 25
    for r in out:
        assert r["text"] and len(r["text"].encode()) <= 4096
        if not r["y"]:
            words = r["text"].split()
            places = [int(w[1:]) for w in words if w[0] == "w"]
            assert set(words) <= {*long.split(), "é0", "é1", "é2", "é3", "é4"} and len({p // 6000 for p in places}) == 10


def test_plain_words_stay():
    model = insult_model()
    assert tx.tokens("The Other, (people) reading: noon 2024 été", tx._memo(model)) >= {"the", "other", "people", "reading", "noon", "2024", "été"}
    assert tx.restore("", model) == "" and len(tx.restore("a1" * 5000, model)) <= 10_000


def test_restore_keeps_a_rare_beginning_until_the_end():
    from tonalert.llm import toxicity as tx

    # The other 24 readings of '**' as two vowels are likelier than 'uo' at first; only 'uo' goes on with 'ts'.
    words = {a + b: 50 for a in "aeiou" for b in "aeiou" if a + b != "uo"} | {"uots": 1}
    grams = Counter()
    for w, n in words.items():
        w = f"^^{w}^"
        for i in range(len(w) - 2):
            grams[w[i:i + 3]] += n
    assert tx.restore("**ts", tx.CharModel(grams)) == "uots"


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only a few of many thousand toxic texts hold is in the lexicon, as are words at the end of a long text."""
    n = 9_000
    rows = [(i, f"some plain words {i}" + (" dreadword" if i % 2 else " goodword"), i % 2) for i in range(n)]
    rows += [(n + i, "some plain words " * 3_000 + "rarebadword", 1) for i in range(6)] + [(n + 5, "again the same id", 1)]
    d = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model, odds, _ = tx.fit(d, labels, F.lit(True))
    assert {"=dreadword", "=rarebadword"} <= odds.keys() and "=goodword" not in odds and "=plain" not in odds
    assert model.tri["pla"] == model.tri["^pl"] >= n + 5 * 3_000


def by_pieces(text, decode):
    """The restored tokens of a text, piece by piece."""
    text = text.lower()
    apart = {decode(part) for m in tx._SPACED.finditer(text) for part in tx.spaced(m.group())}
    return (apart | {tx._read(raw, decode) for raw in text.split()}) - {None}


ODD_SIGNS = "aabbceiostdu  ..--''*$$$@10!|€£éßœ÷×xyz,/\\·’#%\x1c\xa0\u2003\nΣİA ZŸ"


def test_blocks_of_texts_are_read_like_their_pieces():
    """one block of many texts gives each text the tokens that its pieces give one by one."""
    rng, decode = random.Random(6), tx._memo(insult_model())
    texts = ["".join(rng.choice(ODD_SIGNS) for _ in range(rng.randint(0, 40))).lower() for _ in range(1500)] + ["", " ", "a b c ", "(stupid) s t u p 1 d\u3000"]
    words, of, at = tx.read_block(texts, decode)
    found = [set() for _ in texts]
    for i, k in zip(of.tolist(), at.tolist()):
        found[i].add(words[k].as_py())
    assert found == [by_pieces(t, decode) for t in texts] and len(set(zip(of.tolist(), at.tolist()))) == len(of)


def test_plain_pieces_are_not_read_one_by_one(monkeypatch):
    """only what may be a disguise, or has marks before it, becomes a Python value on its own."""
    read, one_by_one = tx._read, []
    monkeypatch.setattr(tx, "_read", lambda raw, decode: one_by_one.append(raw) or read(raw, decode))
    text = " ".join(f"{a}{b}word," for a in "abcdefgh" for b in "abcdefgh") + " (this) l0ser"
    assert {"aaword", "hhword", "this", "loser"} <= tx.tokens(text, tx._memo(insult_model())) and set(one_by_one) <= {"(this)", "l0ser", ""}


def test_trigrams_are_those_of_runs_of_letters(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tx, "RUN", 7)
    monkeypatch.setattr(tx, "BLOCK_BYTES", 100)
    rng = random.Random(8)
    texts = ["".join(rng.choice(ODD_SIGNS) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", "\U0001f600a\U0001f600"]
    expected = Counter()
    for t in texts:
        for w in tx._PLAIN.findall((t or "").lower()):
            expected.update(f"^^{w}^"[i:i + 3] for i in range(len(w) + 1))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    assert sum(b.num_rows for b in tx.blocks(batch)) == len(texts) and len(list(tx.blocks(batch))) > 20
    out = [row for b in tx._trigrams([batch]) for row in b.to_pylist()]
    assert len(out) == len(expected) and {r["gram"]: r["n"] for r in out} == expected


@pytest.mark.parametrize("limit, least", [(tx.CANDIDATE_LIMIT_BYTES, 2), (0, 2), (0, 3)])
def test_lexicon_counts_are_those_of_texts(spark, monkeypatch, limit, least):
    """with and without a broadcast of the toxic texts' keys, and where a restored token begins with '='."""
    monkeypatch.setattr(tx, "CANDIDATE_LIMIT_BYTES", limit)
    rng, model = random.Random(9), insult_model()
    some = ["idiot", "1d10t", "=1d10t", "stupidly", "stupidest", "(people)", "été", "the", "worthlessness", "x y z", "looooser", ""]
    rows = [(" ".join(rng.choices(some, k=rng.randint(0, 6))) or None, i % 2, i // 2 % 2) for i in range(60)]
    expected, decode = {}, tx._memo(model)
    for t, h, y in rows:
        for k in {k for w in by_pieces(t or "", decode) for k in tx.described(w)}:
            expected.setdefault(k, Counter())[f"n{h}{y}"] += 1
    out = tx.lexicon_counts(spark.createDataFrame(rows, "text string, half int, y int").repartition(3), model, least).collect()
    assert len(out) == len({r["key"] for r in out})
    assert {r["key"]: {c: r[c] for c in ("n00", "n01", "n10", "n11")} for r in out} == {
        k: {c: n[c] for c in ("n00", "n01", "n10", "n11")} for k, n in expected.items() if n["n01"] + n["n11"] >= least}


def test_logistic_of_rows_equals_the_one_in_memory(spark):
    from tonalert.llm.training import Logistic

    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1, 5, 0] + [0, 2, 7]
    y = (x[:, 0] + rng.normal(size=400) > 0.3).astype(int)
    rows = spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(x, y)], "x0 double, x1 double, x2 double, y int").repartition(3)
    assert np.allclose(Logistic.of_rows(rows, ["x0", "x1", "x2"], "y")(x), Logistic(x, y)(x), atol=1e-6)
