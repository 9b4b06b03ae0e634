"""Operators 4, 5 and 7 against plain statements of their rules, and their edge cases."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tonalert.llm import line_dedup as ld
from tonalert.llm import quality_rules as qr
from tonalert.llm import sharding as sh

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LINE = "a line that very many documents hold"
TEXTS = [None, "", " \n\t", "one", "a b a b a b a b", f"{LINE}\nx\n{LINE.upper()} ", f" {LINE}\ny\n\n", f"z\n{LINE}", f"z\n{LINE}", "é" * 19, "#%$ <>|&*\x0b ! É",
         "\n".join(["word one two three four five six seven"] * 20), " ".join(f"w{i % 400}" for i in range(3000)), "\x1cq\x85r q r q"]


def docs(spark, texts=TEXTS, **extra):
    rows = [(i if i != 3 else None, t, ["en", "fr", None][i % 3], "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], "doc_id bigint, text string, lang string, n_words string")


def plain_counts(t):
    t = t or ""
    w = WORDS.findall(t)
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_quality_counts(spark):
    got = qr.with_features(docs(spark)).select("text", *qr.COUNTS).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert tuple(r)[1:] == plain_counts(r["text"]), r["text"]


@pytest.mark.parametrize("n, x, p", [(10, 0, 0.05), (117, 0, 0.05), (300, 5, 0.05), (4000, 150, 0.05), (50, 3, 0.05), (0, 0, 0.05), (20000, 900, 0.05)])
def test_binomial_cdf_is_exact(spark, n, x, p):
    got = spark.range(1).select(qr.binomial_cdf(F.lit(x).cast("bigint"), F.lit(n).cast("bigint"), p)).first()[0]
    want = 1.0 if x >= n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(x + 1))
    assert got == pytest.approx(want, rel=1e-8)


def labelled_docs(spark, good, bad, lang="en"):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text + (" %%% ###" if i >= good else ""), lang) for i in range(good + bad)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return d, spark.createDataFrame([(i, int(i < good)) for i in range(good + bad)], "doc_id bigint, quality int")


def test_certified_rule_rejects_bad_and_keeps_good(spark):
    d, labels = labelled_docs(spark, 400, 60)
    f = qr.with_features(d)
    got = {r["doc_id"]: r["kept"] for r in qr.with_verdict(f, qr.thresholds(f, labels)).collect()}
    assert all(got[i] for i in range(400)) and not any(got[i] for i in range(400, 460))


def test_too_few_labels_certify_nothing(spark):
    d, labels = labelled_docs(spark, 40, 30)
    f = qr.with_features(d)
    assert all(r["kept"] for r in qr.with_verdict(f, qr.thresholds(f, labels)).collect())


def test_false_rejections_break_a_rule(spark):
    """Good holdout rows that a rule rejects too often keep it from use."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text + (" %%%" if i >= 400 or i % 5 == 0 else ""), "en") for i in range(500)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(500)], "doc_id bigint, quality int")
    f = qr.with_features(d)
    assert all(r["kept"] for r in qr.with_verdict(f, qr.thresholds(f, labels)).collect())


def test_quality_edges(spark):
    d = docs(spark)
    none = spark.createDataFrame([(None, 1), (1, None), (77, 1)], "doc_id bigint, quality int")
    f = qr.with_features(d)
    out = qr.with_verdict(f, qr.thresholds(f, none)).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        n = plain_counts(r["text"])
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and r["kept"] == (not r["base_failed"])
    assert qr.with_features(d.limit(0)).count() == 0


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def plain_line_dedup(rows):
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(h := holders.get(key(x), ())) >= 3 and i != max((y for y in h if y is not None), default=i))]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def test_line_dedup(spark):
    d = docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    out = ld.drop_lines(d, ld.keep_bitmaps(d))
    assert out.columns == ["doc_id", "text", "lang", "n_words", "n_lines", "n_dropped"]
    got = sorted(((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in out.collect()), key=repr)
    assert got == plain_line_dedup(rows)
    assert any(r[3] for r in got)


@pytest.mark.parametrize("share", [1000, 20, 1])
def test_line_dedup_long_and_hot(spark, monkeypatch, share):
    """Lines all broadcast, some, and all joined."""
    monkeypatch.setattr(ld, "HOT_SHARE", share)
    lines = [f"this is the shared line number {k}" for k in range(300)]
    rows = [(i, "\n".join(lines + [f"own {i}"] + lines[:65])) for i in range(6)] + [(None, lines[0])]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    bitmaps = ld.keep_bitmaps(d)
    assert {len(r["words"]) for r in bitmaps.where("doc_id = 0").collect()} == {6}
    got = sorted(((r["doc_id"], r["text"] or "", r["n_lines"], r["n_dropped"]) for r in ld.drop_lines(d, bitmaps).collect()), key=repr)
    assert got == plain_line_dedup(rows)


def test_line_dedup_without_rows(spark):
    d = docs(spark).limit(0)
    assert ld.drop_lines(d, ld.keep_bitmaps(d)).count() == 0


def test_index_ranges_need_no_second_exchange(spark):
    d = spark.createDataFrame([(i, LINE) for i in range(50)], "doc_id bigint, text string")
    index = ld.occurrence_index(d)
    assert index.where("first").count() == 50


def check_shards(rows, shards):
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    largest = max(r["size"] for r in rows)
    for k in range(shards):
        assert abs(sum(r["size"] for r in by.get(k, [])) - total / shards) <= largest


def test_shards(spark):
    texts = TEXTS + ["the same text again"] * 300 + [f"text {i} " * (i % 37) for i in range(400)]
    rows = sh.shards_by_bytes(docs(spark, texts)).collect()
    assert len(rows) == len(texts) + 1
    check_shards(rows, 8)
    want = Counter((i if i != 3 else None, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in [*enumerate(texts), (len(texts) - 1, texts[-1])])
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    # Ranges that are divided again and again give the same shards.
    again = sh.shards_by_bytes(docs(spark, texts), min_ranges=2, max_rows=25).collect()
    assert sorted((r["doc_id"] or -1, r["shard"], r["slot"]) for r in again if r["doc_id"] != len(texts) - 1) == sorted(
        (r["doc_id"] or -1, r["shard"], r["slot"]) for r in rows if r["doc_id"] != len(texts) - 1)


def test_shards_of_no_rows_and_one_shard(spark):
    assert sh.shards_by_bytes(docs(spark).limit(0)).count() == 0
    rows = sh.shards_by_bytes(docs(spark), shards=1).collect()
    assert {r["shard"] for r in rows} == {0} and sorted(r["slot"] for r in rows) == list(range(len(rows)))
