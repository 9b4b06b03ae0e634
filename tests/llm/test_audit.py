"""Operator 11 against documents sent through every order one by one, and its edge cases."""

import itertools
import math
import random
import re
from collections import Counter

import pytest

from tonalert.llm import filter_audit as fa

SCHEMA = "doc_id bigint, text string, source string, part string, mask string"
LABELS = "doc_id bigint, quality int, toxic int"


def failing(doc_id, text, smallest):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
    out += "D" if re.search("[#$%&*|]", text) else ""
    return out + ("E" if doc_id is not None and smallest is not None and doc_id > smallest else "")


def brute(rows, labels):
    smallest: dict = {}
    for i, t, *_ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, sums = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for i, t, source, *_ in rows:
            part, fails = source or "", failing(i, t, smallest.get(t or ""))
            gone = next((k for k, x in enumerate(order) if x in fails), 5)
            for k, x in enumerate(order):
                row = out.setdefault((part, order, k + 1), [0] * 6)
                lost = gone == k
                for at, hit in enumerate((gone > k, lost, gone < k and x in fails, fails == x, lost and i in good, lost and i in toxic)):
                    row[at] += hit
                sums[part, x] += lost
    return {(p, o, k): (*row, sums[p, o[k - 1]]) for (p, o, k), row in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = fa.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in out}


def random_rows(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = ["", None, "Ab", "x " * 300, "ÀÉ é" * 80, "a\x0bb\x1cc\x85d " * 60, "COPY " * 250]
    for _ in range(25):
        some = rng.sample(words, rng.choice([20, 150, 399])) * rng.choice([1, 1, 3])
        texts.append(rng.choice(["", "#", "A" * 60]) + " ".join(some) + rng.choice(["", "\n", " $"]))
    ids = [*range(n), None, 3, 3]
    return [(i, rng.choice(texts + texts[:7] * 2), rng.choice(["s", "t", None, ""])) for i in ids]


@pytest.mark.parametrize("share", [1000, 5, 1])
def test_audit_matches_brute_force(spark, monkeypatch, share):
    """With lists of hot texts, of rare texts, and both."""
    monkeypatch.setattr(fa, "HOT_SHARE", share)
    rows = random_rows(share, 60)
    labels = [(i, i % 2, i % 3 and 1) for i in range(0, 50, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None), (999, 1, 1)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_copies_by_a_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(fa, "checked_broadcast", lambda df, materialize=True: df)
    rows = random_rows(9, 60)
    assert audited(spark, rows, [(1, 1, 1)]) == brute(rows, [(1, 1, 1)])


def test_paths_through_the_lattice():
    through = fa.paths(5)
    assert len(through) == 80
    for k in range(5):  # every order takes one edge of each level
        assert sum(v for (s, _), v in through.items() if bin(s).count("1") == k) == 120
    for f in range(5):  # and one edge of each filter
        assert sum(v for (_, g), v in through.items() if g == f) == 120
    assert all(v == math.factorial(bin(s).count("1")) * math.factorial(4 - bin(s).count("1")) for (s, _), v in through.items())


def test_no_rows_and_no_labels(spark):
    assert audited(spark, [], []) == {}
    got = audited(spark, [(1, None, None)], [])
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
