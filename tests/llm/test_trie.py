"""Operator 12 against a trie built turn by turn, and its edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tonalert.llm import conversation_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, x int"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [r[3] for r in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(own.items()):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def built(spark, rows):
    df = spark.createDataFrame([(*r, "depth", 1) for r in rows], SCHEMA)
    out = ct.prefix_trie(df)
    assert out.dtypes == [(c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("ends_sha256", "string")]
    return sorted(map(tuple, out.collect()))


def random_rows(seed):
    rng = random.Random(seed)
    texts = ["", None, "a", "ab", "é" * 3, "long " * 9]
    rows = []
    for c in rng.sample(range(-120, 420), 90) + [0, 100, 200]:
        for turn in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 20])):
            rows.append((c, rng.choice([turn, turn, turn, None, 1]), rng.choice(["user", "user", "bot", None]), rng.choice(texts[:rng.choice([2, 3, 6])])))
    same = [(turn, "user", f"t{turn}") for turn in range(17)]
    rows += [(c, *t) for c in range(1000, 1030) for t in same]  # copies, and beginnings of them
    rows += [(c, *t) for c in range(1030, 1040) for t in same[:c - 1024]]
    return rows + [(None, 1, "user", "x"), (None, None, None, None)]


@pytest.mark.parametrize("block", [1, 3, 8])
def test_trie_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ct, "BLOCK", block)
    monkeypatch.setattr(ct, "ID_RUN", 4)
    rows = random_rows(block)
    assert built(spark, rows) == brute(rows)


def test_trie_by_shuffle_joins(spark, monkeypatch):
    monkeypatch.setattr(ct, "checked_broadcast", lambda df, materialize=True: df)
    rows = random_rows(7)
    assert built(spark, rows) == brute(rows)


def test_one_long_conversation(spark):
    rows = [(5, t, "user", f"t{t % 50}") for t in range(300)] + [(105, t, "user", f"t{t % 50}") for t in range(250)]
    assert built(spark, rows) == brute(rows)


def test_no_rows_and_no_turns(spark):
    assert built(spark, []) == [] == built(spark, [(None, 1, "user", "x")])
    rows = [(c, 0, None, None) for c in range(1, 40)]  # many lose their only turn and get none
    assert built(spark, rows) == brute(rows)
