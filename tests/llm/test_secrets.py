"""Operator 13 against plain patterns over whole texts, and confirmed structures built by hand."""

import base64
import hashlib
import json
import random
import re
import struct

import numpy as np
import pytest

from tonalert.llm import secret_scan as ss
from tonalert.llm.q_audit import op13_secret_scan

SF_MID = "/root/testdata/sf0.01"
PLAIN = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            size, least = {"assign": (len(m.groups() and m.group(m.lastindex)), 12), "access": (len(m.group()), 18), "hex": (len(m.group()), 16)}[kind]
            if size >= least:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def spans_of(*texts):
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
    found = ss.block_spans(np.frombuffer(b"".join(raw), np.uint8), ends)
    return [found.get(k, []) for k in range(len(texts))]


def tlv(tag, body):
    n = len(body)
    if n < 128:
        return bytes([tag, n]) + body
    size = (n.bit_length() + 7) // 8
    return bytes([tag, 0x80 | size]) + n.to_bytes(size, "big") + body


def integer(n):
    return tlv(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def rsa_key(bits=1024):
    rng = random.Random(bits)
    p, q = (rng.getrandbits(bits // 2) | 1 << (bits // 2 - 1) for _ in range(2))
    return tlv(0x30, b"".join(integer(x) for x in (0, p * q, 65537, rng.getrandbits(bits - 1), p, q, rng.getrandbits(bits // 2 - 1),
                                                   rng.getrandbits(bits // 2 - 1), rng.getrandbits(bits // 2 - 1))))


ED25519 = tlv(0x30, integer(0) + tlv(0x30, tlv(6, b"\x2b\x65\x70")) + tlv(4, tlv(4, bytes(range(32)))))
EC = tlv(0x30, integer(1) + tlv(4, bytes(range(32))) + tlv(0xA0, tlv(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))
PBES2 = tlv(0x30, tlv(0x30, tlv(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d") + tlv(0x30, b"")) + tlv(4, bytes(64)))
KEYS = {"rsa": rsa_key(), "pkcs8": ED25519, "ec": EC, "pkcs8-encrypted": PBES2}


def ssh_field(raw):
    return struct.pack(">I", len(raw)) + raw


def openssh_key():
    public = ssh_field(b"ssh-ed25519") + ssh_field(bytes(32))
    return b"openssh-key-v1\0" + ssh_field(b"none") + ssh_field(b"none") + ssh_field(b"") + struct.pack(">I", 1) + ssh_field(public) + ssh_field(bytes(136))


def token(alg="HS256", size=32, payload=b'{"sub":"1"}'):
    part = lambda raw: base64.urlsafe_b64encode(raw).rstrip(b"=").decode()
    return ".".join([part(json.dumps({"alg": alg, "typ": "JWT"}).encode()), part(payload), part(bytes(range(256))[:size])])


def test_base_spans_match_plain_patterns():
    rng = random.Random(3)
    bits = ["password", "PassWd", "secret", "toKen", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "é", "ſecret",
            "\n", "x", "ABCDEFGHIJKLM", "abcdefghijkl", ".", "/", "日本", "K", "=="]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for text, spans in zip(texts, spans_of(*texts)):
        assert [s for s in spans if s[0] in ss.BASE] == plain_base(text), text


def test_runs_end_with_texts_and_cross_scans(monkeypatch):
    monkeypatch.setattr(ss, "SCAN_BYTES", 5)
    assert spans_of("", "ab" * 4, "cd" * 4, "", "é" + "0" * 16, "1" * 40, "") == [[], [], [], [], [("hex", 1, 17)], [("hex", 0, 40)], []]


@pytest.mark.parametrize("name", KEYS)
def test_der_keys_in_base64_and_hex(name):
    key = KEYS[name]
    assert ss.der_private_key(key) == (name, len(key))
    for cut in (key[:-1], key[:1] + bytes([key[1] ^ 1]) + key[2:], b"\x31" + key[1:]):
        assert ss.der_private_key(cut) is None
    for text in (base64.b64encode(key).decode(), key.hex().upper(), base64.urlsafe_b64encode(key).decode()):
        for before, after in (("", ""), ("é key/", " x"), ("k=", "\n"), ("AA", "/AAAA")):
            spans = [s for s in spans_of(before + text + after)[0] if s[0] not in ss.BASE]
            start = len(before)
            assert len(spans) == 1 and spans[0][:2] == ("der", start)
            assert len(text.rstrip("=")) <= spans[0][2] - start <= len(text)


def test_openssh_pem_and_tokens():
    key = openssh_key()
    text = base64.b64encode(key).decode()
    assert spans_of("x " + text)[0] == [("openssh", 2, 2 + len(text))]
    assert spans_of(base64.b64encode(key[:-140]).decode())[0] == []
    body = "\n".join(base64.b64encode(KEYS["rsa"]).decode()[i:i + 64] for i in range(0, 900, 64))
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    assert ("pem", 2, 2 + len(pem)) in spans_of("é " + pem + " y")[0]
    assert not [s for s in spans_of(pem.replace(body, body[:200]))[0] if s[0] == "pem"]
    assert not [s for s in spans_of(pem.replace("END RSA", "END"))[0] if s[0] == "pem"]
    for alg, size, found in (("HS256", 32, True), ("HS256", 31, False), ("RS256", 256, True), ("ES512", 132, True), ("none", 0, False), ("XX", 32, False)):
        t = token(alg, size)
        jwt = [s for s in spans_of("Bearer " + t + " ok")[0] if s[0] == "jwt"]
        assert jwt == ([("jwt", 7, 7 + len(t))] if found else []), alg
    assert [s for s in spans_of("token=" + token() + "&x")[0]] == [("assign", 0, 6 + len(token())), ("jwt", 6, 6 + len(token()))]
    assert not spans_of(token(payload=b"[1]"))[0] and not spans_of(token(payload=b"\xff\xfe"))[0]


def test_long_runs_take_linear_time():
    text = "MII" * 300_000 + "." * 1000 + "ey." * 100_000 + "30" * 200_000 + "password " * 20_000
    assert all(s[0] == "hex" or s[0] in ss.BASE for s in spans_of(text)[0])


def test_whole_table_against_plain_patterns(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()}
    rows = op13_secret_scan(spark, SF_MID).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert any(r["n_assign"] for r in rows) and any(r["n_hex"] for r in rows)
    for r in rows:
        want = plain_base(docs[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in want) for x in ss.BASE]
        assert r["spans"] == line  # nothing in these texts has the structure of a key


def test_nulls_repeats_and_no_rows(spark):
    key = base64.b64encode(KEYS["rsa"]).decode()
    rows = [(None, None, 1), (1, "", 2), (2, "secret: " + "x" * 12, 3), (2, "secret: " + "x" * 12, 3), (3, "é" * 50_000 + key, None), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    got = sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in ss.scan(docs).collect()), key=str)
    assert got == sorted([(None, []), (1, []), (2, [("assign", 0, 20)]), (2, [("assign", 0, 20)]), (3, [("der", 50_000, 50_000 + len(key))]), (4, [])], key=str)
    empty = ss.digests(ss.scan(docs.limit(0)))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
