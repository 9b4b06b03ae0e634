"""Operator 13, secret scans with structural confirmation.

Base spans are matches of three fixed patterns, leftmost and non-overlapping per kind, those that are too
short dropped: ``assign`` (a name, a sign and a value), ``access`` (a cloud access key) and ``hex``.
Beyond them, long runs of base64, base64url or hex characters are candidates, and a candidate
is reported only if it decodes to something with the structure of a secret:

* ``jwt``: a signed token. The header decodes to a JSON object that names a known signature
  algorithm, the payload to a JSON object, and the signature has that algorithm's length.
* ``der``: a private key in DER (PKCS#1, PKCS#8 plain or encrypted, SEC1, DSA), in base64 or hex. Lengths
  must be minimal and nested exactly, and the fields must be those of the key type. The key's own length says where
  it ends, so a key inside a longer run is found as well.
* ``openssh``: the OpenSSH private key format, its nested length-prefixed fields read to the end.
* ``pem``: a block between BEGIN and END marks whose body decodes to one of the two above.

Texts are scanned as UTF-8 bytes in blocks: runs of a class of characters by array operations,
patterns only in texts that hold one of their fixed words. Spans are in code points, end exclusive,
ordered by start, kind (as in KINDS) and end; spans of different kinds may overlap.

Edge cases: a NULL or empty text has no spans. Rows that repeat a doc_id are scanned each. Texts are
never cut. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalert.llm.bytewords import text_blocks

KINDS = ["assign", "access", "hex", "jwt", "pem", "der", "openssh"]
BASE = KINDS[:3]
BLOCK_BYTES = 1_000_000
SCAN_BYTES = 1 << 20  # bytes whose character classes are held at a time

# The base patterns and their least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_WORDS = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]
ASSIGN_LEAST = 12
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX_LEAST = 16
# Signature bytes of the signed-token algorithms; RSA ones have the length of the modulus.
JWT_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64, "ES256K": 64}
JWT_RSA = ["RS256", "RS384", "RS512", "PS256", "PS384", "PS512"]
CANDIDATE_LEAST = 40  # characters of the shortest candidate: 30 bytes in base64

_PEM_BEGIN = re.compile(rb"-----BEGIN ([A-Z ]*PRIVATE KEY)-----")
_OPENSSH = b"openssh-key-v1\0"
_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGITS, _UPPER, _LOWER = b"0123456789", bytes(range(65, 91)), bytes(range(97, 123))
HEX = _class(_DIGITS + b"abcdef")
CANDIDATE = _class(_DIGITS + _UPPER + _LOWER + b"+/_.=-")


def long_runs(data: np.ndarray, ends: np.ndarray, chars: np.ndarray, least: int):
    """(start, end) of the maximal runs of at least ``least`` bytes of a class inside one text."""
    found = []
    for at in range(0, len(data), SCAN_BYTES):
        run, have = chars[data[at:at + SCAN_BYTES + least - 1]], 1
        while have < least and len(run):  # run[i]: the bytes i to i + have - 1 are all inside
            step = min(have, least - have)
            run = run[step:] & run[:-step]
            have += step
        found.append(np.flatnonzero(run) + at)
    starts = np.concatenate(found) if found else np.empty(0, np.int64)
    if not len(starts):
        return
    new = np.flatnonzero(np.append(True, np.diff(starts) > 1))
    for a, b in zip(starts[new].tolist(), (starts[np.append(new[1:], len(starts)) - 1] + least).tolist()):
        for cut in (*ends[np.searchsorted(ends, a, side="right"):np.searchsorted(ends, b)].tolist(), b):  # texts end inside
            if cut - a >= least:
                yield a, cut
            a = cut


def _element(data, at, end):
    """(tag, body, end of body) of the DER element at ``at``; None if its length is not minimal or does not fit."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if tag & 0x1F == 0x1F or n == 0x80:
        return None
    if n > 0x80:
        size = n & 0x7F
        if size > 4 or at + size > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at:at + size], "big"), at + size
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data, at, end, most=12):
    """The elements that fill ``at`` to ``end`` exactly, None if they do not or are more than ``most``."""
    out = []
    while at < end:
        e = _element(data, at, end)
        if e is None or len(out) == most:
            return None
        out.append(e)
        at = e[2]
    return out


def _algorithm(data, e):
    """Whether ``e`` is an algorithm identifier; its OID's bytes."""
    inner = _children(data, e[1], e[2], 3) if e[0] == _SEQUENCE else None
    return bytes(data[inner[0][1]:inner[0][2]]) if inner and inner[0][0] == _OID and inner[0][1] < inner[0][2] else None


def der_private_key(data, at=0):
    """(type, end) of the private key whose DER form starts at ``at``, else None."""
    top = _element(data, at, len(data))
    if top is None or top[0] != _SEQUENCE:
        return None
    fields = _children(data, top[1], top[2])
    if not fields or len(fields) < 2:
        return None
    tags = [f[0] for f in fields]
    first = bytes(data[fields[0][1]:fields[0][2]])
    sizes = [f[2] - f[1] for f in fields]
    if tags[0] == _INTEGER and first in (b"\0", b"\1"):
        if set(tags) == {_INTEGER} and min(sizes) > 0:
            if len(tags) == 9 and first == b"\0" and sizes[1] >= sizes[4] and sizes[1] >= sizes[5] and sizes[1] <= sizes[4] + sizes[5]:
                return "rsa", top[2]
            return ("dsa", top[2]) if len(tags) == 6 and first == b"\0" else None
        if tags[1] == _OCTETS and first == b"\1" and sizes[1] >= 14 and set(tags[2:]) <= {0xA0, 0xA1} and len(tags) > 2:
            return "ec", top[2]
        if tags[1:3] == [_SEQUENCE, _OCTETS] and _algorithm(data, fields[1]) and sizes[2] and set(tags[3:]) <= {0xA0, 0xA1, 0x81}:
            return "pkcs8", top[2]
    elif tags == [_SEQUENCE, _OCTETS]:
        oid = _algorithm(data, fields[0])
        if oid and oid.startswith((b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c")) and sizes[1] >= 16:
            return "pkcs8-encrypted", top[2]
    return None


def openssh_private_key(data, at=0):
    """(type, end) of the OpenSSH private key that starts at ``at``, else None."""
    if bytes(data[at:at + len(_OPENSSH)]) != _OPENSSH:
        return None
    at += len(_OPENSSH)

    def number():
        nonlocal at
        if at + 4 > len(data):
            raise ValueError
        at += 4
        return int.from_bytes(data[at - 4:at], "big")

    def field():
        nonlocal at
        n = number()
        if at + n > len(data):
            raise ValueError
        at += n
        return bytes(data[at - n:at])

    try:
        cipher, kdf, _ = field(), field(), field()
        keys = number()
        if not cipher or not kdf or not 1 <= keys <= 64:
            return None
        for _ in range(keys):
            public = field()
            n = int.from_bytes(public[:4], "big")  # a public key starts with the name of its type
            if not public[4:4 + n].startswith((b"ssh-", b"ecdsa-", b"sk-")):
                return None
        return ("openssh", at) if len(field()) >= 8 else None
    except ValueError:
        return None


def _base64(raw: bytes):
    """``raw``'s bytes, an incomplete last group filled up; None if it is not base64."""
    raw = raw.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    try:
        return base64.b64decode(raw + b"A" * (-len(raw) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(raw: bytes):
    if len(raw) % 4 == 1:
        return None
    try:
        out = json.loads(base64.urlsafe_b64decode(raw + b"=" * (-len(raw) % 4)).decode())
    except (binascii.Error, ValueError, RecursionError):
        return None
    return out if isinstance(out, dict) else None


def signed_token(header: bytes, payload: bytes, signature: bytes) -> bool:
    """Whether three base64url segments are a signed token."""
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or len(signature) % 4 == 1 or _json_object(payload) is None:
        return False
    size = len(signature) * 6 // 8
    if head["alg"] in JWT_RSA:
        return size >= 128 and size % 64 == 0
    return head["alg"] in JWT_BYTES and size == JWT_BYTES[head["alg"]]


_URL_RUN = re.compile(rb"[A-Za-z0-9_.-]+")
_RADIX = [
    # (characters of a candidate, where a DER key or an OpenSSH key can start, characters and bytes of a group, decoder)
    (re.compile(rb"[A-Za-z0-9+/_-]{40,}"), re.compile(rb"M[A-I]|b3BlbnNzaC1rZXktdjEA"), 4, 3, _base64),
    (re.compile(rb"[0-9A-Fa-f]{60,}"), re.compile(rb"30|6[Ff]70656[Ee]737368"), 2, 1, lambda raw: bytes.fromhex(raw[:len(raw) // 2 * 2].decode())),
]


def encoded_keys(run: bytes):
    """(kind, start, end) of the private keys that a run of characters holds in base64 or hex."""
    for chars, start, group, width, decode in _RADIX:
        for m in chars.finditer(run):
            text, shifted, past = m.group(), {}, 0
            for s in start.finditer(text):
                p = s.start()
                if p < past:
                    continue
                if p % group not in shifted:
                    shifted[p % group] = decode(text[p % group:])
                data = shifted[p % group]
                if data is None:
                    continue
                at = p // group * width
                found = der_private_key(memoryview(data), at) if data[at] == _SEQUENCE else openssh_private_key(memoryview(data), at)
                if found is None:
                    continue
                end = p + -(-(found[1] - at) * group // width)
                if end <= len(text):  # else the key would end in what was filled up
                    past = end
                    pads = len(run[m.start() + end:m.start() + end + 2]) - len(run[m.start() + end:m.start() + end + 2].lstrip(b"=")) if group == 4 else 0
                    yield "openssh" if found[0] == "openssh" else "der", m.start() + p, m.start() + end + min(pads, -(end - p) % 4)


def confirmed(run: bytes):
    """(kind, start, end) of what a candidate run holds beyond the base patterns."""
    if run.count(b".") >= 2:
        for m in _URL_RUN.finditer(run):
            parts, at, past = m.group().split(b"."), m.start(), -1
            for i in range(len(parts) - 2):
                own = parts[i][max(parts[i].find(b"ey"), 0):]
                begin = at + len(parts[i]) - len(own)
                if at > past and own and signed_token(own, parts[i + 1], parts[i + 2]):
                    past = begin + len(own) + len(parts[i + 1]) + len(parts[i + 2]) + 2
                    yield "jwt", begin, past
                at += len(parts[i]) + 1
    yield from encoded_keys(run)


def pem_keys(raw: bytes):
    """(start, end) of PEM private keys whose body has the structure of one."""
    at = 0
    while m := _PEM_BEGIN.search(raw, at):
        mark = b"-----END " + m.group(1) + b"-----"
        end = raw.find(b"-----", m.end())
        at = m.end()
        if end < 0 or not raw.startswith(mark, end):
            continue
        lines = raw[m.end():end].replace(b"\\n", b"\n").split(b"\n")  # also where the line ends are written out
        encrypted = any(b":" in x and b"ENCRYPTED" in x for x in lines)
        data = _base64(b"".join(x.strip() for x in lines if b":" not in x))
        if data and (len(data) % 8 == 0 and len(data) >= 64 if encrypted else der_private_key(data) or openssh_private_key(data)):
            at = end + len(mark)
            yield m.start(), at


def _texts_with(block: bytes, words, starts, ends):
    """Numbers of the texts that hold one of ``words``."""
    out = set()
    for word in words:
        at = block.find(word)
        while at >= 0:
            k = int(np.searchsorted(ends, at, side="right"))
            if at + len(word) <= ends[k]:
                out.add(k)
                at = block.find(word, int(ends[k]))
            else:
                at = block.find(word, at + 1)
    return sorted(out)


def block_spans(data: np.ndarray, ends: np.ndarray) -> dict:
    """Text number -> its spans (kind, start, end), in code points and in order."""
    block, starts, found = data.tobytes(), np.append(0, ends[:-1]), {}

    def add(k, kind, start, end):
        found.setdefault(k, []).append((start, KINDS.index(kind), end))

    lower = block.lower()
    for k in _texts_with(lower, ASSIGN_WORDS, starts, ends):
        for m in ASSIGN.finditer(block[starts[k]:ends[k]]):
            if len(m.group(2)) >= ASSIGN_LEAST:
                add(k, "assign", m.start(), m.end())
    del lower
    for k in _texts_with(block, [b"AKIA"], starts, ends):
        for m in ACCESS.finditer(block[starts[k]:ends[k]]):
            if len(m.group()) >= ACCESS_LEAST:
                add(k, "access", m.start(), m.end())
    for k in _texts_with(block, [b"-----BEGIN "], starts, ends):
        for a, b in pem_keys(block[starts[k]:ends[k]]):
            add(k, "pem", a, b)
    for kind, chars, least in (("hex", HEX, HEX_LEAST), (None, CANDIDATE, CANDIDATE_LEAST)):
        for a, b in long_runs(data, ends, chars, least):
            k = int(np.searchsorted(ends, a, side="right"))
            base = a - int(starts[k])
            if kind:
                add(k, kind, base, b - int(starts[k]))
            else:
                for found_kind, x, y in confirmed(block[a:b]):
                    add(k, found_kind, base + x, base + y)
    return {k: _code_points(data[starts[k]:ends[k]], sorted(set(spans))) for k, spans in found.items()}


def _code_points(raw: np.ndarray, spans: list) -> list:
    """Byte offsets as code points: less the bytes before them that continue a character."""
    at, less, points = 0, 0, {}
    for offset in sorted({x for s in spans for x in (s[0], s[2])}):
        less += int(np.count_nonzero((raw[at:offset] & 0xC0) == 0x80))
        at, points[offset] = offset, offset - less
    return [(KINDS[kind], points[a], points[b]) for a, kind, b in spans]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text); one narrow pass, no shuffle."""

    def scanned(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column("text"), BLOCK_BYTES):
                spans = block_spans(data, ends)
                rows = [[{"kind": x, "start": a, "end": b} for x, a, b in spans.get(k, ())] for k in range(n)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, n), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(scanned, f"doc_id bigint, spans {SPANS}")


def written(spans) -> F.Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as text, per row of ``scan``."""
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
