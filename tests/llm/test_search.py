"""Operators 1, 2 and 6 against brute force, and their edge cases."""

import base64
import gzip
import hashlib
import io
import os
import random
import re
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonalert.llm import decontaminate as dc
from tonalert.llm import superminhash as sm
from tonalert.llm import warc
from tonalert.llm.bytewords import ALNUM, NOT_SPACE, hash_words

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEST_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def test_words_are_split_like_the_patterns():
    texts = ["", None, "A b\tC\x0bÉé\x85x", "a-b_c 12é", " x ", "x", "\n", "Ünï-çödé\x00z", "AB ab"]
    for pattern, table in ((SPACE_WORD, NOT_SPACE), (TEST_WORD, ALNUM)):
        hashes = hash_words(texts, table)
        words = [pattern.findall(lower(t)) for t in texts]
        assert [len(h) for h in hashes] == [len(w) for w in words]
        seen = {}
        for h, w in zip(np.concatenate(hashes).tolist(), sum(words, [])):
            assert seen.setdefault(h, w) == w
        assert len(seen) == len(set(sum(words, [])))


def plain_superminhash(elements, places):
    """The published loop, one element at a time, with the operator's random bits."""
    out = np.full(places, np.inf)
    for e in elements:
        p = list(range(places))
        for j in range(places):
            bits = int(sm._draw(np.array([e], np.uint64), j)[0])
            k = j + (bits >> 32) % (places - j)
            p[j], p[k] = p[k], p[j]
            out[p[j]] = min(out[p[j]], j + (bits & 0xFFFFFFFF) / 4294967296.0)
    return out


def test_signatures_follow_the_published_loop():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 5, 30, 400]
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in sizes]
    got = sm.signatures(np.concatenate(sets), np.append(0, np.cumsum([len(s) for s in sets])), 20)
    for s, g in zip(sets, got):
        assert np.array_equal(g, plain_superminhash(s, 20))


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 1150, dtype=np.uint64)
    both = np.concatenate([np.sort(pool[:1000]), np.sort(pool[150:])])
    sig = sm.signatures(both, np.array([0, 1000, 2000]), 1024)
    assert sm.similarity(sig[0], sig[1]) == pytest.approx(850 / 1150, abs=0.05)


def plain_near(rows):
    sets = {}
    for i, t in rows:
        w = SPACE_WORD.findall(lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    ids = [i for i in sets if i is not None]
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both) and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return sorted(((i, len(sets[i]), comp[i], comp[i] == i) for i, _ in rows), key=repr)


def near_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(1, None), (2, ""), (3, " "), (4, "One two"), (5, "one TWO"), (6, "one two three"), (None, "one two")]
    n = 10
    for size in (6, 60, 400):
        base = [word() for _ in range(size)]
        for _ in range(30):
            t = list(base)
            for _ in range(rng.randint(0, max(1, size // 90))):
                t[rng.randrange(size)] = word()
            rows.append((n, " ".join(t)))
            n += 1
    rows += rows[-2:]
    rows += [(n, " ".join(word() for _ in range(20_000)))]
    return rows


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    rows = near_rows()
    want = plain_near(rows)
    d = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, n_shingles int")
    got = sm.near_duplicates(d).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == want
    # Buckets cut into many blocks come to the same end.
    monkeypatch.setattr(sm, "UNIT_SHINGLES", 300)
    got = sm.near_duplicates(d).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    rng = random.Random(6)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(100)]
    copy = lambda t: " ".join([*t[:-2], "other", "end"])
    a, b, c, d = (text() for _ in range(4))
    rows = [(10, " ".join(a)), (10, " ".join(b)), (20, copy(a)), (30, copy(b)), (5, " ".join(c)), (40, copy(c)), (40, " ".join(d))]
    got = sm.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    texts = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "xxhash64(text) AS row_hash")
    found = {(r["doc_id"], r["text"]): (r["component_id"], r["kept"]) for r in got.join(texts, ["doc_id", "row_hash"]).collect()}
    assert [found[r] for r in rows] == [(10, True), (10, True), (10, False), (10, False), (5, True), (5, False), (40, True)]


def unit(sets):
    """The arrays of a unit of the given sets, all in one band."""
    n_bands, n_rows, _ = sm.BANDING[85]
    first = np.append(0, np.cumsum([len(x) for x in sets]))
    bits = sm.mix(sm.signatures(np.concatenate(sets), first).view(np.uint64))
    two = np.zeros((len(sets), 128), np.uint64)
    two[:, :n_bands * n_rows] = bits & np.uint64(3)
    sketch = (two.reshape(len(sets), 4, 32) << (2 * np.arange(32)).astype(np.uint64)).sum(axis=2, dtype=np.uint64)
    return list(range(len(sets))), np.zeros(len(sets), np.int64), np.zeros((len(sets), n_bands), np.int64), sketch, sets


def joined(links, n):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


def test_units_connect_what_all_pairs_connect():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = []
    for _ in range(25):  # chains whose ends are not near each other
        at = int(rng.integers(0, 3800))
        for step in range(int(rng.integers(1, 9))):
            sets.append(np.unique(pool[at + 6 * step:at + 6 * step + 100]))
    sets = [sets[i] for i in rng.permutation(len(sets))]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    ids, own, bands, sketch, sets = unit(sets)
    assert joined(sm.unit_links(0, ids, own, bands, sketch, sets, True), len(sets)) == joined(pairs, len(sets))
    half = np.arange(len(sets)) % 2
    across = joined([(a, b) for a, b in pairs if half[a] != half[b]], len(sets))
    got = joined(sm.unit_links(0, ids, half, bands, sketch, sets, False), len(sets))
    whole = joined(pairs, len(sets))
    assert all(got[x] == got[y] for x in range(len(sets)) for y in range(x) if across[x] == across[y])  # nothing across is lost
    assert all(whole[x] == whole[y] for x in range(len(sets)) for y in range(x) if got[x] == got[y])  # nothing wrong is added


def test_a_bucket_of_near_copies_takes_linear_time(monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    n = 20_000
    sets = [np.unique(np.append(base, np.uint64(i))) for i in range(n)]  # all different, 60 of 62 shared
    calls, plain = [], np.intersect1d
    monkeypatch.setattr(np, "intersect1d", lambda *a, **k: calls.append(1) or plain(*a, **k))
    ids, own, bands, sketch, sets = unit(sets)
    links = sm.unit_links(0, ids, own, bands, sketch, sets, True)
    assert len(links) == n - 1 and len(set(joined(links, n))) == 1 and len(calls) < 1.2 * n


def test_near_duplicates_of_few_rows(spark):
    schema = "doc_id bigint, text string"
    assert sm.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = sm.near_duplicates(spark.createDataFrame([(9, None), (8, "x")], schema)).drop("row_hash").collect()
    assert sorted(map(tuple, got)) == [(8, 1, 8, True), (9, 0, 9, True)]


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 90)]
    got = dict(map(tuple, sm.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in [*range(41), 90]}, 100: 100, 101: 100}


def plain_hits(docs, items, size=10):
    out = []
    for i, t in docs:
        w = TEST_WORD.findall(lower(t))
        hit, held = set(), set()
        for item, x in items:
            v = TEST_WORD.findall(lower(x))
            for k in range(max(1, len(v) - size + 1) if v else 0):
                win = v[k:k + size]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit.update(range(p, p + len(win)))
                        held.add("" if item is None else str(item))
        out.append((i, len(w), sorted(hit), sorted(held)))
    return sorted(out, key=repr)


def hit_tables():
    rng = random.Random(5)
    w = [f"t{i}" for i in range(30)]
    items = [(k, " ".join(rng.choice(w) for _ in range(rng.randint(11, 30)))) for k in range(12)] + [(20, "Short one"), (21, None), (22, "..."), (None, "t1 t2 t3"), (2, "the the the")]
    docs = [(0, None), (1, ""), (2, "short ONE"), (3, "a short-one b"), (None, "t1 t2 t3"), (5, " ".join(w * 900))]
    for i in range(10, 30):
        body = [rng.choice(w) for _ in range(60)]
        k = rng.randrange(12)
        cut = (items[k][1]).split()[: rng.randint(5, 20)]
        docs.append((i, " ".join(body[:20] + cut + body[20:]).replace("t4", "T4,")))
    return docs + docs[-1:], items


@pytest.mark.parametrize("block, terms", [(200_000, 4_000_000), (40, 4_000_000), (200_000, 3)])
def test_contaminated_matches_brute_force(spark, monkeypatch, block, terms):
    monkeypatch.setattr(dc, "PHRASE_BLOCK", block)
    monkeypatch.setattr(dc, "MAX_TERMS", terms)
    monkeypatch.setattr(dc, "SEGMENT_BYTES", 300)
    docs, items = hit_tables()
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, hit int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = dc.contaminated(d, b).select("doc_id", "n_words", "hit", "items").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_hits(docs, items)


def test_contaminated_without_rows(spark):
    d, b = (spark.createDataFrame(x, y) for x, y in (([(1, "a b")], "doc_id bigint, text string"), ([(1, "a b")], "item_id bigint, text string")))
    assert dc.contaminated(d.limit(0), b).count() == 0
    assert [tuple(r)[2:] for r in dc.contaminated(d, b.limit(0)).collect()] == [(2, [], [])]


def test_proximity_matches(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice("abcdefghij") for _ in range(80))) for i in range(20)]
    index = dc.build_index(spark.createDataFrame(docs, "doc_id bigint, text string"))
    want = []
    for i, t in docs:
        w = t.split()
        want += [(i, p) for p in range(len(w)) if w[p] in "abc" and set("abc") <= set(w[p:p + 4])]
    assert sorted(map(tuple, dc.proximity_matches(index, "A b c", 4).collect())) == sorted(want)
    assert dc.proximity_matches(index, "a zz", 4).count() == 0


class Counted(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_packages(zip64):
    raw = io.BytesIO()
    z = warc.ZipWriter(raw, zip64)
    for name, body in (("a/data", b"x" * 500_000), ("empty", b""), ("ü", b"last")):
        z.begin(name)
        z.write(body[:7])
        z.write(body[7:])
        z.end()
    z.close()
    with zipfile.ZipFile(io.BytesIO(raw.getvalue())) as other:  # a reader of its own agrees
        assert other.testzip() is None and other.namelist() == ["a/data", "empty", "ü"]
        assert other.read("ü") == b"last"
    f = Counted(raw.getvalue())
    members = warc.zip_members(f, z.at)
    assert f.got < 70_000  # the members were not read
    assert {k: warc.read_range(f, *v) for k, v in members.items()} == {"a/data": b"x" * 500_000, "empty": b"", "ü": b"last"}


def test_zip_of_another_writer():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("one", b"stored")
        z.writestr("two", b"packed" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"with a comment"
    f = io.BytesIO(raw.getvalue())
    members = warc.zip_members(f, len(raw.getvalue()))
    assert members["two"] is None and warc.read_range(f, *members["one"]) == b"stored"
    with pytest.raises(ValueError, match="compressed"):
        warc.stored_member(members, "two")


def plain_warc(rows, least=0):
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        own = [j for j, _, x in rows if (x or "") == (h or "") and j is not None]
        top = max(own, default=i)
        revisit = len(p) >= least and i != top
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


PAGES = [(1, "http://a", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://c d\n", None), (4, "u", ""), (5, "ü", "é\r\n\r\nWARC/1.1\r\n\r\n"), (None, "n", "<p>same</p>"),
         (7, "v", "x" * 200_000), (7, "v", "x" * 200_000), (9, "w", "alone")]


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "ROLL_BYTES", 600)
    monkeypatch.setattr(warc, "READ_RECORDS", 2)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id bigint, url string, html string, payload string")
    manifest = warc.write_archives(pages, least)
    out = warc.read_archives(manifest).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out), key=repr) == plain_warc(PAGES, least)
    for r in out:
        assert r["payload"] is None or (len(r["payload"]) == r["payload_bytes"] and warc.base32_sha1(bytes(r["payload"])) == r["payload_digest"])


def package(folder, name, members):
    path = f"{folder}/{name}.wacz"
    with zipfile.ZipFile(path, "w") as z:
        for member, body, packed in members:
            z.writestr(member, body, zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED)
    return path, os.path.getsize(path)


def archive(ids):
    """(bytes of an archive, (offset, length) of its records)."""
    raw, places = b"", []
    for i in ids:
        record = gzip.compress(warc.record_bytes(i, f"http://x/{i}", f"page {i}".encode()))
        places.append((len(raw), len(record)))
        raw += record
    return raw, places


def test_packages_of_other_writers(spark, tmp_path, monkeypatch):
    """Two archives in one package, an index each or one for both; what cannot be read is an error."""
    monkeypatch.setattr(warc, "READ_RECORDS", 3)
    one, two = archive(range(10)), archive(range(10, 15))

    def line(file, place, full=False):
        name = f"archive/{file}" if full else file
        return f'com,x)/ 20240101000000 {{"url": "http://x", "filename": "{name}", "offset": "{place[0]}", "length": {place[1]}}}\n'.encode()

    lines = [b"".join(line("a.warc.gz", p) for p in one[1]), b"".join(line("b.warc.gz", p, True) for p in two[1])]
    data = [("archive/a.warc.gz", one[0], False), ("archive/b.warc.gz", two[0], False), ("datapackage.json", b"{}", True)]
    good = [package(tmp_path, "apart", [*data, ("indexes/a.cdxj", lines[0], False), ("indexes/b.cdx", lines[1], False)]),
            package(tmp_path, "both", [*data, ("indexes/index.cdxj", lines[0] + lines[1], False)])]
    for path, size in good:
        out = warc.read_archives(spark.createDataFrame([(path, size)], "path string, size bigint")).collect()
        assert sorted((r["page_id"], bytes(r["payload"]).decode(), r["url"]) for r in out) == [(i, f"page {i}", f"http://x/{i}") for i in range(15)]
    bad = [package(tmp_path, "lost", [*data, ("indexes/a.cdxj", lines[0], False)]),
           package(tmp_path, "packed", [("archive/a.warc.gz", one[0], True), ("indexes/a.cdxj", lines[0], False)]),
           package(tmp_path, "packed-index", [data[0], ("indexes/a.cdxj", lines[0], True)]),
           package(tmp_path, "none", [("indexes/a.cdxj", lines[0], False)])]
    for path, size in bad:
        with pytest.raises(Exception, match="no index names|compressed|not in the package"):
            warc.read_archives(spark.createDataFrame([(path, size)], "path string, size bigint")).collect()


def test_records_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_RECORDS", 50)
    pages = spark.range(1000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    out = warc.read_archives(warc.write_archives(pages.coalesce(1)))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert out.rdd.getNumPartitions() == 20 and out.count() == 1000


def test_warc_without_rows(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read_archives(warc.write_archives(pages)).count() == 0


def test_words_across_runs(monkeypatch):
    """Texts hashed a few bytes at a time: words, texts and empty texts on either side of a run's end."""
    import tonalert.llm.bytewords as bw

    monkeypatch.setattr(bw, "RUN_BYTES", 7)
    rng = random.Random(2)
    for _ in range(500):
        texts = ["".join(rng.choice("aAb \n") for _ in range(rng.choice([0, 0, 1, 3, 6, 7, 8, 20, 40]))) for _ in range(rng.randint(0, 6))]
        words = [SPACE_WORD.findall(lower(t)) for t in texts]
        got = hash_words(texts, NOT_SPACE)
        assert [len(h) for h in got] == [len(w) for w in words]
        assert [int(h) for row in got for h in row] == [int(hash_words([w], NOT_SPACE)[0][0]) for row in words for w in row]
