"""Operator 1, near-duplicates by SuperMinHash signatures, banding, verification and union-find.

A document's set is its distinct 5-word shingles (64-bit hashes). SuperMinHash gives every element
a random permutation of the signature's places: at level j it offers rank j + r to the j-th place
of its permutation, and a place keeps its smallest rank. A rank of level j is smaller than any of a
later level, so all elements of all documents of a block are handled level by level, and a document
stops as soon as each place has a rank (early stopping); its later levels could change nothing.

1. One pass over the texts: set size, a 128-bit digest of the set, band hashes of the signature.
2. Documents with equal sets are one class, stood for by its smallest (doc_id, row_hash).
3. Classes that share a band hash are a bucket. Each member brings its full set to its buckets. A
   bucket with many or long sets is cut into blocks, and each pair of blocks is a unit of work of bounded size,
   so no bucket has to fit in one task.
4. A unit of work verifies its pairs with groups of its own: a member meets the first member of every group, then
   the members of groups that it did not join. Pairs whose set sizes and sketches (two bits of each place) leave the threshold
   possible, in the first band that they share, are compared on their full sets. Only links that connect something are returned, at most
   one per member and unit, never all pairs. A pair at the threshold fails the sketch test at most twice in
   about 100,000 times.
5. The links are grouped by union-find as DataFrame steps: hooking on the smallest neighbour and
   pointer jumping, each step a table in the shared folder.

The threshold is a whole percentage with banding in BANDING: 85, op1's contract, and 80, the pipeline
stage's. A pair at 0.85 shares one of 21 bands of 6 rows, and a pair at 0.80 one of 25 bands of 5 rows,
with probability over 0.9999.

Edge cases: a NULL or wordless text has an empty set, links with nothing and is its own component.
A NULL doc_id stands as its own component and is kept. Rows that repeat a doc_id with another text
are judged each by itself and a component is reported by its smallest doc_id, so all rows of a
component with that id are kept. (The SQL knows classes by doc_id only and merges such rows: it
holds where a doc_id has one text.) Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalert.llm.bytewords import NOT_SPACE, mix, text_blocks, windows, words_of
from tonalert.llm.common import stored, text_or_empty
from tonalert.operators.joins import checked_broadcast

SHINGLE = 5
PERCENT = 85
BANDING = {85: (21, 6, 30), 80: (25, 5, 38)}  # bands, rows of a band, places of a sketch that may differ
PLACES = BANDING[PERCENT][0] * BANDING[PERCENT][1]
UNIT_SHINGLES = 1_000_000  # shingles of one block of a bucket (8 bytes each)
BLOCK_BYTES = 2_000_000
_CHUNK = 32_768  # elements whose permutations are held at a time
_U = np.uint64


def _distinct(hashes: np.ndarray, first: np.ndarray):
    """Each text's distinct hashes, ascending: (hashes, first)."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(first)))


def shingle_sets(data, ends, size: int = SHINGLE):
    return _distinct(*windows(words_of(data, ends, NOT_SPACE), size))


def _draw(elements: np.ndarray, level: int):
    """The level's random 64 bits of each element."""
    return mix(elements + _U((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF))


def signatures(hashes: np.ndarray, first: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash of every set, (sets, places) float64; empty sets have infinite ranks."""
    sets = len(first) - 1
    out = np.full((sets, places), np.inf)
    sizes = np.diff(first)
    flat = out.reshape(-1)
    # Level 0 needs no permutation table: its place is the first draw.
    owner = np.repeat(np.arange(sets), sizes)
    bits = _draw(hashes, 0)
    _offer(flat, owner, (bits >> _U(32)) % _U(places), bits, 0, places)
    open_sets = np.flatnonzero(np.isinf(out).any(axis=1) & (sizes > 0))
    at = 0
    while at < len(open_sets):  # sets with places left, in groups of about _CHUNK elements
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[open_sets[at:]]), _CHUNK)) + at)
        group = open_sets[at:upto]
        at = upto
        index = np.concatenate([np.arange(first[d], first[d + 1]) for d in group])
        _levels(flat, hashes[index], np.repeat(group, sizes[group]), out, places)
    return out


def _offer(flat, owner, place, bits, level, places):
    rank = level + (bits & _U(0xFFFFFFFF)).astype(np.float64) / 4294967296.0
    np.minimum.at(flat, owner * places + place.astype(np.int64), rank)


def _levels(flat, elements, owner, out, places):
    """Levels 1 and up of a group of sets. ``table`` holds each element's partly shuffled
    permutation; place 0 of it was fixed at level 0."""
    table = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.int32), (len(elements), 1))
    row = np.arange(len(elements))
    k = ((_draw(elements, 0) >> _U(32)) % _U(places)).astype(np.int64)
    table[row, k], table[:, 0] = table[:, 0].copy(), table[row, k].copy()
    for level in range(1, places):
        bits = _draw(elements, level)
        k = level + ((bits >> _U(32)) % _U(places - level)).astype(np.int64)
        chosen = table[row[:len(elements)], k].copy()
        table[row[:len(elements)], k] = table[:, level]
        table[:, level] = chosen
        _offer(flat, owner, chosen, bits, level, places)
        more = np.isinf(out[owner]).any(axis=1) if level % 4 == 0 or level < 4 else None
        if more is not None and not more.all():
            if not more.any():
                return
            elements, owner, table = elements[more], owner[more], table[more]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("row_hash"), "text")


def features(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_hash, n_shingles, d1, d2 (digest of the set), bands array<bigint>, sketch array<bigint>."""
    n_bands, n_rows, _ = BANDING[percent]
    places = n_bands * n_rows
    words = -(-places // 32)  # 64-bit words of two bits per place

    def measured(batches):
        import pyarrow as pa

        weights = mix(np.arange(1, places + 1, dtype=np.uint64))
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            for at, n, data, ends in text_blocks(column, BLOCK_BYTES):
                hashes, first = shingle_sets(data, ends)
                sizes = np.diff(first)
                sums = [np.append(_U(0), np.cumsum(mix(hashes + _U(seed)))) for seed in (11, 29)]
                d1, d2 = ((s[first[1:]] - s[first[:-1]]).astype(np.int64) for s in sums)
                sig = signatures(hashes, first, places)
                sig[np.isinf(sig)] = 0
                bits = mix(sig.view(np.uint64) ^ weights)
                bands = mix(bits.reshape(n, n_bands, n_rows).sum(axis=2, dtype=np.uint64)).view(np.int64)
                two = np.zeros((n, words * 32), np.uint64)
                two[:, :places] = bits & _U(3)
                sketch = (two.reshape(n, words, 32) << (2 * np.arange(32)).astype(np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)
                full = sizes > 0

                def lists(values):
                    offsets = np.append(0, np.cumsum(np.where(full, values.shape[1], 0))).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[full].reshape(-1)))

                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, n), batch.column("row_hash").slice(at, n), pa.array(sizes.astype(np.int64)), pa.array(d1), pa.array(d2),
                     lists(bands), lists(sketch)],
                    names=["doc_id", "row_hash", "n_shingles", "d1", "d2", "bands", "sketch"])

    return _rows(docs).mapInArrow(measured, "doc_id bigint, row_hash bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>")


def full_sets(rows: DataFrame) -> DataFrame:
    """Of rows (doc_id, row_hash, text): doc_id, row_hash and the shingle hashes as array<bigint>."""

    def made(batches):
        import pyarrow as pa

        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column("text"), BLOCK_BYTES):
                hashes, first = shingle_sets(data, ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), batch.column("row_hash").slice(at, n), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                    names=["doc_id", "row_hash", "shingles"])

    return rows.mapInArrow(made, "doc_id bigint, row_hash bigint, shingles array<bigint>")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id reachable. Each round hooks
    every component on the smallest component next to it and then shortens the paths; a round at
    least halves the components that still have neighbours outside."""
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")).select(F.col("a").alias("id"), "c"), "components")
    while True:
        # Edges between components; none left means done.
        la = labels.select(F.col("id").alias("a"), F.col("c").alias("ca"))
        lb = labels.select(F.col("id").alias("b"), F.col("c").alias("cb"))
        between = stored(edges.join(la, "a").join(lb, "b").where("ca <> cb").select("ca", "cb").distinct(), "between")
        if between.isEmpty():
            return labels.select("id", F.col("c").alias("component"))
        parent = stored(between.groupBy("ca").agg(F.min("cb").alias("p")).where("p < ca"), "parents")
        while True:  # pointer jumping over the parents
            up = parent.select(F.col("ca").alias("p"), F.col("p").alias("pp"))
            jumped = parent.join(up, "p", "left").select("ca", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved"))
            jumped = stored(jumped, "parents")
            parent = jumped.select("ca", "p")
            if jumped.where("moved").isEmpty():
                break
        new = labels.join(parent.withColumnRenamed("ca", "c"), "c", "left").select("id", F.coalesce("p", "c").alias("c"))
        labels = stored(new, "components")


def _units(classes: DataFrame) -> DataFrame:
    """(band, key, i, j, id): the members of buckets that more than one class is in, once for each
    pair of blocks (i <= j) that the member's block is in."""
    rows = classes.select("id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    often = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size")).where("n > 1")
    blocks = F.ceil(F.col("size") / UNIT_SHINGLES).cast("int").alias("blocks")
    members = rows.join(often.select("band", "key", blocks), ["band", "key"])
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    members = members.select("band", "key", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return stored(members.select("band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id"), "bucket-units")


def unit_links(band: int, ids, own, bands, sketches, sets, within: bool, percent: int = PERCENT) -> list:
    """Links that connect the members of a unit. ``own``: each member's block; within one block
    all pairs count, between two blocks only those across.

    A member meets the first member of every component so far, and then only the members of components that it did
    not join. So a connected bucket takes one comparison a member, whatever its size; only members that are
    not connected are compared pair by pair."""
    max_differ = BANDING[percent][2]
    sizes = np.array([len(s) for s in sets])
    odd = _U(0x5555555555555555)
    label = np.arange(len(ids))  # each member's component, by the number of one of its members
    groups: dict = {}  # component -> its members
    heads, place, n_heads = np.empty(len(ids), np.int64), {}, 0  # the components' numbers, and where each stands among them
    is_head = np.zeros(len(ids), bool)
    biggest = 0
    links = []

    def maybe(x, others):
        """Those of ``others`` that may be near ``x``, the likeliest first."""
        diff = sketches[others] ^ sketches[x]
        differ = np.bitwise_count((diff | (diff >> _U(1))) & odd).sum(axis=1)
        small, large = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
        ok = (differ <= max_differ) & (100 * small >= percent * large)
        return others[ok][np.argsort(differ[ok], kind="stable")]

    def join(x, y):
        nonlocal n_heads, biggest
        both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if 100 * both < percent * (sizes[x] + sizes[y] - both):
            return
        links.append((ids[y], ids[x]))
        a, b = sorted((int(label[x]), int(label[y])), key=lambda g: -len(groups[g]))  # the smaller group moves
        label[groups[b]] = a
        groups[a] += groups.pop(b)
        n_heads -= 1
        last, at = int(heads[n_heads]), place.pop(b)
        heads[at], is_head[b] = last, False
        if last != b:
            place[last] = at
        if len(groups[a]) > len(groups.get(biggest, ())):
            biggest = a

    for x in range(len(ids)):
        others = heads[:n_heads].copy()
        groups[x], place[x], heads[n_heads], is_head[x] = [x], n_heads, x, True
        n_heads += 1
        for y in maybe(x, others).tolist():
            if label[x] != label[y]:
                join(x, y)
        if n_heads == 1:
            continue
        if label[x] == biggest:
            others = np.concatenate([groups[g] for g in heads[:n_heads].tolist() if g != biggest])
        else:
            others = np.flatnonzero(label[:x] != label[x])
        others = others[~is_head[others]]  # x has met these
        if not within:
            others = others[own[others] != own[x]]
        first = (bands[others] == bands[x]).argmax(axis=1) == band  # pairs that share an earlier band meet in its unit
        for y in maybe(x, others[first]).tolist():
            if label[x] != label[y]:
                join(x, y)
    return links


_UNIT = ["band", "key", "i", "j"]


def _linked(batches, percent):
    """Streams the rows of units, which lie together, and returns the links of each unit."""
    import pyarrow as pa

    unit, rows = None, []

    def close():
        rows.sort(key=lambda r: r[0])
        ids, own = [r[0] for r in rows], np.array([r[1] for r in rows])
        bands, sketches = np.array([r[2] for r in rows]), np.array([r[3] for r in rows]).view(np.uint64)
        found = unit_links(unit[0], ids, own, bands, sketches, [r[4] for r in rows], unit[2] == unit[3], percent)
        ends = [pa.array([link[end][part] for link in found], pa.int64()) for end in (0, 1) for part in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, names=["a", "a_row", "b", "b_row"])

    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in _UNIT]))
        values = [batch.column(c) for c in ("doc_id", "row_hash", "own", "bands", "sketch", "shingles")]
        ids, own = list(zip(values[0].to_pylist(), values[1].to_pylist())), values[2].to_pylist()
        arrays = [[x.values.to_numpy(zero_copy_only=False) for x in v] for v in values[3:]]
        for k, key in enumerate(keys):
            if key != unit:
                if len(rows) > 1:
                    yield close()
                unit, rows = key, []
            rows.append((ids[k], own[k], *[a[k].copy() for a in arrays]))
    if len(rows) > 1:
        yield close()


def class_links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Verified links (a, b) between classes (id, n_shingles, bands, sketch): enough of them to
    connect all linked classes that share a band. An id is a struct (doc_id, row_hash)."""
    units = _units(classes)
    key = ["doc_id", "row_hash"]
    wanted = checked_broadcast(stored(units.select("id.*").distinct(), "wanted"), materialize=False)
    sets = full_sets(_rows(docs).join(wanted, key, "left_semi")).groupBy(F.struct(*key).alias("id")).agg(F.max("shingles").alias("shingles"))
    sets = stored(sets.join(classes.select("id", "bands", "sketch"), "id"), "shingle-sets")  # one set per id, also where rows repeat
    work = units.join(sets, "id").repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    found = work.select(*_UNIT, "id.*", "own", "bands", "sketch", "shingles").mapInArrow(
        lambda batches: _linked(batches, percent), "a bigint, a_row bigint, b bigint, b_row bigint").distinct()
    ends = [F.struct(F.col(x).alias("doc_id"), F.col(f"{x}_row").alias("row_hash")).alias(x) for x in ("a", "b")]
    return stored(found.select(*ends), "verified")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_hash, n_shingles, component_id, kept: one row per row of ``docs``. Sets link at a
    Jaccard similarity of ``percent`` hundredths or more."""
    found = stored(features(docs, percent), "minhash")
    usable = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("n_shingles", "d1", "d2").agg(F.min(F.struct("doc_id", "row_hash", "bands", "sketch")).alias("m"))
    classes = stored(classes.select("n_shingles", "d1", "d2", F.struct("m.doc_id", "m.row_hash").alias("id"), "m.bands", "m.sketch"), "classes")
    labels = components(class_links(classes, docs, percent))
    member = classes.join(labels, "id", "left").select("n_shingles", "d1", "d2", F.coalesce("component", "id")["doc_id"].alias("id"))
    # Most classes have one document; the others' key may be that of very many rows, and the class
    # side of this join has one row per key.
    out = found.drop("bands", "sketch").join(member, ["n_shingles", "d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "row_hash", "n_shingles", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(component).alias("component_id"))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
