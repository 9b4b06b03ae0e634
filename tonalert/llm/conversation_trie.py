"""Operator 12, a prefix trie of conversations by fixed-length block hashing.

A turn's hash covers its place, role and text, and a prefix is known by the XOR of its turns' hashes (two lanes of 64
bits), so digests of blocks combine into digests of prefixes without going through the turns again.

1. Conversations with the same digest and length are one class: its smallest id stands for it, with the number
   of its members. Only the representatives' turns are looked at from here on.
2. Successive blocks of BLOCK turns give a trie of blocks: a block is known by the digest of everything up to its
   end, its parent by the digest up to its start. Members are summed per block.
3. A block without siblings has all turn boundaries of its parent's members, so each of its turns is a node with the block's
   members. Only where siblings diverge are turn boundaries refined: one copy of each sibling is cut into its
   turns, and turns with the same prefix become one node.
4. A node's tokens belong to the block of its smallest member. Sums over subtrees add up, per class, what
   lies below each of its blocks, and then per block and node; no step goes through the trie level by level.

No group is collected: members, leaves and tokens are sums with partial aggregation, a block's turns are at
most BLOCK, and a node's ids are written in runs of at most ID_RUN neighbouring ids and hashed as a stream. Turns are
numbered after a range sort, so a conversation of any length spreads over tasks; one
window runs over the blocks (not the turns) of a representative.

Edge cases: a NULL role or text is empty; a NULL turn comes first; turns with equal numbers are ordered by the SHA-256
of role and text (rows that repeat a turn are turns of their own). Rows with a NULL conv_id belong to no conversation and
are ignored. A rebuilt conversation may have no turns: it ends at the root. An empty table gives no rows, not even a root. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tonalert.llm.common import stored
from tonalert.operators.joins import checked_broadcast
from tonalert.operators.vocab import number_rows

BLOCK = 8
SHARED = 100  # conversations that take their first turns from the same one
HEAD = 6  # one of HEAD numbers of turns is taken
ID_RUN = 512


def turns_in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, t, chars): the turns of every conversation from place 0; ``t`` is the SHA-256 of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    own = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)  # the role's length keeps the two apart
    turns = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.unhex(F.sha2(own.cast("binary"), 256)).alias("t"), F.char_length(text).alias("chars"))
    numbered = stored(number_rows(turns, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t"), col="at"), "trie-turns")
    first = numbered.groupBy("conv_id").agg(F.min("at").alias("first"))
    return numbered.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first")).cast("int").alias("pos"), "t", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): every conversation starts with the first turns of the one it shares them with. Conversations: conv_id
    and n_turns; turns as in ``turns_in_order``."""
    sizes = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD)).cast("int")
    convs = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"), head.alias("h"))
    of_base = sizes.where(F.col("conv_id") % SHARED == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(of_base, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "trie-conversations")
    first = turns.where((F.col("pos") < HEAD) & (F.col("conv_id") % SHARED == 0)).select(F.col("conv_id").alias("base"), "pos", "t", "chars")
    taken = convs.where("m > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("pos")).join(first, ["base", "pos"])
    own = turns.join(convs.select("conv_id", "h", "m"), "conv_id").where("pos >= h")
    out = taken.select("conv_id", "pos", "t", "chars").unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "t", "chars"))
    return convs.select("conv_id", "n_turns"), stored(out.select("*", F.xxhash64("pos", "t").alias("x"), F.xxhash64("t", "pos", F.lit(1)).alias("y")), "trie-rebuilt")


def classes_of(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, x, y): every conversation with the digest of all its turns (0, 0 of none)."""
    whole = turns.groupBy("conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    return stored(convs.join(whole, "conv_id", "left").fillna(0, ["x", "y"]), "trie-classes")


def class_blocks(classes: DataFrame, turns: DataFrame) -> DataFrame:
    """Blocks of the representatives: c, k, weight, turns array<struct<x,y,chars>> (digests of the whole prefix that ends
    with the turn), px, py (digest up to the block), x, y (digest to its end)."""
    wanted = checked_broadcast(classes.select("c", "weight"), materialize=False)
    block = (F.col("pos") / BLOCK).cast("int").alias("k")
    own = turns.join(wanted, turns["conv_id"] == wanted["c"]).select("c", "weight", block, "pos", "x", "y", "chars")
    blocks = own.groupBy("c", "weight", "k").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y", "chars"))).alias("turns"),
                                                 F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    to_end = W.partitionBy("c").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    blocks = blocks.select("*", F.bit_xor("bx").over(to_end).alias("x"), F.bit_xor("by").over(to_end).alias("y"))
    blocks = blocks.withColumns({"px": F.col("x").bitwiseXOR(F.col("bx")), "py": F.col("y").bitwiseXOR(F.col("by"))})

    def prefix(lane, start, i):
        return F.aggregate(F.slice("turns", F.lit(1), i + 1), start, lambda a, t: a.bitwiseXOR(t[lane]))

    run = F.transform("turns", lambda t, i: F.struct(prefix("x", F.col("px"), i).alias("x"), prefix("y", F.col("py"), i).alias("y"), t["chars"].alias("chars")))
    return stored(blocks.select("c", "weight", "k", run.alias("turns"), "px", "py", "x", "y"), "trie-class-blocks")


KEY = ["k", "px", "py", "x", "y"]  # a block: its place, the digest up to it and the digest to its end
NODE = ["depth", "x", "y"]


def _turns(blocks: DataFrame, *cols: str) -> DataFrame:
    """One row per turn of ``blocks``: depth, x, y, ux, uy (the parent's digest), chars, i (place in the block) and ``cols``."""
    rows = blocks.select("k", "px", "py", "turns", *cols, F.posexplode("turns").alias("i", "u"))
    before = F.get("turns", F.col("i") - 1)
    return rows.select((F.col("k") * BLOCK + F.col("i") + 1).alias("depth"), "u.x", "u.y", F.coalesce(before["x"], "px").alias("ux"),
                       F.coalesce(before["y"], "py").alias("uy"), F.col("u.chars").cast("bigint").alias("chars"), "i", "k", *cols)


def distinct_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks without siblings, blocks with some), one row per distinct block: KEY, first (smallest conversation), n_convs, turns."""
    found = stored(blocks.groupBy(*KEY).agg(F.min("c").alias("first"), F.sum("weight").alias("n_convs"), F.first("turns").alias("turns")), "trie-blocks")
    alone = found.groupBy("k", "px", "py").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("x"), F.max("y").alias("y")).where("n = 1").drop("n")
    marked = stored(found.join(alone.withColumn("alone", F.lit(True)), KEY, "left"), "trie-blocks")
    return marked.where("alone").drop("alone"), marked.where("alone IS NULL").drop("alone")


def _id_text(ids: DataFrame) -> DataFrame:
    """(x, y, n_turns, ends_sha256): SHA-256 of the ids of each class in ascending order, comma-joined. Runs of neighbouring
    ids are joined apart, then hashed one after the other as a stream: no list of all ids is ever held."""
    run = F.floor(F.col("conv_id") / ID_RUN).alias("run")
    runs = ids.groupBy("n_turns", "x", "y", run).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("text"))

    def hashed(batches):
        import hashlib

        import pyarrow as pa

        def rows(done):
            return pa.RecordBatch.from_pylist([{**dict(zip(NODE, k)), "ends_sha256": h} for k, h in done], schema)

        schema = pa.schema([("depth", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])
        key, state = None, None
        for batch in batches:
            done = []
            for *now, text in zip(*[batch.column(c).to_pylist() for c in (*NODE, "text")]):
                if now != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = now, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield rows(done)
        if key is not None:
            yield rows([(key, state.hexdigest())])

    work = runs.repartition("n_turns", "x", "y").sortWithinPartitions("n_turns", "x", "y", "run")
    return work.select(F.col("n_turns").alias("depth"), "x", "y", "text").mapInArrow(hashed, "depth int, x bigint, y bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(turns_in_order(rows))
    convs = classes_of(convs, turns)
    classes = stored(convs.groupBy("n_turns", "x", "y").agg(F.min("conv_id").alias("c"), F.count(F.lit(1)).alias("weight")), "trie-class")
    blocks = class_blocks(classes, turns)
    alone, siblings = distinct_blocks(blocks)

    # Nodes and their members; turn boundaries are compared only among siblings.
    refined = _turns(siblings, "first", "n_convs").groupBy(*NODE, "ux", "uy").agg(
        F.min("first").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("chars").alias("chars"))
    lone = _turns(alone, "first", "n_convs").select(*NODE, "ux", "uy", F.col("first").alias("conv_id"), "n_convs", "chars")
    below_root = stored(refined.unionByName(lone), "trie-nodes")
    nothing = {"depth": F.lit(0), **{c: F.lit(0).cast("bigint") for c in ("x", "y", "chars")}, **{c: F.lit(None).cast("bigint") for c in ("ux", "uy")}}
    root = classes.agg(F.min("c").alias("conv_id"), F.sum("weight").alias("n_convs")).where("conv_id IS NOT NULL").withColumns(nothing)
    nodes = below_root.unionByName(root)
    children = stored(below_root.groupBy((F.col("depth") - 1).alias("depth"), F.col("ux").alias("x"), F.col("uy").alias("y")).agg(
        F.count(F.lit(1)).alias("n_children")), "trie-children")
    leaves = classes.withColumnRenamed("n_turns", "depth").join(children, NODE, "left_anti")
    leaves = stored(leaves.select("c", F.lit(1).cast("bigint").alias("leaf")), "trie-leaves")

    # Tokens of the nodes whose smallest member is a block's smallest: at most one per turn of the block.
    k, i = ((F.col("depth") - 1) / BLOCK).cast("int"), (F.col("depth") - 1) % BLOCK
    tokens = (F.col("n_convs") - 1) * F.col("chars")
    own = below_root.select(k.alias("k"), F.col("conv_id").alias("c"), F.struct(i.alias("i"), tokens.alias("w")).alias("v"))
    own = stored(own.groupBy("k", "c").agg(F.collect_list("v").alias("own"), F.sum("v.w").alias("tokens")), "trie-tokens")
    # What lies below a block on the way of each class, summed over the classes that go through the block.
    after = W.partitionBy("c").orderBy(F.col("k").desc()).rowsBetween(W.unboundedPreceding, -1)
    ways = blocks.drop("turns").join(own.drop("own"), ["k", "c"], "left").join(leaves, "c", "left")
    ways = ways.select(*KEY, F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce(F.sum("tokens").over(after), F.lit(0)).alias("below"))
    sums = stored(ways.groupBy(*KEY).agg(F.sum("leaf").alias("leaf"), F.sum("below").alias("below")), "trie-sums")

    def turn_sums(part):
        held = part.join(sums, KEY).join(own.select("k", F.col("c").alias("first"), "own"), ["k", "first"], "left")
        rest = F.aggregate(F.filter("own", lambda v: v["i"] >= F.col("i")), F.lit(0).cast("bigint"), lambda a, v: a + v["w"])
        return _turns(held, "leaf", "below", "own").select(*NODE, F.col("leaf").alias("n_leaves"), (F.col("below") + F.coalesce(rest, F.lit(0))).alias("saved_tokens"))

    totals = turn_sums(siblings).groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")).unionByName(turn_sums(alone))
    of_root = leaves.agg(F.count(F.lit(1)).alias("n_leaves")).withColumns({c: nothing[c] for c in NODE})
    of_root = of_root.join(below_root.agg(F.lit(0).alias("depth"), F.coalesce(F.sum(tokens), F.lit(0)).alias("saved_tokens")), "depth")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals.unionByName(of_root), NODE).join(children, NODE, "left").join(_id_text(convs), NODE, "left")
    out = out.join(checked_broadcast(parents), ["depth", "ux", "uy"], "left")  # in a shuffle join AQE splits the children of one node
    return out.select("conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
