"""The prefix trie of conversations: ROLLUP over positional turn-id columns.

A conversation is laid out in blocks of ``WIDTH`` columns, one turn id in each; longer
ones go on in further blocks. One ``GROUP BY block, prior, ROLLUP (t0, .., t7)`` counts every
prefix of every block at once, and ``grouping_id`` tells its level. ``prior`` is the node
the block before ended in, so equal blocks behind different beginnings stay apart. These
nodes are found for all blocks together by doubling: after round j a block knows the digest
of the 2**j blocks that end with it, so rounds are logarithmic in the blocks of the longest
conversation, and there are none where one block holds all.

A turn id is the MD5 of role and text with the text's length behind it: texts are read once,
where they lie, and never shuffled. Totals of subtrees are sums over each node's
ancestors in its block; blocks further down are added up by doubling as well. Groups are
combined before each shuffle, conversations of any length are numbered by ranges, and
lookups by parent are salted, so neither the root nor a very common first turn meets one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.texts import small_batches
from ridgeline.operators.running import numbered_by_range
from ridgeline.operators.skew import lookup
from ridgeline.runtime import materialize

WIDTH = 8
# Conversations that share a beginning: those of one group take the first turns of its first.
GROUP = 5
HEADS = 9
# Ids of one node that are joined to one string.
_PACK = 1000
_MD5, _SIZE = 16, 6


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered_turns(df: DataFrame) -> DataFrame:
    """``(conv_id, pos, id)``: turns by number, null first; those of one number by role, then by digest.

    Rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.lpad(F.hex(F.octet_length(text)), 2 * _SIZE, "0")
    marked = F.concat(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")), size)
    given = df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.unhex(marked).alias("id")
    )
    placed = numbered_by_range(given, ["conv_id"], ["turn", "role", "id"], "nth")
    return placed.select("conv_id", (F.col("nth") - 1).alias("pos"), "id")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, id)`` where each conversation begins with turns of its group's first; a turnless one has a row of nulls.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % GROUP`` (``h`` is the CRC-32 of its number modulo
    ``HEADS``), or what there is of them, and then its own turns after its first ``h``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    begun = turns.where((F.col("conv_id") == first) & (F.col("pos") < HEADS - 1))
    sizes = convs.select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    named = convs.select("conv_id", first.alias("first"), h.alias("h"))
    taken = named.join(begun.select(F.col("conv_id").alias("first"), "pos", "id"), "first").where(F.col("pos") < F.col("h"))
    shift = named.join(sizes, "first", "left").select("conv_id", (F.least("h", F.coalesce("n_first", F.lit(0))) - F.col("h")).alias("shift"))
    own = lookup(turns.where(F.col("pos") >= h), materialize(shift, "shifts"), "conv_id", ["pos"])
    none = named.select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("id"))
    return taken.select("conv_id", "pos", "id").unionByName(own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "id")).unionByName(none)


def _blocks(turns: DataFrame, width: int) -> tuple[DataFrame, int]:
    """``(conv_id, blk, t0.., k, more, prior, here)`` and the number of the last block.

    ``k`` turns stand in the block, ``more`` is 1 if another follows; ``prior`` is the node before it, ``here`` the one
    a full block ends in.
    """
    ids = [f"t{j}" for j in range(width)]
    place = F.col("pos") % width
    made = materialize(
        turns.groupBy("conv_id", F.coalesce(F.floor(F.col("pos") / width), F.lit(0)).alias("blk")).agg(
            *[F.max(F.when(place == j, F.col("id"))).alias(t) for j, t in enumerate(ids)], F.count("id").alias("k")
        ), "blocks",
    )
    last = made.agg(F.max("blk")).first()[0] or 0
    full = made.where(F.col("k") == width)
    here = F.when(F.col("k") == width, _digest(*ids)).alias("here")
    empty = F.unhex(F.lit(""))
    if not last:
        return made.select("*", F.lit(0).alias("more"), empty.alias("prior"), here), 0
    chain = full.select("conv_id", "blk", here)
    step = 1
    while step <= last:
        before = chain.select("conv_id", (F.col("blk") + step).alias("blk"), F.col("here").alias("before"))
        chain = materialize(
            chain.join(before, ["conv_id", "blk"], "left").select(
                "conv_id", "blk", F.when(F.col("before").isNull(), F.col("here")).otherwise(_digest(F.col("before"), F.col("here"))).alias("here")
            ), "chain",
        )
        step *= 2
    prior = chain.select("conv_id", (F.col("blk") + 1).alias("blk"), F.col("here").alias("prior"))
    follows = made.where("blk > 0").select("conv_id", (F.col("blk") - 1).alias("blk"), F.lit(1).alias("more"))
    joined = made.join(prior, ["conv_id", "blk"], "left").join(chain, ["conv_id", "blk"], "left").join(follows, ["conv_id", "blk"], "left")
    return materialize(joined.select(*made.columns, F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("prior", empty).alias("prior"), "here"), "blocks"), last


def _keys(width: int) -> Column:
    """The nodes of a block's path, from the one it starts at: an array by level."""
    ids = [F.col(f"t{j}") for j in range(width)]
    start = F.when(F.col("blk") == 0, F.unhex(F.md5(F.lit("").cast("binary")))).otherwise(F.col("prior"))
    return F.array(start, *[_digest(F.col("prior"), *ids[:j]) for j in range(1, width)], F.col("here"))


def trie_nodes(blocks: DataFrame, width: int) -> DataFrame:
    """One row for each node but its place in the tree: key, parent's key, members, and the nodes above it in its block."""
    ids = ", ".join(f"t{j}" for j in range(width))
    rolled = blocks.sparkSession.sql(
        f"""SELECT blk, prior, {ids}, {width} - bit_count(grouping_id()) AS level, min(conv_id) AS conv_id,
              count(*) AS n_convs, max(k + more) AS reach, min(here) AS here
            FROM {{blocks}} GROUP BY blk, prior, ROLLUP ({ids})""",
        blocks=blocks,
    )
    level, last = F.col("level"), F.get(F.array(*[F.col(f"t{j}") for j in range(width)]), F.col("level") - 1)
    # A conversation that ended earlier has null columns: no node. Further blocks start at a node of the one before.
    real = rolled.where(F.when(level == 0, F.col("blk") == 0).otherwise(last.isNotNull()))
    keys, size = _keys(width), F.conv(F.hex(F.substring(last, _MD5 + 1, _SIZE)), 16, 10).cast("long")
    lowest = F.when(F.col("blk") == 0, 1).otherwise(2)
    return real.withColumn("keys", keys).select(
        F.get("keys", level).alias("key"), F.when(level > 0, F.get("keys", level - 1)).alias("parent"), "blk", "prior", "level",
        "conv_id", (F.col("blk") * width + level).alias("depth"), "n_convs",
        (F.col("reach") == level).cast("long").alias("leaf"), F.coalesce((F.col("n_convs") - 1) * size, F.lit(0)).alias("saved"),
        F.slice("keys", lowest, level - lowest + 2).alias("path"),
    )


def _deeper(nodes: DataFrame, width: int) -> DataFrame:
    """``(key, leaves, saved)`` of all blocks below the node a full block ends in."""
    totals = nodes.where("blk > 0").groupBy(F.col("prior").alias("key")).agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    up = nodes.where(F.col("level") == width).select("key", F.when(F.col("blk") > 0, F.col("prior")).alias("up"))
    below = materialize(totals.join(up, "key"), "below")
    while not below.where("up is not null").isEmpty():
        added = below.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = below.select(F.col("key").alias("up"), F.col("up").alias("upper"))
        moved = lookup(below, above, "up", ["key"], "left")
        below = materialize(
            moved.join(added, "key", "left").select(
                "key", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
                F.col("upper").alias("up"),
            ), "below",
        )
    return below.select("key", F.col("leaves").alias("leaf"), "saved")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: of the ids of each key, ascending and comma-joined; they stream through the digest."""
    batched = small_batches(ends)

    def pack(batches):
        for batch in batches:
            keys, ids = (c.to_pylist() for c in batch.columns)
            out, at = [], 0
            while at < len(keys):
                to = at + 1
                while to < len(keys) and keys[to] == keys[at] and to - at < _PACK:
                    to += 1
                out.append((keys[at], ids[at], ",".join(map(str, ids[at:to]))))
                at = to
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["key", "first", "ids"])

    def fold(batches):
        key, digest = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k == key:
                    digest.update(b"," + text.encode())
                    continue
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    ordered = batched.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    packed = ordered.mapInArrow(lambda b: pack(x for x in b if x.num_rows), "key binary, first long, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(fold, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each node of the trie of conversations ``(conv_id, pos, id)``, as :func:`rebuilt_turns` makes them.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (null for the root), ``n_convs`` the members,
    ``n_leaves`` the nodes without children in the subtree, itself included, ``saved_tokens`` the bytes that
    its members need not store again, over the subtree, ``ends_sha256`` a digest of the members that end there.
    A table without conversations gives no rows.
    """
    blocks, last = _blocks(turns, width)
    nodes = materialize(trie_nodes(blocks, width), "nodes")
    up = nodes.select(F.explode("path").alias("key"), "leaf", "saved")
    if last:
        deep = nodes.where(F.col("level") == width).select("key", "path").join(_deeper(nodes, width), "key")
        up = up.unionByName(deep.select(F.explode("path").alias("key"), "leaf", "saved"))
    own = ["conv_id", "depth", "n_convs", "parent"]
    zero, nobody = F.lit(0).cast("long"), F.lit(None)
    parts = nodes.select("key", F.struct(*own).alias("own"), zero.alias("child"), zero.alias("leaf"), zero.alias("saved"))
    known = parts.schema["own"].dataType
    children = nodes.where("parent is not null").select(
        F.col("parent").alias("key"), nobody.cast(known).alias("own"), F.lit(1).cast("long").alias("child"), zero.alias("leaf"), zero.alias("saved")
    )
    up = up.select("key", nobody.cast(known).alias("own"), zero.alias("child"), "leaf", "saved")
    summed = materialize(
        parts.unionByName(children).unionByName(up).groupBy("key").agg(
            F.max("own").alias("own"), F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
        ).select("key", "own.*", "n_children", "n_leaves", "saved_tokens"), "trie",
    )
    ends = blocks.where("more = 0").select(F.get(_keys(width), F.col("k").cast("int")).alias("key"), "conv_id")
    parents = summed.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = lookup(summed, parents, "parent", ["key"], "left")
    return placed.join(end_digests(ends), "key", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(df: DataFrame, width: int = WIDTH) -> DataFrame:
    """:func:`prefix_trie` of a table ``(conv_id, turn, role, text)`` whose conversations are rebuilt first.

    A null role or text is empty. Repeated rows are turns of their own. Rows without ``conv_id``
    are left out; other columns are ignored.
    """
    turns = materialize(numbered_turns(df), "turns")
    return prefix_trie(rebuilt_turns(turns), width)
