"""Prefix trie of conversations by van Emde Boas recursion (operator 11).

Every distinct sequence of first turns is a trie node.  Depths are cut in
half again and again, down to blocks of ``BLOCK`` turns:

* **Naming.**  Blocks of turns get a digest each, and pairs of neighbouring
  blocks a digest of the two, up to half of the greatest depth.  The prefix
  that ends at a cut is then named from the prefix at the cut before it and
  the digest of what lies between, from the coarsest cut down to the finest:
  upper tries and lower forests advance together, and equal prefixes get equal
  names.  The names inside a block follow from the one at its start.
* **Grafting.**  Subtree totals are first summed inside blocks of depths, then
  the total of each cut node is added to its ancestors in the upper half, for
  cuts of twice the size each time.  A round moves at most half a row per
  turn and doubles the reach, so a conversation of D turns takes log D rounds
  and D log D rows, not D squared.

Nothing gathers a conversation, a node's members or its children: turns are
numbered by a range sort, members and children by partial aggregation, a
parent is looked up under (parent, salt), and the member lists behind
``ends_sha256`` are joined to pieces of ``PIECE`` ids before they meet.  (The
digest of one node's list is sequential by its definition; it is streamed,
and never held.)
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibliospark.operators.ordering import range_partitions

from .common import arrow_map, saved

BLOCK_BITS = 4
BLOCK = 1 << BLOCK_BITS  # turns of a block, whose trie is summed at once
PIECE = 4096  # turns of a conversation, or ids of a node, that share one key
HEAD, FAMILY = 6, 100  # fixed values of the contract
ROOT = "root"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, sym, len): turns from 1 on within their conversation.

    Ordered by turn (null first), equal turns by role and text; ``sym`` is a
    digest of role and text, ``len`` the text's code points.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    ).filter("conv_id is not null")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    digest = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    ordered = (
        named.repartitionByRange(range_partitions(turns), *order)
        .sortWithinPartitions(*order)
        .select("conv_id", digest.alias("sym"), F.char_length("text").cast("long").alias("len"))
    )
    local = saved(arrow_map(ordered, _positions, "conv_id long, sym string, len long, pid int, pos long"), "turns")
    # a conversation may go on from one range to the next: one row per partition tells
    parts = local.groupBy("pid").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos")).alias("last")).collect()
    carried, last, count = [], None, 0
    for r in sorted(parts, key=lambda r: r.pid):
        carry = count if r.first == last else 0
        if carry:
            carried.append((r.pid, r.first, carry))
        last, count = r.last.conv_id, r.last.pos + (carry if r.last.conv_id == r.first else 0)
    carries = F.broadcast(turns.sparkSession.createDataFrame(carried, "pid int, conv_id long, carry long"))
    return local.join(carries, ["pid", "conv_id"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("carry", F.lit(0))).alias("pos"), "sym", "len"
    )


def _positions(batches):
    """Appends the partition's id and the place of each row among its conversation's rows there; streams."""
    pid, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch.column(0).to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
        sizes = np.diff(np.append(starts, n))
        pos = np.arange(1, n + 1) - np.repeat(starts, sizes)
        if ids[0] == last:
            pos[: sizes[0]] += count
        last, count = ids[-1], int(pos[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(pos.astype(np.int64))],
            names=["conv_id", "sym", "len", "pid", "pos"],
        )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth) of the rebuilt conversations, and their turns (conv_id, d, sym, len).

    Conversation c takes the first h turns of the first of its family
    (c - c % 100) and its own after its first h; h = crc32(c) % 6.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    first = F.col("conv_id") % FAMILY == 0
    convs = sizes.select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
    )
    have = sizes.filter(first).select(F.col("conv_id").alias("base"), F.col("n").alias("have"))
    given = F.least("h", F.coalesce("have", F.lit(0)))
    convs = saved(
        convs.join(have, "base", "left").select(
            "conv_id", "n", "h", "base", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth")
        ),
        "convs",
    )
    heads = turns.filter(first & (F.col("pos") < HEAD)).withColumnRenamed("conv_id", "base")
    borrowed = (
        convs.filter("given > 0").select("conv_id", "base", "given").join(heads, "base").filter("pos <= given")
        .select("conv_id", F.col("pos").alias("d"), "sym", "len")
    )
    # one key per PIECE turns, so that no long conversation is one key
    pieces = convs.filter("n > h").select(
        "conv_id", "h", (F.col("given") - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / PIECE).cast("int"))).alias("piece"),
    )
    own = (
        turns.withColumn("piece", ((F.col("pos") - 1) / PIECE).cast("int")).join(pieces, ["conv_id", "piece"])
        .filter("pos > h").select("conv_id", (F.col("pos") + F.col("shift")).alias("d"), "sym", "len")
    )
    return convs.select("conv_id", "depth"), borrowed.unionByName(own)


def _cut_names(blocks: DataFrame, deepest: int) -> DataFrame | None:
    """(conv_id, cut, name): names of the prefixes of cut x BLOCK turns, for each whole block before a cut."""
    if not deepest:
        return None
    whole = blocks.filter(F.size("syms") == BLOCK).select("conv_id", "i", F.md5(F.array_join("syms", "")).alias("part"))
    levels = [saved(whole, "parts")]
    while 1 << len(levels) <= deepest:
        pairs = levels[-1].groupBy("conv_id", F.shiftright("i", 1).alias("i")).agg(
            F.count(F.lit(1)).alias("n"), F.min_by("part", "i").alias("left"), F.max_by("part", "i").alias("right")
        )
        levels.append(saved(pairs.filter("n = 2").select("conv_id", "i", F.md5(F.concat("left", "right")).alias("part")), "parts"))
    cuts: list[DataFrame] = []
    for j in reversed(range(len(levels))):
        halves = levels[j].filter(F.col("i") % 2 == 0).select("conv_id", F.shiftleft("i", j).alias("cut"), "part")
        from_root = halves.filter("cut = 0").withColumn("name", F.lit(ROOT))
        known = [halves.join(reduce(DataFrame.unionByName, cuts), ["conv_id", "cut"])] if cuts else []
        ahead = reduce(DataFrame.unionByName, [from_root, *(k.select(*from_root.columns) for k in known)])
        name = F.md5(F.concat("name", F.lit("+"), "part"))
        cuts.append(saved(ahead.select("conv_id", (F.col("cut") + (1 << j)).alias("cut"), name.alias("name")), "cuts"))
    return reduce(DataFrame.unionByName, cuts)


def named_paths(symbols: DataFrame) -> DataFrame:
    """(conv_id, d, name, parent, len): every prefix of every conversation under the name of its node."""
    turn = F.struct("d", "sym", "len")
    blocks = symbols.groupBy("conv_id", F.shiftright(F.col("d") - 1, BLOCK_BITS).cast("int").alias("i")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")  # BLOCK at most
    )
    blocks = saved(blocks.select("conv_id", "i", F.col("turns.sym").alias("syms"), F.col("turns.len").alias("lens")), "blocks")
    deepest = blocks.agg(F.max("i")).first()[0]
    cuts = _cut_names(blocks, (deepest or 0) + 1)
    if cuts is not None:
        before = cuts.select("conv_id", F.col("cut").alias("i"), F.col("name").alias("start"))
        behind = cuts.select("conv_id", (F.col("cut") - 1).alias("i"), F.col("name").alias("end"))
        blocks = blocks.join(before, ["conv_id", "i"], "left").join(behind, ["conv_id", "i"], "left")
    blocks = blocks.withColumn("start", F.when(F.col("i") == 0, F.lit(ROOT)).otherwise(F.col("start")))
    inner = F.transform(
        F.sequence(F.lit(1), F.least(F.size("syms"), F.lit(BLOCK - 1))),
        lambda k: F.md5(F.concat("start", F.lit("/"), F.array_join(F.slice("syms", 1, k), ""))),
    )
    names = F.when(F.size("syms") == BLOCK, F.concat(inner, F.array("end"))).otherwise(inner)
    zipped = F.arrays_zip(
        "names", F.concat(F.array("start"), F.slice("names", 1, F.size("names") - 1)).alias("parents"), "lens"
    )
    paths = (
        blocks.withColumn("names", names)
        .select("conv_id", "i", F.posexplode(zipped).alias("at", "turn"))
        .select(
            "conv_id",
            (F.col("i").cast("long") * BLOCK + F.col("at") + 1).alias("d"),
            F.col("turn.names").alias("name"),
            F.col("turn.parents").alias("parent"),
            F.col("turn.lens").alias("len"),
        )
    )
    return saved(paths, "paths")


def _nodes(paths: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per node with its members, parent and children; and the parents' smallest members by (parent, salt)."""
    salt = F.pmod(F.xxhash64("name"), F.lit(max(16, int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))))).alias("salt")
    inner = paths.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.max("d").alias("depth"), F.min("parent").alias("parent"),
        F.max("len").alias("len"), F.count(F.lit(1)).alias("n_convs"),
    )
    root = convs.groupBy(F.lit(ROOT).alias("name")).agg(
        F.min("conv_id").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("len"), F.count(F.lit(1)).alias("n_convs"),
    )
    nodes = saved(inner.unionByName(root).withColumn("salt", salt), "nodes")
    families = saved(nodes.filter("parent is not null").groupBy("parent", "salt").agg(F.count(F.lit(1)).alias("n")), "families")
    children = families.groupBy(F.col("parent").alias("name")).agg(F.sum("n").alias("n_children"))
    counted = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    above = families.join(nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    return saved(counted, "counted"), above.drop("n")


def _grafted(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(name, leaves, saved): what every node but the root gets from the nodes below it."""
    own = nodes.filter("depth > 0").select(
        "name", "conv_id", F.col("depth").alias("d"), (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("len")).alias("saved"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    steps = paths.select("conv_id", F.col("d").alias("at"), "name", F.shiftright("d", BLOCK_BITS).alias("block"))

    def up(cut: DataFrame) -> DataFrame:
        """Totals of cut nodes (conv_id, block, d, leaves, saved) added to the ancestors in those blocks of their path."""
        pairs = cut.join(steps, ["conv_id", "block"]).filter("at < d")
        return pairs.groupBy("name").agg(F.max("at").alias("d"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    inside = own.filter(F.col("d") % BLOCK != 0).withColumn("block", F.shiftright("d", BLOCK_BITS))
    got = [saved(up(inside.drop("name")), "grafts")]
    half = BLOCK
    while half <= deepest:
        here = F.col("d") % (2 * half) == half
        sums = [own.filter(here)] + [
            g.filter(here).select("name", F.lit(None).cast("long").alias("conv_id"), "d", "leaves", "saved") for g in got
        ]
        cut = reduce(DataFrame.unionByName, sums).groupBy("name").agg(
            F.max("conv_id").alias("conv_id"), F.max("d").alias("d"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )
        block = F.sequence(F.shiftright(F.col("d") - half, BLOCK_BITS), F.shiftright("d", BLOCK_BITS) - 1)
        got.append(saved(up(cut.drop("name").withColumn("block", F.explode(block))), "grafts"))
        half *= 2
    parts = [g.drop("d") for g in got]
    return reduce(DataFrame.unionByName, parts).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _pieces(batches):
    """Runs of one name in sorted (name, conv_id) rows, joined to texts of at most PIECE ids."""
    name, first, ids, out = None, None, [], []
    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n != name or len(ids) == PIECE:
                if ids:
                    out.append((name, first, ",".join(ids)))
                name, first, ids = n, c, []
            ids.append(str(c))
        yield _rows(out, "name", "first", "ids")
        out = []
    if ids:
        yield _rows([(name, first, ",".join(ids))], "name", "first", "ids")


def _digests(batches):
    """SHA-256 over the pieces of each name, which come in order; streams."""
    name, digest, out = None, None, []
    for batch in batches:
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n == name:
                digest.update(b",")
            else:
                if name is not None:
                    out.append((name, digest.hexdigest()))
                name, digest = n, hashlib.sha256()
            digest.update(ids.encode())
        yield _rows(out, "name", "ends_sha256")
        out = []
    if name is not None:
        yield _rows([(name, digest.hexdigest())], "name", "ends_sha256")


def _rows(rows: list[tuple], *names: str) -> pa.RecordBatch:
    kinds = {"first": pa.int64()}
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns)], names=list(names))


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end."""
    at = convs.withColumnRenamed("depth", "d")
    ends = paths.select("conv_id", "d", "name").join(at.filter("d > 0"), ["conv_id", "d"]).select("name", "conv_id")
    ends = ends.unionByName(at.filter("d = 0").select(F.lit(ROOT).alias("name"), "conv_id"))
    ordered = ends.repartitionByRange(range_partitions(paths), "name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = arrow_map(ordered, _pieces, "name string, first long, ids string")
    met = pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return arrow_map(met, _digests, "name string, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per trie node of the rebuilt conversations in ``turns`` (conv_id, turn, role, text).

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Null
    role and text count as empty; equal turns of a conversation are ordered by
    role and text, and repeated rows are turns of their own; rows without a
    conv_id take no part; other columns do not matter; an empty table has no
    nodes.
    """
    convs, symbols = rebuilt(numbered_turns(turns))
    paths = named_paths(symbols)
    nodes, above = _nodes(paths, convs)
    below = _grafted(nodes, paths)
    # the root's totals are those of all nodes
    every = nodes.filter("depth > 0").agg(
        F.lit(ROOT).alias("name"),
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("len")).alias("saved"),
    )
    nothing = F.lit(0).cast("long")
    return (
        nodes.join(below.unionByName(every), "name", "left")
        .join(_ends(paths, convs), "name", "left")
        .join(above, ["parent", "salt"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.coalesce("leaves", nothing) + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
            (F.coalesce("saved", nothing) + (F.col("n_convs") - 1) * F.col("len")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
