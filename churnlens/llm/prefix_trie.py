"""Conversation prefix trie (operator 12): adaptive radix trees, merged by prefix.

A turn's id is the first 16 bytes of SHA-256 over its role and text, big-endian, so a
conversation is a byte string of fixed-width ids and a trie node is a prefix at a byte
depth that is a multiple of 16.

* Turns are numbered within their conversation by a range sort; a conversation that spans
  partitions gets its offsets from one row a partition.
* Conversations are cut into blocks of ``BLOCK`` positions, so a conversation with a third
  of all turns is built by many tasks. A task puts its blocks into adaptive radix trees of
  ``TREE_TURNS`` turns and emits one row for each turn-aligned prefix: the local count and
  smallest id, the parent's place, and the prefix's digest: two polynomials over the turn
  ids modulo 2**61 - 1. Such a digest can be continued: a later block's is shifted by the
  state before it, once the states of long conversations are folded.
* Local rows with one digest and depth are one node; a common prefix comes once from each
  tree, not once from each conversation.
* Subtree sums take no rounds by depth. A node is owned by its smallest member; it counts
  in the one tree where its owner passes it, is summed upwards there, and what a long
  conversation owns in later blocks is added where its earlier blocks end.
* The hash over a node's ends needs its ids in order: they are packed into chunks in range
  order, and one task streams a node's chunks, holding one.

Defined results
* turns are ordered by turn (null first), ties by the first 32 characters of the role, the
  first 64 of the text, then the turn's id; repeated rows count each;
* a null role or text is empty; rows with a null conversation id take no part;
* a conversation without turns belongs to the root only; without any conversation there is
  no node, not even a root (it would have no smallest member);
* texts of any length are hashed in the JVM and not moved; other columns are not read,
  whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import col_of, staged, text_or_empty
from churnlens.llm.radix_tree import RadixTree

WIDTH = 16
BLOCK, TREE_TURNS = 1 << 12, 1 << 17
CHUNK_BYTES = 1 << 20
# fixed values: a Mersenne prime, and the points at which the two polynomials are taken
PRIME = (1 << 61) - 1
POINTS = (1_000_000_007, 998_244_353_111)

_L, _I, _B = pa.int64(), pa.int32(), pa.bool_()


def _spark(schema: pa.Schema) -> T.StructType:
    kinds = {_L: T.LongType(), _I: T.IntegerType(), _B: T.BooleanType(), pa.binary(): T.BinaryType(), pa.string(): T.StringType()}
    return T.StructType([T.StructField(f.name, kinds[f.type]) for f in schema])


_TURNS = pa.schema([("pid", _L), ("conv", _L), ("local", _L), ("tid", pa.binary()), ("n_bytes", _L)])
# is_node: a prefix of a tree (block null: from the beginning). Else a block's end (a
# conversation's, if ``ended``) and the place of its last turn in the tree.
_BUILT = pa.schema([
    ("is_node", _B), ("tree", _L), ("at", _L), ("above", _L), ("depth", _L), ("a", _L), ("b", _L), ("pa", _L), ("pb", _L),
    ("n_bytes", _L), ("n", _L), ("conv", _L), ("block", _L), ("ended", _B),
])
_CARRY = pa.schema([("conv", _L), ("block", _L), ("depth0", _L), ("a0", _L), ("b0", _L)])
_SUMS = pa.schema([("depth", _L), ("a", _L), ("b", _L), ("saved", _L), ("leaves", _L)])
_CHUNKS = pa.schema([("depth", _L), ("a", _L), ("b", _L), ("first", _L), ("ids", pa.string())])
_ENDS = pa.schema([("depth", _L), ("a", _L), ("b", _L), ("ends_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def numbered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, pos (from 0), tid, n_bytes (of the text) of each turn. Written once."""
    spark = df.sparkSession
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = df.where(col_of(conv_col).isNotNull()).select(
        col_of(conv_col).cast("bigint").alias("c"), col_of(turn_col).alias("n"),
        F.left(role, F.lit(32)).alias("r"), F.left(text, F.lit(64)).alias("t"),
        F.unhex(F.left(F.sha2(said, 256), F.lit(2 * WIDTH))).alias("tid"), F.octet_length(text).cast("bigint").alias("n_bytes"))

    def number(batches):
        pid, conv, local = TaskContext.get().partitionId(), None, 0
        for rec in batches:
            places = []
            for c in rec.column(0).to_pylist():
                local = local + 1 if c == conv else 0
                conv = c
                places.append(local)
            yield pa.record_batch([pa.array([pid] * len(places), _L), rec.column(0), pa.array(places, _L), rec.column(4), rec.column(5)], schema=_TURNS)

    order = rows.repartitionByRange("c", "n", "r", "t").sortWithinPartitions("c", "n", "r", "t", "tid")
    turns = staged(order.mapInArrow(number, _spark(_TURNS)), "turns")
    spans = turns.groupBy("pid").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "local")).alias("last")).orderBy("pid").collect()
    offsets, conv, total = [], None, 0  # a row a partition
    for s in spans:
        before = total if s.first == conv else 0
        if before:
            offsets.append((s.pid, s.first, before))
        conv = s["last"].conv
        total = s["last"].local + 1 + (before if conv == s.first else 0)
    moved = spark.createDataFrame(offsets, "pid long, conv long, moved long")
    pos = F.col("local") + F.coalesce("moved", F.lit(0))
    return turns.join(F.broadcast(moved), ["pid", "conv"], "left").select("conv", pos.alias("pos"), "tid", "n_bytes")


def rebuilt(turns: DataFrame, donor: Column, shared: Column, most_shared: int) -> DataFrame:
    """Each conversation with the first ``shared`` turns of conversation ``donor`` in place
    of its own first ones (columns over ``conv``; shared <= most_shared)."""
    convs = turns.select("conv").distinct().select("conv", donor.alias("donor"), shared.alias("shared"))
    heads = turns.where(F.col("pos") < most_shared).select(F.col("conv").alias("donor"), "pos", "tid", "n_bytes")
    taken = convs.join(heads, "donor").where(F.col("pos") < F.col("shared"))
    return turns.where(F.col("pos") >= shared).unionByName(taken.select("conv", "pos", "tid", "n_bytes"))


_powers: tuple[list[int], list[int]] = ([1], [1])


def _power(lane: int, n: int) -> int:
    known = _powers[lane]
    while len(known) <= n:
        known.append(known[-1] * POINTS[lane] % PRIME)
    return known[n]


def _ids(tid: bytes) -> tuple[int, int]:
    return int.from_bytes(tid[:8], "big") % PRIME, int.from_bytes(tid[8:], "big") % PRIME


def continued(depth: int, a: int, b: int, depth0: int, a0: int, b0: int) -> tuple[int, int, int]:
    """The digest of a piece that follows a prefix with digest (depth0, a0, b0)."""
    return depth0 + depth, (a0 + pow(POINTS[0], depth0, PRIME) * a) % PRIME, (b0 + pow(POINTS[1], depth0, PRIME) * b) % PRIME


def prefixes(tree: RadixTree, sizes: dict[bytes, int], number: int, block: int | None) -> Iterator[tuple]:
    """Rows of ``_BUILT`` for one tree: its turn-aligned prefixes, parents first, and the ends of the blocks in it. The root is a prefix if ``block`` is
    null, else it stands for what came before."""
    nodes = tree.walk()
    count = [len(node.held) for node, _, _ in nodes]
    least = [min((conv for conv, _, _ in node.held), default=None) for node, _, _ in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        above = nodes[i][1]
        count[above] += count[i]
        if least[above] is None or least[i] < least[above]:
            least[above] = least[i]
    place = 0
    state: list[tuple] = []  # of each node: the place of its last prefix, depth, digest, bytes since
    for i, (node, above, part) in enumerate(nodes):
        at, depth, a, b, rest = state[above] if above >= 0 else (-1, 0, 0, 0, b"")
        if above < 0 and block is None:
            yield (True, number, place, -1, 0, 0, 0, None, None, 0, count[i], least[i], None, None)
            at, place = place, place + 1
        part = rest + part
        for k in range(0, len(part) - WIDTH + 1, WIDTH):
            tid = part[k : k + WIDTH]
            x, y = _ids(tid)
            pa_, pb_ = a, b
            a = (a + x * _power(0, depth)) % PRIME
            b = (b + y * _power(1, depth)) % PRIME
            depth += 1
            yield (True, number, place, at, depth, a, b, pa_, pb_, sizes[tid], count[i], least[i], block, None)
            at, place = place, place + 1
        state.append((at, depth, a, b, part[len(part) // WIDTH * WIDTH :]))
        for conv, its_block, ended in node.held:
            yield (False, number, at, None, depth, a, b, None, None, None, None, conv, its_block, ended)


def _build(tree_turns: int):
    """Blocks, in order, into trees; rows of ``_BUILT``."""

    def build(batches):
        number = TaskContext.get().partitionId() << 32
        tree, sizes, inside = RadixTree(), {}, 0
        run: list[bytes] = []
        key, ended = None, False
        out: list[tuple] = []

        def close():
            """Put the finished block where it belongs."""
            nonlocal inside, number
            if key is None:
                return
            conv, block = key
            if block == 0:
                tree.put(b"".join(run), (conv, block, ended))
                inside += len(run) + 1
            else:  # begins in the middle of a conversation: a tree of its own
                number += 1
                single = RadixTree()
                single.put(b"".join(run), (conv, block, ended))
                out.extend(prefixes(single, sizes, number - 1, block))

        def flush():
            nonlocal tree, sizes, inside, number
            if inside:
                number += 1
                out.extend(prefixes(tree, sizes, number - 1, None))
            tree, sizes, inside = RadixTree(), {}, 0

        for rec in batches:
            for conv, block, tid, n_bytes in zip(*(rec.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if (conv, block) != key:
                    close()
                    if inside >= tree_turns or len(sizes) >= tree_turns:
                        flush()
                    key, run, ended = (conv, block), [], False
                if tid is None:
                    ended = True
                else:
                    run.append(tid)
                    sizes[tid] = n_bytes
            while len(out) >= 1 << 14:
                yield _batch(out[: 1 << 14], _BUILT)
                del out[: 1 << 14]
        close()
        flush()
        for i in range(0, len(out), 1 << 14):
            yield _batch(out[i : i + (1 << 14)], _BUILT)

    return build


def _fold(key: tuple, blocks: pa.Table) -> pa.Table:
    """The state before each block of one long conversation."""
    out, state = [], (0, 0, 0)
    for r in sorted(blocks.to_pylist(), key=lambda r: r["block"]):
        out.append((r["conv"], r["block"], *state))
        state = continued(r["depth"], r["a"], r["b"], *state)
    return pa.Table.from_batches([_batch(out, _CARRY)])


def _shifted(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Rows of later blocks with the digests they have from the beginning on."""
    schema = T.StructType([*_spark(_BUILT)])

    def shift(batches):
        for rec in batches:
            out = []
            for r in rec.to_pylist():
                before = (r.pop("depth0"), r.pop("a0"), r.pop("b0"))
                if r["pa"] is not None:
                    _, r["pa"], r["pb"] = continued(0, r["pa"], r["pb"], *before)
                r["depth"], r["a"], r["b"] = continued(r["depth"], r["a"], r["b"], *before)
                out.append(r)
            yield pa.RecordBatch.from_pylist(out, schema=_BUILT)

    joined = rows.join(carry, ["conv", "block"]).select(*_BUILT.names, "depth0", "a0", "b0")
    return joined.mapInArrow(shift, schema)


def _upwards(key: tuple, nodes: pa.Table, later: pa.Table) -> pa.Table:
    """One tree's subtree sums: places are dense, a parent's below its children's."""
    nodes = nodes.sort_by("at")
    saved, leaves = nodes.column("weight").to_pylist(), nodes.column("leaf").to_pylist()
    for at, w, n in zip(*(later.column(c).to_pylist() for c in ("at", "weight", "leaf"))):
        saved[at] += w
        leaves[at] += n
    above = nodes.column("above").to_pylist()
    for i in range(len(above) - 1, -1, -1):
        if above[i] >= 0:
            saved[above[i]] += saved[i]
            leaves[above[i]] += leaves[i]
    return pa.table([nodes.column(c) for c in ("depth", "a", "b")] + [pa.array(saved, _L), pa.array(leaves, _L)], schema=_SUMS)


def _ends_hashes(ends: DataFrame, chunk_bytes: int) -> DataFrame:
    """depth, a, b, ends_sha256 of each node at which conversations end."""

    def pack(batches):
        node, first, ids, held = None, None, [], 0
        for rec in batches:
            out = []
            for depth, a, b, conv in zip(*(rec.column(i).to_pylist() for i in range(4))):
                if (depth, a, b) != node or held >= chunk_bytes:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids, held = (depth, a, b), conv, [], 0
                ids.append(str(conv))
                held += len(ids[-1]) + 1
            yield _batch(out, _CHUNKS)
        if ids:
            yield _batch([(*node, first, ",".join(ids))], _CHUNKS)

    def digest(batches):
        node, state = None, None
        for rec in batches:
            out = []
            for depth, a, b, ids in zip(*(rec.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if (depth, a, b) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, a, b), hashlib.sha256(ids.encode())
            yield _batch(out, _ENDS)
        if node:
            yield _batch([(*node, state.hexdigest())], _ENDS)

    keys = ["depth", "a", "b"]
    packed = ends.select(*keys, "conv").repartitionByRange(*keys, "conv").sortWithinPartitions(*keys, "conv").mapInArrow(pack, _spark(_CHUNKS))
    return packed.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digest, _spark(_ENDS))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``turns``: conv, pos (ascending numbers, the first below
    ``BLOCK``; gaps are allowed), tid, n_bytes, as ``numbered`` gives them; ``convs``: every conversation's id, as ``conv``."""
    node, node_keys = F.col("is_node"), ["depth", "a", "b"]
    last = turns.groupBy("conv").agg((F.max("pos") + 1).alias("pos"))
    marks = convs.select("conv").distinct().join(last, "conv", "left").select(
        "conv", F.coalesce("pos", F.lit(0)).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("tid"), F.lit(0).cast("bigint").alias("n_bytes"))
    block = F.expr(f"pos div {BLOCK}").alias("block")
    rows = turns.select("conv", "pos", "tid", "n_bytes").unionByName(marks).select("conv", block, "pos", "tid", "n_bytes")
    blocks = rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "pos")
    built = staged(blocks.mapInArrow(_build(TREE_TURNS), _spark(_BUILT)), "built")

    # conversations of several blocks: the state before each of them
    cut = built.where(~node & ((F.col("block") > 0) | ~F.col("ended")))
    carry = staged(cut.select("conv", "block", "depth", "a", "b").groupBy("conv").applyInArrow(_fold, _spark(_CARRY)), "carry")
    late = staged(_shifted(built.where(F.col("block") > 0), carry), "late")
    local = built.where(node & F.col("block").isNull()).unionByName(late.where(node))
    ends = built.where(~node & (F.col("block") == 0) & F.col("ended")).unionByName(late.where(~node & F.col("ended")))

    nodes = staged(local.groupBy(*node_keys).agg(
        F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb")), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    kids = nodes.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    linked = nodes.join(parents, ["depth", "pa", "pb"], "left").join(kids, node_keys, "left")
    linked = staged(linked.select(*node_keys, "conv_id", "parent_conv_id", "n_convs", "n_bytes", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children")), "linked")

    # a node counts where its owner, its smallest member, passes it
    facts = linked.select(*node_keys, "conv_id", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("worth"), (F.col("n_children") == 0).cast("bigint").alias("childless"))
    own = F.col("conv") == F.col("conv_id")
    owned = staged(local.select("tree", "at", "above", "conv", "block", *node_keys).join(facts, node_keys).select(
        "tree", "at", "above", "conv", "block", *node_keys,
        F.when(own, F.col("worth")).otherwise(0).alias("weight"), F.when(own, F.col("childless")).otherwise(0).alias("leaf")), "owned")
    in_block = owned.where(F.col("block").isNotNull()).groupBy("conv", "block").agg(F.sum("weight").alias("w"), F.sum("leaf").alias("l"))
    after = "over (partition by conv order by block desc rows between unbounded preceding and 1 preceding)"
    later = cut.join(in_block, ["conv", "block"], "left").select(
        "tree", "at", "ended", F.expr(f"coalesce(sum(w) {after}, 0)").alias("weight"), F.expr(f"coalesce(sum(l) {after}, 0)").alias("leaf"))
    sums = owned.select("tree", "at", "above", *node_keys, "weight", "leaf").groupBy("tree").cogroup(
        later.where(~F.col("ended") & (F.col("at") >= 0)).select("tree", "at", "weight", "leaf").groupBy("tree")).applyInArrow(_upwards, _spark(_SUMS))
    totals = sums.groupBy(*node_keys).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    none = hashlib.sha256(b"").hexdigest()
    return linked.join(totals, node_keys).join(_ends_hashes(ends, CHUNK_BYTES), node_keys, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
