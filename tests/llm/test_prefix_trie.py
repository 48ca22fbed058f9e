"""The trie against prefixes in a dictionary; the radix tree; long conversations."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from churnlens.llm import prefix_trie as P
from churnlens.llm.radix_tree import Full, Indexed, Listed, RadixTree, common

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_order(rows):
    """{conv: [(role, text)]} with null turns first, ties by role and text."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def plain_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain_trie(paths):
    members, ends = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, {}, {}
    for key in members:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    for key, convs in members.items():
        worth = (len(convs) - 1) * len(key[-1][1].encode()) if key else 0
        for d in range(len(key) + 1):
            saved[key[:d]] = saved.get(key[:d], 0) + worth
            leaves[key[:d]] = leaves.get(key[:d], 0) + (key not in children)
    return sorted(
        (min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), children.get(key, 0), leaves[key], saved[key],
         hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest())
        for key, convs in members.items()
    )


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[:2], r[2] or 0))


def tries(spark, rows, names=("conv_id", "turn", "role", "text"), schema=SCHEMA):
    turns = P.numbered(spark.createDataFrame(rows, schema), *names)
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return P.prefix_trie(P.rebuilt(turns, F.col("conv") - F.col("conv") % 5, shared, 8), turns)


def conversations(n, seed, deep=()):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        size = rnd.randint(1, 12)
        say = lambda: rnd.choice(["a", "bé", "ccc", "", None, "long " * 9])
        rows += [(c, t, rnd.choice(["user", "assistant"]) if rnd.random() < 0.2 else "user", say()) for t in range(size)]
    for c, size, text in deep:
        rows += [(c, t, "user", text if t % 7 else "x") for t in range(size)]
    rnd.shuffle(rows)
    return rows


def test_long_conversations_in_blocks(spark, monkeypatch):
    """Blocks of 16 and small trees: conversations that share more than a block, one that
    goes on where another ends, one that spans partitions."""
    monkeypatch.setattr(P, "BLOCK", 16)
    monkeypatch.setattr(P, "TREE_TURNS", 50)
    monkeypatch.setattr(P, "CHUNK_BYTES", 10)
    deep = [(1000, 300, "z"), (1005, 300, "z"), (1010, 170, "z"), (1015, 171, "z"), (1020, 16, "z"), (1025, 32, "z"), (1030, 33, "y"), (1035, 2000, "q")]
    rows = conversations(60, 2, deep) + [(2000 + c, t, "user", "same") for c in range(40) for t in range(40)]
    got = tries(spark, rows)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert ordered(got.collect()) == plain_trie(plain_rebuilt(plain_order(rows)))


def test_nulls_repeats_and_clashing_names(spark):
    rows = [
        (0, None, None, None, 1, "x"), (0, 1, "user", "", 1, "x"), (0, 1, "user", "", 1, "x"), (0, 2, "user", None, 2, "y"),
        (None, 1, "user", "lost", 3, "z"), (-3, 1, "a", "b", 4, "w"), (-5, 1, "a:", "b", 4, "w"), (-5, 2, "a", ":b", 4, "w"),
        (7, 5, "user", "only", 5, "v"), (8, 1, "ab", "c", 6, "u"), (9, 1, "a", "bc", 6, "u"), (2**62, 1, "a", "b" * 100_000, 7, "t"),
    ]
    df_rows = [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows]
    schema = "`my.conv` long, `tu``rn` long, tid string, b string, pos int, conv string"
    turns = P.numbered(spark.createDataFrame(df_rows, schema), "my.conv", "tu`rn", "tid", "b")
    got = P.prefix_trie(turns, turns)
    assert ordered(got.collect()) == plain_trie(plain_order([r[:4] for r in rows]))


def test_turnless_and_empty(spark):
    """Conversations of which nothing is left are members of the root alone."""
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:20]
    rows = [(c, t, "user", "hi") for c in short for t in range(2)]
    got = ordered(tries(spark, rows).collect())
    assert got == plain_trie(plain_rebuilt(plain_order(rows)))
    assert got[0][1] == 0 and got[0][3] == 20 and len(got) == 1
    assert tries(spark, []).count() == 0


def test_digest_of_a_continued_piece():
    rnd = random.Random(4)
    ids = [rnd.randbytes(16) for _ in range(50)]

    def digest(part):
        tree, sizes = RadixTree(), dict.fromkeys(part, 1)
        tree.put(b"".join(part), (1, 0, True))
        return list(P.prefixes(tree, sizes, 0, None))[-1][4:7]

    for cut in (1, 16, 49):
        assert P.continued(*digest(ids[cut:]), *digest(ids[:cut])) == digest(ids)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_radix_tree(seed):
    rnd = random.Random(seed)
    alphabet = [2, 3, 40, 256][seed]
    keys = [bytes(rnd.randrange(alphabet) for _ in range(rnd.randint(0, 6))) for _ in range(3000)]
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.put(key, i)
    found, path = {}, []
    for node, above, part in tree.walk():
        path.append((path[above] if above >= 0 else b"") + part)
        for i in node.held:
            found[i] = path[-1]
        kids = list(node.layout.items())
        assert len(kids) != 1 or node.held or node is tree.root  # paths are compressed
        kind, least = {Listed: (16, 0), Indexed: (48, 17), Full: (256, 49)}[type(node.layout)]
        assert least <= len(kids) <= kind
    assert found == dict(enumerate(keys))


def test_common():
    for a, b, n in [(b"", b"x", 0), (b"abc", b"abd", 2), (b"abc", b"abc", 3), (b"ab", b"abc", 2), (b"x" * 1000 + b"a", b"x" * 1000 + b"b", 1000)]:
        assert common(a, b) == n
