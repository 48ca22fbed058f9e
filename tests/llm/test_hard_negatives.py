"""Hard negatives against all pairs; the tree's parts; edge cases."""

import math
import random

import numpy as np
import pytest

from churnlens.llm import hard_negatives as H


def brute(rows, is_anchor, n_pos=5, n_neg=5, low=80, high=100):
    """Sorted result rows over (id, label, vector) rows."""
    whole = []
    for i, label, vec in rows:
        if i is not None and label is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            whole.append((i, label, [math.floor(256 * np.float64(np.float32(x))) for x in vec]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, label, v) in enumerate(whole):
        if not is_anchor(i):
            continue
        scored = [(-dot(v, w), j, lab, m) for m, (j, lab, w) in enumerate(whole)]
        for s, p, _, _ in sorted(x for x in scored if x[2] == label and x[3] != n)[:n_pos]:
            s = -s
            negatives = sorted((x, j) for x, j, lab, _ in scored if lab != label and low * s <= -100 * x <= high * s)[:n_neg]
            out += [(i, p, r + 1, j, s, -x) for r, (x, j) in enumerate(negatives)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = H.mine(df, H.F.col("id") % 10 == 0, **kw)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted(map(tuple, got.collect()))


def sample(n, dims, seed, labels=4):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        label = int(rnd.integers(labels))
        v = 0.4 * centres[label] + rnd.normal(size=dims) * 0.5
        rows.append((i, label, [float(x) for x in (v / np.linalg.norm(v)).astype(np.float32)]))
    return rows


def test_against_all_pairs(spark, monkeypatch):
    """Several units, several pages each, a vector on a third of the rows, repeated rows."""
    monkeypatch.setattr(H, "UNIT_ROWS", 60)
    monkeypatch.setattr(H, "PAGE", 8)
    rows = sample(240, 6, 1)
    rows += [(240 + i, 1, rows[3][2]) for i in range(60)] + [(300 + i, i % 4, rows[3][2]) for i in range(60)]
    rows += rows[:25]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, n_positives=2, n_negatives=9, low=50, high=90) == brute(rows, lambda i: i % 10 == 0, 2, 9, 50, 90)


def test_two_dimensions_and_ties(spark, monkeypatch):
    """Small integers: nearly all scores tie."""
    monkeypatch.setattr(H, "UNIT_ROWS", 40)
    monkeypatch.setattr(H, "PAGE", 4)
    rnd = random.Random(7)
    rows = [(i, rnd.randrange(3), [rnd.randint(-2, 3) / 256, rnd.randint(-2, 3) / 256]) for i in range(200)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_nulls_lengths_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0]), (2, 1, [1.0, 0.5, 0.0]), (3, 2, [0.9]), (4, 2, []), (5, None, [1.0]), (6, 2, None), (7, 2, [None, 1.0]),
        (8, 2, [nan, 1.0]), (9, 2, [inf]), (None, 2, [1.0]), (10, 3, []), (11, 3, [0.0, 0.0]), (20, 4, [1.0]), (-10, 1, [-1.0, -2.0]), (0, 1, [1.0, 0.5]),
    ]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert {r[0] for r in got} == {0, 10}  # 20 has no positive, -10 no negative in a window
    assert mined(spark, rows[:1]) == []
    assert mined(spark, []) == []


def test_large_components(spark):
    """Sums beyond 2**53 are exact; beyond 2**26 components are cut."""
    rows = [(0, 1, [200_000.5, 3.0]), (1, 1, [200_001.0, 3.0]), (2, 2, [199_999.0, 3.0]), (3, 2, [200_000.0, 2.0])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    got = mined(spark, [(0, 1, [1e30]), (1, 1, [1e30]), (2, 2, [1e30])])
    assert got == [(0, 1, 1, 2, 2**52, 2**52)]


def test_clashing_names(spark):
    rows = [(i, lab, v, 1, "x", 2) for i, lab, v in sample(40, 3, 5)]
    df = spark.createDataFrame(rows, "`my.id` long, `l``b` int, vec array<float>, id int, code string, label long")
    got = H.mine(df, H.F.col("id") % 10 == 0, id_col="my.id", label_col="l`b", vec_col="vec")
    assert sorted(map(tuple, got.collect())) == brute([r[:3] for r in rows], lambda i: i % 10 == 0)


@pytest.mark.parametrize("n, dims", [(1, 3), (700, 1), (700, 2), (700, 20)])
def test_tree(n, dims):
    """Pages hold every row once and are full but for slabs' ends; boxes bound all scores."""
    rnd = np.random.default_rng(n + dims)
    x = rnd.integers(-300, 300, (n, dims))
    pages = list(H.str_pages(x, 16))
    assert sorted(np.concatenate(pages).tolist()) == list(range(n))
    assert max(map(len, pages)) <= 16 and len(pages) <= 2 * -(-n // 16)
    q = rnd.integers(-300, 300, (9, dims))
    for rows in pages:
        least, most = H.intervals(q, x[rows].min(axis=0)[None], x[rows].max(axis=0)[None])
        scores = q @ x[rows].T
        assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    dims_, cuts = H.str_cuts(x, 3)
    blocks = H.block_of(x, dims_, cuts)
    assert n < 100 or np.bincount(blocks)[8:].max() < n / 4


def test_queue_prunes(monkeypatch):
    """Near clusters are found without opening the pages of far ones."""
    monkeypatch.setattr(H, "PAGE", 32)
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-200, 200, (40, 8))
    x = np.concatenate([c + rnd.integers(-3, 4, (50, 8)) for c in centres])
    entries = H.pa.table({"code": [H._raw(v) for v in x], "label": [0] * len(x), "ids": [[i] for i in range(len(x))]})
    tree = H.RTree(H._pack((H.pa.scalar(0),), entries), 8)
    q = centres[5][None]
    one = H.Query(tree, q[0], *(b[0] for b in H.intervals(q, tree.lo, tree.hi)))
    want = sorted((-int(s), i) for i, s in enumerate(x @ q[0]))
    assert one.best([tree.roots[0]], 5, None, None) == want[:5]
    top = -want[300][0]
    inside = [w for w in want if 0.8 * top <= -w[0] <= top][:5]
    assert one.best([tree.roots[0]], 5, *H.window(top, 80, 100)) == inside
    assert len(one.opened) < len(tree.codes)
