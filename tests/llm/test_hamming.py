"""Exact top-k against all pairs; the radius that proves it; edge cases."""

import random

import numpy as np

from churnlens.llm import hamming as H
from churnlens.llm.hamming import top_k


def brute(rows, k, is_query):
    """{(id, code): [(distance, id)]} over distinct (id, code) rows."""
    rows = sorted(set(rows))
    return {(i, c): sorted(((c ^ d).bit_count(), j) for j, d in rows if (j, d) != (i, c))[:k] for i, c in rows if is_query(i)}


def vector(code):
    return [1.0 if code >> j & 1 else -1.0 for j in range(64)]


def found(spark, rows, k):
    df = spark.createDataFrame([(i, vector(c)) for i, c in rows], "vec_id long, embedding array<float>")
    out = {}
    for r in top_k(df, H.F.col("id") % 20 == 0, k).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.distance, r.id))
    return {q: [(d, i) for _, d, i in sorted(v)] for q, v in out.items()}


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(H, "ENTRY_BLOCK", 100)
    rnd = random.Random(2)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    rows = [(i, rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6)))) for i in range(300)]
    rows += [(300 + i, rnd.getrandbits(64)) for i in range(100)]
    rows += [(400 + i, centres[0]) for i in range(150)]  # one code on a fourth of the rows
    rows += rows[:40]  # repeated rows
    want = {i: v for (i, _), v in brute(rows, 10, lambda i: i % 20 == 0).items()}
    assert found(spark, rows, 10) == want


def test_index_covers_what_it_says():
    rnd = np.random.default_rng(4)
    for n in (1, 7, 300, 5000):
        codes = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        members = rnd.integers(1, 4, len(codes))
        index = H.MultiIndex(codes, members)
        assert index.cuts[0] == 0 and index.cuts[-1] == 64
        for q in [codes[0], np.uint64(2**64 - 1), np.uint64(0)]:
            for k in (1, 5, 10**6):
                at, d = index.nearest(q, k)
                assert len(set(at.tolist())) == len(at)
                every = np.bitwise_count(codes ^ q)
                assert (d == every[at]).all()
                if members[at].sum() < k:  # all of them
                    assert len(at) == len(codes)
                assert len(at) == (every <= d.max()).sum()  # no code as near is missing


def test_few_rows_nulls_and_clashing_names(spark):
    rows = [(20, [1.0, -1.0], 1), (21, [1.0, 1.0], 2), (20, [1.0, -1.0], 3), (20, [-1.0, -1.0], 4), (None, [1.0], 5), (22, None, 6), (40, [], 7), (60, [None, 1.0], 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code int")
    got = sorted((r.query_id, r.rank, r.id, r.distance) for r in top_k(df, H.F.col("id") % 20 == 0, 3).collect())
    assert got == sorted([
        (20, 1, 20, 1), (20, 2, 21, 1), (20, 3, 60, 2),  # of the row with code 1
        (20, 1, 20, 1), (20, 2, 60, 1), (20, 3, 21, 2),  # of the row with code 0
        (60, 1, 20, 1), (60, 2, 21, 1), (60, 3, 20, 2)])
    assert top_k(df.limit(0), H.F.col("id") % 20 == 0, 3).count() == 0


def test_folding(spark):
    """Beyond 64 dimensions, elements 64 apart add up."""
    wide = [0.5] * 64 + [-1.0] + [0.0] * 63
    df = spark.createDataFrame([(1, wide)], "vec_id long, embedding array<float>")
    code = H.sign_codes(df, "vec_id", "embedding").first().code
    assert code % 2**64 == 2**64 - 2
