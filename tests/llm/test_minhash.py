"""Near-duplicate groups against all pairs, on the small table and on edge cases."""

import random

import pytest

from churnlens.llm import minhash, shingles
from churnlens.llm.minhash import keep_one, near_duplicates
from churnlens.sources.tables import read_table

from .plain import near_groups

SF = "/root/testdata/sf0.001"


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}
    assert got == near_groups(rows)


def test_small_table(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    check(spark, rows)


def test_groups_chains_and_shared_passages(spark, monkeypatch):
    """Large buckets of texts that share a passage but are no copies take the prefix
    path; chains need several contractions."""
    monkeypatch.setattr(minhash, "SMALL", 3)
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows, passage = [], [word() for _ in range(60)]
    for i in range(60):  # J about 0.5 between any two, some of them nearly equal
        own = [word() for _ in range(rnd.randint(8, 45))]
        rows.append(own + passage)
        if i % 6 == 0:
            rows.append([*own[:-1], word(), *passage])
    chain = [word() for _ in range(80)]
    for _ in range(12):
        chain = chain[4:] + [word() for _ in range(4)]
        rows.append(list(chain))
    base = [word() for _ in range(50)]
    for _ in range(30):
        copy = list(base)
        copy[rnd.randrange(50)] = word()
        rows.append(copy)
    rnd.shuffle(rows)
    check(spark, [(i, " ".join(r)) for i, r in enumerate(rows)])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "é É"), (8, "a b"),
            (9, "x\x0by z 1 2 3"), (10, "X y\x0cZ 1 2 3"), (11, "long " * 20000)]
    check(spark, rows)
    empty = near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0


def test_repeated_null_and_clashing(spark):
    rows = [(None, "p q r s t u", 1), (5, "p q r s t u", 2), (5, "p q r s t u", 2), (5, "other words", 3), (4, "other words", 4), (None, "", 5), (None, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, v int").withColumnRenamed("v", "kept")
    got = sorted((r.id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_duplicates(df).collect())
    assert got == sorted([(0, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (5, 1, 4, False), (4, 1, 4, True), (0, 0, 0, True), (0, 0, 0, True)])
    kept = keep_one(df)
    assert kept.columns == ["doc_id", "text", "kept"]
    assert sorted(r.kept for r in kept.collect()) == [2, 4, 5, 6]


@pytest.mark.parametrize("rows", [2, 4])
def test_signatures_estimate_similarity(rows):
    rnd = random.Random(1)
    a = [" ".join(str(rnd.randrange(10**6)) for _ in range(400))]
    words = a[0].split()
    words[::40] = ["new"] * 10
    sets = shingles.shingle_sets([a[0], " ".join(words)])
    sig = shingles.signatures(sets, 512)
    true = len(set(sets[0].tolist()) & set(sets[1].tolist())) / len(set(sets[0].tolist()) | set(sets[1].tolist()))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.08
    assert shingles.band_keys(sig, rows).shape == (2, 512 // rows)


def test_rounds_follow_the_logarithm_of_a_bucket(spark, monkeypatch):
    """121 texts, any two alike in one of five places at most (similarity 0.58 or less): their
    buckets hold eleven near misses each, which one pivot a round would take ten rounds for."""
    q, common = 11, [f"w{i}" for i in range(75)]
    rows = []
    for x in range(q):
        for y in range(q):
            words = list(common)
            for slot, value in enumerate((x, y, x + y, x + 2 * y, x + 3 * y)):
                words.insert(16 * slot + 5, f"s{slot}v{value % q}")
            rows.append((len(rows), " ".join(words)))
    rounds = []
    run = minhash._Rounds.run
    monkeypatch.setattr(minhash._Rounds, "run", lambda self, small: rounds.append(small) or run(self, small))
    monkeypatch.setattr(minhash, "SMALL", 1)
    check(spark, rows)
    assert 2 < len(rounds) <= 5


def test_words_of_any_length_and_white_space():
    texts = [None, " a\x1cb\tc\x0bd\x0ce\rf\ng ", "x" * 64 + " " + "x" * 65 + " abcdefgh abcdefghi", "É é \xa0 1 2 3", ""]
    data = "\n".join(t or "" for t in texts).encode().lower()
    starts, hashes = shingles.word_hashes(data)
    words = data.split()
    assert [data[a:].split()[0] for a in starts.tolist()] == words
    assert len(set(hashes.tolist())) == len(set(words))
    sets = shingles.shingle_sets(texts)
    assert [len(s) for s in sets] == [0, 2, 1, 2, 0]
    assert [shingles.digest(s) for s in sets] == [shingles.digest(shingles.shingle_sets([t])[0]) for t in texts]
