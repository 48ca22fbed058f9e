"""The model against a plain one, shards against one pass, and the classifier's decisions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import kneser_ney as K
from churnlens.llm.kneser_ney import Lookup, judged, keep_good, score, train
from churnlens.sources.tables import read_table

from .plain import kneser_ney

SF = "/root/testdata/sf0.001"


def test_lookup():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 2**63, 5000, dtype=np.uint64))
    keys = np.concatenate([keys, np.array([0, 2**64 - 1], dtype=np.uint64)])
    table = Lookup(keys, np.arange(len(keys)))
    found, value = table.find(np.concatenate([keys, keys + np.uint64(1)]))
    assert found[: len(keys)].all() and (value[: len(keys)] == np.arange(len(keys))).all()
    assert found[len(keys) :].sum() == np.isin(keys + np.uint64(1), keys).sum()
    assert not Lookup(keys[:0], keys[:0].astype(float)).find(keys)[0].any()


def rows_of(seed):
    rnd = random.Random(seed)
    line = lambda al, n: "".join(rnd.choice(al) for _ in range(n))
    rows = [(i, line("abc d", rnd.randint(1, 80)), "x") for i in range(30)] + [(100 + i, line("äöü🙂 \0", 40), None) for i in range(12)]
    return rows + [(200, "", "x"), (201, None, "x"), (202, "unseen ZZZ 日本", "x"), (203, "no model", "zz"), (0, rows[0][1], "x")]


@pytest.mark.parametrize("shard_rows", [10**6, 60])
def test_model_and_shards(spark, monkeypatch, shard_rows):
    """Log probabilities equal the plain model's, with one shard and with many."""
    monkeypatch.setattr(K, "SHARD_ROWS", shard_rows)
    rows = rows_of(3)
    df = spark.createDataFrame(rows, "doc_id long, t string, l string")
    trusted = df.where("doc_id < 20 OR doc_id BETWEEN 100 AND 108")
    model = train(trusted, "t", "l")
    assert (model.count() > shard_rows) == (shard_rows == 60)
    plain = {lang: kneser_ney([t for i, t, la in rows if la == lang and (i < 20 or 100 <= i <= 108)], K.ORDER) for lang in ("x", None)}
    got = score(df, model, "t", "l", "nll", "n", "w").collect()
    assert len(got) == len(rows)
    for r in got:
        if not r.t or r.l == "zz":
            assert r.nll is None and r.n is None
            continue
        want = plain[r.l](r.t)
        assert r.n == len(want)
        assert math.isclose(r.nll, sum(want), rel_tol=1e-9)


def test_probabilities_add_up_to_one():
    surprise = kneser_ney(["abab c", "bac", "cc a"], 4)
    assert all(s > 0 for s in surprise("abz"))


def test_unevenness(spark):
    df = spark.createDataFrame([(1, "ab " * 200, "x"), (2, "ab " * 100 + "zq" * 150, "x")], "doc_id long, t string, l string")
    model = train(df.where("doc_id = 1"), "t", "l")
    got = {r.doc_id: r.w for r in score(df, model, "t", "l", "nll", "n", "w").collect()}
    assert got[1] < 0.1 < 1 < got[2]


def test_decisions_on_the_table(spark):
    """Held-out labels: nearly all good documents stay (not those with half their text in
    another language), most bad ones go."""
    docs, labels = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "labels")
    hidden = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0  # their labels are not given
    got = judged(docs, labels.where(~hidden)).join(labels.where(hidden).withColumnRenamed("doc_id", "id"), "id").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert len(good) > 100 and len(bad) > 15
    assert sum(good) / len(good) > 0.96
    assert sum(bad) / len(bad) < 0.3


def test_edges(spark):
    docs = spark.createDataFrame([(1, "good text here " * 9, "en", 1), (1, "good text here " * 9, "en", 1), (2, None, "en", 2), (None, "", None, 3)], "doc_id long, text string, lang string, kept int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(r.kept for r in keep_good(docs, none).collect()) == [1, 1, 2, 3]  # nothing trusted: all stay
    labels = spark.createDataFrame([(1, 1, None), (1, None, 0), (2, 1, 1), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r.id for r in K.trusted_ids(labels).collect()] == [1]
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 4
    assert judged(docs.limit(0), labels).count() == 0
