"""Exact dedup against a dictionary; batches against a persistent index."""

import hashlib

import pytest
from pyspark.sql import functions as F

from churnlens.llm.digest_index import DigestIndex
from churnlens.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), sha(t)))
    return out


def test_report(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    rows += [(10**6, rows[0][1]), (None, rows[0][1]), (None, None), (10**6 + 1, ""), (10**6 + 2, "Ä"), (10**6 + 3, "ä"), (None, "alone"), (10**6 + 2, "Ä")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("zzz", "digest")
    got = DigestIndex(spark).report(df).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(plain(rows), key=key)
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted({sha(t) for _, t in rows})  # one row of each text, repeated rows too
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_batches(spark):
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(9, "a"), (10, "c"), (11, "c"), (12, None)], "doc_id long, text string")
    index = DigestIndex(spark, buckets=4)
    assert sorted(r.doc_id for r in index.keep_new(first).collect()) == [2, 3]
    index.drop()
    again = DigestIndex(spark, path=index.path, buckets=4)  # reopened by its path
    assert sorted(r.doc_id for r in again.keep_new(second).collect()) == [11, 12]
    assert sorted((r.id, r.keep_id, r.kept) for r in again.report(second).collect()) == [(9, 2, False), (10, 11, False), (11, 11, False), (12, 12, False)]
    assert again.read().count() == 4


def test_columns_and_repeated_rows(spark):
    rows = [(1, "x", "p", 5), (1, "x", "p", 5), (2, "y", "q", 6), (None, "z", "r", 7), (None, "z", "r", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, _key int")
    kept = DigestIndex(spark).keep_new(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r._key) for r in kept.collect()) == [(0, "z", 7), (1, "x", 5), (2, "y", 6)]
    assert DigestIndex(spark).report(df.limit(0)).count() == 0
    assert DigestIndex(spark).keep_new(df.limit(0)).count() == 0


def test_no_python_in_plans(spark):
    plan = DigestIndex(spark).keep_new(read_table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_crash_and_retry(spark):
    """A batch that runs again keeps what it kept: after its rows were lost, and after a
    part of its append was written without the marker."""
    first = spark.range(2000).selectExpr("id AS doc_id", "concat('t', id div 2) AS text")
    index = DigestIndex(spark, buckets=4)
    want = sorted(range(1, 2000, 2))
    groups = index.groups(first, "doc_id", "text")
    index.append_new(groups, "monday")  # the job is lost before the rows are written
    assert index.batches() == {"monday"}
    assert sorted(r.doc_id for r in index.keep_new(first, batch="monday").collect()) == want
    assert sorted(r.id for r in index.report(first, batch="monday").where("kept").collect()) == want
    assert index.read().count() == 1000
    half = DigestIndex(spark, buckets=4)
    half.append_new(groups.where(F.hash("digest") % 2 == 0), "tuesday")
    half._notes, done = (lambda kind, ddl, old=half._notes: [] if kind == "batches" else old(kind, ddl)), half.read().count()
    assert 0 < done < 1000
    assert sorted(r.doc_id for r in half.keep_new(first, batch="tuesday").collect()) == want
    assert half.read().count() == 1000
    assert half.keep_new(first, batch="wednesday").count() == 0


def test_reopened(spark):
    index = DigestIndex(spark, buckets=8)
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('t', id) AS text")
    assert index.keep_new(docs).count() == 500
    with pytest.raises(ValueError):
        DigestIndex(spark, path=index.path, buckets=32)
    again = DigestIndex(spark, path=index.path)
    assert again.buckets == 8 and again.keep_new(docs).count() == 0


def test_index_is_read_by_bucket(spark):
    """One exchange for the batch's digests in front of the anti-join, none for the index."""
    index = DigestIndex(spark, buckets=8)
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('t', id) AS text")
    index.keep_new(docs)
    found = index.groups(docs, "doc_id", "text").select("digest").distinct().join(index.read().hint("merge"), "digest")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("Bucketed: true")
    assert "Exchange" not in plan[plan.rindex(":- ", 0, scan) + 1 : scan].split("+- ", 1)[0] and "SelectedBucketsCount: 8 out of 8" in plan


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "x" * 3_000_000), (2, "x" * 3_000_000), (3, "x" * 2_999_999)], "doc_id long, text string")
    assert sorted(r.doc_id for r in DigestIndex(spark).keep_new(docs).collect()) == [2, 3]
