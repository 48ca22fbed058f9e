"""Raking against a plain version; marginals, draws and edge cases."""

from pyspark.sql import functions as F

import corpus_pipeline
from churnlens.llm.mixing import MOST_SWEEPS, SWEEPS, TOLERANCE, bounded_cells, mixed, n_tokens, sample, shares
from churnlens.llm.queries import MIX, topic_of
from churnlens.sources.tables import read_table

from .plain import bounded_mix, mix

SF = "/root/testdata/sf0.01"


def test_against_plain(spark):
    docs = read_table(spark, SF, "documents")
    want = mix([(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()], sweeps=SWEEPS, **MIX)
    got = mixed(docs, topic_of(), **MIX).collect()
    assert len(got) == len(want)
    for r in got:
        f, p, sampled = want[r.id]
        assert abs(r.factor - f) < 1e-9 and abs(r.p - p) < 1e-9 and r.sampled == sampled
        assert abs(r.weight * r.p - r.factor) < 1e-9


def test_marginals(spark):
    """Raked totals: topics exactly, languages nearly; the weighted sample is close."""
    rows = mixed(read_table(spark, SF, "documents"), topic_of(), **MIX)
    total = rows.agg(F.sum("n_tokens")).first()[0]
    topics = {r.topic: r.w / total for r in rows.groupBy("topic").agg(F.sum(F.col("n_tokens") * F.col("factor")).alias("w")).collect()}
    goals = MIX["wanted"]["topic"]
    assert all(abs(topics[t] - goals[t] / sum(goals[x] for x in topics)) < 1e-9 for t in topics)
    langs = {r.lang: (r.w / total, r.s / total) for r in rows.groupBy("lang").agg(
        F.sum(F.col("n_tokens") * F.col("factor")).alias("w"),
        F.sum(F.when(F.col("sampled"), F.col("n_tokens") * F.col("weight")).otherwise(0)).alias("s")).collect()}
    assert all(abs(w - MIX["wanted"]["lang"][x]) < 0.01 and abs(s - w) < 0.08 for x, (w, s) in langs.items())


def test_edges(spark):
    rows = [(1, "a b", "s", "en", 1), (1, "a b", "s", "en", 1), (2, None, None, None, 2), (None, "", "null", "null", 3), (3, "x " * 50_000, None, "en", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic int")
    got = mixed(df, topic_of(), rate=1.0).collect()
    assert len(got) == 5
    assert {(r.id, r.source, r.lang, r.n_tokens) for r in got} == {(1, "s", "en", 2), (2, None, None, 0), (None, "null", "null", 0), (3, None, "en", 50_000)}
    assert all(abs(r.factor - 1) < 1e-9 for r in got)  # no wish: shares stay
    kept = sample(df, topic_of(), rate=1.0)
    assert kept.columns == df.columns and kept.count() == 5
    assert mixed(df.limit(0), topic_of(), rate=1.0).count() == 0
    assert sample(df.limit(0), topic_of(), rate=1.0).count() == 0


def test_no_python_in_plans(spark):
    plan = mixed(read_table(spark, SF, "documents"), topic_of(), **MIX)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def tuples(docs):
    return [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]


def test_bounded_against_plain(spark):
    """Cells that run out, with and without repeats."""
    docs = read_table(spark, SF, "documents")
    for more in ({"max_repeats": 1}, {"max_repeats": 3, "rate": 1.2}):
        args = {**MIX, **more}
        want, report = bounded_mix(tuples(docs), tolerance=TOLERANCE, sweeps=MOST_SWEEPS, **args)
        drawn = sample(docs, topic_of(), **args)
        assert drawn.columns == docs.columns
        counts = {r.doc_id: r["count"] for r in drawn.groupBy("doc_id").count().collect()}
        assert counts == {i: n for i, n in want.items() if n} and max(counts.values()) <= args["max_repeats"]
        targets = {k: v for k, v in args.items() if k != "seed"}
        for r in shares(bounded_cells(docs, topic_of(), **targets)).collect():
            goal, reachable, raked = report[r.margin, r.value[1:]]
            assert abs(r.goal - goal) < 1e-9 and abs(r.reachable - reachable) < 1e-9 and abs(r.raked - raked) < 1e-9


def test_reachable_goals(spark):
    """A topic with a hundredth of the tokens can't have a third of them without repeats."""
    rows = [(i, "a b c", "s", "en") for i in range(300)] + [(300 + i, "a | b", "s", "en") for i in range(3)] + [(400 + i, "x !! y", "s", "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    wanted = {"topic": {"prose": 0.4, "table": 0.3, "shout": 0.3}}
    got = {r.value: (r.goal, r.reachable, r.raked) for r in shares(bounded_cells(docs, topic_of(), 0.5, wanted=wanted)).collect() if r.margin == "topic"}
    mass = 403 * 3
    assert abs(got["=table"][1] - 3 * 3 * 2 / mass) < 1e-9  # all it has
    rest = 1 - got["=table"][1]
    assert abs(got["=prose"][1] - rest * 4 / 7) < 1e-9 and abs(got["=shout"][1] - rest * 3 / 7) < 1e-9
    assert all(abs(reach - raked) < 0.002 for _, reach, raked in got.values())
    drawn = [r.doc_id for r in sample(docs, topic_of(), 0.5, wanted=wanted).collect()]
    assert len(drawn) == len(set(drawn)) and {300, 301, 302} <= set(drawn)


def test_drawn_shares(spark):
    """The pipeline's stage on what near-duplicate removal leaves: no document twice, and
    the rows drawn, unweighted, have the reachable shares but for the chance of the draw."""
    small = "/root/testdata/sf0.001"
    docs = read_table(spark, small, "documents")
    for name in ("quality", "exact_dedup", "near_dedup"):
        docs = dict(corpus_pipeline.STAGES)[name](spark, docs, small).checkpoint()
    args = corpus_pipeline.MIX
    drawn = corpus_pipeline.mix(spark, docs, small).select("doc_id", "source", "lang", topic_of().alias("topic"), n_tokens("text").alias("n")).cache()
    assert drawn.count() == drawn.select("doc_id").distinct().count() > 0
    want, report = bounded_mix(tuples(docs), tolerance=TOLERANCE, sweeps=MOST_SWEEPS, **args)
    assert {r.doc_id for r in drawn.collect()} == {i for i, n in want.items() if n}
    mass = docs.agg(F.sum(n_tokens("text"))).first()[0]
    for by in ("source", "lang", "topic"):
        got = {r[0]: r.n for r in drawn.groupBy(by).agg(F.sum("n").alias("n")).collect()}
        square = {r[0]: r.s for r in docs.withColumn("topic", topic_of()).groupBy(by).agg(F.sum(n_tokens("text") ** 2).alias("s")).collect()}
        for (margin, value), (_, _, raked) in report.items():
            if margin == by:  # half the root of the sum of squares is the greatest deviation of such a draw
                assert abs(got.get(value, 0) - args["rate"] * raked * mass) <= 4 * 0.5 * square[value] ** 0.5


def test_a_sweep_is_one_job_and_nothing_is_broadcast(spark, monkeypatch):
    """The raking's plans stay small: the driver holds each of them."""
    from churnlens.llm import mixing

    plans = []
    write = mixing.staged
    monkeypatch.setattr(mixing, "staged", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or write(df, name))
    docs = read_table(spark, SF, "documents")
    asked = []
    monkeypatch.setattr(type(docs), "first", lambda self: asked.append(self))
    cells = bounded_cells(docs, topic_of(), 0.5, wanted={"topic": {"prose": 0.88, "license": 0.1, "table": 0.01, "symbols": 0.005, "shout": 0.005}})
    assert cells.count() > 0 and not asked
    raked = [p for name, p in plans if name == "bounded"]
    assert len(raked) > 1 and all("Broadcast" not in p for p in raked)
