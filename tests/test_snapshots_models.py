"""Partitioned snapshots, saved models, attribution over all rows, days in lieu."""

import datetime as dt
import os
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens.functions import holidays as hol
from churnlens.operators import explain, ml
from churnlens.sources.snapshots import SnapshotTable
from churnlens.sources.stage import new_path

DAYS = [dt.date(2001, m, 1) for m in (5, 6, 7)]


def files(path, day):
    folder = f"{path}/SNAPSHOT={day}"
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in sorted(os.listdir(folder)) if f.endswith(".parquet")}


def test_snapshots_are_written_once(spark):
    built = []

    def build(days):
        built.append(list(days))
        return spark.createDataFrame([(d, i, i * 0.5) for d in days for i in range(20)], "SNAPSHOT date, id int, x double")

    table = SnapshotTable(spark, new_path(spark, "snapshots"))
    schema = build(DAYS[:1]).schema
    assert table.committed() == [] and table.read(schema).count() == 0
    built.clear()
    assert table.write_missing(DAYS[:2], build) == DAYS[:2]
    before = [files(table.path, d) for d in DAYS[:2]]
    assert table.write_missing(DAYS, build) == DAYS[2:]  # one more anchor: one more partition
    assert [files(table.path, d) for d in DAYS[:2]] == before
    assert table.write_missing(DAYS, build) == [] and built == [DAYS[:2], DAYS[2:]]
    table.write(build(DAYS[1:2]), DAYS[1:2])  # rewritten on purpose: that partition only
    assert files(table.path, DAYS[0]) == before[0] and files(table.path, DAYS[1]) != before[1]
    got = table.read(schema)
    assert got.schema.names == schema.names and got.count() == 60
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, build(DAYS).collect()))
    one = table.read(schema, [DAYS[2]])
    assert one.count() == 20 and "PartitionFilters: [isnotnull(SNAPSHOT" in one._jdf.queryExecution().toString()


def test_uncommitted_snapshot_is_written_again(spark):
    """A partition without its note was cut off: it is not read, and is replaced."""
    table = SnapshotTable(spark, new_path(spark, "snapshots"))
    rows = lambda d, n: spark.createDataFrame([(d, i) for i in range(n)], "SNAPSHOT date, id int")
    table.write(rows(DAYS[0], 3), DAYS[:1])
    rows(DAYS[1], 2).write.mode("append").partitionBy("SNAPSHOT").parquet(table.path)
    assert table.read(rows(DAYS[0], 1).schema).count() == 3
    assert table.write_missing(DAYS[:2], lambda days: rows(days[0], 5)) == [DAYS[1]]
    assert table.read(rows(DAYS[0], 1).schema).groupBy("SNAPSHOT").count().orderBy("SNAPSHOT").collect() == [(DAYS[0], 3), (DAYS[1], 5)]


@pytest.fixture(scope="module")
def training(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        x, y = rnd.random(), rnd.random()
        rows.append((f"c{i % 60}", dt.date(2000, 1 + i % 12, 1), x, y, *[(h + x) * 2 + (y > 0.5) for h in range(6)]))
    targets = ", ".join(f"CCH_shift_{h} double" for h in range(1, 7))
    return spark.createDataFrame(rows, f"CUSTOMER_SHIPTO string, POSTING_DATE date, x double, y double, {targets}").cache()


def test_saved_models(spark, training):
    """Loaded regressors predict what the fitted ones do; early stopping ends the boosting."""
    names, as_of = ["x", "y"], dt.date(2001, 8, 1)
    models = ml.horizon_models(training, names)
    path = new_path(spark, "models")
    saved = ml.save_models(spark, models, path, as_of, ml.horizon_mse(models, training, names), names).orderBy("horizon").collect()
    assert [r.horizon for r in saved] == list(range(1, 7)) and all(r.variables == names and r.n == 300 and r.mse < 1 for r in saved)
    assert all(0 < r.rounds < 200 for r in saved)  # the limit is 2500
    loaded = ml.load_models(spark, path, as_of, names)
    scores = [sorted(tuple(r) for r in ml.predict_horizons(m, training, names).select("CUSTOMER_SHIPTO", "x", *[f"pred{h}" for h in range(1, 7)]).collect()) for m in (models, loaded)]
    assert scores[0] == scores[1]
    with pytest.raises(ValueError):
        ml.load_models(spark, path, as_of, ["y", "x"])


def test_attribution_against_loop(spark):
    """Every row, one feature at its mean at a time, scored by itself."""
    rnd = random.Random(3)
    rows = []
    for i in range(150):
        v = [rnd.choice([0.0, 1.0, 2.5, None]) for _ in range(5)]
        rows.append((dt.date(2001, 5, 1), f"c{i}", int((v[0] or 0) > 1), *v))
    names = list("abcde")
    snap = spark.createDataFrame(rows, "SNAPSHOT date, CUSTOMER_NUMBER string, purchase int, " + ", ".join(f"{n} double" for n in names))
    model, _ = ml.forest_importance(snap, names, num_trees=5)
    forest, score = ml.assembled(model, names), vector_to_array("probability")[1]
    got = {r.variable: r for r in explain.feature_attribution(forest, snap, names, score, block=2).collect()}
    plain = [[x or 0.0 for x in r[3:]] for r in rows]
    means = [sum(c) / len(c) for c in zip(*plain)]
    variants = [[*v[:j], means[j], *v[j + 1 :]] if j < 5 else v for v in plain for j in range(6)]
    frame = spark.createDataFrame([(i, *v) for i, v in enumerate(variants)], "i int, " + ", ".join(f"{n} double" for n in names))
    p = [r.p for r in forest.transform(frame).select("i", score.alias("p")).orderBy("i").collect()]
    for j, n in enumerate(names):
        gains = [p[6 * r + 5] - p[6 * r + j] for r in range(150)]
        assert abs(got[n].mean_abs_contribution - sum(map(abs, gains)) / 150) < 1e-9
        assert abs(got[n].mean_contribution - sum(gains) / 150) < 1e-9 and got[n].n == 150
    assert max(got.values(), key=lambda r: r.mean_abs_contribution).variable == "a"


def test_days_in_lieu(spark):
    """One after another by hand, on the calendar and on crowded weekends."""

    def plain(dates):
        taken, out = set(dates), []
        last = dt.date(1900, 1, 1)
        for d in sorted(x for x in set(dates) if x.weekday() >= 5):
            o = max(d, last) + dt.timedelta(1)
            while o.weekday() >= 5 or o in taken:
                o += dt.timedelta(1)
            last = o
            out.append(o)
        return sorted(out)

    rnd = random.Random(1)
    rules = [r.date for r in hol.holiday_calendar(spark.createDataFrame([(y,) for y in range(1999, 2012)], "year int")).collect()]
    for dates in (rules, [dt.date(2004, 12, 20) + dt.timedelta(rnd.randrange(40)) for _ in range(25)], [dt.date(2005, 1, 1), dt.date(2005, 1, 1)], []):
        table = spark.createDataFrame([(d, f"h{i}") for i, d in enumerate(dates)], "date date, holiday string")
        got = hol.with_days_in_lieu(table).where(F.col("holiday").endswith("(in lieu)"))
        assert sorted(r.date for r in got.collect()) == plain(dates)
    assert dt.date(2004, 12, 27) in plain(rules) and dt.date(2004, 12, 28) in plain(rules)  # Christmas and Boxing Day at a weekend
