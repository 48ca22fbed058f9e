"""The snapshot's inputs are read once, and its hash tables stay small as the items grow."""

import datetime as dt

import pytest
from churnlens.operators import nba
from churnlens.plans import queries as q
from churnlens.sources import fixtures as fx

from conftest import SF_SMALL

ANCHORS = [dt.date(2001, 8, 1), dt.date(2001, 7, 1)]


def test_near_items_are_all_that_the_windows_need(spark):
    items = fx.delivery_items(spark, SF_SMALL)
    near = nba.near_items(items, ANCHORS)
    want = items.where("ERDAT >= DATE'2000-01-01' AND ERDAT < DATE'2001-08-01'")
    assert near.count() == want.count() > 0
    assert near.exceptAll(want).count() == 0
    for f in (nba.items_profile, nba.new_items):
        a, b = f(near, ANCHORS), f(items, ANCHORS)
        assert a.count() > 0 and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.mark.parametrize("rows", [7, 50])
def test_parts_follow_the_items(spark, monkeypatch, rows):
    monkeypatch.setattr(nba, "ROWS_PER_TASK", rows)
    near = nba.near_items(fx.delivery_items(spark, SF_SMALL), ANCHORS)
    in_window = near.where("ERDAT < DATE'2001-02-01'").count()
    plan = nba.items_profile(near, ANCHORS)._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-in_window // rows)}), REPARTITION_BY_NUM" in plan
    assert "Broadcast" not in plan


def test_snapshot_without_broadcasts(spark):
    plan = q.snapshot_frame(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "lineitem" not in plan and "orders" not in plan
