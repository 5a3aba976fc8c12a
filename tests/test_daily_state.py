"""Daily marts from merged states against a rebuild."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderlens.plans import daily_state, marts
from orderlens.session import scratch_path
from test_plans import plan

SLA = "order_id string, purchase_date date, delivered_date date, is_delivered boolean, is_late boolean, delivery_days int, days_late int"


def orders(n, seed, first=0):
    rng = random.Random(seed)
    out = []
    for k in range(first, first + n):
        bought = dt.date(2024, 1, 20) + dt.timedelta(days=rng.randrange(20)) if rng.random() > 0.02 else None
        days, late = rng.randrange(1, 30), rng.randrange(-9, 9)
        done = bought is not None and rng.random() < 0.8
        out.append((str(k), bought, bought + dt.timedelta(days=days) if done else None, done, done and late > 0,
                    days if done else None, late if done else None))
    return out


def same(a, b):
    key = lambda t: tuple((x is None, str(x)) for x in t)
    rows = lambda df: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*b.columns).collect()), key=key)
    return rows(a) == rows(b)


def test_corrections_equal_a_rebuild(spark):
    before = orders(2000, 1)
    changed = {r[0]: r for r in orders(60, 2, first=500)}  # other versions of sixty orders
    gone, added = {r[0] for r in before[:30]}, orders(40, 3, first=5000)
    after = [changed.get(r[0], r) for r in before if r[0] not in gone] + added
    frame = lambda rows: spark.createDataFrame(rows, SLA)
    old = frame([r for r in before if r[0] in changed or r[0] in gone])
    new = frame([*changed.values(), *added])
    for day, mart, of_state in (("purchase_date", marts.sla_daily, daily_state.sla_daily),
                                ("delivered_date", marts.sla_delivered_daily, daily_state.sla_delivered_daily)):
        state = daily_state.DailyState(spark, scratch_path(spark, "test-daily"), day)
        assert state.read().count() == 0
        state.rebuild(frame(before))
        assert same(of_state(state.read()), mart(frame(before)))
        state.correct(old, new)
        assert same(of_state(state.read()), mart(frame(after)))
        assert state.correct(frame([]), frame([])) == []
        with pytest.raises(ValueError, match="does not hold"):
            state.correct(frame([("x", dt.date(2030, 1, 1), dt.date(2030, 1, 2), True, False, 1, 0)]), frame([]))
        assert same(of_state(state.read()), mart(frame(after)))


def test_only_the_changed_days_are_read_and_a_day_can_become_empty(spark):
    rows = orders(500, 4)
    frame = lambda x: spark.createDataFrame(x, SLA)
    state = daily_state.DailyState(spark, scratch_path(spark, "test-daily"), "purchase_date")
    state.rebuild(frame(rows))
    day = dt.date(2024, 2, 5)
    files = {f for f in state._stored().inputFiles() if "2024-02" not in f}
    assert state.correct(frame([r for r in rows if r[1] == day]), frame([])) == [day]
    p = plan(state.touched([day]), "formatted")
    assert "PartitionFilters: [" in p and "2024-02" in p.split("PartitionFilters")[1].split("\n")[0]
    assert len(files) == 2 and {f for f in state._stored().inputFiles() if "2024-02" not in f} == files  # others are as they were
    assert state.read().filter(F.col("day") == F.lit(day)).count() == 0
    assert same(daily_state.sla_daily(state.read()), marts.sla_daily(frame([r for r in rows if r[1] != day])))
    february = [r for r in rows if r[1] and r[1].month == 2 and r[1] != day]
    state.correct(frame(february), frame([]))  # a whole month goes
    assert same(daily_state.sla_daily(state.read()), marts.sla_daily(frame([r for r in rows if not r[1] or r[1].month != 2])))
