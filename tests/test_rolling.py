"""The activity window from daily partials equals the window counted anew, day after day."""

import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from buyerlens.operators import activity as act
from buyerlens.operators import rolling as roll
from buyerlens.params import FIXTURE_PARAMS as P
from buyerlens.plans.catalog import inputs
from conftest import SF_SMALL
from frames import make_inputs


def rows(df):
    return sorted(map(repr, df.select("merchant_num", "member_id", "join_num_90", "interactive_num").collect()))


def test_three_days_equal_the_whole_window(spark):
    log = inputs(spark, SF_SMALL).activity
    path = tempfile.mkdtemp(prefix="daily-") + "/state"
    made = []
    for day in ("2024-01-28", "2024-01-29", "2024-01-30"):
        p = replace(P, as_of=day)
        # The log as it stands on that day.
        made.append(roll.advance(log.where(F.substring("created_at", 1, 10) <= day), path, p))
        assert rows(roll.recent_interaction(spark, path, p)) == rows(act.recent_interaction(log, p))
    assert [len(m) for m in made] == [10, 1, 1]  # a run adds one day


def test_late_rows_empty_days_and_null_keys(spark):
    day = lambda d, n, member=1, ok=1: [("1", member, 1, ok, f"2024-01-{d:02d} 10:00:{i:02d}") for i in range(n)]
    first = day(20, 3) + day(30, 2, None) + day(21, 1, 2, 0) + [(None, 4, 1, 1, "2024-01-29 00:00:00"), ("1", 5, 1, 1, None)]
    late = first + day(30, 4) + day(29, 2, 3)
    path = tempfile.mkdtemp(prefix="daily-") + "/state"
    p = replace(P, as_of="2024-01-30", activity_days=10)
    logs = [make_inputs(spark, activity=x).activity for x in (first, late)]
    assert len(roll.advance(logs[0], path, p)) == 10
    assert rows(roll.recent_interaction(spark, path, p)) == rows(act.recent_interaction(logs[0], p))
    assert roll.advance(logs[1], path, p, late_days=2) == ["2024-01-29", "2024-01-30"]
    assert rows(roll.recent_interaction(spark, path, p)) == rows(act.recent_interaction(logs[1], p))
    with pytest.raises(ValueError, match="2024-01-31"):
        roll.recent_interaction(spark, path, replace(p, as_of="2024-01-31"))
    assert roll.advance(logs[1].limit(0), path, replace(p, as_of="2024-01-31")) == ["2024-01-31"]
    assert "day=2024-01-31" in os.listdir(path)


def test_a_window_reads_its_days_alone(spark):
    path = tempfile.mkdtemp(prefix="daily-") + "/state"
    log = make_inputs(spark, activity=[("1", i, 1, 1, f"2024-01-{i:02d} 00:00:00") for i in range(1, 31)]).activity
    for day in ("2024-01-15", "2024-01-30"):
        roll.advance(log, path, replace(P, as_of=day))
    out = roll.recent_interaction(spark, path, P)
    assert out.count() == 10 and "PartitionFilters: [day" in out._jdf.queryExecution().executedPlan().toString()
