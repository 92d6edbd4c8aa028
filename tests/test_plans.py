"""Physical-plan properties of the registered queries (what .explain shows)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_window_counts_prune_columns_and_shuffle_once(spark):
    df = E.queries()["window_counts_union"](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


def test_dedup_aggregates_partially_before_shuffle(spark):
    plan = _plan(E.queries()["dedup_events"](spark, SF001))
    assert "partial_min" in plan


def test_replay_lists_only_its_days(spark):
    df = E.queries()["replay_range"](spark, SF001)
    days = {part for f in df.inputFiles() for part in f.split("/") if part.startswith("dt=")}
    assert days == {f"dt=2024-01-{d:02d}" for d in range(8, 15)}
    scan = _plan(df).split("FileScan parquet")[1]
    assert "comment" not in scan.split("ReadSchema")[1].split("\n")[0]
