"""Event ranking is dealt to a given number of tasks, not to as few as compressed bytes suggest."""

from conftest import SF

from runlake.operators import events
from runlake.plans import catalog


def test_ranking_keeps_its_tasks_whatever_adaptive_execution_sees(spark):
    v = catalog.Views(spark, SF)
    rows = events.number_in_order(events.event_rows(v.runs, v.logs))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(run_id" in plan and plan.count("REPARTITION_BY_NUM") >= 2
    assert f", {events.TASKS}), REPARTITION_BY_NUM" in plan
