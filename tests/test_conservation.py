"""Totals that must not change on the way from events to reports."""

import pytest
from pyspark.sql import functions as F

from tracelode.operators import gold, silver, usage
from tracelode.sources import testdata as td

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def events(spark):
    return td.canonical(spark, SF_DIR)


def totals(df, *columns):
    return tuple(df.agg(*[F.sum(c) for c in columns]).first())


def test_rows_per_kind(events):
    got = dict(map(tuple, events.groupBy("event_name").count().collect()))
    assert got == {
        "user_prompt": 2006, "assistant_response": 1982, "tool_result": 1981, "tool_decision": 2017, "api_error": 2014,
    }


def test_usage_adds_up_at_every_level(events):
    measures = ("sessions", "prompts", "responses", "tool_events", "input_tokens")
    users = usage.daily_user_usage(events)
    assert totals(users, *measures) == (749, 2006, 1982, 1981 + 2017, 856_841)
    assert totals(gold.daily_org_usage(users), *measures) == totals(users, *measures)


def test_gold_keeps_all_sessions_tools_and_cost(events):
    assert totals(gold.daily_user_metrics(silver.sessions(events)), "total_sessions") == (749,)
    summary = gold.tool_adoption_summary(silver.tool_executions(events, dedupe=False))
    assert totals(summary, "total_executions", "completed_executions", "failed_executions") == (3998, 1981, 428)
    costs = silver.token_costs(events, dedupe=False)
    attributed = gold.department_cost_attribution(costs)
    assert attributed.count() == 445
    assert totals(attributed, "total_cost_units") == totals(costs, "cost_units")
    rollup = gold.department_cost_rollup(costs)
    assert totals(rollup.filter("level = 3"), "total_cost_units") == totals(costs, "cost_units")


def test_sequence_and_prompts_match_the_window_definition(events):
    from pyspark.sql import Window

    w = Window.partitionBy("session_id").orderBy("event_timestamp", "event_id")
    prompts = F.sum((F.col("event_name") == "user_prompt").cast("bigint")).over(w)
    plain = events.select(
        "event_id",
        F.row_number().over(w).cast("bigint").alias("event_sequence"),
        F.when(prompts > 0, F.concat("session_id", F.lit("#"), prompts.cast("string"))).alias("prompt_id"),
    )
    sliced = td.ordered(events).select(plain.columns)
    assert sliced.exceptAll(plain).count() == 0 and plain.exceptAll(sliced).count() == 0


def test_transcript_rows(spark, events):
    log = td.with_text(td.ordered(events), spark, SF_DIR)
    lines = usage.transcript_lines(silver.prompts(log, dedupe=False), silver.responses(log, dedupe=False))
    assert lines.count() == 2507
    assert lines.filter("response_sequence IS NULL").count() == 1202


@pytest.mark.parametrize("reported", [False, True])
def test_one_cost_everywhere(spark, events, reported):
    """Department cost, daily usage and the scorecard show the same spend, with and without reported cost."""
    from tracelode.operators import kpi

    if reported:
        answered = F.col("event_name") == "assistant_response"
        events = events.withColumn("cost_usd", F.when(answered & (F.col("k") % 2 == 0), F.col("k") / 100))
    costs = silver.token_costs(events, dedupe=False)
    units = totals(costs, "cost_units")[0]
    assert totals(gold.department_cost_attribution(costs), "total_cost_units") == (units,)
    assert totals(usage.daily_user_usage(events), "cost_units") == (units,)
    assert totals(silver.sessions_by_user(events), "total_cost_units") == (units,)
    card = kpi.scorecard(costs, kpi.last_day(events), 10_000).first()
    assert card.total_investment_usd == round(units / 1e8 + 1e-9, 2)
    listed = totals(costs, "list_cost_units")[0]
    assert (listed != units) == reported
