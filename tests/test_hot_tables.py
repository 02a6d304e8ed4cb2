"""Queries against their oracles on tables where one user holds a third of all events."""

from pathlib import Path

import duckdb
import pytest
from compare import TABLES, connect, difference

import __spark_entry__ as entry

SF_DIR = Path("/root/testdata/sf0.001")
SKEW_SENSITIVE = (
    "normalize_events", "silver_prompts", "silver_token_costs", "daily_user_metrics", "daily_user_usage",
    "responses_by_user", "compliance_transcript_lines", "transcript_nearest", "prompt_trace", "tool_decision_outcome",
    "tool_wait_breakdown", "dedupe_by_sk", "dedupe_session_ts", "merge_insert_new", "session_recovery",
    "dau_wau_mau", "v_executive_daily_kpis", "commits_by_model", "session_tools", "usage_spikes", "user_spikes",
)


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    """One user with a third of the events, half of those at one moment."""
    folder = tmp_path_factory.mktemp("hot")
    for name in TABLES:
        if name != "events":
            (folder / f"{name}.parquet").symlink_to(SF_DIR / f"{name}.parquet")
    duckdb.sql(f"""
        COPY (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN TIMESTAMP '2024-01-10 12:00:00' ELSE ts END AS ts,
                CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, event_type, value, props
              FROM '{SF_DIR}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)
    """)
    return str(folder)


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_on_hot_tables(spark, hot_dir, name):
    assert difference(entry.queries()[name](spark, hot_dir), connect(hot_dir), entry.oracle_sql()[name]) is None
