"""Serving views and SQL functions, for users who query by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelode.operators import audit, gold


def register_functions(spark: SparkSession) -> None:
    """``event_key(a, b, c, kind)``: the surrogate key as a SQL function, without a UDF."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION event_key(a STRING, b STRING, c STRING, kind STRING) RETURNS STRING
        RETURN substring(sha2(concat_ws('|', coalesce(a, ''), coalesce(b, ''), coalesce(c, ''), kind), 256), 1, 32)
    """)


def serving_views(silver: dict[str, DataFrame], daily_users: DataFrame | None = None) -> dict[str, DataFrame]:
    """The views over the silver tables ``prompts``, ``tool_executions`` and ``token_costs``."""
    views = {
        "v_executive_daily_kpis": gold.executive_daily_kpis(silver["token_costs"]),
        "v_tool_adoption_matrix": gold.tool_adoption_matrix(silver["tool_executions"]),
        "v_department_cost_attribution": gold.department_cost_view(silver["token_costs"]),
        "v_security_leak_audit": gold.prompt_leak_audit(silver["prompts"]),
    }
    if daily_users is not None:
        views["v_daily_org_usage"] = gold.daily_org_usage(daily_users)
    return views


# The grant each view is checked against.
GRANTED_AS = {
    "v_executive_daily_kpis": "executive_daily_kpis",
    "v_tool_adoption_matrix": "tool_adoption_matrix",
    "v_department_cost_attribution": "department_cost_view",
    "v_security_leak_audit": "prompt_leak_audit",
}


def register(views: dict[str, DataFrame], role: str | None = None) -> list[str]:
    """Register views by name; with a role, only those it may read, without text columns
    where it may not see them. Returns the names."""
    names = []
    for name, df in views.items():
        if role:
            try:
                df = audit.view_for_role(role, GRANTED_AS.get(name, name), df)
            except PermissionError:
                continue
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
