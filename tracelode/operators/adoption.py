"""Tokens, adoption, code output, spend and trends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelode.functions.measures import count_if, rounded_ratio, sum_long, usd

TOKEN_COLUMNS = ("input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens")


def token_breakdown(costs: DataFrame, by: list[str]) -> DataFrame:
    """Tokens by type and group: aggregated wide, unpivoted when small."""
    wide = costs.groupBy(*by).agg(*[sum_long(c).alias(c.removesuffix("_tokens")) for c in TOKEN_COLUMNS])
    return wide.unpivot(by, [c.removesuffix("_tokens") for c in TOKEN_COLUMNS], "token_type", "tokens")


def session_adoption(points: DataFrame) -> DataFrame:
    """Sessions started per day; launches of the local dashboard are no sessions."""
    started = points.filter((F.col("metric") == "session.count") & (F.col("start_type") != "agents_view"))
    per_user = started.groupBy("event_date", "user_email").agg(
        F.sum("points").alias("n"),
        sum_long(F.when(F.col("start_type") == "fresh", F.col("points"))).alias("fresh"),
    )
    return per_user.groupBy("event_date").agg(
        F.sum("n").alias("sessions"), F.sum("fresh").alias("fresh_sessions"), F.count("user_email").alias("users")
    )


def loc_by_model(points: DataFrame) -> DataFrame:
    lines = points.filter(F.col("metric") == "lines_of_code.count")
    out = lines.groupBy("model").pivot("type", ["added", "removed"]).agg(sum_long("points"))
    return out.select(
        "model", F.coalesce("added", F.lit(0)).alias("lines_added"), F.coalesce("removed", F.lit(0)).alias("lines_removed")
    )


def daily_output(points: DataFrame) -> DataFrame:
    """Commits and pull requests per day and department."""
    made = points.filter(F.col("metric").isin("commit.count", "pull_request.count"))
    return made.groupBy("event_date", "department").agg(
        sum_long(F.when(F.col("metric") == "commit.count", F.col("points"))).alias("commits"),
        sum_long(F.when(F.col("metric") == "pull_request.count", F.col("points"))).alias("pull_requests"),
    )


def commits_by_model(points: DataFrame, requests: DataFrame) -> DataFrame:
    """Commits of the sessions that used a model for main requests. A session with two models
    counts for both, so the rows need not add up to all commits.

    Both sides are reduced to one row per session (and model) before they meet.
    """
    commits = (
        points.filter(F.col("metric") == "commit.count").groupBy("session_id").agg(F.sum("points").alias("commits"))
    )
    used = requests.filter(F.col("query_source") == "main").select("session_id", "model").distinct()
    return (
        used.join(commits, "session_id")
        .groupBy("model")
        .agg(F.sum("commits").alias("commits"), F.count("*").alias("sessions"))
    )


def top_cost_sessions(costs: DataFrame, limit: int) -> DataFrame:
    """The most expensive sessions; ties by id."""
    return (
        costs.groupBy("session_id", "user_email")
        .agg(F.sum("cost_units").alias("cost_units"))
        .groupBy("session_id")
        .agg(F.min("user_email").alias("user_email"), F.sum("cost_units").alias("cost_units"))
        .orderBy(F.desc("cost_units"), "session_id")
        .limit(limit)
    )


def spend_by_agent(requests: DataFrame) -> DataFrame:
    """Spend by skill, subagent and plugin."""
    return (
        requests.groupBy("skill_name", "agent_name", "plugin_name", "query_source")
        .agg(F.count("*").alias("requests"), F.sum("cost_units").alias("cost_units"))
        .withColumn("cost_usd", usd("cost_units"))
    )


def usage_spikes(costs: DataFrame, by: str = "department", days: int = 7, factor: int = 2) -> DataFrame:
    """Days on which cost, tokens or sessions of a department (or user) exceed ``factor`` times
    the mean of its last ``days`` active days.

    The window runs over one row per department (or user) and day. Compared as integers.
    """
    tokens = F.col("input_tokens") + F.col("output_tokens")
    daily = (
        costs.groupBy(F.to_date("event_timestamp").alias("usage_date"), by, "session_id")
        .agg(F.sum("cost_units").alias("cost"), F.sum(tokens).alias("tokens"))
        .groupBy("usage_date", by)
        .agg(
            F.sum("cost").alias("cost"),
            F.sum("tokens").alias("tokens"),
            F.count("session_id").alias("sessions"),
        )
    )
    before = Window.partitionBy(by).orderBy("usage_date").rowsBetween(-days, -1)
    out = daily.withColumn("days_before", F.count("*").over(before))
    for m in ("cost", "tokens", "sessions"):
        out = out.withColumn(
            f"{m}_spike", F.col(m) * F.col("days_before") > F.sum(m).over(before) * factor
        )
    return out.select(
        "usage_date", by, "cost", "tokens", "sessions", "days_before",
        *[F.coalesce(f"{m}_spike", F.lit(False)).alias(f"{m}_spike") for m in ("cost", "tokens", "sessions")],
    )


def active_users(events: DataFrame, windows: dict[str, int], user: str = "user_email") -> DataFrame:
    """Distinct users of the last n days, for every day and window.

    A user counts on the days from an active day to n - 1 days later, or to the day before
    the next active day. Those spans do not overlap, so a +1 and a -1 per active day and a
    running sum over days replace a distinct count over n copies of each user-day.
    """
    active = (
        events.filter(F.col(user).isNotNull())
        .select(user, F.to_date("event_timestamp").alias("day"))
        .distinct()
        .withColumn("next_day", F.lead("day").over(Window.partitionBy(user).orderBy("day")))
    )
    spans = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.least(F.date_add("day", n), F.col("next_day")).alias("stop"),
            )
            for name, n in windows.items()
        ]
    )
    spans = active.select("day", F.inline(spans))
    changes = spans.select(
        "name", F.inline(F.array(_change(F.col("day"), 1), _change(F.col("stop"), -1)))
    )
    ends = active.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = ends.select(
        F.lit("_calendar").alias("name"),
        F.explode(F.sequence("first", "last")).alias("day"),
        F.lit(1).cast("bigint").alias("change"),
    )
    by_day = changes.unionByName(calendar).groupBy("day").pivot("name", ["_calendar", *windows]).agg(F.sum("change"))
    # One row per day from here on. Spans that end after the last active day leave the calendar.
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = by_day.select(
        F.col("day").alias("usage_date"),
        "_calendar",
        *[F.sum(F.coalesce(name, F.lit(0))).over(so_far).alias(name) for name in windows],
    )
    return counted.filter(F.col("_calendar") == 1).drop("_calendar")


def _change(day: Column, change: int) -> Column:
    return F.struct(day.alias("day"), F.lit(change).cast("bigint").alias("change"))


def edit_acceptance(points: DataFrame) -> DataFrame:
    return (
        points.filter(F.col("metric") == "code_edit_tool.decision")
        .groupBy("language", "source")
        .agg(
            F.sum("points").alias("decisions"),
            sum_long(F.when(F.col("decision") == "accept", F.col("points"))).alias("accepted"),
        )
        .withColumn("acceptance_pct", rounded_ratio("accepted", "decisions", 2, scale=100))
    )


def active_time(points: DataFrame) -> DataFrame:
    """Seconds of keyboard and of machine activity per day and department."""
    timed = points.filter(F.col("metric") == "active_time.total")
    out = timed.groupBy("event_date", "department").pivot("type", ["user", "cli"]).agg(F.sum("points"))
    return out.select(
        "event_date",
        "department",
        F.coalesce("user", F.lit(0)).alias("user_seconds"),
        F.coalesce("cli", F.lit(0)).alias("cli_seconds"),
    )


# Include-flags and the attributes each one controls, with the defaults.
CARDINALITY_FLAGS = {
    "session_id": (True, ("session_id",)),
    "version": (False, ("app_version",)),
    "account_uuid": (True, ("user_account_uuid", "user_email")),
    "entrypoint": (False, ("app_entrypoint",)),
    "resource_attributes": (True, ("resource_attributes",)),
}


def limit_cardinality(points: DataFrame, flags: dict[str, bool], attributes: list[str]) -> DataFrame:
    """Drop the attributes whose flag is off, then add up the points that became equal."""
    off = {
        column
        for name, (default, columns) in CARDINALITY_FLAGS.items()
        if not flags.get(name, default)
        for column in columns
    }
    kept = [a for a in attributes if a not in off]
    return points.groupBy("metric", *kept).agg(F.sum("points").alias("points"))


def cost_by_resource(costs: DataFrame, key: str, attributes: str = "resource_attributes") -> DataFrame:
    """Spend by one key of a ``k=v,k=v`` attribute string with percent-encoded values.

    A plus sign is a plus sign in such values, so it is shielded from the URL decoder.
    """
    value = F.str_to_map(attributes, F.lit(","), F.lit("="))[key]
    decoded = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return (
        costs.groupBy(decoded.alias(key))
        .agg(F.count("*").alias("requests"), F.sum("cost_units").alias("cost_units"))
        .withColumn("cost_usd", usd("cost_units"))
    )


def spend_forecast(costs: DataFrame, horizon_days: int, quota_usd: float, as_of: Column | date) -> DataFrame:
    """Least-squares line through each department's daily spend from its first day to ``as_of``, and the spend it
    predicts for the ``horizon_days`` days after.

    A day without spend counts as 0, so a department that has stopped tends to 0. The sums over the calendar have closed forms, and only
    days with spend are read. They are exact integers (cents and day numbers); only the quotient is not.
    """
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    since = F.lit("2020-01-01").cast("date")
    x = F.datediff(F.to_date("event_timestamp"), since).cast("bigint")
    daily = costs.filter(F.to_date("event_timestamp") <= end).groupBy("department", x.alias("x")).agg(F.sum("cost_units").alias("units"))
    daily = daily.select("department", "x", F.expr("(units + 500000) div 1000000").alias("y"))
    fit = daily.groupBy("department").agg(F.min("x").alias("first"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("y")).alias("xy"))
    fit = fit.withColumn("n", F.datediff(end, since).cast("bigint") - F.col("first") + 1).withColumns(
        {
            "sx": F.expr("n * (n - 1) div 2"),
            "sxx": F.expr("(n - 1) * n * (2 * n - 1) div 6"),
            "sxy": F.col("xy") - F.col("first") * F.col("sy"),
        }
    )
    slope = F.expr("cast(n * sxy - sx * sy as double) / nullif(cast(n * sxx - sx * sx as double), 0)")
    fitted = fit.withColumn("slope", slope).withColumn(
        "intercept", (F.col("sy").cast("double") - F.col("slope") * F.col("sx").cast("double")) / F.col("n")
    )
    # Sum of intercept + slope * x for x = n .. n + horizon - 1.
    ahead = F.lit(float(horizon_days)) * (F.col("n") - 1) + F.lit(horizon_days * (horizon_days + 1) / 2)
    predicted = F.col("intercept") * F.lit(float(horizon_days)) + F.col("slope") * ahead
    return fitted.select(
        "department",
        F.col("n").alias("days"),
        F.col("sy").alias("spend_cents"),
        F.round("slope", 4).alias("slope_cents_per_day"),
        F.round(predicted, 2).alias("forecast_cents"),
        (predicted > quota_usd * 100).alias("over_quota"),
    )


def prompt_complexity(prompts: DataFrame, text: str) -> DataFrame:
    """A transparent score per prompt from its whole text: words, lines, questions, digits."""

    def occurrences(pattern: str) -> Column:
        return F.regexp_count(F.col(text), F.lit(pattern)).cast("bigint")

    scored = prompts.withColumns(
        {
            "chars": F.length(text).cast("bigint"),
            "words": occurrences(r"[^ \n\t]+"),
            "lines": occurrences(r"\n") + 1,
            "questions": occurrences(r"\?"),
        }
    ).withColumn("score", F.col("words") + 5 * (F.col("lines") - 1) + 10 * F.col("questions"))
    level = F.when(F.col("score") >= 200, "high").when(F.col("score") >= 50, "medium").otherwise("low")
    return scored.withColumn("complexity", level).drop(text)


def conversation_depth(turns: DataFrame) -> DataFrame:
    """Turns, prompts and answered prompts per conversation."""
    name = F.col("event_name")
    per_prompt = turns.groupBy("session_id", "prompt_id").agg(
        F.count("*").alias("turns"),
        count_if(name == "user_prompt").alias("prompts"),
        count_if(name == "assistant_response").alias("responses"),
        sum_long(F.length(F.coalesce("prompt_text", "response_text"))).alias("chars"),
    )
    return per_prompt.groupBy("session_id").agg(
        F.sum("turns").alias("turns"),
        F.sum("prompts").alias("prompts"),
        F.sum("responses").alias("responses"),
        count_if((F.col("prompts") > 0) & (F.col("responses") > 0)).alias("answered_prompts"),
        F.sum("chars").alias("chars"),
    )


def session_tools(events: DataFrame) -> DataFrame:
    """Per session: tool events, different tools, and the most used one (ties by name)."""
    used = (
        events.filter(F.col("tool_name").isNotNull() & F.col("session_id").isNotNull())
        .groupBy("session_id", "tool_name")
        .agg(F.count("*").alias("n"))
    )
    return used.groupBy("session_id").agg(
        F.sum("n").alias("tool_events"),
        F.count("*").alias("tools"),
        F.min_by("tool_name", F.struct(-F.col("n"), F.col("tool_name"))).alias("top_tool"),
    )
