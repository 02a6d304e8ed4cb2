"""The same results as plain SQL over the given tables, for an independent check."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    name: str
    pattern: str
    replacement: str


# Written out here, not taken from the code: what counts as a secret, and what takes its place.
_BARE = "[^\\s'\"\\\\,;&(){}\\[\\]<>]"
_NAMED = (
    "(?:(?:api|access)[_-]?key|secret|passwd|password|passphrase|(?:auth_)?token)"
    "(?:[_-]?(?:test|prod|base64|string|token|value|id|key|access)){0,3}"
)
_VALUES = (
    '\\\\"(?:[^"\\\\]|\\\\\\\\\\\\.|\\\\\\\\[^\\\\])+\\\\"', "\\\\'(?:[^'\\\\]|\\\\\\\\\\\\.|\\\\\\\\[^\\\\])+\\\\'",
    '"(?:\\\\[\\s\\S]|[^"\\\\])+"', "'(?:\\\\[\\s\\S]|[^'\\\\])+'", "\\\\?[\"'][^\\s\"'\\\\]{3,}\\z",
)
_QUOTED = "(?:" + "|".join(_VALUES) + ")"
SECRET_RULES = (
    Rule("storage_account_key", "((?:SharedAccess|Account)Key\\s*=\\s*)[A-Za-z0-9+/]{20,}={0,2}", "$1[REDACTED_STORAGE_KEY]"),
    Rule("aws_key", "AKIA[0-9A-Z]{16}", "[REDACTED_AWS_KEY]"),
    Rule("aws_temp_key", "ASIA[0-9A-Z]{16}", "[REDACTED_AWS_TEMP_KEY]"),
    Rule("jwt", "eyJ[a-zA-Z0-9_-]+\\.eyJ[a-zA-Z0-9_-]+\\.[a-zA-Z0-9_-]+", "[REDACTED_JWT_TOKEN]"),
    Rule("credential", f"({_NAMED}\\\\?['\"]?\\s*[:=]\\s*)(?:{_QUOTED}|{_BARE}*[0-9]{_BARE}*)", "$1[REDACTED_CREDENTIAL]"),
    Rule("url_credentials", "https?://[^\\s:/@]+:[^\\s@/]+@\\S+", "[REDACTED_URL_CREDS]"),
    Rule("private_key", "-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----[\\s\\S]*?"
         "(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----|\\z)", "[REDACTED_PRIVATE_KEY]"),
    Rule("assigned_credential", f"({_NAMED}=){_BARE}{{3,}}", "$1[REDACTED_CREDENTIAL]"),
    Rule("connection_password", f"(\\bpwd\\s*=\\s*)(?:{_QUOTED}|[A-Za-z0-9!@#%^*_+][^\\s'\"\\\\,;&(){{}}\\[\\]<>/]{{2,}})",
         "$1[REDACTED_CREDENTIAL]"),
    Rule("password_line", f"(pass(?:word|wd|phrase)[ \\t]*:[ \\t]+){_BARE}{{8,}}([ \\t]*(?:[\\r\\n]|\\z))", "$1[REDACTED_CREDENTIAL]$2"),
    Rule("auth_header", "(authorization\\\\?['\"]?\\s*[:=]\\s*\\\\?['\"]?(?:bearer|basic|token)\\s+)[A-Za-z0-9._~+/=-]+",
         "$1[REDACTED_AUTHORIZATION]"),
    Rule("bearer_token", "(\\bbearer\\s+)[A-Za-z0-9._~+/-]{20,}=*", "$1[REDACTED_BEARER]"),
    Rule("command_line_user", "(\\bcurl\\b[^\\r\\n]{0,200}?[ \\t](?:--user|-u)[ \\t=]*\\\\?['\"]?[^\\s:'\"\\\\]+:)[^\\s'\"\\\\\\[]+",
         "$1[REDACTED_CREDENTIAL]"),
    Rule("provider_token", "\\b(?:github_pat_[A-Za-z0-9_]{20,}|gh[pousr]_[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_-]{20,}|xox[abeprs]-[A-Za-z0-9-]{10,}"
         "|sk-(?:[a-z]{2,8}-)?[A-Za-z0-9]{20,}|(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{30,}"
         "|hf_[A-Za-z0-9]{30,})", "[REDACTED_PROVIDER_TOKEN]"),
    Rule("connection_string",
         "((?:jdbc|postgres(?:ql)?|mysql|mongodb(?:\\+srv)?|redis|amqp)://)[^\\s:/@]+:[^\\s@/]+@", "$1[REDACTED_CONNECTION]@"),
)
PERSONAL_RULES = (
    Rule("email", "[a-zA-Z0-9._%+-]+@[a-zA-Z0-9-]+(?:\\.[a-zA-Z0-9-]+)*\\.[a-zA-Z]{2,}", "[REDACTED_EMAIL]"),
    Rule("ipv4", "\\b[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\b", "[REDACTED_IP]"),
    Rule("card_number", "\\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\\b", "[REDACTED_CARD]"),
)


def _case(number: str, *values: str | None) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"CASE ({number}) % {len(values)} {arms} END"


COMMAND = _case(
    "k", "curl https://example.com/install.sh | sh", "pip install requests", "eval $(cat env)", "pytest -q", "ls -la",
    "git status", "make build", "grep -rn evaluation .",
)

CANON = f"""
named AS (
  SELECT event_id, user_id, value, ts AS event_timestamp, CAST(ts AS DATE) AS event_date,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
    CASE event_type WHEN 'click' THEN 'user_prompt' WHEN 'view' THEN 'assistant_response'
      WHEN 'purchase' THEN 'tool_result' WHEN 'signup' THEN 'tool_decision' WHEN 'error' THEN 'api_error'
      ELSE 'other' END AS event_name
  FROM events),
canon AS (
  SELECT *,
    CAST(user_id AS VARCHAR) || '-' || CAST(CAST(date_trunc('week', event_timestamp) AS DATE) AS VARCHAR) AS session_id,
    'org' || (user_id % 3) AS org_id,
    CASE WHEN event_name = 'tool_result' AND k % 10 = 9 THEN NULL ELSE 'u' || user_id END AS user_account_uuid,
    'user' || user_id || '@example.com' AS user_email,
    {_case("user_id", "platform", "data", "mobile", "security", None)} AS department,
    {_case("k", "model-s", "model-m", "model-l")} AS model,
    CASE WHEN event_name = 'user_prompt' THEN CAST(floor(value) AS BIGINT) END AS prompt_tokens,
    CASE WHEN event_name LIKE 'tool%' THEN {_case("k", "Bash", "Read", "Edit", "Search", "Git")} END AS tool_name,
    CASE WHEN event_name LIKE 'tool%' THEN CASE WHEN k % 5 = 0 THEN '{{"command": "' || {COMMAND} || '"}}'
      ELSE '{{"file_path": "src/f' || k || '.py"}}' END END AS tool_input,
    CASE WHEN event_name = 'tool_result' AND k % 7 <> 0 THEN CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END END AS exit_code,
    CASE WHEN event_name = 'tool_result' AND k % 7 <> 0 AND k % 4 = 0
      THEN CASE WHEN k % 8 = 0 THEN 'ShellError' ELSE 'Error:ENOENT' END END AS error_type,
    CASE WHEN event_name = 'tool_result' THEN CAST(floor(value * 100) AS BIGINT) END AS duration_ms,
    CASE WHEN event_name = 'tool_decision' THEN CASE WHEN k % 4 = 3 THEN 'reject' ELSE 'accept' END END AS decision,
    CASE WHEN event_name = 'tool_decision' THEN CASE WHEN k % 8 = 3 THEN 'user_reject' WHEN k % 8 = 7 THEN 'user_abort'
      ELSE {_case("k", "config", "hook", "user_temporary")} END END AS decision_source,
    CASE WHEN event_name = 'tool_decision' THEN CAST(floor(value * 50) AS BIGINT) END AS wait_ms,
    CASE WHEN event_name = 'assistant_response' AND k % 10 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS input_tokens,
    CASE WHEN event_name = 'assistant_response' THEN CAST(floor(value * 2) AS BIGINT) END AS output_tokens,
    CASE WHEN event_name = 'assistant_response' THEN k * 50 END AS cache_read_tokens,
    CASE WHEN event_name = 'assistant_response' THEN k * 5 END AS cache_creation_tokens,
    CASE WHEN event_name = 'assistant_response' THEN CAST(floor(value * 20) AS BIGINT) END AS latency_ms,
    CASE WHEN event_name = 'assistant_response'
      THEN {_case("k", "main", "main", "main", "subagent", "auxiliary")} END AS query_source,
    CASE WHEN event_name = 'assistant_response' THEN {_case("k", "review", "refactor", None)} END AS skill_name,
    CASE WHEN event_name = 'assistant_response' THEN {_case("k", "planner", "explorer", None, None)} END AS agent_name,
    CASE WHEN event_name = 'assistant_response' THEN {_case("k", "docs", None, "lint", None, None)} END AS plugin_name,
    '2.' || (k % 4) AS app_version,
    CASE WHEN event_name = 'api_error' THEN CAST(k % 11 + 1 AS INTEGER) END AS attempt,
    CASE WHEN event_name = 'api_error' THEN CASE WHEN k % 2 = 0 THEN 429 ELSE 500 END END AS status_code
  FROM named)"""

ORDERED = """
counted AS (
  SELECT *, row_number() OVER s AS event_sequence,
    count(*) FILTER (WHERE event_name = 'user_prompt') OVER s AS prompts_so_far,
    count(*) FILTER (WHERE event_name = 'tool_decision') OVER s AS calls_so_far
  FROM canon
  WINDOW s AS (PARTITION BY session_id ORDER BY event_timestamp, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ordered AS (
  SELECT *, CASE WHEN prompts_so_far > 0 THEN session_id || '#' || prompts_so_far END AS prompt_id,
    CASE WHEN event_name LIKE 'tool%' AND calls_so_far > 0 THEN session_id || '#t' || calls_so_far END AS tool_use_id
  FROM counted)"""


def _texted(source: str) -> str:
    return f"""
texted AS (
  SELECT e.*, CASE WHEN event_name = 'user_prompt' THEN d.text END AS prompt_text,
    CASE WHEN event_name = 'assistant_response' THEN d.text END AS response_text,
    CASE WHEN event_name = 'tool_result' THEN d.text END AS tool_output
  FROM {source} e LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""


COSTS = """
costs AS (
  SELECT *, i * 300 + o * 1500 + cc * 375 + cr * 30 AS cost_units
  FROM (SELECT *, coalesce(input_tokens, 0) AS i, coalesce(output_tokens, 0) AS o,
          coalesce(cache_creation_tokens, 0) AS cc, coalesce(cache_read_tokens, 0) AS cr
        FROM canon WHERE event_name = 'assistant_response'))"""

SESSIONS = """
sessions AS (
  SELECT session_id, min(user_email) AS user_email, min(department) AS department,
    min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
    count(*) FILTER (WHERE event_name = 'user_prompt') AS total_prompts,
    count(*) FILTER (WHERE event_name = 'assistant_response') AS total_responses,
    count(*) FILTER (WHERE event_name LIKE 'tool%') AS total_tool_calls,
    date_diff('second', min(event_timestamp), max(event_timestamp)) AS session_duration_sec
  FROM canon GROUP BY session_id)"""

USER_SESSIONS = """
user_sessions AS (
  SELECT session_id, org_id, user_account_uuid, min(user_email) AS user_email, min(app_version) AS app_version,
    min(event_timestamp) AS started_at, max(event_timestamp) AS last_event_at,
    count(*) FILTER (WHERE event_name = 'user_prompt') AS prompt_count,
    count(*) FILTER (WHERE event_name = 'assistant_response') AS response_count,
    count(*) FILTER (WHERE event_name LIKE 'tool%') AS tool_call_count,
    CAST(coalesce(sum(input_tokens), 0) AS BIGINT) AS total_input_tokens,
    CAST(coalesce(sum(output_tokens), 0) AS BIGINT) AS total_output_tokens,
    CAST(sum(coalesce(input_tokens, 0) * 300 + coalesce(output_tokens, 0) * 1500
      + coalesce(cache_creation_tokens, 0) * 375 + coalesce(cache_read_tokens, 0) * 30) AS BIGINT) AS total_cost_units
  FROM canon GROUP BY session_id, org_id, user_account_uuid),
owners AS (
  SELECT session_id, org_id, max(user_account_uuid) AS user_account_uuid FROM user_sessions GROUP BY ALL)"""

LAST_DAY = "(SELECT CAST(max(ts) AS DATE) FROM events)"

METRICS = f"""
points AS (
  SELECT event_id, event_date, session_id, user_account_uuid, user_email, department, model,
    {_case("user_id", "cli", "sdk", "ide")} AS app_entrypoint,
    CASE event_name WHEN 'user_prompt' THEN 'session.count' WHEN 'assistant_response' THEN 'lines_of_code.count'
      WHEN 'tool_result' THEN {_case("k", "commit.count", "pull_request.count")}
      WHEN 'tool_decision' THEN 'code_edit_tool.decision' WHEN 'api_error' THEN 'active_time.total' END AS metric,
    CASE event_name WHEN 'assistant_response' THEN CAST(floor(value) AS BIGINT)
      WHEN 'api_error' THEN CAST(floor(value * 10) AS BIGINT) ELSE 1 END AS points,
    CASE WHEN event_name = 'user_prompt'
      THEN {_case("k", "fresh", "resume", "continue", "agents_view")} END AS start_type,
    CASE event_name WHEN 'assistant_response' THEN {_case("k", "added", "removed")}
      WHEN 'api_error' THEN {_case("k", "user", "cli")} END AS type,
    decision, decision_source AS source,
    CASE WHEN event_name = 'tool_decision'
      THEN {_case("user_id", "Python", "TypeScript", "Markdown", "unknown")} END AS language
  FROM canon)"""

TURNS = """
turns AS (
  SELECT CAST(conv_id AS VARCHAR) AS session_id, turn AS event_sequence, role, text,
    CASE WHEN p > 0 THEN conv_id || '#' || p END AS prompt_id
  FROM (SELECT *, count(*) FILTER (WHERE role = 'user') OVER (PARTITION BY conv_id ORDER BY turn) AS p
        FROM conversations))"""

PAGES = r"""
paged AS (
  SELECT page_id, url, html, regexp_replace(regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1), '/+$', '') || '.md' AS rel,
    regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
    regexp_extract(html, '<html lang="([a-zA-Z-]+)"', 1) AS lang, CAST(strlen(html) AS BIGINT) AS bytes
  FROM pages),
slugged AS (SELECT *, regexp_replace(regexp_replace(rel, '^en/', ''), '\.md$', '') AS slug FROM paged),
latest AS (SELECT * FROM slugged QUALIFY row_number() OVER (PARTITION BY slug ORDER BY rel DESC, page_id DESC) = 1),
listed AS (
  SELECT DISTINCT slug, TRY_CAST(regexp_extract(slug, '([0-9]+)$', 1) AS INTEGER) AS number,
    CASE WHEN contains(slug, '/') THEN split_part(slug, '/', 1) ELSE 'en' END AS folder
  FROM slugged),
taxonomy AS (
  SELECT slug, 'Pages ' || folder AS section FROM listed WHERE number % 3 = 0
  UNION ALL SELECT slug, 'Round numbers' FROM listed WHERE number % 10 = 0)"""

ENTRIES = r"""
links AS (
  SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_replace(url, '[?#].*$', '') AS link
  FROM pages),
entries AS (
  SELECT page_id, title, url, 'Page ' || page_id AS summary, regexp_replace(url, '^https?://[^/]+/', '') AS rel
  FROM (SELECT *, CASE WHEN link LIKE '%.md' THEN link ELSE regexp_replace(link, '/+$', '') || '.md' END AS url FROM links)
  WHERE title <> '' AND NOT contains(title, ']'))"""


def _ratio(num: str, den: str, places: int, scale: int = 1) -> str:
    return f"CAST((({num}) * {2 * scale * 10**places} + ({den})) // (2 * nullif(({den}), 0)) AS DOUBLE) / {10**places}"


def _cents(units: str) -> str:
    return f"CAST(({units} + 500000) // 1000000 AS DOUBLE) / 100"


def _pattern(rule: Rule) -> str:
    return rule.pattern.replace("'", "''")


def _redact(text: str, rules: tuple[Rule, ...] = SECRET_RULES) -> str:
    out = text
    for rule in rules:
        replacement = rule.replacement.replace("$", "\\")
        out = f"regexp_replace({out}, '{_pattern(rule)}', '{replacement}', 'gi')"
    return out


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


TOOL_DAYS = """
tool_days AS (
  SELECT event_date, tool_name, count(*) AS n, count(*) FILTER (WHERE event_name = 'tool_result') AS done,
    count(DISTINCT user_email) AS users, count(*) FILTER (WHERE exit_code <> 0) AS failed,
    CAST(sum(duration_ms) AS BIGINT) AS ms, count(duration_ms) AS timed
  FROM canon WHERE event_name LIKE 'tool%' GROUP BY event_date, tool_name)"""

MATRIX = f"""
matrix AS (
  SELECT event_date AS metric_date, tool_name, n AS total_executions, users AS unique_users,
    failed AS failed_executions, {_ratio("failed", "n", 2, 100)} AS error_rate_pct,
    {_ratio("ms", "timed", 2)} AS avg_duration_ms
  FROM tool_days)"""

DEPARTMENT_DAYS = f"""
department_days AS (
  SELECT event_date AS metric_date, coalesce(department, 'Unassigned') AS department, model AS model_name,
    count(DISTINCT user_email) AS active_users, CAST(sum(i) AS BIGINT) AS total_input_tokens,
    CAST(sum(o) AS BIGINT) AS total_output_tokens, CAST(sum(cr) AS BIGINT) AS total_cache_read_tokens,
    {_cents("sum(cost_units)")} AS total_cost_usd
  FROM costs GROUP BY 1, 2, 3)"""

EXECUTIVE_DAYS = f"""
executive_days AS (
  SELECT event_date AS metric_date, count(DISTINCT user_email) AS active_developers_dau,
    count(DISTINCT session_id) AS total_sessions, CAST(sum(i + o + cc + cr) AS BIGINT) AS total_tokens_consumed,
    {_cents("sum(cost_units)")} AS total_spend_usd,
    {_ratio("sum(cost_units)", "count(DISTINCT user_email) * 1000000", 0)} / 100 AS avg_spend_per_dev_usd
  FROM costs GROUP BY 1)"""

USAGE = """
resolved AS (
  SELECT c.event_date AS usage_date, c.org_id, coalesce(c.user_account_uuid, o.user_account_uuid) AS user_account_uuid,
    c.event_name
  FROM canon c JOIN owners o USING (session_id, org_id)),
starts AS (
  SELECT CAST(s.started AS DATE) AS usage_date, org_id, o.user_account_uuid, s.input_tokens, s.output_tokens, s.units
  FROM (SELECT session_id, org_id, min(started_at) AS started, sum(total_input_tokens) AS input_tokens,
          sum(total_output_tokens) AS output_tokens, sum(total_cost_units) AS units
        FROM user_sessions GROUP BY ALL) s JOIN owners o USING (session_id, org_id)),
usage_parts AS (
  SELECT usage_date, org_id, user_account_uuid, 0 AS sessions,
    CASE WHEN event_name = 'user_prompt' THEN 1 ELSE 0 END AS prompts,
    CASE WHEN event_name = 'assistant_response' THEN 1 ELSE 0 END AS responses,
    CASE WHEN event_name LIKE 'tool%' THEN 1 ELSE 0 END AS tool_events, 0 AS input_tokens, 0 AS output_tokens, 0 AS units
  FROM resolved
  UNION ALL SELECT usage_date, org_id, user_account_uuid, 1, 0, 0, 0, input_tokens, output_tokens, units FROM starts),
daily_usage AS (
  SELECT usage_date, org_id, user_account_uuid, CAST(sum(sessions) AS BIGINT) AS sessions,
    CAST(sum(prompts) AS BIGINT) AS prompts, CAST(sum(responses) AS BIGINT) AS responses,
    CAST(sum(tool_events) AS BIGINT) AS tool_events, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
    CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(units) AS BIGINT) AS cost_units
  FROM usage_parts GROUP BY ALL)"""


def _by_user(kind: str, measure: str, owners: str = "owners") -> str:
    return f"""SELECT event_date AS usage_date, c.org_id, o.user_account_uuid, count(*) AS {measure}
  FROM canon c LEFT JOIN {owners} o USING (session_id, org_id) WHERE {kind} GROUP BY ALL"""


def _transcript(source: str, prompt: str, response: str) -> str:
    return f"""SELECT p.org_id, p.session_id, p.prompt_id, p.user_account_uuid, p.event_sequence AS prompt_sequence,
    p.event_timestamp AS prompt_ts, {prompt} AS prompt_text, r.event_sequence AS response_sequence,
    r.event_timestamp AS response_ts, {response} AS response_text, r.model
  FROM (SELECT * FROM {source} WHERE event_name = 'user_prompt') p
  LEFT JOIN (SELECT * FROM {source} WHERE event_name = 'assistant_response') r
    ON p.session_id = r.session_id AND p.prompt_id IS NOT DISTINCT FROM r.prompt_id"""


ALL_RULES = SECRET_RULES + PERSONAL_RULES

JUDGED = f"""
judged AS (
  SELECT event_id, event_date, session_id, concat_ws(',', {", ".join(
    f"CASE WHEN regexp_matches(prompt_text, '{_pattern(r)}', 'i') THEN '{r.name}' END" for r in ALL_RULES)}) AS matched
  FROM texted)"""

AUDIT_EVENTS = f"""
audit_events AS (
  SELECT * REPLACE (CASE WHEN event_name = 'api_error' THEN {_case(
      "k", "api_error", "permission_mode_changed", "hook_execution_complete", "auth", "mcp_server_connection",
      "plugin_installed")} ELSE event_name END AS event_name) FROM canon),
signals AS (
  SELECT event_date, user_email, unnest([
    CASE WHEN event_name = 'tool_decision' AND decision = 'reject' THEN 'tool_call_denied' END,
    CASE WHEN event_name = 'permission_mode_changed' AND (k // 6) % 3 = 2 THEN 'permission_escalation' END,
    CASE WHEN event_name = 'hook_execution_complete' AND k % 4 > 0 THEN 'hook_blocked' END,
    CASE WHEN event_name = 'auth' AND k % 5 = 0 THEN 'auth_failure' END,
    CASE WHEN event_name = 'auth' AND k % 5 > 0 THEN CASE (k // 6) % 2 WHEN 0 THEN 'login' ELSE 'logout' END END,
    CASE WHEN event_name = 'mcp_server_connection' AND k % 8 <> 4 THEN 'mcp_server_connected' END,
    CASE WHEN event_name = 'plugin_installed' AND k % 12 = 5 THEN 'official_plugin' END,
    CASE WHEN event_name = 'tool_decision' AND decision = 'reject' AND tool_name = 'Bash' THEN 'command_rejected' END,
    CASE WHEN event_name = 'tool_decision' AND decision = 'accept' THEN 'tool_call_allowed:' || decision_source END,
    CASE WHEN event_name = 'tool_result' AND contains(tool_input, '"file_path"') THEN 'file_touched' END,
    CASE WHEN event_name = 'mcp_server_connection' AND k % 8 = 4 THEN 'mcp_server_failure' END,
    CASE WHEN event_name = 'plugin_installed' AND k % 12 <> 5 THEN 'unofficial_plugin' END,
    CASE WHEN event_name = 'tool_result' AND tool_name = 'Bash' THEN 'command_run' END]) AS signal
  FROM audit_events)"""  # fmt: skip

LANDED = "SELECT event_id, event_name, session_id, event_timestamp, user_account_uuid, duration_ms FROM canon"


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    # silver
    q["normalize_events"] = _with(CANON, ORDERED, select="""
SELECT event_id, event_name, event_timestamp, event_date, event_sequence, session_id, prompt_id, org_id,
  user_account_uuid, user_email, department, model, tool_name, tool_input, exit_code, duration_ms, latency_ms,
  input_tokens, output_tokens, cache_read_tokens, cache_creation_tokens FROM ordered""")
    sk = "substring(sha256(session_id || '|' || coalesce(prompt_id, '') || '|' || event_sequence || '|{}'), 1, 32)"
    response_sk = sk.format("response")
    q["silver_prompts"] = _with(CANON, ORDERED, _texted("ordered"), select=f"""
SELECT {sk.format("prompt")} AS prompt_sk, session_id, prompt_id, event_sequence, event_timestamp, org_id,
  user_account_uuid, user_email, department, model AS model_name, {_redact("prompt_text")} AS prompt_text,
  CAST(length(prompt_text) AS INTEGER) AS prompt_length, prompt_tokens
FROM texted WHERE event_name = 'user_prompt'""")
    q["silver_responses"] = _with(CANON, ORDERED, _texted("ordered"), select=f"""
SELECT {response_sk} AS response_sk, session_id, prompt_id, event_sequence, event_timestamp, org_id, user_email,
  model AS model_name, {_redact("response_text")} AS response_text,
  CAST(length(response_text) AS INTEGER) AS response_length, output_tokens AS completion_tokens, latency_ms
FROM texted WHERE event_name = 'assistant_response'""")
    q["silver_tool_executions"] = _with(CANON, ORDERED, _texted("ordered"), select=f"""
SELECT substring(sha256(session_id || '|' || event_sequence || '|' || tool_name || '|tool'), 1, 32) AS tool_event_sk,
  session_id, prompt_id, event_sequence, event_timestamp, org_id, user_account_uuid, user_email, event_name, tool_name,
  {_redact("tool_input")} AS tool_input, {_redact("tool_output")} AS tool_output, decision, duration_ms, exit_code
FROM texted WHERE event_name LIKE 'tool%'""")
    q["silver_token_costs"] = _with(CANON, ORDERED, COSTS.replace("FROM canon", "FROM ordered"), select=f"""
SELECT {response_sk} AS response_sk, session_id, user_email, department, event_timestamp, model AS model_name,
  i AS input_tokens, o AS output_tokens, cc AS cache_creation_tokens, cr AS cache_read_tokens, cost_units,
  cost_units AS list_cost_units, CAST(cost_units AS DOUBLE) / 100000000 AS estimated_cost_usd FROM costs""")
    q["silver_sessions"] = _with(CANON, SESSIONS, select="SELECT * FROM sessions")
    q["silver_sessions_by_user"] = _with(CANON, USER_SESSIONS, select="SELECT * FROM user_sessions")
    q["silver_users"] = _with(CANON, select="""
SELECT user_account_uuid, min(user_email) AS user_email, min(department) AS department,
  min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen, count(DISTINCT session_id) AS sessions,
  count(*) AS events FROM canon WHERE user_account_uuid IS NOT NULL GROUP BY 1""")
    fan_out = """
SELECT 'prompts' AS table_name, count(*) FILTER (WHERE event_name = 'user_prompt') AS row_count FROM {0}
UNION ALL SELECT 'responses', count(*) FILTER (WHERE event_name = 'assistant_response') FROM {0}
UNION ALL SELECT 'token_costs', count(*) FILTER (WHERE event_name = 'assistant_response') FROM {0}
UNION ALL SELECT 'tool_executions', count(*) FILTER (WHERE event_name LIKE 'tool%') FROM {0}
UNION ALL SELECT 'sessions', count(DISTINCT session_id) FROM {0}"""
    q["silver_fanout_counts"] = _with(CANON, select=fan_out.format("canon"))
    q["dedupe_by_sk"] = _with(CANON, ORDERED, select="""
SELECT substring(sha256(session_id || '|' || coalesce(prompt_id, '') || '|' || event_sequence || '|' || event_name), 1, 32)
  AS event_sk, event_id, event_name, event_timestamp, 1 AS delivery FROM ordered""")
    q["dedupe_session_ts"] = _with(CANON, select="""
SELECT session_id, date_trunc('hour', event_timestamp) AS tick, tool_name, event_id, event_timestamp
FROM canon WHERE event_name LIKE 'tool%'
QUALIFY row_number() OVER (PARTITION BY session_id, date_trunc('hour', event_timestamp), tool_name
                           ORDER BY event_timestamp, event_id) = 1""")
    for name, kind in (("dedupe_prompts_ts", "user_prompt"), ("dedupe_responses_ts", "assistant_response")):
        q[name] = _with(CANON, select=f"""
SELECT session_id, date_trunc('hour', event_timestamp) AS tick, event_id, event_timestamp
FROM canon WHERE event_name = '{kind}'
QUALIFY row_number() OVER (PARTITION BY session_id, date_trunc('hour', event_timestamp)
                           ORDER BY event_timestamp, event_id) = 1""")
    q["merge_insert_new"] = _with(CANON, ORDERED, select="""
SELECT md5(session_id || '|' || coalesce(prompt_id, '') || '|' || event_sequence || '|prompt') AS prompt_sk,
  session_id, prompt_id, event_sequence, event_timestamp, event_id, org_id
FROM ordered WHERE event_name = 'user_prompt' AND md5(CAST(event_id AS VARCHAR)) >= '8'""")
    q["filter_empty_events"] = _with(CANON, select="""
SELECT event_id, CASE WHEN k % 4 <> 0 THEN event_name END AS event_name,
  CASE WHEN k % 6 <> 0 THEN session_id END AS body FROM canon WHERE NOT (k % 4 = 0 AND k % 6 = 0)""")
    q["enrich_attributes"] = _with(CANON, select="""
SELECT event_id, 'event.name=' || event_name || ';org.id=acme;pipeline.environment=prod;pipeline.source=agent;session.id='
  || session_id AS attributes FROM canon""")
    q["truncate_content"] = """
SELECT doc_id, md5(substring(text, 1, 2000)) AS text_md5, CAST(length(text) AS INTEGER) AS text_length,
  length(text) > 2000 AS text_truncated FROM documents"""
    q["content_gate"] = _with(CANON, _texted("canon"), select="""
SELECT event_id, md5(CASE WHEN prompt_text IS NOT NULL THEN CASE WHEN org_id = 'org1' THEN prompt_text ELSE '<REDACTED>' END END)
  AS prompt_md5, md5(response_text) AS response_md5,
  CASE WHEN tool_input IS NOT NULL THEN '<REDACTED>' END AS tool_input FROM texted""")
    q["cardinality_control"] = _with(CANON, METRICS, select="""
SELECT metric, user_account_uuid, user_email, department, model, app_entrypoint, CAST(sum(points) AS BIGINT) AS points
FROM points GROUP BY ALL""")

    q["unkeyed_secrets"] = """
WITH d AS (SELECT doc_id % 6 AS i, coalesce(text, '') AS text, sha256(CAST(doc_id AS VARCHAR)) AS h,
    replace(to_base64(from_hex(sha256(CAST(doc_id AS VARCHAR)))), '=', '') AS r, doc_id FROM documents),
p AS (SELECT CASE i WHEN 0 THEN 'base64' WHEN 1 THEN 'upper' WHEN 2 THEN 'prefixed' WHEN 3 THEN 'digest' WHEN 4 THEN 'name' ELSE 'path' END AS kind, text,
    CASE i WHEN 0 THEN r WHEN 1 THEN upper(r[1:28]) WHEN 2 THEN 'tok_live-' || r[3:26] WHEN 3 THEN h
      WHEN 4 THEN 'configValue_' || doc_id || '_forProductionUse' ELSE '/srv/app/release-' || doc_id || '/static/bundle' END AS planted,
    row_number() OVER () AS n FROM d),
t AS (SELECT n, unnest(regexp_extract_all(text || ' ' || planted, '[A-Za-z0-9+/_=-]{20,}')) AS token FROM p),
c AS (SELECT token, unnest(string_split(token, '')) AS ch FROM (SELECT DISTINCT token FROM t)),
e AS (SELECT token, sum(k * log2(k)) AS s FROM (SELECT token, ch, CAST(count(*) AS DOUBLE) AS k FROM c WHERE ch <> '' GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT token FROM (SELECT token, s, CAST(length(token) AS DOUBLE) AS l FROM e)
  WHERE 1 - s / (l * log2(l)) >= 0.8 * least(1.0, 5.0 / log2(l)) AND regexp_matches(token, '[A-Za-z]') AND regexp_matches(token, '[0-9]')
    AND NOT regexp_matches(token, '^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})$')
    AND NOT regexp_matches(token, '^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$')
    AND NOT (regexp_matches(token, '^(?:[A-Z]?[a-z]{2,}|[A-Z]+|[0-9]+|[_/+=-]+)*$') AND NOT regexp_matches(token, '[A-Z]{6}')
      AND len(regexp_extract_all(token, '[0-9]+')) <= greatest(2, length(token) // 10))),
s AS (SELECT t.n, list(token) AS found FROM t JOIN f USING (token) GROUP BY t.n)
SELECT kind, count(*) AS documents, count(CASE WHEN list_contains(found, planted) THEN 1 END) AS caught,
  count(CASE WHEN len(list_filter(found, lambda x: x <> planted)) > 0 THEN 1 END) AS others
FROM p LEFT JOIN s USING (n) GROUP BY kind"""

    # gold and views
    q["daily_user_metrics"] = _with(CANON, SESSIONS, select="""
SELECT CAST(session_start AS DATE) AS usage_date, user_email, department, count(*) AS total_sessions,
  CAST(sum(total_prompts) AS BIGINT) AS total_prompts, CAST(sum(total_tool_calls) AS BIGINT) AS total_tool_calls,
  CAST(sum(session_duration_sec) AS BIGINT) AS total_duration_sec,
  CAST(sum(session_duration_sec) AS DOUBLE) / count(*) AS avg_session_duration_sec
FROM sessions GROUP BY 1, 2, 3""")
    summary = """
SELECT event_date AS execution_date, tool_name, n AS total_executions, done AS completed_executions,
  users AS unique_users, failed AS failed_executions, CAST(ms AS DOUBLE) / nullif(timed, 0) AS avg_duration_ms,
  CAST(failed AS DOUBLE) / n * 100 AS error_rate_pct FROM tool_days"""
    q["tool_adoption_summary"] = _with(CANON, TOOL_DAYS, select=summary)
    q["department_cost_attribution"] = _with(CANON, COSTS, select="""
SELECT event_date AS cost_date, department, model AS model_name, count(DISTINCT user_email) AS active_users,
  CAST(sum(i) AS BIGINT) AS total_input_tokens, CAST(sum(o) AS BIGINT) AS total_output_tokens,
  CAST(sum(cc) AS BIGINT) AS total_cache_creation_tokens, CAST(sum(cr) AS BIGINT) AS total_cache_read_tokens,
  CAST(sum(cost_units) AS BIGINT) AS total_cost_units, CAST(sum(cost_units) AS DOUBLE) / 100000000 AS total_cost_usd
FROM costs GROUP BY 1, 2, 3""")
    q["dept_cost_rollup"] = _with(CANON, COSTS, select="""
SELECT department, model AS model_name, grouping(department, model) AS level,
  CAST(sum(cost_units) AS BIGINT) AS total_cost_units, CAST(sum(cost_units) AS DOUBLE) / 100000000 AS total_cost_usd
FROM costs GROUP BY ROLLUP (department, model)""")
    q["redact_text"] = f"""
SELECT doc_id, CAST(length(redacted) AS INTEGER) AS redacted_length, md5(redacted) AS redacted_md5,
  contains(redacted, '[REDACTED_') AS flagged
FROM (SELECT doc_id, {_redact("text")} AS redacted FROM documents)"""
    q["redaction_counts"] = "\nUNION ALL ".join(
        f"""SELECT source, '{r.name}' AS rule, CAST(sum(n) AS BIGINT) AS hits, count(*) FILTER (WHERE n > 0) AS texts
FROM (SELECT source, len(regexp_extract_all(text, '{_pattern(r)}', 0, 'i')) AS n FROM documents) GROUP BY source"""
        for r in ALL_RULES
    )
    sources = [("prompt", "prompt_text"), ("response", "response_text"), ("tool_input",) * 2, ("tool_output",) * 2]
    scanned = " UNION ALL ".join(
        f"SELECT event_id, event_timestamp, user_email, department, session_id, '{s}' AS source, {_redact(c)} AS t FROM texted"
        for s, c in sources
    )
    alerts = f"""
SELECT event_id, event_timestamp, user_email, department, session_id, source, md5(t) AS flagged_text,
  CAST(event_timestamp AS DATE) AS alert_date FROM ({scanned}) WHERE contains(t, '[REDACTED_')"""
    q["security_leak_alerts"] = _with(CANON, _texted("canon"), select=alerts)
    leak_rows = f"""
leaks AS (
  SELECT event_date AS audit_date, event_timestamp, user_email, department, session_id,
    {_redact("prompt_text")} AS flagged_content_snippet FROM texted WHERE event_name = 'user_prompt')"""
    flagged = "contains(flagged_content_snippet, '[REDACTED_')"
    q["v_security_leak_audit"] = _with(CANON, _texted("canon"), leak_rows, select=f"SELECT * FROM leaks WHERE {flagged}")
    q["v_executive_daily_kpis"] = _with(CANON, COSTS, EXECUTIVE_DAYS, select="SELECT * FROM executive_days")
    q["v_tool_adoption_matrix"] = _with(CANON, TOOL_DAYS, MATRIX, select="SELECT * FROM matrix")
    q["v_department_cost"] = _with(CANON, COSTS, DEPARTMENT_DAYS, select="SELECT * FROM department_days")
    q["role_executive_view"] = _with(CANON, COSTS, DEPARTMENT_DAYS, _texted("canon"), leak_rows, select=f"""
SELECT d.*, flagged_prompts FROM department_days d LEFT JOIN (
  SELECT audit_date AS metric_date, coalesce(department, 'Unassigned') AS department, count(*) AS flagged_prompts
  FROM leaks WHERE {flagged} GROUP BY 1, 2) USING (metric_date, department)""")
    q["v_daily_org_usage"] = _with(CANON, USER_SESSIONS, USAGE, select="""
SELECT usage_date, org_id, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(prompts) AS BIGINT) AS prompts,
  CAST(sum(responses) AS BIGINT) AS responses, CAST(sum(tool_events) AS BIGINT) AS tool_events,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(cost_units) AS BIGINT) AS cost_units FROM daily_usage GROUP BY 1, 2""")
    q["kpi_scorecard"] = _with(CANON, COSTS, select=f"""
SELECT count(DISTINCT user_email) AS active_developers_30d, count(DISTINCT session_id) AS total_coding_sessions,
  CAST(sum(i + o + cc + cr) AS BIGINT) AS total_tokens_used, {_cents("sum(cost_units)")} AS total_investment_usd,
  {_ratio("sum(cost_units)", "count(DISTINCT user_email) * 1000000", 0)} / 100 AS avg_cost_per_dev_usd
FROM costs WHERE event_timestamp >= {LAST_DAY} - 30""")
    q["kpi_tool_matrix"] = _with(CANON, select=f"""
SELECT tool_name, count(*) AS total_executions_30d, count(DISTINCT user_email) AS active_developers_using_tool,
  {_ratio("count(*) FILTER (WHERE exit_code <> 0)", "count(*)", 2, 100)} AS failure_rate_pct,
  {_ratio("sum(duration_ms)", "count(duration_ms)", 0)} AS avg_execution_time_ms
FROM canon WHERE event_name LIKE 'tool%' AND event_timestamp >= {LAST_DAY} - 30 GROUP BY tool_name""")
    q["kpi_tool_matrix_literal"] = _with(CANON, TOOL_DAYS, MATRIX, select=f"""
SELECT tool_name, CAST(sum(total_executions) AS BIGINT) AS total_executions_30d,
  count(DISTINCT unique_users) AS active_developers_using_tool,
  {_ratio("sum(CAST(round(error_rate_pct * 100) AS BIGINT))", "count(error_rate_pct) * 100", 2)} AS avg_failure_rate_pct,
  {_ratio("sum(CAST(round(avg_duration_ms * 100) AS BIGINT))", "count(avg_duration_ms) * 100", 0)} AS avg_execution_time_ms
FROM matrix WHERE metric_date >= {LAST_DAY} - 30 GROUP BY tool_name""")
    q["kpi_department_cost"] = _with(CANON, COSTS, select=f"""
SELECT coalesce(department, 'Unassigned') AS department, count(DISTINCT user_email) AS dev_count,
  CAST(sum(i) AS BIGINT) AS input_tokens, CAST(sum(o) AS BIGINT) AS output_tokens, CAST(sum(cr) AS BIGINT) AS cached_tokens,
  {_ratio("sum(cr)", "sum(i + cr)", 1, 100)} AS cache_hit_ratio_pct, {_cents("sum(cost_units)")} AS total_department_cost_usd
FROM costs WHERE event_timestamp >= {LAST_DAY} - 30 GROUP BY 1""")
    q["kpi_department_cost_literal"] = _with(CANON, COSTS, DEPARTMENT_DAYS, select=f"""
SELECT department, count(DISTINCT active_users) AS dev_count, CAST(sum(total_input_tokens) AS BIGINT) AS input_tokens,
  CAST(sum(total_output_tokens) AS BIGINT) AS output_tokens, CAST(sum(total_cache_read_tokens) AS BIGINT) AS cached_tokens,
  {_ratio("sum(total_cache_read_tokens)", "sum(total_input_tokens + total_cache_read_tokens)", 1, 100)} AS cache_hit_ratio_pct,
  CAST(sum(CAST(round(total_cost_usd * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_department_cost_usd
FROM department_days WHERE metric_date >= {LAST_DAY} - 30 GROUP BY department""")
    q["kpi_dau_trend"] = _with(CANON, COSTS, EXECUTIVE_DAYS, select="""
SELECT metric_date, active_developers_dau, total_sessions, total_spend_usd AS daily_spend_usd FROM executive_days""")
    q["kpi_security_audit"] = _with(CANON, _texted("canon"), leak_rows, select=f"""
SELECT audit_date, department, count(*) AS flagged_prompts,
  CAST(sum(len(string_split(flagged_content_snippet, '[REDACTED_')) - 1) AS BIGINT) AS secrets_redacted,
  count(DISTINCT user_email) AS impacted_developers
FROM leaks WHERE {flagged} AND event_timestamp >= {LAST_DAY} - 30 GROUP BY 1, 2""")

    # daily usage and transcripts
    is_response, is_tool = "event_name = 'assistant_response'", "event_name LIKE 'tool%'"
    q["responses_by_user"] = _with(CANON, USER_SESSIONS, select=_by_user(is_response, "responses"))
    q["tools_by_user"] = _with(CANON, USER_SESSIONS, select=_by_user(is_tool, "tool_events"))
    q["daily_user_usage"] = _with(CANON, USER_SESSIONS, USAGE, select="SELECT * FROM daily_usage")
    q["daily_user_usage_literal"] = _with(CANON, USER_SESSIONS, f"""
s AS (SELECT CAST(started_at AS DATE) AS usage_date, org_id, user_account_uuid, count(DISTINCT session_id) AS sessions,
    CAST(sum(total_input_tokens) AS BIGINT) AS input_tokens, CAST(sum(total_output_tokens) AS BIGINT) AS output_tokens,
    CAST(sum(total_cost_units) AS BIGINT) AS cost_units FROM user_sessions GROUP BY 1, 2, 3),
p AS (SELECT event_date AS usage_date, org_id, user_account_uuid, count(*) AS prompts FROM canon
    WHERE event_name = 'user_prompt' GROUP BY 1, 2, 3),
r AS ({_by_user(is_response, "responses", "user_sessions")}),
t AS ({_by_user(is_tool, "tool_events", "user_sessions")})""", select="""
SELECT usage_date, org_id, user_account_uuid, coalesce(sessions, 0) AS sessions, coalesce(input_tokens, 0) AS input_tokens,
  coalesce(output_tokens, 0) AS output_tokens, coalesce(cost_units, 0) AS cost_units, coalesce(prompts, 0) AS prompts,
  coalesce(responses, 0) AS responses, coalesce(tool_events, 0) AS tool_events
FROM s FULL JOIN p USING (usage_date, org_id, user_account_uuid) FULL JOIN r USING (usage_date, org_id, user_account_uuid)
  FULL JOIN t USING (usage_date, org_id, user_account_uuid)""")
    q["compliance_transcript_lines"] = _with(CANON, ORDERED, _texted("ordered"), select=_transcript(
        "texted", f"md5({_redact('p.prompt_text')})", f"md5({_redact('r.response_text')})"))
    everything = (_redact("p.prompt_text", ALL_RULES), _redact("r.response_text", ALL_RULES))
    q["compliance_masked"] = _with(CANON, ORDERED, _texted("ordered"), select=_transcript("texted", *everything).replace(
        "p.user_account_uuid,", "substring(sha256(p.user_account_uuid), 1, 32) AS user_account_uuid,"))
    q["conversation_transcript"] = _with(TURNS, select="""
SELECT p.session_id, p.prompt_id, p.event_sequence AS prompt_sequence, p.text AS prompt_text,
  r.event_sequence AS response_sequence, r.text AS response_text
FROM (SELECT * FROM turns WHERE role = 'user') p LEFT JOIN (SELECT * FROM turns WHERE role = 'assistant') r
  ON p.session_id = r.session_id AND p.prompt_id IS NOT DISTINCT FROM r.prompt_id""")
    q["transcript_nearest"] = _with(CANON, select="""
SELECT session_id, event_id AS prompt_event_id, event_timestamp AS prompt_ts, next.id AS response_event_id,
  next.ts AS response_ts
FROM (SELECT *, first(CASE WHEN event_name = 'assistant_response' THEN {'ts': event_timestamp, 'id': event_id} END
        IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM canon)
WHERE event_name = 'user_prompt'""".replace("first(", "first_value("))

    lost_session = "CASE WHEN k % 19 <> 0 THEN session_id END AS session_id"
    q["transcript_lost_sessions"] = _with(
        CANON, ORDERED, _texted(f"(SELECT * REPLACE ({lost_session}) FROM ordered)"),
        select=_transcript("texted", "md5(p.prompt_text)", "md5(r.response_text)"))
    nearest = q["transcript_nearest"].replace("FROM canon)", f"FROM (SELECT * REPLACE ({lost_session}) FROM canon))")
    for part in ("id", "ts"):
        nearest = nearest.replace(f"next.{part} AS", f"CASE WHEN session_id IS NOT NULL THEN next.{part} END AS")
    q["nearest_lost_sessions"] = nearest
    q["trace_lost_events"] = _with(CANON, ORDERED, f"""
lost AS (SELECT * REPLACE ({lost_session}, CASE WHEN k % 23 <> 0 THEN event_sequence END AS event_sequence) FROM ordered),
known AS (SELECT *, max(CASE WHEN event_name = 'user_prompt' THEN event_sequence END)
    OVER (PARTITION BY session_id ORDER BY event_sequence) AS s
  FROM lost WHERE session_id IS NOT NULL AND event_sequence IS NOT NULL)""", select="""
SELECT k.session_id, k.prompt_id, k.event_sequence - k.s AS step, k.event_sequence, k.event_name,
  (epoch_us(k.event_timestamp) - epoch_us(p.event_timestamp)) // 1000 AS offset_ms
FROM known k JOIN known p ON p.session_id = k.session_id AND p.event_sequence = k.s
UNION ALL SELECT session_id, prompt_id, NULL, event_sequence, event_name, NULL FROM lost
WHERE session_id IS NULL OR event_sequence IS NULL""")

    # governance
    q["validate_contract"] = _with(CANON, select="""
SELECT event_id, concat_ws(',', CASE WHEN k % 19 = 0 THEN 'missing:session_id' END,
  CASE WHEN k % 23 = 0 THEN 'missing:org_id' END, CASE WHEN k % 13 = 0 THEN 'enum:event_name' END,
  CASE WHEN k % 17 = 0 THEN 'format:event_timestamp' END, CASE WHEN k % 29 = 0 THEN 'type:input_tokens' END,
  CASE WHEN k % 31 = 0 THEN 'type:cost_usd' END) AS violations FROM canon""")
    faults = {
        "missing:event_name": "event_id % 41 = 0",
        "missing:event_timestamp": "event_id % 37 = 0",
        "missing:session_id": "event_id % 19 = 0",
        "missing:org_id": "event_id % 23 = 0",
        "enum:event_name": "event_id % 13 = 0 AND event_id % 41 <> 0",
        "format:event_timestamp": "event_id % 17 = 0 AND event_id % 37 <> 0",
        "type:input_tokens": "event_id % 29 = 0",
        "type:cost_usd": "event_id % 31 = 0",
    }
    q["contract_violations"] = " UNION ALL ".join(
        f"SELECT '{name}' AS violation, count(*) AS records FROM events WHERE {fault} HAVING count(*) > 0"
        for name, fault in faults.items()
    )
    q["length_mismatch"] = """
SELECT doc_id, n_chars - doc_id % 2 AS declared, CAST(length(text) AS INTEGER) AS actual_length
FROM documents WHERE length(text) <> n_chars - doc_id % 2"""
    q["retention_classify"] = _with(CANON, select=f"""
SELECT *, CASE WHEN age_days > 90 THEN 'archive' WHEN age_days > 7 THEN 'cool' ELSE 'hot' END AS raw_tier,
  CASE WHEN age_days > 30 THEN 'purge' ELSE 'keep' END AS quarantine_action,
  CASE WHEN age_days > 3 THEN 'purge' ELSE 'keep' END AS stage_action,
  CASE WHEN age_days > 7 THEN 'vacuum' ELSE 'keep' END AS bronze_history,
  CASE WHEN age_days > 30 THEN 'vacuum' ELSE 'keep' END AS silver_history
FROM (SELECT event_date, count(*) AS events, CAST(date_diff('day', event_date, {LAST_DAY} + 70) AS INTEGER) AS age_days
      FROM canon GROUP BY event_date)""")
    prompts_only = _texted("(SELECT * FROM canon WHERE event_name = 'user_prompt')")
    q["dlp_verdict"] = _with(CANON, prompts_only, JUDGED, select="""
SELECT *, CASE WHEN matched <> '' THEN 'deny' ELSE 'allow' END AS verdict,
  CASE WHEN matched <> '' THEN split_part(matched, ',', 1) END AS reason FROM judged""")
    q["dlp_shadow_report"] = _with(CANON, prompts_only, JUDGED, select="""
SELECT rule, count(*) AS would_deny, count(*) FILTER (WHERE rule = split_part(matched, ',', 1)) AS as_first_reason
FROM (SELECT matched, unnest(string_split(matched, ',')) AS rule FROM judged WHERE matched <> '') GROUP BY rule""")
    q["risky_commands"] = _with(CANON, select=r"""
SELECT event_id, event_date, session_id, user_email, tool_name, command, risk FROM (
  SELECT *, json_extract_string(tool_input, '$.command') AS command FROM canon WHERE event_name LIKE 'tool%')
JOIN (VALUES ('download', '\b(?:curl|wget)\b'), ('package_install', '\bpip3?\s+install\b'), ('dynamic_code', '\beval\b'))
  AS rules(risk, pattern) ON regexp_matches(command, pattern)""")
    q["security_signals"] = _with(CANON, AUDIT_EVENTS, select="""
SELECT event_date, signal, count(*) AS events, count(DISTINCT user_email) AS users FROM signals WHERE signal IS NOT NULL GROUP BY 1, 2""")
    q["ingest_lag"] = _with(CANON, select="""
SELECT event_date, event_name, count(*) AS events, round(quantile_cont(lag, 0.5), 3) AS p50_seconds,
  round(quantile_cont(lag, 0.95), 3) AS p95_seconds, max(lag) AS max_seconds,
  count(*) FILTER (WHERE lag > 300) AS breaches, count(*) FILTER (WHERE lag > 300) > 0 AS breached
FROM (SELECT *, CASE WHEN event_name = 'api_error' THEN k * 10 ELSE k END AS lag FROM canon) GROUP BY 1, 2""")

    # documented analyses
    q["retry_exhausted"] = _with(CANON, select="""
SELECT event_date, model, status_code, count(*) AS errors, count(*) FILTER (WHERE attempt >= 11) AS exhausted
FROM canon WHERE event_name = 'api_error' GROUP BY 1, 2, 3""")
    q["session_recovery"] = _with(CANON, """
failed AS (SELECT session_id, event_timestamp, event_id, count(*) OVER (PARTITION BY session_id) AS exhausted
  FROM canon WHERE event_name = 'api_error' AND attempt >= 11
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC) = 1)""", select="""
SELECT session_id, exhausted, event_timestamp AS last_exhausted_at,
  CASE WHEN EXISTS (SELECT 1 FROM canon c WHERE c.session_id = f.session_id AND c.event_name = 'assistant_response'
    AND (c.event_timestamp > f.event_timestamp OR (c.event_timestamp = f.event_timestamp AND c.event_id > f.event_id)))
    THEN 'recovered' ELSE 'stalled' END AS outcome FROM failed f""")
    q["api_latency"] = _with(CANON, select="""
SELECT event_date, model, count(*) AS requests, round(quantile_cont(latency_ms, 0.5), 3) AS p50_ms,
  round(quantile_cont(latency_ms, 0.95), 3) AS p95_ms, max(latency_ms) AS max_ms
FROM canon WHERE latency_ms IS NOT NULL GROUP BY 1, 2""")
    q["tool_success"] = _with(CANON, """
t AS (SELECT tool_name, count(*) AS results, count(*) FILTER (WHERE exit_code = 0) AS succeeded,
  count(*) FILTER (WHERE exit_code <> 0) AS failed, sum(duration_ms) AS ms, count(duration_ms) AS timed
  FROM canon WHERE event_name = 'tool_result' GROUP BY 1)""", select=f"""
SELECT tool_name, results, succeeded, failed, {_ratio("succeeded", "succeeded + failed", 2, 100)} AS success_rate_pct,
  {_ratio("ms", "timed", 2)} AS avg_duration_ms FROM t""")
    q["tool_errors"] = _with(CANON, select="""
SELECT tool_name, error_type, count(*) AS errors FROM canon WHERE error_type IS NOT NULL GROUP BY 1, 2""")
    q["tool_decision_outcome"] = _with(CANON, ORDERED, select="""
SELECT *, CASE WHEN decision = 'reject' THEN CASE WHEN results = 0 THEN 'rejected' ELSE 'result_after_reject' END
  WHEN results = 0 THEN 'no_result' WHEN failures > 0 THEN 'failed' ELSE 'executed' END AS outcome
FROM (SELECT tool_use_id, max(decision) AS decision, count(*) FILTER (WHERE event_name = 'tool_result') AS results,
  count(*) FILTER (WHERE event_name = 'tool_result' AND exit_code <> 0) AS failures
  FROM ordered WHERE tool_use_id IS NOT NULL GROUP BY 1)""")
    q["prompt_trace"] = _with(CANON, ORDERED, select="""
SELECT e.session_id, e.prompt_id, e.event_sequence - p.event_sequence AS step, e.event_sequence, e.event_name,
  (epoch_us(e.event_timestamp) - epoch_us(p.event_timestamp)) // 1000 AS offset_ms
FROM ordered e JOIN (SELECT * FROM ordered WHERE event_name = 'user_prompt') p USING (prompt_id)""")
    q["compaction_ratio"] = _with(CANON, f"""
c AS (SELECT event_date, {_case("k", "auto", "manual")} AS trigger, k % 9 <> 0 AS ok,
  CAST(floor(value * 1000) AS BIGINT) AS pre, CAST(floor(value * 150) AS BIGINT) AS post
  FROM canon WHERE event_name = 'api_error'),
g AS (SELECT event_date, trigger, count(*) AS compactions, count(*) FILTER (WHERE ok) AS succeeded,
  CAST(sum(pre) FILTER (WHERE ok) AS BIGINT) AS pre_tokens, CAST(sum(post) FILTER (WHERE ok) AS BIGINT) AS post_tokens
  FROM c GROUP BY 1, 2)""", select=f"SELECT *, {_ratio('post_tokens', 'pre_tokens', 2, 100)} AS remaining_pct FROM g")
    q["tool_wait_breakdown"] = _with(CANON, ORDERED, """
calls AS (SELECT tool_use_id, max(CASE WHEN event_name = 'tool_decision' THEN tool_name END) AS tool_name,
  sum(wait_ms) AS wait_ms, sum(duration_ms) AS execute_ms FROM ordered WHERE tool_use_id IS NOT NULL GROUP BY 1),
g AS (SELECT tool_name, count(*) AS calls, count(execute_ms) AS executed_calls, CAST(sum(wait_ms) AS BIGINT) AS wait_ms,
  CAST(sum(execute_ms) AS BIGINT) AS execute_ms FROM calls GROUP BY 1)""", select=f"""
SELECT *, {_ratio("wait_ms", "wait_ms + execute_ms", 2, 100)} AS wait_share_pct FROM g""")
    # Children merged by a running maximum of their ends; the way down from the roots by recursion.
    tree = """
s AS (SELECT *, row_number() OVER o AS seq, max(CASE WHEN event_name = 'user_prompt' THEN event_sequence END) OVER o AS p,
    max(CASE WHEN event_name = 'assistant_response' THEN event_sequence END) OVER o AS r,
    max(CASE WHEN event_name = 'tool_decision' THEN event_sequence END) OVER o AS d
  FROM ordered WINDOW o AS (PARTITION BY session_id ORDER BY event_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT *, CASE WHEN event_name = 'user_prompt' THEN NULL
    WHEN event_name = 'assistant_response' AND query_source <> 'subagent' THEN p
    WHEN event_name IN ('assistant_response', 'tool_result') THEN CASE WHEN d > coalesce(p, 0) THEN d ELSE p END
    ELSE CASE WHEN r > coalesce(p, 0) THEN r ELSE p END END AS up,
    event_sequence * 40 AS lo, event_sequence * 40 + coalesce(latency_ms, duration_ms, wait_ms,
      CASE WHEN event_name = 'user_prompt' THEN CAST(floor(value * 100) AS BIGINT) END, 0) AS hi FROM s),
n AS (SELECT b.session_id, b.event_sequence AS seq, 'e' || b.event_id AS span_id, b.lo, b.hi, b.event_name, b.up, u.lo AS ulo, u.hi AS uhi
  FROM b LEFT JOIN b u ON u.session_id = b.session_id AND u.event_sequence = b.up),
ch AS (SELECT session_id, up, greatest(lo, ulo) AS lo, least(hi, uhi) AS hi FROM n WHERE up IS NOT NULL AND greatest(lo, ulo) < least(hi, uhi)),
cv AS (SELECT session_id, up, CAST(sum(greatest(0, hi - greatest(lo, coalesce(before, lo)))) AS BIGINT) AS covered FROM (
    SELECT *, max(hi) OVER (PARTITION BY session_id, up ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ch)
  GROUP BY session_id, up),
la AS (SELECT session_id, seq FROM n WHERE up IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY session_id, up ORDER BY hi DESC, lo DESC, span_id) = 1),
w(session_id, seq, root_id, depth, critical, state) AS (
  SELECT session_id, seq, span_id, CAST(0 AS BIGINT), true, CASE WHEN event_name = 'user_prompt' THEN 'rooted' ELSE 'orphan' END FROM n WHERE up IS NULL
  UNION ALL SELECT n.session_id, n.seq, w.root_id, w.depth + 1, w.critical AND la.seq IS NOT NULL, 'rooted'
  FROM w JOIN n ON n.session_id = w.session_id AND n.up = w.seq LEFT JOIN la ON la.session_id = n.session_id AND la.seq = n.seq),
t AS (SELECT n.span_id, w.root_id, w.depth, w.state, n.hi - n.lo AS duration_ms, n.hi - n.lo - coalesce(covered, 0) AS self_ms, w.critical, n.event_name
  FROM n JOIN w USING (session_id, seq) LEFT JOIN cv ON cv.session_id = n.session_id AND cv.up = n.seq)"""
    q["span_tree"] = "WITH RECURSIVE " + _with(CANON, ORDERED, tree, select="""
SELECT span_id, root_id, depth, state, duration_ms, self_ms, critical FROM t""").lstrip()[len("WITH"):]
    q["trace_summary"] = "WITH RECURSIVE " + _with(CANON, ORDERED, tree, select="""
SELECT root_id, min(CASE WHEN depth = 0 THEN state END) AS state, count(*) AS spans, max(depth) AS levels, CAST(sum(self_ms) AS BIGINT) AS self_ms,
  CAST(sum(CASE WHEN critical THEN self_ms ELSE 0 END) AS BIGINT) AS critical_ms, count(*) FILTER (WHERE event_name = 'api_error') AS retries,
  CAST(sum(CASE WHEN event_name = 'api_error' THEN duration_ms ELSE 0 END) AS BIGINT) AS retry_ms FROM t GROUP BY root_id""").lstrip()[len("WITH"):]
    q["token_breakdown"] = _with(CANON, COSTS, select=" UNION ALL ".join(
        f"SELECT department, model AS model_name, user_email, '{n}' AS token_type, CAST(sum({c}) AS BIGINT) AS tokens "
        "FROM costs GROUP BY 1, 2, 3"
        for n, c in (("input", "i"), ("output", "o"), ("cache_read", "cr"), ("cache_creation", "cc"))))
    q["token_breakdown_by_agent"] = _with(CANON, COSTS, select=" UNION ALL ".join(
        f"SELECT skill_name, agent_name, plugin_name, '{n}' AS token_type, CAST(sum({c}) AS BIGINT) AS tokens "
        "FROM costs GROUP BY 1, 2, 3"
        for n, c in (("input", "i"), ("output", "o"), ("cache_read", "cr"), ("cache_creation", "cc"))))
    q["daily_users_approx"] = _with(CANON, select="""
SELECT event_date AS metric_date, count(DISTINCT user_email) AS active_users, count(DISTINCT session_id) AS sessions, true AS near
FROM canon WHERE event_name = 'assistant_response' GROUP BY 1""")
    q["weekly_users_sketched"] = _with(CANON, """
u AS (SELECT DISTINCT CAST(date_trunc('week', event_date) AS DATE) AS week, user_email FROM canon)""", select="""
SELECT week, count(*) AS active, (SELECT count(*) FROM u p WHERE p.week + 7 = a.week AND NOT EXISTS (
    SELECT 1 FROM u c WHERE c.week = a.week AND c.user_email = p.user_email)) AS lost,
  count(CASE WHEN EXISTS (SELECT 1 FROM u p WHERE p.week + 7 = a.week AND p.user_email = a.user_email) THEN 1 END) AS returning,
  true AS active_near, true AS lost_near, true AS returning_near, true AS hll_near FROM u a GROUP BY week""")
    q["session_adoption"] = _with(CANON, METRICS, select="""
SELECT event_date, count(*) AS sessions, count(*) FILTER (WHERE start_type = 'fresh') AS fresh_sessions,
  count(DISTINCT user_email) AS users
FROM points WHERE metric = 'session.count' AND start_type <> 'agents_view' GROUP BY 1""")
    q["loc_by_model"] = _with(CANON, METRICS, select="""
SELECT model, CAST(coalesce(sum(points) FILTER (WHERE type = 'added'), 0) AS BIGINT) AS lines_added,
  CAST(coalesce(sum(points) FILTER (WHERE type = 'removed'), 0) AS BIGINT) AS lines_removed
FROM points WHERE metric = 'lines_of_code.count' GROUP BY 1""")
    q["daily_output"] = _with(CANON, METRICS, select="""
SELECT event_date, department, count(*) FILTER (WHERE metric = 'commit.count') AS commits,
  count(*) FILTER (WHERE metric = 'pull_request.count') AS pull_requests
FROM points WHERE metric IN ('commit.count', 'pull_request.count') GROUP BY 1, 2""")
    q["commits_by_model"] = _with(CANON, METRICS, """
used AS (SELECT DISTINCT session_id, model FROM canon WHERE query_source = 'main'),
made AS (SELECT session_id, sum(points) AS commits FROM points WHERE metric = 'commit.count' GROUP BY 1)""", select="""
SELECT model, CAST(sum(commits) AS BIGINT) AS commits, count(*) AS sessions FROM used JOIN made USING (session_id) GROUP BY 1""")
    q["top_cost_sessions"] = _with(CANON, COSTS, select="""
SELECT session_id, min(user_email) AS user_email, CAST(sum(cost_units) AS BIGINT) AS cost_units FROM costs GROUP BY 1
ORDER BY cost_units DESC, session_id LIMIT 100""")
    q["spend_by_agent"] = _with(CANON, COSTS, select="""
SELECT skill_name, agent_name, plugin_name, query_source, count(*) AS requests,
  CAST(sum(cost_units) AS BIGINT) AS cost_units, CAST(sum(cost_units) AS DOUBLE) / 100000000 AS cost_usd
FROM costs GROUP BY 1, 2, 3, 4""")
    q["usage_spikes"] = _with(CANON, COSTS, """
d AS (SELECT event_date AS usage_date, department, CAST(sum(cost_units) AS BIGINT) AS cost,
  CAST(sum(i + o) AS BIGINT) AS tokens, count(DISTINCT session_id) AS sessions FROM costs GROUP BY 1, 2)""", select="""
SELECT *, count(*) OVER w AS days_before, coalesce(cost * count(*) OVER w > sum(cost) OVER w * 2, false) AS cost_spike,
  coalesce(tokens * count(*) OVER w > sum(tokens) OVER w * 2, false) AS tokens_spike,
  coalesce(sessions * count(*) OVER w > sum(sessions) OVER w * 2, false) AS sessions_spike
FROM d WINDOW w AS (PARTITION BY department ORDER BY usage_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
    q["user_spikes"] = q["usage_spikes"].replace(", department,", ", user_email,").replace("BY department", "BY user_email")
    active = "(SELECT count(DISTINCT user_email) FROM a WHERE day BETWEEN c.d - {} AND c.d)"
    q["dau_wau_mau"] = _with(CANON, """
a AS (SELECT DISTINCT user_email, event_date AS day FROM canon),
c AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM a), (SELECT max(day) FROM a), INTERVAL 1 DAY)) AS DATE)
      AS d)""", select=f"""
SELECT d AS usage_date, {active.format(0)} AS dau, {active.format(6)} AS wau, {active.format(29)} AS mau FROM c""")
    q["edit_acceptance"] = _with(CANON, METRICS, """
g AS (SELECT language, source, count(*) AS decisions, count(*) FILTER (WHERE decision = 'accept') AS accepted
  FROM points WHERE metric = 'code_edit_tool.decision' GROUP BY 1, 2)""", select=f"""
SELECT *, {_ratio("accepted", "decisions", 2, 100)} AS acceptance_pct FROM g""")
    q["active_time"] = _with(CANON, METRICS, select="""
SELECT event_date, department, CAST(coalesce(sum(points) FILTER (WHERE type = 'user'), 0) AS BIGINT) AS user_seconds,
  CAST(coalesce(sum(points) FILTER (WHERE type = 'cli'), 0) AS BIGINT) AS cli_seconds
FROM points WHERE metric = 'active_time.total' GROUP BY 1, 2""")
    grouped = """
SELECT {} AS {}, count(*) AS requests, CAST(sum(cost_units) AS BIGINT) AS cost_units,
  CAST(sum(cost_units) AS DOUBLE) / 100000000 AS cost_usd FROM costs GROUP BY 1"""
    q["cost_by_cost_center"] = _with(CANON, COSTS, select=grouped.format("'eng-' || (user_id % 7)", "cost_center"))
    q["cost_by_team"] = _with(CANON, COSTS, select=grouped.format("'team ' || (user_id % 4)", "team_id"))
    q["spend_forecast"] = _with(CANON, COSTS, """
a AS (SELECT max(CAST(ts AS DATE)) AS last FROM events),
k AS (SELECT * FROM costs, a WHERE NOT (coalesce(department, '') = 'mobile' AND event_date > last - 10)),
g AS (SELECT department, last, min(event_date) AS first FROM k GROUP BY 1, 2),
c AS (SELECT department, CAST(x AS BIGINT) AS x, first + CAST(x AS INTEGER) AS day FROM g, range(0, 400) r(x) WHERE first + CAST(x AS INTEGER) <= last),
y AS (SELECT department, event_date AS day, (sum(cost_units) + 500000) // 1000000 AS y FROM k GROUP BY 1, 2),
e AS (SELECT c.department, x, coalesce(y, 0) AS y FROM c LEFT JOIN y ON c.department IS NOT DISTINCT FROM y.department AND c.day = y.day),
f AS (SELECT department, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM e GROUP BY 1),
s AS (SELECT *, CAST(n * sxy - sx * sy AS DOUBLE) / nullif(CAST(n * sxx - sx * sx AS DOUBLE), 0) AS slope FROM f),
i AS (SELECT *, (CAST(sy AS DOUBLE) - slope * CAST(sx AS DOUBLE)) / n AS intercept FROM s),
p AS (SELECT *, intercept * 30.0::DOUBLE + slope * (30.0::DOUBLE * (n - 1) + 465.0::DOUBLE) AS predicted FROM i)""", select="""
SELECT department, n AS days, CAST(sy AS BIGINT) AS spend_cents, round(slope, 4) AS slope_cents_per_day,
  round(predicted, 2) AS forecast_cents, predicted > 2500.0 AS over_quota FROM p""")
    q["prompt_complexity"] = r"""
SELECT *, CASE WHEN score >= 200 THEN 'high' WHEN score >= 50 THEN 'medium' ELSE 'low' END AS complexity
FROM (SELECT *, words + 5 * (lines - 1) + 10 * questions AS score FROM (
  SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS chars,
    CAST(len(regexp_extract_all(text, '[^ \n\t]+')) AS BIGINT) AS words,
    CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines,
    CAST(len(string_split(text, '?')) - 1 AS BIGINT) AS questions FROM conversations WHERE role = 'user'))"""
    q["conversation_depth"] = _with(TURNS, """
g AS (SELECT session_id, prompt_id, count(*) AS turns, count(*) FILTER (WHERE role = 'user') AS prompts,
  count(*) FILTER (WHERE role = 'assistant') AS responses,
  coalesce(sum(length(text)) FILTER (WHERE role IN ('user', 'assistant')), 0) AS chars FROM turns GROUP BY 1, 2)""", select="""
SELECT session_id, CAST(sum(turns) AS BIGINT) AS turns, CAST(sum(prompts) AS BIGINT) AS prompts,
  CAST(sum(responses) AS BIGINT) AS responses, count(*) FILTER (WHERE prompts > 0 AND responses > 0) AS answered_prompts,
  CAST(sum(chars) AS BIGINT) AS chars FROM g GROUP BY 1""")
    q["session_tools"] = _with(CANON, """
u AS (SELECT session_id, tool_name, count(*) AS n FROM canon WHERE event_name LIKE 'tool%' GROUP BY 1, 2)""", select="""
SELECT session_id, CAST(sum(n) OVER w AS BIGINT) AS tool_events, count(*) OVER w AS tools, tool_name AS top_tool
FROM u WINDOW w AS (PARTITION BY session_id)
QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY n DESC, tool_name) = 1""")

    # corpus
    q["kb_parse_index"] = _with(ENTRIES, select="SELECT page_id, title, url, summary, rel FROM entries")
    q["kb_manifest"] = _with(ENTRIES, select="""
SELECT rel, page_id, url FROM entries QUALIFY row_number() OVER (
  PARTITION BY rel ORDER BY CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END, page_id) = 1""")
    q["kb_header"] = _with(ENTRIES, select="""
SELECT page_id, md5('---' || chr(10) || 'title: "' || replace(title, '"', '''') || '"' || chr(10) || 'source: "' || url || '"'
  || chr(10) || 'html: "' || replace(url, '.md', '') || '"' || chr(10) || 'summary: "' || summary || '"' || chr(10)
  || 'fetched: true' || chr(10) || '---' || chr(10) || chr(10)) AS header_md5 FROM entries""")
    q["kb_category"] = _with(PAGES, select="""
SELECT page_id, rel, CASE WHEN rel NOT LIKE 'en/%' THEN 'other' WHEN len(string_split(rel, '/')) = 2 THEN 'core'
  ELSE split_part(rel, '/', 2) END AS category FROM paged""")
    q["kb_slug"] = _with(PAGES, select=r"""
SELECT page_id, slug, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS anchor
FROM slugged""")
    q["kb_front_matter"] = _with(PAGES, select="""
SELECT page_id, rel, slug, title, summary, source, replace(source, '.md', '') AS html, bytes FROM (
  SELECT page_id, rel, slug,
    CASE page_id % 4 WHEN 0 THEN trim(title, '"') WHEN 1 THEN trim(trim(title), '"') ELSE slug END AS title,
    CASE WHEN page_id % 4 = 0 THEN 'About it' ELSE '' END AS summary,
    CASE WHEN page_id % 4 = 0 THEN url ELSE 'https://docs.example.com/' || rel END AS source,
    CAST(strlen(CASE page_id % 4
        WHEN 0 THEN '---' || chr(10) || 'title: "' || title || '"' || chr(10) || 'summary: "About it"' || chr(10)
          || 'source: "' || url || '"' || chr(10) || '---' || chr(10) || chr(10)
        WHEN 1 THEN '---' || chr(10) || 'title: ' || title || chr(10) || '---' || chr(10)
        WHEN 2 THEN '---' || chr(10) || 'title: open' || chr(10) ELSE '' END
      || '# ' || title || chr(10)) AS BIGINT) AS bytes
  FROM slugged)""")
    q["page_metadata"] = _with(PAGES, select="SELECT page_id, title, lang, bytes FROM paged")
    q["kb_taxonomy_sections"] = _with(PAGES, select="""
SELECT section, slug, page_id, bytes FROM taxonomy JOIN latest USING (slug)""")
    q["kb_leftover"] = _with(PAGES, select="""
SELECT slug, page_id FROM latest WHERE slug NOT IN (SELECT slug FROM taxonomy)""")
    q["kb_stats"] = _with(PAGES, select="""
SELECT count(*) AS pages, CAST(sum(bytes) AS BIGINT) AS total_bytes,
  count(*) FILTER (WHERE slug NOT IN (SELECT slug FROM taxonomy)) AS uncategorised FROM slugged""")
    q["kb_ok_failed"] = _with(PAGES, select="""
SELECT page_id, rel, NOT (page_id % 5 = 0 AND page_id % 2 <> 0) AS ok FROM paged""")

    # files and streams
    good = " WHERE event_id % 97 <> 0"
    q["bronze_ingest"] = _with(CANON, select=LANDED + good)
    q["bronze_copy_into"] = q["bronze_ingest"]
    q["copy_into_history"] = """
SELECT event_id % 3 AS load_id, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum, count(DISTINCT event_id) AS different
FROM events WHERE event_id % 97 <> 0 GROUP BY 1"""
    q["bronze_quarantine"] = "SELECT event_id FROM events WHERE event_id % 97 = 0"
    q["bronze_schema_merge"] = _with(CANON, select="""
SELECT event_id, event_name, CASE WHEN event_timestamp >= TIMESTAMP '2024-01-16' THEN model END AS model,
  CASE WHEN event_timestamp >= TIMESTAMP '2024-01-16' THEN department END AS department FROM canon""")
    q["schema_drift"] = _with(CANON, """
d AS (SELECT *, day(event_date) AS dom, CAST(date_trunc('week', event_date) AS DATE) AS week FROM canon),
v AS (SELECT week, 'event_id' AS field, 'BIGINT' AS kind FROM d UNION ALL SELECT week, 'event_name', 'STRING' FROM d
  UNION ALL SELECT week, 'attributes.region', 'STRING' FROM d WHERE dom >= 10 AND department IS NOT NULL
  UNION ALL SELECT week, 'attributes.score', CASE WHEN dom >= 17 THEN 'DECIMAL' ELSE 'BIGINT' END FROM d
  UNION ALL SELECT week, 'attributes.code', CASE WHEN dom < 24 THEN 'BIGINT' ELSE 'STRING' END FROM d),
g AS (SELECT week, field, count(*) AS records, max(CASE WHEN kind = 'BIGINT' THEN 1 ELSE 0 END) AS i, max(CASE WHEN kind = 'DECIMAL' THEN 1 ELSE 0 END) AS d,
  max(CASE WHEN kind = 'STRING' THEN 1 ELSE 0 END) AS s FROM v GROUP BY 1, 2),
c AS (SELECT *, max(i) OVER w AS ci, max(d) OVER w AS cd, max(s) OVER w AS cs FROM g WINDOW w AS (PARTITION BY field ORDER BY week)),
n AS (SELECT week, field, records, CASE WHEN s > 0 AND i + d > 0 THEN 'VARIANT' WHEN s > 0 THEN 'STRING' WHEN d > 0 THEN 'DECIMAL' ELSE 'BIGINT' END AS type,
  CASE WHEN cs > 0 AND ci + cd > 0 THEN 'VARIANT' WHEN cs > 0 THEN 'STRING' WHEN cd > 0 THEN 'DECIMAL' ELSE 'BIGINT' END AS known FROM c),
b AS (SELECT *, lag(known) OVER (PARTITION BY field ORDER BY week) AS before FROM n)""", select="""
SELECT week, field, type, records, known, CASE WHEN before IS NULL AND type <> 'VARIANT' THEN 'new' WHEN known = before THEN 'same'
  WHEN known = 'VARIANT' THEN 'conflict' ELSE 'widened' END AS change FROM b""")
    q["bronze_rescued"] = _with(CANON, select="""
SELECT event_id, CASE WHEN event_id % 4 < 2 AND attempt IS NOT NULL THEN 'attempt=' || attempt || ';' ELSE '' END
  || 'event_id=' || event_id AS rescued FROM canon""")
    q["bronze_other_signals"] = _with(CANON, ORDERED, METRICS, select="""
SELECT 'metrics' AS signal, metric AS name, count(*) AS records, CAST(sum(points) AS BIGINT) AS total FROM points GROUP BY 2
UNION ALL SELECT 'traces', CASE WHEN event_name = 'tool_decision' THEN 'tool.blocked_on_user' ELSE 'tool.execution' END,
  count(*), CAST(sum(coalesce(wait_ms, duration_ms)) AS BIGINT) FROM ordered WHERE tool_use_id IS NOT NULL GROUP BY 2""")
    q["serving_sync"] = _with(CANON, COSTS, SESSIONS, USER_SESSIONS, USAGE, _texted("canon"), select=f"""
SELECT 'daily_user_metrics' AS table_name, count(*) AS row_count FROM ({q["daily_user_metrics"]})
UNION ALL SELECT 'tool_adoption_summary', count(*) FROM ({q["tool_adoption_summary"]})
UNION ALL SELECT 'department_cost_attribution', count(*) FROM ({q["department_cost_attribution"]})
UNION ALL SELECT 'security_leak_alerts', count(*) FROM ({alerts})
UNION ALL SELECT 'sessions', count(*) FROM sessions UNION ALL SELECT 'token_costs', count(*) FROM costs
UNION ALL SELECT 'daily_user_usage', count(*) FROM daily_usage""")
    q["sync_changed_days"] = _with(CANON, """
t AS (SELECT event_date, tool_name, event_id = max(event_id) OVER () AS late FROM canon WHERE event_name LIKE 'tool%'),
c AS (SELECT event_date, department, model FROM canon WHERE event_name = 'assistant_response')""", select="""
SELECT 'tool_adoption_summary' AS table_name, count(DISTINCT CASE WHEN NOT late THEN event_date END) AS first, CAST(1 AS BIGINT) AS second,
  CAST(0 AS BIGINT) AS third, (SELECT count(*) FROM (SELECT DISTINCT event_date, tool_name FROM t)) AS row_count, true AS same FROM t
UNION ALL SELECT 'department_cost_attribution', count(DISTINCT event_date), 0, 0,
  (SELECT count(*) FROM (SELECT DISTINCT event_date, department, model FROM c)), true FROM c""")
    q["stage_export"] = _with(CANON, select="""
SELECT event_date AS execution_date, tool_name, count(*) AS total_executions, CAST(year(event_date) AS INTEGER) AS year,
  CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day
FROM canon WHERE event_name LIKE 'tool%' GROUP BY 1, 2""")
    q["stream_dedupe"] = _with(CANON, ORDERED, select=f"""
SELECT session_id, event_name, event_sequence, CASE WHEN event_id % 7 <> 0 THEN event_timestamp END AS event_timestamp
FROM ordered{good}""")
    landed = f"landed AS (SELECT * FROM canon{good})"
    q["stream_silver_fanout"] = _with(CANON, landed, select=fan_out.format("landed"))
    q["stream_latency_sketches"] = _with(CANON, landed, select="""
SELECT event_date, model, count(*) AS requests, true AS p50_near, true AS p95_near FROM landed WHERE latency_ms IS NOT NULL GROUP BY 1, 2""")
    q["stream_followup"] = _with(CANON, landed, """
w AS (SELECT session_id, event_timestamp, event_name = 'api_error' AS failed FROM landed
  WHERE event_name = 'assistant_response' OR event_name = 'api_error' AND attempt >= 11),
e AS (SELECT session_id, max(CASE WHEN failed THEN event_timestamp END) AS f, max(CASE WHEN NOT failed THEN event_timestamp END) AS s FROM w GROUP BY 1)""",
        select="""
SELECT session_id, f AS last_exhausted_at, CASE WHEN s > f THEN 'recovered'
  WHEN epoch_ms(f) + 3600000 <= (SELECT epoch_ms(max(event_timestamp)) FROM w) THEN 'stalled' ELSE 'open' END AS status FROM e WHERE f IS NOT NULL""")
    q["compact_silver"] = _with(CANON, landed, select=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT event_date) AS files, true AS no_more_files, true AS unchanged "
        f"FROM landed WHERE event_name {kind}"
        for t, kind in (("prompts", "= 'user_prompt'"), ("responses", "= 'assistant_response'"), ("tool_executions", "LIKE 'tool%'"),
                        ("token_costs", "= 'assistant_response'"))))
    q["stream_sessions"] = _with(CANON, landed, SESSIONS.replace("FROM canon", "FROM landed"), select="SELECT * FROM sessions")
    q["stream_tool_counts"] = _with(CANON, f"r AS (SELECT * FROM canon{good} AND event_name = 'tool_result')", select="""
SELECT CAST(event_date AS TIMESTAMP) AS window_start, CAST(event_date + 1 AS TIMESTAMP) AS window_end, tool_name,
  count(*) AS results, CAST(sum(duration_ms) AS BIGINT) AS duration_ms
FROM r GROUP BY event_date, tool_name""")
    return q
