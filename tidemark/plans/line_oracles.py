"""SQL for DuckDB of the queries over raw lines, written from the rules of the tables and not from the operators.

Nothing here is shared with the operators: names, pairs and checks are spelled
out again, so that a wrong name or pair on one side shows.
"""

from __future__ import annotations

COUNTS = (
    "user_initiated_interaction_count code_generation_activity_count code_acceptance_activity_count loc_suggested_to_add_sum loc_suggested_to_delete_sum loc_added_sum "
    "loc_deleted_sum distinct_custom_agent_use_count distinct_mcp_use_count distinct_plugin_use_count distinct_skill_use_count distinct_slash_cmd_use_count "
    "daily_active_users daily_active_cli_users daily_active_copilot_app_users daily_active_copilot_cloud_agent_users daily_active_copilot_code_review_users "
    "daily_active_vscode_agent_users daily_passive_copilot_code_review_users weekly_active_users weekly_active_copilot_cloud_agent_users "
    "weekly_active_copilot_code_review_users weekly_active_vscode_agent_users weekly_passive_copilot_code_review_users monthly_active_users "
    "monthly_active_agent_users monthly_active_chat_users monthly_active_copilot_cloud_agent_users monthly_active_copilot_code_review_users "
    "monthly_active_vscode_agent_users monthly_passive_copilot_code_review_users"
).split()
USED = (
    "used_agent used_chat used_cli used_copilot_app used_copilot_coding_agent used_copilot_cloud_agent used_copilot_code_review_active "
    "used_copilot_code_review_passive used_vscode_agent"
).split()
PR_TOTALS = (
    "total_reviewed total_created total_created_by_copilot total_reviewed_by_copilot total_merged total_suggestions total_applied_suggestions "
    "total_merged_created_by_copilot total_copilot_suggestions total_copilot_applied_suggestions total_merged_reviewed_by_copilot"
).split()
PR_MEDIANS = "median_minutes_to_merge median_minutes_to_merge_copilot_authored median_minutes_to_merge_copilot_reviewed".split()
METRICS = (
    "user_initiated_interaction_count interaction_count session_count code_generation_activity_count code_acceptance_activity_count loc_suggested_to_add_sum "
    "loc_suggested_to_delete_sum loc_added_sum loc_deleted_sum"
).split()
PHASE_COUNTS = "phase_number total_engaged_users users_in_phase_28d total_pull_requests_merged".split()
PHASE_AVERAGES = (
    "avg_code_acceptance_activities avg_code_generation_activities avg_loc_added avg_loc_deleted avg_pull_requests_created avg_pull_requests_median_minutes_to_merge "
    "avg_pull_requests_merged avg_pull_requests_minutes_to_review avg_pull_requests_review_cycles avg_pull_requests_reviewed avg_user_initiated_interactions"
).split()
REVIEW_TIMES = (
    "median_minutes_ready_to_first_review p90_minutes_ready_to_first_review median_minutes_first_to_final_review p90_minutes_first_to_final_review "
    "median_minutes_final_review_to_merge p90_minutes_final_review_to_merge"
).split()


def kind(j: str, path: str) -> str:
    return f"coalesce(json_type({j}, '$.{path}'), 'NULL')"


def raw(j: str, path: str) -> str:
    return f"json_extract_string({j}, '$.{path}')"


def whole(j: str, path: str) -> str:
    return f"({kind(j, path)} IN ('BIGINT', 'UBIGINT') AND coalesce(try_cast({raw(j, path)} AS BIGINT) >= 0, false))"


def number(j: str, path: str) -> str:
    return f"({kind(j, path)} IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') AND coalesce(try_cast({raw(j, path)} AS DOUBLE) >= 0, false))"


def text(j: str, path: str) -> str:
    return f"nullif(regexp_replace(CASE WHEN {kind(j, path)} = 'VARCHAR' THEN {raw(j, path)} END, '^\\s+|\\s+$', '', 'g'), '')"


def integer(j: str, path: str) -> str:
    return f"try_cast({raw(j, path)} AS BIGINT)"


def double(j: str, path: str) -> str:
    return f"try_cast({raw(j, path)} AS DOUBLE)"


def iso(j: str, path: str) -> str:
    return f"CASE WHEN {kind(j, path)} = 'VARCHAR' AND regexp_full_match({raw(j, path)}, '\\d{{4}}-\\d\\d-\\d\\d') THEN try_cast({raw(j, path)} AS DATE) END"


def when(bad: str, code: str) -> str:
    return f"CASE WHEN {bad} THEN '{code}' END"


def codes(checks: list[str]) -> str:
    return f"list_sort(list_distinct([x FOR x IN [{', '.join(checks)}] IF x IS NOT NULL]))"


def bad_counts(j: str, names: list[str], prefix: str = "", after: str = "_must_be_nonnegative_number") -> list[str]:
    return [when(f"{kind(j, prefix + n)} <> 'NULL' AND NOT {whole(j, prefix + n)}", f"{prefix}{n}{after}") for n in names]


def bad_numbers(j: str, names: list[str], prefix: str = "") -> list[str]:
    return [when(f"{kind(j, prefix + n)} <> 'NULL' AND NOT {number(j, prefix + n)}", f"{prefix}{n}_must_be_nonnegative_number") for n in names]


def bad_strings(j: str, names: list[str]) -> list[str]:
    return [when(f"{kind(j, n)} NOT IN ('NULL', 'VARCHAR')", f"{n}_must_be_string") for n in names]


def bad_ids(j: str, names: list[str]) -> list[str]:
    return [when(f"NOT {whole(j, n)}", f"{n}_must_be_nonnegative_integer") for n in names]


# ---- lines and records

_RAW = """lines AS (SELECT record_id, scope_slug, report_type, report_day, source_file AS path, line_no, strftime(source_ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp,
    json_valid(raw_json) AS valid, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS j FROM silver_users_edge_cases WHERE trim(raw_json) <> '')"""
#: One row per record; an entity line that holds an array of days gives one per entry, with what it inherits.
_RECORDS = f"""{_RAW},
  plain AS (SELECT record_id, scope_slug, report_type, report_day, path, line_no, stamp, valid, j, 0 AS day_index, false AS is_entry,
      json_extract(j, '$.enterprise_id') AS e_id, json_extract(j, '$.organization_id') AS o_id, json_extract(j, '$.report_start_day') AS s_day, json_extract(j, '$.report_end_day') AS t_day
    FROM lines WHERE NOT (report_type = 'entity' AND valid AND {kind('j', 'day_totals')} = 'ARRAY')),
  wrapped AS (SELECT record_id, scope_slug, report_type, report_day, path, line_no, stamp, j AS w, unnest(json_extract(j, '$.day_totals[*]')) AS e,
      CAST(generate_subscripts(json_extract(j, '$.day_totals[*]'), 1) - 1 AS INTEGER) AS day_index
    FROM lines WHERE report_type = 'entity' AND valid AND {kind('j', 'day_totals')} = 'ARRAY' AND json_array_length(j, '$.day_totals') > 0),
  records AS (SELECT * FROM plain UNION ALL SELECT record_id, scope_slug, report_type, report_day, path, line_no, stamp, true, e, day_index, true,
      coalesce(json_extract(e, '$.enterprise_id'), json_extract(w, '$.enterprise_id')), coalesce(json_extract(e, '$.organization_id'), json_extract(w, '$.organization_id')),
      coalesce(json_extract(e, '$.report_start_day'), json_extract(w, '$.report_start_day')), coalesce(json_extract(e, '$.report_end_day'), json_extract(w, '$.report_end_day'))
    FROM wrapped)"""


def _own(x: str) -> tuple[str, str]:
    """Type and text of a JSON value of its own."""
    return f"coalesce(json_type({x}), 'NULL')", f"json_extract_string({x}, '$')"


def _own_text(x: str) -> str:
    t, v = _own(x)
    return f"nullif(regexp_replace(CASE WHEN {t} = 'VARCHAR' THEN {v} END, '^\\s+|\\s+$', '', 'g'), '')"


def _own_iso(x: str) -> str:
    t, v = _own(x)
    return f"CASE WHEN {t} = 'VARCHAR' AND regexp_full_match({v}, '\\d{{4}}-\\d\\d-\\d\\d') THEN try_cast({v} AS DATE) END"


_DAY = iso("j", "day")
_BASE_CODES = [
    when(f"({_DAY}) IS NULL", "day_must_be_iso_date"),
    when(f"({_DAY}) <> CAST(report_day AS DATE)", "day_does_not_match_bronze_partition"),
    when(f"{_own('e_id')[0]} NOT IN ('NULL', 'VARCHAR')", "enterprise_id_must_be_string"),
    when(f"{_own('o_id')[0]} NOT IN ('NULL', 'VARCHAR')", "organization_id_must_be_string"),
    when(f"{_own_text('e_id')} IS NULL", "enterprise_id_is_required_for_enterprise_scope"),
]
_PR_CODES = [
    when(f"{kind('j', 'pull_requests')} NOT IN ('NULL', 'OBJECT')", "pull_requests_must_be_object"),
    *bad_counts("j", PR_TOTALS, "pull_requests."),
    *bad_numbers("j", PR_MEDIANS, "pull_requests."),
    *[
        when(
            f"{kind('j', 'pull_requests.' + a)} IN ('BIGINT', 'UBIGINT') AND {kind('j', 'pull_requests.' + b)} IN ('BIGINT', 'UBIGINT') AND "
            f"{integer('j', 'pull_requests.' + a)} > {integer('j', 'pull_requests.' + b)}",
            f"pull_requests.{a}_exceeds_{b}",
        )
        for a, b in [
            ("total_created_by_copilot", "total_created"),
            ("total_reviewed_by_copilot", "total_reviewed"),
            ("total_merged_created_by_copilot", "total_merged"),
            ("total_merged_reviewed_by_copilot", "total_merged"),
            ("total_copilot_suggestions", "total_suggestions"),
            ("total_copilot_applied_suggestions", "total_applied_suggestions"),
        ]
    ],
]
_P = "ai_adoption_phase"
_USAGE_CODES = [
    *_BASE_CODES,
    *bad_numbers("j", ["ai_credits_used"]),
    *bad_counts("j", COUNTS),
    *[when(f"{kind('j', f)} NOT IN ('NULL', 'BOOLEAN')", f"{f}_must_be_boolean_or_null") for f in USED],
    *bad_strings("j", ["user_login"]),
    when(f"{_own('s_day')[0]} <> 'NULL' AND ({_own_iso('s_day')}) IS NULL", "report_start_day_must_be_iso_date"),
    when(f"{_own('t_day')[0]} <> 'NULL' AND ({_own_iso('t_day')}) IS NULL", "report_end_day_must_be_iso_date"),
    when(f"({_own_iso('s_day')}) > ({_own_iso('t_day')})", "report_start_day_must_not_follow_report_end_day"),
    when(f"{kind('j', _P)} NOT IN ('NULL', 'OBJECT')", "ai_adoption_phase_must_be_object"),
    when(f"{kind('j', _P + '.phase_number')} <> 'NULL' AND NOT {whole('j', _P + '.phase_number')}", "ai_adoption_phase.phase_number_must_be_nonnegative_integer"),
    *bad_strings("j", [f"{_P}.phase", f"{_P}.name", f"{_P}.version"]),
    when(
        f"{whole('j', 'code_acceptance_activity_count')} AND {whole('j', 'code_generation_activity_count')} AND "
        f"{integer('j', 'code_acceptance_activity_count')} > {integer('j', 'code_generation_activity_count')}",
        "code_acceptance_count_exceeds_generation_count",
    ),
    *_PR_CODES,
]
_CODES = {
    "users": [*_USAGE_CODES, *bad_ids("j", ["user_id"])],
    "entity": _USAGE_CODES,
    "repositories": [
        *_BASE_CODES,
        when(f"{_own_text('o_id')} IS NULL", "organization_id_is_required_for_repository"),
        *bad_ids("j", ["repo_id"]),
        *bad_strings("j", ["repo_owner_name", "repo_name", "repo_visibility"]),
        *_PR_CODES,
    ],
}


def checked(report: str, name: str) -> str:
    """CTE of the records of a report with ``reasons`` and the common columns of their rows."""
    return f"""{name} AS (SELECT *, CASE WHEN NOT valid THEN ['invalid_json'] WHEN coalesce(json_type(j), 'NULL') <> 'OBJECT' THEN [CASE WHEN is_entry THEN 'day_totals_entry_must_be_object' ELSE 'record_must_be_object' END]
      ELSE {codes(_CODES[report])} END AS reasons, CASE WHEN json_type(j) = 'OBJECT' THEN {_DAY} END AS d, {_own_text('e_id')} AS enterprise_id, {_own_text('o_id')} AS organization_id
    FROM records WHERE report_type = '{report}')"""


BASE = f"""'enterprise' AS scope_kind, scope_slug, strftime(d, '%Y-%m-%d') AS day, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS day_key, enterprise_id, organization_id,
  report_type AS source_report_type, report_day AS source_report_day, CAST(NULL AS VARCHAR) AS source_ingestion_id, stamp AS source_ingested_at, path AS source_path"""


def latest(keys: str, entry: str = "") -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY scope_slug, d{keys} ORDER BY stamp DESC, path DESC, line_no DESC, day_index{entry}) = 1"


_PR_OWN = ", ".join([f"{integer('j', 'pull_requests.' + c)} AS pr_{c}" for c in PR_TOTALS] + [f"{double('j', 'pull_requests.' + c)} AS pr_{c}" for c in PR_MEDIANS])
_COUNT_OWN = ", ".join([f"{double('j', 'ai_credits_used')} AS ai_credits_used"] + [f"{integer('j', c)} AS {c}" for c in COUNTS])
_MAIN = {
    "entity_daily": (
        "entity",
        f"{_COUNT_OWN}, {_PR_OWN}, strftime({_own_iso('s_day')}, '%Y-%m-%d') AS report_start_day, strftime({_own_iso('t_day')}, '%Y-%m-%d') AS report_end_day",
        "",
    ),
    "user_daily": (
        "users",
        f"""{integer('j', 'user_id')} AS user_id, {text('j', 'user_login')} AS user_login, {_COUNT_OWN}, {', '.join(f"try_cast({raw('j', f)} AS BOOLEAN) AS {f}" for f in USED)}, {_PR_OWN},
          coalesce({text('j', _P + '.phase')}, CASE WHEN json_type(j, '$.{_P}.phase') IS NULL THEN {text('j', _P + '.name')} END) AS adoption_phase,
          {integer('j', _P + '.phase_number')} AS adoption_phase_number, {text('j', _P + '.version')} AS adoption_phase_version""",
        f", {integer('j', 'user_id')}",
    ),
    "repository_daily": (
        "repositories",
        f"{integer('j', 'repo_id')} AS repo_id, {', '.join(text('j', c) + ' AS ' + c for c in ('repo_owner_name', 'repo_name', 'repo_visibility'))}, {_PR_OWN}",
        f", {integer('j', 'repo_id')}",
    ),
}


def _main(table: str) -> str:
    report, own, key = _MAIN[table]
    return f"WITH {_RECORDS}, {checked(report, 'c')} SELECT {BASE}, {own} FROM c WHERE len(reasons) = 0 {latest(key)}"


# ---- nested entries

#: Of each array: its table, required names in the source, whole numbers, other numbers, texts.
_ARRAYS = {
    "totals_by_feature": ("feature_daily", ["feature"], METRICS, [], []),
    "totals_by_ide": ("ide_daily", ["ide"], METRICS, [], []),
    "totals_by_language_feature": ("language_feature_daily", ["language", "feature"], METRICS, [], []),
    "totals_by_language_model": ("language_model_daily", ["language", "model"], METRICS, [], []),
    "totals_by_model_feature": ("model_feature_daily", ["model", "feature"], METRICS, [], []),
    "totals_by_custom_agent": ("custom_agent_daily", ["custom_agent"], METRICS, [], []),
    "totals_by_3rd_party_agent": ("third_party_agent_daily", ["agent_id"], METRICS, [], ["agent_name"]),
    "totals_by_mcp": ("mcp_daily", ["mcp"], METRICS, [], []),
    "totals_by_plugin": ("plugin_daily", ["plugin"], METRICS, [], []),
    "totals_by_skill": ("skill_daily", ["skill"], METRICS, [], []),
    "totals_by_slash_cmd": ("slash_command_daily", ["slash_cmd"], METRICS, [], []),
    "totals_by_ai_adoption_phase": ("adoption_phase_daily", ["phase"], PHASE_COUNTS, PHASE_AVERAGES, []),
    "pull_requests.copilot_suggestions_by_comment_type": (
        "repository_pr_comment_type_daily", ["comment_type"], ["total_copilot_suggestions", "total_copilot_applied_suggestions"], [], []
    ),
    "pull_request_review_times": ("repository_pr_review_time_daily", ["authored_by", "reviewed_by"], ["total_merged"], REVIEW_TIMES, []),
    "copilot_feature_engagement.totals_by_feature": ("feature_engagement_daily", ["feature"], ["engaged_user_count"], [], []),
}
_OBJECTS = {"totals_by_cli": "cli_daily", "totals_by_copilot_app": "copilot_app_daily", "totals_by_vscode_agent": "vscode_agent_daily"}
_LENIENT = ("pull_requests.copilot_suggestions_by_comment_type", "copilot_feature_engagement.totals_by_feature")


def entries(path: str, source: str, name: str) -> str:
    """CTE of the entries of an array of the good records of ``source`` with ``entry_reasons``."""
    _, required, counts, numbers, _ = _ARRAYS[path]
    bad = [when(f"{text('e', n)} IS NULL", f"{n}_is_required") for n in required] + bad_counts("e", counts) + bad_numbers("e", numbers)
    at = f"json_extract(j, '$.{path}[*]')"
    other = "" if path in _LENIENT else f"UNION ALL SELECT *, j AS e, CAST(NULL AS BIGINT) AS idx, ['{path}_must_be_array'] AS entry_reasons FROM {source} WHERE len(reasons) = 0 AND {kind('j', path)} NOT IN ('NULL', 'ARRAY')"
    return f"""{name} AS (SELECT *, CASE WHEN coalesce(json_type(e), 'NULL') <> 'OBJECT' THEN ['nested_entry_must_be_object'] ELSE {codes(bad)} END AS entry_reasons FROM (
        SELECT *, unnest({at}) AS e, CAST(generate_subscripts({at}, 1) - 1 AS BIGINT) AS idx FROM {source}
        WHERE len(reasons) = 0 AND {kind('j', path)} = 'ARRAY' AND json_array_length(j, '$.{path}') > 0) {other})"""


def single(path: str, source: str, name: str) -> str:
    """CTE of a single object of the good records of ``source`` with ``entry_reasons``."""
    bad = [
        *bad_counts("e", ["prompt_count", "request_count", "session_count", "total_user_messages"], after="_must_be_nonnegative_integer"),
        when(f"{kind('e', 'token_usage')} NOT IN ('NULL', 'OBJECT')", "token_usage_must_be_object"),
        *bad_counts("e", ["output_tokens_sum", "prompt_tokens_sum"], "token_usage."),
        *bad_numbers("e", ["avg_tokens_per_request"], "token_usage."),
        *([when(f"{kind('e', 'last_known_cli_version')} NOT IN ('NULL', 'OBJECT')", "last_known_cli_version_must_be_object")] if path == "totals_by_cli" else []),
    ]
    return f"""{name} AS (SELECT *, CASE WHEN json_type(j, '$.{path}') <> 'OBJECT' THEN ['{path}_must_be_object'] ELSE {codes(bad)} END AS entry_reasons FROM (
        SELECT *, json_extract(j, '$.{path}') AS e, CAST(NULL AS BIGINT) AS idx FROM {source} WHERE len(reasons) = 0 AND {kind('j', path)} <> 'NULL'))"""


#: Entity lines that hold days, as records of the last day of their report.
_ENGAGED = f"""g0 AS (SELECT record_id, scope_slug, report_type, report_day, path, line_no, stamp, true AS valid, j, 0 AS day_index, false AS is_entry,
      json_extract(j, '$.enterprise_id') AS e_id, json_extract(j, '$.organization_id') AS o_id, {iso('j', 'report_end_day')} AS d
    FROM lines WHERE report_type = 'entity' AND valid AND {kind('j', 'day_totals')} = 'ARRAY'),
  g AS (SELECT *, {_own_text('e_id')} AS enterprise_id, {_own_text('o_id')} AS organization_id, {codes([
    when("d IS NULL", "x"), when("d <> CAST(report_day AS DATE)", "x"), when(f"{_own('e_id')[0]} NOT IN ('NULL', 'VARCHAR')", "x"),
    when(f"{_own('o_id')[0]} NOT IN ('NULL', 'VARCHAR')", "x"), when(f"{_own_text('e_id')} IS NULL", "x"),
  ])} AS reasons FROM g0)"""
_IDE = f"""CASE WHEN json_type(e, '$.last_known_ide_version') = 'OBJECT' THEN {text('e', 'last_known_ide_version.ide_version')} ELSE {text('e', 'ide_version')} END AS ide_version,
  CASE WHEN json_type(e, '$.last_known_ide_version') = 'OBJECT' THEN {text('e', 'last_known_ide_version.sampled_at')} ELSE {text('e', 'ide_version_sampled_at')} END AS ide_version_sampled_at,
  CASE WHEN json_type(e, '$.last_known_plugin_version') = 'OBJECT' THEN {text('e', 'last_known_plugin_version.plugin')} ELSE {text('e', 'plugin')} END AS plugin,
  CASE WHEN json_type(e, '$.last_known_plugin_version') = 'OBJECT' THEN {text('e', 'last_known_plugin_version.plugin_version')} ELSE {text('e', 'plugin_version')} END AS plugin_version,
  CASE WHEN json_type(e, '$.last_known_plugin_version') = 'OBJECT' THEN {text('e', 'last_known_plugin_version.sampled_at')} ELSE {text('e', 'plugin_version_sampled_at')} END AS plugin_version_sampled_at"""


def _child_own(path: str) -> tuple[str, list[str]]:
    _, required, counts, numbers, texts = _ARRAYS[path]
    named = [f"{text('e', n)} AS {'slash_command' if n == 'slash_cmd' else n}" for n in required]
    own = [*named, *[f"{integer('e', c)} AS {c}" for c in counts], *[f"{double('e', c)} AS {c}" for c in numbers], *[f"{text('e', c)} AS {c}" for c in texts]]
    if path == "totals_by_ide":
        own.append(_IDE)
    if path.startswith("copilot_feature"):
        active = "copilot_feature_engagement.active_user_count"
        own.append(f"CASE WHEN {whole('j', active)} THEN {integer('j', active)} END AS active_user_count")
    return ", ".join(own), [text("e", n) for n in required]


def _usage_child(own: str, keys: list[str], cte: str) -> str:
    """Rows of the entries of users and entity records; only the former have a user."""
    user = f"CASE WHEN report_type = 'users' THEN {integer('j', 'user_id')} END"
    return f"""WITH {_RECORDS}, {checked('users', 'u')}, {checked('entity', 'y')}, a AS (SELECT * FROM u UNION ALL SELECT * FROM y), {cte}
      SELECT {BASE}, {user} AS user_id, {own} FROM n WHERE len(entry_reasons) = 0 {latest(''.join(f', {k}' for k in [user, *keys]), ', idx')}"""


def _array(path: str) -> str:
    own, keys = _child_own(path)
    if path.startswith("copilot_feature"):
        return f"WITH {_RAW}, {_ENGAGED}, {entries(path, 'g', 'n')} SELECT {BASE}, {own} FROM n WHERE len(entry_reasons) = 0 {latest(', ' + keys[0], ', idx')}"
    if path.startswith("pull_request"):
        repo = integer("j", "repo_id")
        return f"""WITH {_RECORDS}, {checked('repositories', 'r')}, {entries(path, 'r', 'n')}
          SELECT {BASE}, {repo} AS repo_id, {own} FROM n WHERE len(entry_reasons) = 0 {latest(''.join(f', {k}' for k in [repo, *keys]), ', idx')}"""
    return _usage_child(own, keys, entries(path, "a", "n"))


_TOKENS = [
    *[f"{integer('e', c)} AS {c}" for c in ("prompt_count", "request_count", "session_count")],
    *[f"{integer('e', 'token_usage.' + c)} AS {c}" for c in ("output_tokens_sum", "prompt_tokens_sum")],
    f"{double('e', 'token_usage.avg_tokens_per_request')} AS avg_tokens_per_request",
]
_OBJECT_OWN = {
    "totals_by_cli": [
        *_TOKENS,
        f"{text('e', 'last_known_cli_version.cli_version')} AS last_known_cli_version",
        f"{text('e', 'last_known_cli_version.sampled_at')} AS last_known_cli_version_sampled_at",
    ],
    "totals_by_copilot_app": _TOKENS,
    "totals_by_vscode_agent": [f"{integer('e', c)} AS {c}" for c in ("session_count", "total_user_messages")],
}
_TEAM_ROWS = """t AS (SELECT *, strftime(source_ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp, nullif(regexp_replace(organization_id, '^\\s+|\\s+$', '', 'g'), '') AS org,
    list_sort([x FOR x IN [CASE WHEN nullif(regexp_replace(organization_id, '^\\s+|\\s+$', '', 'g'), '') IS NULL THEN 'organization_id_is_required_for_organization_scope' END,
      CASE WHEN coalesce(user_id < 0, true) THEN 'user_id_must_be_nonnegative_integer' END, CASE WHEN coalesce(team_id < 0, true) THEN 'team_id_must_be_nonnegative_integer' END]
      IF x IS NOT NULL]) AS reasons FROM copilot_user_teams_1_day)"""
_TEAM = f"""WITH {_TEAM_ROWS} SELECT 'organization' AS scope_kind, scope_slug, day, CAST(replace(day, '-', '') AS BIGINT) AS day_key, CAST(NULL AS VARCHAR) AS enterprise_id, org AS organization_id,
    user_id, nullif(regexp_replace(user_login, '^\\s+|\\s+$', '', 'g'), '') AS user_login, team_id, nullif(regexp_replace(slug, '^\\s+|\\s+$', '', 'g'), '') AS team_slug,
    'user-teams' AS source_report_type, day AS source_report_day, source_ingestion_id, stamp AS source_ingested_at, CAST(NULL AS VARCHAR) AS source_path FROM t WHERE len(reasons) = 0
  QUALIFY row_number() OVER (PARTITION BY scope_slug, day, user_id, team_id ORDER BY stamp DESC, source_ingestion_id DESC, source_line DESC) = 1"""

# ---- quarantine, drift, quality

_ALL = f"{_RECORDS}, {checked('users', 'u')}, {checked('entity', 'y')}, {checked('repositories', 'r')}, {_ENGAGED}, a AS (SELECT * FROM u UNION ALL SELECT * FROM y)"
_USAGE_ARRAYS = [p for p in _ARRAYS if p.startswith("totals_by")]
_ENTRY_CTES = [
    *[(p, _ARRAYS[p][0], f"n{k}", entries(p, "a", f"n{k}")) for k, p in enumerate(_USAGE_ARRAYS)],
    *[(p, t, f"o{k}", single(p, "a", f"o{k}")) for k, (p, t) in enumerate(_OBJECTS.items())],
    *[(p, _ARRAYS[p][0], f"p{k}", entries(p, "r", f"p{k}")) for k, p in enumerate([q for q in _ARRAYS if q.startswith("pull_request")])],
    ("copilot_feature_engagement.totals_by_feature", "feature_engagement_daily", "q", entries("copilot_feature_engagement.totals_by_feature", "g", "q")),
]
_WITH_ENTRIES = f"{_ALL}, {', '.join(c for *_, c in _ENTRY_CTES)}"
_QUARANTINE_COLUMNS = "scope_kind, scope_slug, report_type, target_table, day, source_ingestion_id, source_path, nested_field, nested_index, reason_codes_json"


def _rejected(source: str, target: str) -> str:
    unread = "reasons[1] IN ('invalid_json', 'record_must_be_object')"
    return f"""SELECT 'enterprise' AS scope_kind, scope_slug, report_type, CASE WHEN {unread} THEN 'unknown' ELSE '{target}' END AS target_table, strftime(d, '%Y-%m-%d') AS day, CAST(NULL AS VARCHAR) AS source_ingestion_id,
      path AS source_path, CASE WHEN reasons[1] = 'day_totals_entry_must_be_object' THEN 'day_totals' END AS nested_field, CAST(NULL AS BIGINT) AS nested_index, to_json(reasons)::VARCHAR AS reason_codes_json
      FROM {source} WHERE len(reasons) > 0"""


_QUARANTINE = f"""WITH {_WITH_ENTRIES}, {_TEAM_ROWS}, z AS ({_rejected('u', 'user_daily')} UNION ALL {_rejected('y', 'entity_daily')} UNION ALL {_rejected('r', 'repository_daily')}
  UNION ALL SELECT 'organization', scope_slug, 'user-teams', 'user_team_daily', day, source_ingestion_id, NULL, NULL, NULL, to_json(reasons)::VARCHAR FROM t WHERE len(reasons) > 0
  UNION ALL {' UNION ALL '.join(f"SELECT 'enterprise', scope_slug, report_type, '{t}', strftime(d, '%Y-%m-%d'), NULL, path, '{p}', idx, to_json(entry_reasons)::VARCHAR FROM {n} WHERE len(entry_reasons) > 0" for p, t, n, _ in _ENTRY_CTES)})
  SELECT {_QUARANTINE_COLUMNS}, count(*) AS copies FROM z GROUP BY ALL"""

_IDS = ["day", "enterprise_id", "organization_id"]
_USAGE_KEYS = [
    *_IDS, "ai_credits_used", *COUNTS, *USED, *_USAGE_ARRAYS, *_OBJECTS, "pull_requests", "pull_request_review_times", "ai_adoption_phase", "user_login",
    "report_start_day", "report_end_day",
]


def _stray(source: str, j: str, prefix: str, known: list[str], where: str, day: str = "strftime(d, '%Y-%m-%d')") -> str:
    listed = ", ".join(f"'{k}'" for k in known)
    return f"""SELECT 'enterprise' AS scope_kind, scope_slug, report_type, day, '{prefix}' || k AS field_path, CASE json_type(x, '$."' || k || '"') WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list'
        WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END AS observed_type
      FROM (SELECT scope_slug, report_type, {day} AS day, {j} AS x, unnest(json_keys({j})) AS k FROM {source} WHERE {where}) WHERE k NOT IN ({listed})"""


def _object_at(path: str) -> str:
    return f"{kind('j', path)} = 'OBJECT'"


_GOOD = "len(reasons) = 0"
_IS_OBJECT = "reasons[1] IS DISTINCT FROM 'invalid_json' AND json_type(j) = 'OBJECT'"
_PR_KEYS = [*PR_TOTALS, *PR_MEDIANS, "copilot_suggestions_by_comment_type"]
_DRIFT_PARTS = [
    _stray("u", "j", "", [*_USAGE_KEYS, "user_id"], _GOOD),
    _stray("y", "j", "", _USAGE_KEYS, _GOOD),
    _stray("r", "j", "", [*_IDS, "repo_id", "repo_owner_name", "repo_name", "repo_visibility", "pull_requests", "pull_request_review_times"], _GOOD),
    _stray("a", "json_extract(j, '$.ai_adoption_phase')", "ai_adoption_phase.", ["phase", "name", "phase_number", "version"], f"{_IS_OBJECT} AND {_object_at('ai_adoption_phase')}"),
    *[_stray(s, "json_extract(j, '$.pull_requests')", "pull_requests.", _PR_KEYS, f"{_IS_OBJECT} AND {_object_at('pull_requests')}") for s in ("a", "r")],
    _stray(
        "g", "j", "", ["day_totals", "enterprise_id", "organization_id", "report_start_day", "report_end_day", "copilot_feature_engagement"],
        f"len(reasons) = 0 OR NOT {_object_at('copilot_feature_engagement')}", "CAST(NULL AS VARCHAR)",
    ),
]
for _path, _t, _n, _ in _ENTRY_CTES:
    if _path in _OBJECTS:
        _known = ["prompt_count", "request_count", "session_count", "total_user_messages", "token_usage", "last_known_cli_version"]
        _DRIFT_PARTS.append(_stray(_n, "e", f"{_path}.", _known, "len(entry_reasons) = 0"))
        _usage = f"json_type(j, '$.{_path}') = 'OBJECT' AND json_type(e, '$.token_usage') = 'OBJECT'"
        _DRIFT_PARTS.append(_stray(_n, "json_extract(e, '$.token_usage')", f"{_path}.token_usage.", ["avg_tokens_per_request", "output_tokens_sum", "prompt_tokens_sum"], _usage))
        if _path == "totals_by_cli":
            _version = "json_type(j, '$.totals_by_cli') = 'OBJECT' AND json_type(e, '$.last_known_cli_version') = 'OBJECT'"
            _DRIFT_PARTS.append(_stray(_n, "json_extract(e, '$.last_known_cli_version')", f"{_path}.last_known_cli_version.", ["cli_version", "sampled_at"], _version))
    else:
        _, _required, _counts, _numbers, _texts = _ARRAYS[_path]
        _known = [*_required, *_counts, *_numbers, *_texts]
        if _path == "totals_by_ide":
            _known += ["last_known_ide_version", "last_known_plugin_version", "ide_version", "ide_version_sampled_at", "plugin", "plugin_version", "plugin_version_sampled_at"]
        _DRIFT_PARTS.append(_stray(_n, "e", f"{_path}[].", _known, "len(entry_reasons) = 0"))
_DRIFT = f"""WITH {_WITH_ENTRIES}, z AS ({' UNION ALL '.join(_DRIFT_PARTS)})
  SELECT scope_kind, scope_slug, report_type, day, field_path, observed_type, count(*) AS copies FROM z GROUP BY ALL"""


def _issues(table: str, source: str, keys: dict[str, str], good: str, kind_: str = "enterprise") -> str:
    """Keys of a table with several rows; ``keys`` maps an SQL value to how it is spelled in JSON (text or number)."""
    spelled = " || ',' || ".join([f"""'["{kind_}"'""", "to_json(scope_slug)::VARCHAR", "to_json(strftime(d, '%Y-%m-%d'))::VARCHAR"] + [f"coalesce(to_json({k})::VARCHAR, 'null')" for k in keys])
    group = ", ".join(["scope_slug", "d", *keys])
    return f"""SELECT '{table}' AS target_table, {spelled} || ']' AS upsert_key_json, 'duplicate_upsert_key' AS check_name, 'warning' AS severity,
      count(*) || ' rows shared an upsert key; the deterministic latest row was retained' AS message FROM {source} WHERE {good} GROUP BY {group} HAVING count(*) > 1"""


_ISSUES = [
    _issues("entity_daily", "y", {}, _GOOD),
    _issues("user_daily", "u", {integer("j", "user_id"): ""}, _GOOD),
    _issues("repository_daily", "r", {integer("j", "repo_id"): ""}, _GOOD),
    _issues("user_team_daily", "(SELECT *, CAST(day AS DATE) AS d FROM t)", {"user_id": "", "team_id": ""}, _GOOD, "organization"),
]
_USER = f"CASE WHEN report_type = 'users' THEN {integer('j', 'user_id')} END"
for _path, _t, _n, _ in _ENTRY_CTES:
    _keys = [] if _path in _OBJECTS else [text("e", c) for c in _ARRAYS[_path][1]]
    _first = [integer("j", "repo_id")] if _n.startswith("p") else [] if _n == "q" else [_USER]
    _ISSUES.append(_issues(_t, _n, dict.fromkeys([*_first, *_keys], ""), "len(entry_reasons) = 0"))
_QUALITY = f"WITH {_WITH_ENTRIES}, {_TEAM_ROWS} {' UNION ALL '.join(_ISSUES)}"


def _validation(report: str) -> str:
    return f"WITH {_RECORDS}, {checked(report, 'c')} SELECT record_id, day_index, array_to_string(reasons, ',') AS reasons FROM c WHERE len(reasons) > 0"


def _usage(path: str, dimension: str) -> str:
    """Adoption per dimension value from the user rows of a child table, one row per key first."""
    sums = {
        "interaction_count": "user_initiated_interaction_count", "generation_count": "code_generation_activity_count", "acceptance_count": "code_acceptance_activity_count",
        "loc_suggested": "loc_suggested_to_add_sum", "loc_accepted": "loc_added_sum",
    }
    used = " OR ".join(f"coalesce({c}, 0) > 0" for c in [*sums.values(), "loc_deleted_sum"] if c != "loc_suggested_to_add_sum")
    return f"""SELECT scope_kind, scope_slug, day, day_key, {dimension}, count(DISTINCT user_id) AS observed_users, count(DISTINCT user_id) FILTER ({used}) AS active_users,
      count(DISTINCT user_id) FILTER ({used}) AS engaged_users, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {n}' for n, c in sums.items())},
      coalesce(sum(code_acceptance_activity_count), 0)::DOUBLE / nullif(sum(code_generation_activity_count), 0)::DOUBLE AS acceptance_rate,
      coalesce(sum(loc_added_sum), 0)::DOUBLE / nullif(sum(loc_suggested_to_add_sum), 0)::DOUBLE AS loc_acceptance_rate, CAST(NULL AS DOUBLE) AS ai_credits_used
      FROM ({_array(path)}) WHERE user_id IS NOT NULL GROUP BY ALL"""


ORACLE_SQL = {
    **{f"silver_{t}": _main(t) for t in _MAIN},
    "silver_user_team_daily": _TEAM,
    **{f"silver_{_ARRAYS[p][0]}": _array(p) for p in _ARRAYS},
    **{f"silver_{t}": _usage_child(", ".join(_OBJECT_OWN[p]), [], single(p, "a", "n")) for p, t in _OBJECTS.items()},
    "silver_quarantine": _QUARANTINE,
    "silver_schema_drift": _DRIFT,
    "silver_quality_issues": _QUALITY,
    **{f"validation_{r}": _validation(r) for r in ("users", "entity", "repositories")},
    "language_usage_daily": _usage("totals_by_language_feature", "language"),
    "ide_usage_daily": _usage("totals_by_ide", "ide"),
}
