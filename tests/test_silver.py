from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import SILVER
from tidemark.operators import silver
from tidemark.session import materialized

SCHEMA = "record_id bigint, scope_slug string, report_type string, report_day string, source_file string, line_no bigint, raw_json string, v string, reasons string"
GOOD = {"day": "2031-03-01", "user_id": 1, "organization_id": "o"}
REPO = {"day": "2031-03-01", "repo_id": 1, "organization_id": "o"}


def lines(spark, *raw, report="users"):
    rows = [(k, "s", report, "2031-03-01", "f", k, x if isinstance(x, (str, type(None))) else json.dumps(x), "", "") for k, x in enumerate(raw)]
    return spark.createDataFrame(rows, SCHEMA)


def normal(spark, *raw, report="users", scope="organization"):
    return silver.Normalizer(lines(spark, *raw, report=report), scope)


def why(spark, *raw, report="users", scope="organization"):
    return {r.record_id: r.reasons for r in normal(spark, *raw, report=report, scope=scope).checked(report).collect()}


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("text", ["{", '{"a": 1} x', '{"a": 1}}', '{"a": 1} {"b": 2}', '{"a": 1}, {"b": 2}', '{"a": 1}]', '{"a": NaN}', '{"a": 1},', "{}{"])
def test_anything_but_one_value_is_invalid(spark, text):
    assert why(spark, text) == {0: ["invalid_json"]}


def test_other_values_are_no_records_and_blank_lines_are_skipped(spark):
    assert why(spark, "[1]", "null", '"x"', "3", "", "  ", None) == {k: ["record_must_be_object"] for k in range(4)}


@pytest.mark.parametrize(
    ("change", "reasons"),
    [
        ({}, []),
        ({"user_id": True}, ["user_id_must_be_nonnegative_integer"]),
        ({"user_id": 2.0}, ["user_id_must_be_nonnegative_integer"]),
        ({"user_id": 2**70}, ["user_id_must_be_nonnegative_integer"]),
        ({"user_id": None}, ["user_id_must_be_nonnegative_integer"]),
        ({"loc_added_sum": -1}, ["loc_added_sum_must_be_nonnegative_number"]),
        ({"loc_added_sum": "1"}, ["loc_added_sum_must_be_nonnegative_number"]),
        ({"loc_added_sum": None, "ai_credits_used": 1.5}, []),
        ({"used_chat": 1}, ["used_chat_must_be_boolean_or_null"]),
        ({"day": "2031-3-1"}, ["day_must_be_iso_date"]),
        ({"day": "2031-03-02"}, ["day_does_not_match_bronze_partition"]),
        ({"day": "2031-02-30"}, ["day_must_be_iso_date"]),
        ({"user_login": 5}, ["user_login_must_be_string"]),
        ({"code_acceptance_activity_count": 3, "code_generation_activity_count": 2}, ["code_acceptance_count_exceeds_generation_count"]),
        ({"ai_adoption_phase": "x"}, ["ai_adoption_phase_must_be_object"]),
        ({"ai_adoption_phase": {"phase_number": -1, "name": 3}}, ["ai_adoption_phase.name_must_be_string", "ai_adoption_phase.phase_number_must_be_nonnegative_integer"]),
        ({"pull_requests": {"total_created": 1, "total_created_by_copilot": 2}}, ["pull_requests.total_created_by_copilot_exceeds_total_created"]),
        ({"pull_requests": []}, ["pull_requests_must_be_object"]),
        ({"organization_id": " "}, ["organization_id_is_required_for_organization_scope"]),
        ({"organization_id": 7}, ["organization_id_is_required_for_organization_scope", "organization_id_must_be_string"]),
        ({"enterprise_id": False}, ["enterprise_id_must_be_string"]),
        ({"report_start_day": "2031-03-02", "report_end_day": "2031-03-01"}, ["report_start_day_must_not_follow_report_end_day"]),
        ({"report_start_day": "2031-03-01", "report_end_day": "2031-03-01"}, []),
        ({"report_start_day": "March", "report_end_day": 3}, ["report_end_day_must_be_iso_date", "report_start_day_must_be_iso_date"]),
    ],
)
def test_reasons(spark, change, reasons):
    assert why(spark, {**GOOD, **change}) == {0: reasons}


# written out by hand: child, total, and pairs that look alike but are not checked
PAIRS = [
    ("total_created_by_copilot", "total_created"),
    ("total_reviewed_by_copilot", "total_reviewed"),
    ("total_merged_created_by_copilot", "total_merged"),
    ("total_merged_reviewed_by_copilot", "total_merged"),
    ("total_copilot_suggestions", "total_suggestions"),
    ("total_copilot_applied_suggestions", "total_applied_suggestions"),
]
NO_PAIRS = [("total_applied_suggestions", "total_suggestions"), ("total_copilot_applied_suggestions", "total_copilot_suggestions")]


@pytest.mark.parametrize("report", ["users", "repositories"])
def test_children_must_not_exceed_their_total(spark, report):
    base = GOOD if report == "users" else REPO
    got = why(spark, *[{**base, "pull_requests": {a: 2, b: 1}} for a, b in PAIRS + NO_PAIRS], *[{**base, "pull_requests": {a: 2, b: 2}} for a, b in PAIRS], report=report)
    want = [[f"pull_requests.{a}_exceeds_{b}"] for a, b in PAIRS] + [[]] * (len(NO_PAIRS) + len(PAIRS))
    assert got == dict(enumerate(want))


def test_scope_decides_which_id_is_needed(spark):
    assert why(spark, GOOD, {**GOOD, "enterprise_id": "e"}, scope="enterprise") == {0: ["enterprise_id_is_required_for_enterprise_scope"], 1: []}
    got = why(spark, {**REPO, "enterprise_id": "e", "organization_id": ""}, report="repositories", scope="enterprise")
    assert got == {0: ["organization_id_is_required_for_repository"]}


def test_repository_reasons(spark):
    got = why(spark, REPO, {"day": "2031-03-01", "repo_id": "1", "repo_name": 2, "organization_id": "o"}, report="repositories")
    assert got == {0: [], 1: ["repo_id_must_be_nonnegative_integer", "repo_name_must_be_string"]}


def test_team_lines(spark):
    good = {"day": "2031-03-01", "organization_id": "o", "user_id": 1, "team_id": 2, "slug": " core ", "user_login": "u", "beta": 1}
    n = normal(spark, good, {**good, "team_id": -1, "slug": 4}, {**good, "user_id": "1", "user_login": {}}, report="user-teams")
    assert {r.record_id: r.reasons for r in n.checked("user-teams").collect()} == {
        0: [], 1: ["slug_must_be_string", "team_id_must_be_nonnegative_integer"], 2: ["user_id_must_be_nonnegative_integer", "user_login_must_be_string"],
    }
    assert rows(n.table("user_team_daily"), "scope_kind", "day_key", "organization_id", "user_id", "team_id", "team_slug", "source_report_type") == [
        ("organization", 20310301, "o", 1, 2, "core", "user-teams")
    ]
    assert rows(n.table("silver_schema_drift"), "field_path", "observed_type", "sample_value_json") == [("beta", "int", "1")]
    alias = silver.Normalizer(lines(spark, good, report="user_teams"), "organization")
    assert alias.table("user_team_daily").count() == 1


def test_phase_goes_before_name_only_if_given(spark):
    raw = [{**GOOD, "user_id": k, "ai_adoption_phase": p} for k, p in enumerate([{"phase": " A ", "name": "B"}, {"name": "B"}, {"phase": None, "name": "B"}, {"phase": ""}, None])]
    assert dict(rows(normal(spark, *raw).table("user_daily"), "user_id", "adoption_phase")) == {0: "A", 1: "B", 2: None, 3: None, 4: None}


def test_user_rows_hold_every_counter_flag_and_pull_request_total(spark):
    from tidemark import contracts

    record = {**GOOD, **{c: k for k, c in enumerate(contracts.COUNTERS)}, **dict.fromkeys(contracts.FLAGS, True), "code_acceptance_activity_count": 0}
    record["pull_requests"] = {c: 5 if not c.startswith("median") else 1.5 for c in contracts.PULL_REQUESTS}
    row = normal(spark, record).table("user_daily").first().asDict()
    assert all(row[c] == (0 if c == "code_acceptance_activity_count" else k) for k, c in enumerate(contracts.COUNTERS))
    assert all(row[c] is True for c in contracts.FLAGS)
    assert all(row[f"pr_{c}"] == (1.5 if c.startswith("median") else 5) for c in contracts.PULL_REQUESTS)


def test_equal_records_have_one_hash_however_they_are_spelled(spark):
    a, b = json.dumps({**GOOD, "x": {"p": 1, "q": [1, 2]}}), '{"x": {"q":[1,2], "p" : 1}, "organization_id":"o","user_id":1, "day":"2031-03-01"}'
    c = json.dumps({**GOOD, "x": {"p": 1, "q": [2, 1]}})
    h = {r.record_id: r.source_record_hash for r in normal(spark, a, b, c).checked("users").collect()}
    assert h[0] == h[1] != h[2] and len(h[0]) == 64


def test_a_bad_entry_leaves_its_parent_and_siblings(spark):
    n = normal(
        spark,
        {**GOOD, "totals_by_slash_cmd": [{"slash_cmd": " /fix ", "interaction_count": 2}, None, {"slash_cmd": " "}, {"slash_cmd": "/a", "interaction_count": -1}, 7]},
        {**GOOD, "totals_by_slash_cmd": "text"}, {**GOOD, "totals_by_slash_cmd": []}, {**GOOD, "totals_by_slash_cmd": None}, {"totals_by_slash_cmd": [{"slash_cmd": "x"}]},
    )
    assert rows(n.table("slash_command_daily"), "slash_command", "interaction_count") == [("/fix", 2)]
    bad = rows(n.quarantine().where("nested_field IS NOT NULL"), "record_id", "nested_index", "target_table", "reason_codes_json", "raw_record_json")
    assert bad == [
        (0, 1, "slash_command_daily", '["nested_entry_must_be_object"]', '{"value":null}'),
        (0, 2, "slash_command_daily", '["slash_cmd_is_required"]', '{"slash_cmd":" "}'),
        (0, 3, "slash_command_daily", '["interaction_count_must_be_nonnegative_number"]', '{"interaction_count":-1,"slash_cmd":"/a"}'),
        (0, 4, "slash_command_daily", '["nested_entry_must_be_object"]', '{"value":7}'),
        (1, None, "slash_command_daily", '["totals_by_slash_cmd_must_be_array"]', '{"day":"2031-03-01","organization_id":"o","totals_by_slash_cmd":"text","user_id":1}'),
    ]
    assert n.table("user_daily").count() == 1 and n.table("silver_quarantine").count() == 6


def test_children_take_their_own_values_and_the_first_entry_of_a_key(spark):
    n = normal(spark, {**GOOD, "code_generation_activity_count": 99, "totals_by_feature": [{"feature": "f", "code_generation_activity_count": 1}, {"feature": " f", "code_generation_activity_count": 7}]})
    assert rows(n.table("feature_daily"), "user_id", "feature", "code_generation_activity_count") == [(1, "f", 1)]
    assert rows(n.table("silver_quality_issues"), "target_table", "upsert_key_json") == [("feature_daily", '["organization","s","2031-03-01",1,"f"]')]


#: Of every child table a source field, an entry, and columns it must come out with.
CHILDREN = [
    ("totals_by_ide", "ide_daily", {"ide": "vim", "last_known_ide_version": {"ide_version": " 9 ", "sampled_at": "t"}, "last_known_plugin_version": {"plugin": "p", "plugin_version": "1", "sampled_at": "u"}},
     {"ide": "vim", "ide_version": "9", "ide_version_sampled_at": "t", "plugin": "p", "plugin_version": "1", "plugin_version_sampled_at": "u"}),
    ("totals_by_language_feature", "language_feature_daily", {"language": "go", "feature": "f", "loc_added_sum": 3}, {"language": "go", "feature": "f", "loc_added_sum": 3}),
    ("totals_by_language_model", "language_model_daily", {"language": "go", "model": "m", "session_count": 3}, {"language": "go", "model": "m", "session_count": 3}),
    ("totals_by_model_feature", "model_feature_daily", {"model": "m", "feature": "f", "loc_deleted_sum": 3}, {"model": "m", "feature": "f", "loc_deleted_sum": 3}),
    ("totals_by_custom_agent", "custom_agent_daily", {"custom_agent": "a", "interaction_count": 4}, {"custom_agent": "a", "interaction_count": 4}),
    ("totals_by_3rd_party_agent", "third_party_agent_daily", {"agent_id": "7", "agent_name": "n", "session_count": 1}, {"agent_id": "7", "agent_name": "n", "session_count": 1}),
    ("totals_by_mcp", "mcp_daily", {"mcp": "m", "interaction_count": 4}, {"mcp": "m", "interaction_count": 4}),
    ("totals_by_plugin", "plugin_daily", {"plugin": "m", "interaction_count": 4}, {"plugin": "m", "interaction_count": 4}),
    ("totals_by_skill", "skill_daily", {"skill": "m", "interaction_count": 4}, {"skill": "m", "interaction_count": 4}),
    ("totals_by_ai_adoption_phase", "adoption_phase_daily", {"phase": "P", "phase_number": 2, "users_in_phase_28d": 9, "avg_loc_added": 1.5, "avg_pull_requests_reviewed": 2},
     {"phase": "P", "phase_number": 2, "users_in_phase_28d": 9, "avg_loc_added": 1.5, "avg_pull_requests_reviewed": 2.0, "avg_loc_deleted": None}),
    ("totals_by_cli", "cli_daily", {"prompt_count": 2, "token_usage": {"output_tokens_sum": 3, "avg_tokens_per_request": 1.5}, "last_known_cli_version": {"cli_version": " 1.2 ", "sampled_at": "t"}},
     {"prompt_count": 2, "output_tokens_sum": 3, "avg_tokens_per_request": 1.5, "last_known_cli_version": "1.2", "last_known_cli_version_sampled_at": "t"}),
    ("totals_by_copilot_app", "copilot_app_daily", {"request_count": 2, "token_usage": {"prompt_tokens_sum": 3}}, {"request_count": 2, "prompt_tokens_sum": 3}),
    ("totals_by_vscode_agent", "vscode_agent_daily", {"session_count": 2, "total_user_messages": 5}, {"session_count": 2, "total_user_messages": 5}),
]


@pytest.mark.parametrize("report", ["users", "entity"])
def test_every_child_table_of_users_and_entities(spark, report):
    single = ("cli_daily", "copilot_app_daily", "vscode_agent_daily")
    fields = {f: e if t in single else [e] for f, t, e, _ in CHILDREN}
    record = {**GOOD, **fields} if report == "users" else {"organization_id": "o", "day_totals": [{"day": "2031-03-01", **fields}]}
    n = silver.Normalizer(lines(spark, record, report=report), "organization", materialized)
    for _, table, _, want in CHILDREN:
        (row,) = n.table(table).collect()
        assert {k: row[k] for k in want} == want and row.user_id == (1 if report == "users" else None) and row.organization_id == "o" and row.source_report_type == report
    assert n.drift().isEmpty() and n.quarantine().isEmpty()


def test_entity_days_inherit_from_the_line_and_keep_their_own(spark):
    n = normal(
        spark,
        {"organization_id": "o", "report_start_day": "2031-02-01", "report_end_day": "2031-03-01", "odd": 1,
         "day_totals": [{"day": "2031-03-01", "daily_active_users": 4, "pull_requests": {"total_created": 6}}, 3, {"day": "2031-03-01", "organization_id": None}, {"day": "2031-03-02"}],
         "copilot_feature_engagement": {"active_user_count": 8, "totals_by_feature": [{"feature": "f", "engaged_user_count": 3}, {"engaged_user_count": 1}, {"feature": "f", "engaged_user_count": 9}]}},
        {"organization_id": "o", "day": "2031-03-01", "day_totals": {}}, report="entity",
    )
    assert rows(n.table("entity_daily"), "day_key", "daily_active_users", "pr_total_created", "organization_id", F.col("report_start_day").cast("string"), "source_path") == [(20310301, None, None, "o", None, "f")]
    got = rows(n.rows("entity_daily"), "record_id", "day_index", "daily_active_users", "pr_total_created", F.col("report_start_day").cast("string"))
    assert got == [(0, 0, 4, 6, "2031-02-01"), (1, 0, None, None, None)]
    assert rows(n.quarantine(), "record_id", "target_table", "nested_field", "nested_index", "reason_codes_json") == [
        (0, "entity_daily", "day_totals", None, '["day_totals_entry_must_be_object"]'),
        (0, "entity_daily", None, None, '["day_does_not_match_bronze_partition"]'),
        (0, "entity_daily", None, None, '["organization_id_is_required_for_organization_scope"]'),
        (0, "feature_engagement_daily", "copilot_feature_engagement.totals_by_feature", 1, '["feature_is_required"]'),
    ]
    assert rows(n.table("feature_engagement_daily"), "feature", "active_user_count", "engaged_user_count") == [("f", 8, 3)]
    assert rows(n.drift(), "record_id", "field_path") == [(0, "odd"), (1, "day_totals")]


def test_single_objects_are_checked(spark):
    n = normal(
        spark, {**GOOD, "totals_by_cli": [1]}, {**GOOD, "totals_by_cli": {"prompt_count": -1, "token_usage": 4, "last_known_cli_version": "1"}},
        {**GOOD, "totals_by_cli": None}, GOOD, {**GOOD, "totals_by_cli": {"token_usage": {"prompt_tokens_sum": 1.5}}},
    )
    assert rows(n.quarantine(), "record_id", "target_table", "reason_codes_json") == [
        (0, "cli_daily", '["totals_by_cli_must_be_object"]'),
        (1, "cli_daily", '["last_known_cli_version_must_be_object","prompt_count_must_be_nonnegative_integer","token_usage_must_be_object"]'),
        (4, "cli_daily", '["token_usage.prompt_tokens_sum_must_be_nonnegative_number"]'),
    ]
    assert n.table("cli_daily").count() == 0


def test_parts_of_repositories(spark):
    comments = [{"comment_type": "a", "total_copilot_suggestions": 1}, None, {"comment_type": " "}, {"comment_type": "b", "total_copilot_suggestions": "1"}]
    times = [{"authored_by": "x", "reviewed_by": "y", "total_merged": 2, "p90_minutes_first_to_final_review": 2.5}, {"authored_by": "x"}]
    n = normal(
        spark, {**REPO, "repo_name": " n ", "pull_requests": {"total_merged": 3, "copilot_suggestions_by_comment_type": comments}, "pull_request_review_times": times},
        {**REPO, "repo_id": 2, "pull_requests": {"copilot_suggestions_by_comment_type": {}}, "pull_request_review_times": {}}, report="repositories",
    )
    assert rows(n.table("repository_daily"), "repo_id", "repo_name", "pr_total_merged") == [(1, "n", 3), (2, None, None)]
    assert rows(n.table("repository_pr_comment_type_daily"), "repo_id", "comment_type", "total_copilot_suggestions") == [(1, "a", 1)]
    assert rows(n.table("repository_pr_review_time_daily"), "authored_by", "reviewed_by", "total_merged", "p90_minutes_first_to_final_review") == [("x", "y", 2, 2.5)]
    assert rows(n.quarantine(), "record_id", "nested_index", "reason_codes_json") == [
        (0, 1, '["nested_entry_must_be_object"]'), (0, 1, '["reviewed_by_is_required"]'), (0, 2, '["comment_type_is_required"]'),
        (0, 3, '["total_copilot_suggestions_must_be_nonnegative_number"]'), (1, None, '["pull_request_review_times_must_be_array"]'),
    ]


def test_drift_names_nested_paths_and_types(spark):
    n = normal(
        spark,
        {**GOOD, "z": 1.5, "big": [1], "none": None, "ai_adoption_phase": {"score": 1}, "pull_requests": {"odd": "x"}, "totals_by_feature": [{"feature": "f", "lag": True}, {"lag": 1}],
         "totals_by_cli": {"token_usage": {"cached": {}}, "last_known_cli_version": {"x": 1}, "more": 2}},
        {"ai_adoption_phase": {"score": 1}, "z": 3},
    )
    assert rows(n.drift(), "record_id", "field_path", "observed_type") == [
        (0, "ai_adoption_phase.score", "int"), (0, "big", "list"), (0, "none", "NoneType"), (0, "pull_requests.odd", "str"), (0, "totals_by_cli.last_known_cli_version.x", "int"),
        (0, "totals_by_cli.more", "int"), (0, "totals_by_cli.token_usage.cached", "dict"), (0, "totals_by_feature[].lag", "bool"), (0, "z", "float"), (1, "ai_adoption_phase.score", "int"),
    ]


def test_unreadable_lines_are_quarantined_whole(spark):
    n = normal(spark, "{", "[1]")
    assert rows(n.table("silver_quarantine"), "target_table", "reason_codes_json", "raw_record_json") == [
        ("unknown", '["invalid_json"]', '{"raw_line":"{"}'), ("unknown", '["record_must_be_object"]', '{"value":[1]}')
    ]


@pytest.mark.parametrize("name", ["user_daily", "feature_daily", "silver_quarantine"])
def test_no_lines_give_empty_tables_of_the_contract(spark, name):
    n = silver.Normalizer(lines(spark, GOOD).limit(0).withColumn("user_id", F.lit("clash")), "organization")
    df = n.table(name)
    assert df.columns == SILVER[name].names and df.isEmpty()


def test_unknown_fields_and_issues(spark):
    df = lines(spark, {"a": 1, "n": None, "o": {"x": 1}}, "[]")
    got = {(r.field_path, r.observed_type, r.sample_value_json) for r in silver.unknown_fields(df, {"users": ["a"]}).collect()}
    assert got == {("n", "null", "null"), ("o", "object", '{"x":1}')}
    twice = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, s string")
    assert [(r.upsert_key_json, r.severity) for r in silver.duplicate_issues(twice, "t", ["k", "s"]).collect()] == [("[1,null]", "warning")]


def test_unknown_fields_of_objects_and_entries(spark):
    known = ["a", "o", "o.x", "es", "es[].k", "es[].in", "totals_by_ide", "totals_by_ide[].ide"]
    df = lines(
        spark, {"o": {"x": 1, "y": {"z": 1}}, "es": [{"k": 1, "q": True}, None, {"q": "later"}, [{"r": 1}], {"in": [{"s": None}]}]},
        {"totals_by_ide": {"ide": "v", "extra": 1}, "o.x": 2, "stray": {"x": 1}}, {"a": 1, "o": None, "es": "text", "totals_by_ide": '[{"ide": "v", "late": []}]'},
    )
    got = {(r.record_id, r.field_path, r.observed_type) for r in silver.unknown_fields(df, {"users": known}).collect()}
    assert got == {
        (0, "o.y", "object"), (0, "es[].q", "boolean"), (0, "es[][].r", "number"), (0, "es[].in[].s", "null"),
        (1, "totals_by_ide[].extra", "number"), (1, "o.x", "number"), (1, "stray", "object"), (2, "totals_by_ide[].late", "array"),
    }


def test_unknown_fields_query_reaches_nested_fields(spark, data, duck):
    import __spark_entry__ as entry

    got = {tuple(r) for r in entry.queries()["unknown_fields"](spark, data).select("record_id", "report_type", "field_path", "observed_type").collect()}
    assert {"." in r[2] for r in got} == {True, False}
    assert {r for r in got if "." not in r[2]} == {r for r in duck.execute(entry.oracle_sql()["unknown_fields"]).fetchall() if "." not in r[2]}


def test_predicates(spark):
    from tidemark import store

    df = spark.createDataFrame([("o", "s", "users", "2031-03-01", 1), ("o", "s", "users", "2031-03-02", 2), ("o", "s", "entity", "2031-03-01", 3)], "scope_kind string, scope_slug string, source_report_type string, source_report_day string, k int")
    inside = store.snapshot_predicate([("o", "s", "users", "2031-03-01")])
    assert [r.k for r in df.withColumn("source_report_day", F.to_date("source_report_day")).where(inside).collect()] == [1]
    days = spark.createDataFrame([("o", "s", "2031-03-01"), ("o", "t", "2031-03-01"), ("o", "s", "2031-03-09")], "scope_kind string, scope_slug string, day string").withColumn("day", F.to_date("day"))
    assert days.where(store.window_predicate([("o", "s", "2031-03-01", "2031-03-05")])).count() == 1
    assert days.where(store.window_predicate([("o", "s", "2031-03-01", "2031-03-05")], has_day=False)).count() == 2
