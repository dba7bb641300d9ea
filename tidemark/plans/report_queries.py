"""The pN_ queries of the core, on the report tables of a data directory, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift, hashruns, history, profile, rolling, shred, snapdiff
from tidemark.session import materialized, spread, table, written

USERS, TEAMS, REPOS, LINES = "copilot_users_1_day", "copilot_user_teams_1_day", "copilot_repos_1_day", "silver_users_edge_cases"

def _user_checks() -> list[profile.ColumnCheck]:
    exceeds = F.col("code_acceptance_activity_count") > F.col("code_generation_activity_count")
    return [
        profile.ColumnCheck("code_acceptance_activity_count", "code_generation_activity_count", {"exceeds_generation": exceeds}),
        profile.ColumnCheck("loc_added_sum", "code_generation_activity_count"),
    ]


def _repo_checks() -> list[profile.ColumnCheck]:
    return [profile.ColumnCheck("pull_requests.median_minutes_to_merge", "pull_requests.total_merged")]


#: What texts of the reports look like.
DIGITS, LOGIN, VISIBILITY = "^[0-9]+$", "^[a-z0-9._-]+$", "^(PUBLIC|PRIVATE|INTERNAL)$"


def _every_column(reports: DataFrame, named: list[profile.ColumnCheck], patterns: dict[str, str]) -> list[profile.ColumnCheck]:
    """Checks of all scalar columns of a report, members of structs included; those ``named`` keep theirs."""
    own = {c.column: c for c in named}
    leaves = [(f.name, f.dataType) for f in reports.schema if f.name not in ("scope_kind", "scope_slug", "day") and not f.name.startswith("source_")]
    leaves = [leaf for n, t in leaves for leaf in ([(f"{n}.{m.name}", m.dataType) for m in t] if t.typeName() == "struct" else [(n, t)])]
    return [own.get(n) or profile.ColumnCheck(n, text=t.typeName() == "string", pattern=patterns.get(n)) for n, t in leaves if t.typeName() not in ("array", "struct", "map")]


def _states(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """States of both reports, stored per load of a report and merged: of the named columns, or of every column with distinct values."""
    users, repos = table(spark, sf_dir, USERS), table(spark, sf_dir, REPOS)
    checks = [_user_checks(), _repo_checks()]
    if every:
        ids = {"organization_id": DIGITS, "enterprise_id": DIGITS}
        checks = [_every_column(users, checks[0], ids | {"user_login": LOGIN}), _every_column(repos, checks[1], ids | {"repo_visibility": VISIBILITY})]
    return profile.merge_states(*[written(profile.profile_states(df, name, c, every)) for df, name, c in zip((users, repos), (USERS, REPOS), checks)])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = materialized(_states(spark, sf_dir))  # a few rows per delivery and column, read several times
    return profile.judged(states).where("broken").select("table_name", "column_name", "source_ingestion_id")


def p1_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the profile of every column that SQL can check."""
    keys = ("table_name", "column_name", "source_ingestion_id", "row_count", "null_count", "nan_count", "zero_count", "negative_count", "violations")
    return profile.profiles(_states(spark, sf_dir, every=True)).select(*keys, F.col("least").alias("least_value"), F.col("greatest").alias("greatest_value"))


def _whole_profile(judged: DataFrame) -> DataFrame:
    limits = [f"{v}{s}" for v in ("excess", "correlation", "violation_share") for s in ("", "_center", "_sigma")]
    keys = ("table_name", "column_name", "scope_slug", "source_ingestion_id", "day", "row_count", "null_count", "nan_count", "zero_count", "negative_count", "violations")
    return judged.select(*keys, F.col("least").alias("least_value"), F.col("greatest").alias("greatest_value"), "distinct_values", *limits, "peers", "broken")


def p1_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole profile of every column: that of p1_profile with distinct values, agreement with the companion, change against the other deliveries and limits."""
    return _whole_profile(profile.judged(materialized(_states(spark, sf_dir, every=True))))


def p1_new_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries of the last seven days, judged by the stored states of the days before alone."""
    states = materialized(_states(spark, sf_dir, every=True))
    last = states.agg(F.date_sub(F.max(F.to_date("day")), 6).cast("string")).first()[0] or ""
    return _whole_profile(profile.judged(states.where(F.col("day") >= last), states.where(F.col("day") < last)))


def p2_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the blocks are stored before they are merged, as those of every day would be
    return hashruns.merged_counts(written(hashruns.usage_blocks(table(spark, sf_dir, USERS), table(spark, sf_dir, TEAMS))))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase = [F.col("ai_adoption_phase").isNull(), *[F.col(f"ai_adoption_phase.{m}") for m in ("name", "phase_number", "version")]]
    changes = snapdiff.snapshot_changes(
        {
            "users": (table(spark, sf_dir, USERS), "user_id", [F.col("user_login"), F.col("organization_id"), *phase]),
            "repositories": (table(spark, sf_dir, REPOS), "repo_id", [F.col(c) for c in ("repo_owner_name", "repo_name", "repo_visibility")]),
        }
    )
    return changes.select("report_type", "day", "record_id", "change_kind")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, LINES).select("record_id", "scope_slug", "report_type", "report_day", "source_file", "line_no", "raw_json"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.child_objects(_lines(spark, sf_dir), "record_id", "raw_json")


def p4_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred.child_tables(_lines(spark, sf_dir), "record_id", "raw_json", every=True)


def p4_typed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["source_ingestion_id", "source_line", "user_id"]
    members = ["feature", "code_generation_activity_count", "code_acceptance_activity_count"]
    return shred.typed_children(table(spark, sf_dir, USERS), keys, "totals_by_feature", members)


def p4_typed_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["source_ingestion_id", "source_line", "repo_id"]
    members = ["comment_type", "total_copilot_suggestions", "total_copilot_applied_suggestions"]
    return shred.typed_children(table(spark, sf_dir, REPOS), keys, "pull_requests.copilot_suggestions_by_comment_type", members)


def p4_typed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["source_ingestion_id", "source_line", "repo_id"]
    members = ["authored_by", "reviewed_by", "total_merged", "median_minutes_to_first_review", "p90_minutes_to_first_review"]
    return shred.typed_children(table(spark, sf_dir, REPOS), keys, "pull_request_review_times", members)


def p4_typed_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["source_ingestion_id", "source_line", "user_id"]
    return shred.typed_struct(table(spark, sf_dir, USERS), keys, "ai_adoption_phase", ["name", "phase_number", "version"])


def p4_typed_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals and medians of pull_requests; its array is ``p4_typed_comments``."""
    repos = table(spark, sf_dir, REPOS)
    members = [f.name for f in repos.schema["pull_requests"].dataType if f.dataType.typeName() != "array"]
    return shred.typed_struct(repos, ["source_ingestion_id", "source_line", "repo_id"], "pull_requests", members)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(drift.lifespans(drift.field_observations(_lines(spark, sf_dir))))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select("source_file", "change_kind", "old_field", "new_field")


def p5_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    observations = materialized(drift.field_observations(lines))  # a row per file and field, read several times
    return drift.consistent_lines(lines, drift.target_schema(observations))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = history.team_slugs(table(spark, sf_dir, TEAMS)).unionByName(history.user_logins(table(spark, sf_dir, USERS)))
    return history.folded(seen)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.changed_entities(_versions(spark, sf_dir)).select("entity_kind", "entity_id", "attribute_value", "valid_from")


def p6_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).select("entity_kind", "entity_id", "attribute_value", "valid_from", "valid_to", "is_current")


def p7_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.user_trailing_totals(table(spark, sf_dir, USERS))


QUERIES = {
    "p1_found": p1_found,
    "p1_profile": p1_profile,
    "p1_judged": p1_judged,
    "p1_new_loads": p1_new_loads,
    "p2_distinct": p2_distinct,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_tables": p4_tables,
    "p4_typed_features": p4_typed_features,
    "p4_typed_comments": p4_typed_comments,
    "p4_typed_reviews": p4_typed_reviews,
    "p4_typed_phases": p4_typed_phases,
    "p4_typed_pull_requests": p4_typed_pull_requests,
    "p5_found": p5_found,
    "p5_consistent": p5_consistent,
    "p6_found": p6_found,
    "p6_history": p6_history,
    "p7_trailing": p7_trailing,
}

def _won(name: str, keys: str) -> str:
    """CTE body: the winning rows of the snapshots of table ``name``."""
    return f"""SELECT * FROM (
      SELECT t.*, row_number() OVER (PARTITION BY t.scope_slug, t.day, {keys} ORDER BY t.source_line DESC) AS line_rank
      FROM {name} t
      JOIN (SELECT scope_slug, day, max(source_ingested_at) AS newest FROM {name} GROUP BY scope_slug, day) l
        ON t.scope_slug = l.scope_slug AND t.day = l.day AND t.source_ingested_at = l.newest)
    WHERE line_rank = 1"""


def _profile_sql(name: str, column: str, rule: str = "false", text: bool = False) -> str:
    x = f"CAST(length(trim({column})) AS DOUBLE)" if text else f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{name}' AS table_name, '{column}' AS column_name, source_ingestion_id, count(*) AS row_count,
      count(*) FILTER ({x} IS NULL) AS null_count, count(*) FILTER (isnan({x})) AS nan_count,
      count(*) FILTER ({x} = 0) AS zero_count, count(*) FILTER ({x} < 0) AS negative_count,
      count(*) FILTER ({rule}) AS violations,
      min({x}) FILTER (NOT isnan({x})) AS least_value, max({x}) FILTER (NOT isnan({x})) AS greatest_value
    FROM {name} GROUP BY source_ingestion_id"""


_P1 = " UNION ALL ".join(
    [
        _profile_sql(USERS, "code_acceptance_activity_count", "code_acceptance_activity_count > code_generation_activity_count"),
        *[
            _profile_sql(USERS, c)
            for c in (
                "user_id ai_credits_used user_initiated_interaction_count code_generation_activity_count loc_suggested_to_add_sum loc_suggested_to_delete_sum loc_added_sum "
                "loc_deleted_sum used_agent used_chat used_cli used_copilot_app used_copilot_coding_agent used_copilot_cloud_agent ai_adoption_phase.phase_number"
            ).split()
        ],
        *[_profile_sql(n, c, f"NOT regexp_matches({c}, '^[0-9]+$')", True) for n in (USERS, REPOS) for c in ("enterprise_id", "organization_id")],
        _profile_sql(USERS, "user_login", "NOT regexp_matches(user_login, '^[a-z0-9._-]+$')", True),
        *[_profile_sql(USERS, f"ai_adoption_phase.{c}", text=True) for c in ("name", "version")],
        _profile_sql(REPOS, "repo_visibility", "NOT regexp_matches(repo_visibility, '^(PUBLIC|PRIVATE|INTERNAL)$')", True),
        *[_profile_sql(REPOS, c, text=True) for c in ("repo_owner_name", "repo_name")],
        _profile_sql(REPOS, "repo_id"),
        *[
            _profile_sql(REPOS, f"pull_requests.{c}")
            for c in (
                "total_reviewed total_created total_created_by_copilot total_reviewed_by_copilot total_merged median_minutes_to_merge total_suggestions total_applied_suggestions "
                "total_merged_created_by_copilot median_minutes_to_merge_copilot_authored total_copilot_suggestions total_copilot_applied_suggestions "
                "total_merged_reviewed_by_copilot median_minutes_to_merge_copilot_reviewed"
            ).split()
        ],
    ]
)

_P2 = f"""
WITH u AS (SELECT day, organization_id, CAST(NULL AS BIGINT) AS team_id, user_id, false AS has_team FROM {USERS}
           UNION ALL SELECT day, organization_id, team_id, user_id, true FROM {TEAMS}),
g AS (
  SELECT * FROM (SELECT grouping(day) = 0 AS by_day, grouping(organization_id) = 0 AS by_organization, false AS by_team,
         day, organization_id, CAST(NULL AS BIGINT) AS team_id, count(DISTINCT user_id) AS distinct_user_ids,
         count(DISTINCT oid) AS distinct_organization_ids, count(DISTINCT tid) AS distinct_team_ids
  FROM (SELECT *, organization_id AS oid, team_id AS tid FROM u) GROUP BY CUBE (day, organization_id))
  UNION ALL
  SELECT * FROM (SELECT grouping(day) = 0, grouping(organization_id) = 0, true, day, organization_id, team_id,
         count(DISTINCT user_id), count(DISTINCT oid), count(DISTINCT tid)
  FROM (SELECT *, organization_id AS oid, team_id AS tid FROM u WHERE has_team)
  GROUP BY GROUPING SETS ((team_id), (day, team_id), (organization_id, team_id), (day, organization_id, team_id))))
SELECT *,
  CAST(distinct_user_ids AS DOUBLE) * (CAST(distinct_user_ids AS DOUBLE) - 1) / 36893488147419103232.0::DOUBLE AS user_ids_error_bound,
  CAST(distinct_organization_ids AS DOUBLE) * (CAST(distinct_organization_ids AS DOUBLE) - 1) / 36893488147419103232.0::DOUBLE AS organization_ids_error_bound,
  CAST(distinct_team_ids AS DOUBLE) * (CAST(distinct_team_ids AS DOUBLE) - 1) / 36893488147419103232.0::DOUBLE AS team_ids_error_bound
FROM g"""


def _diff_sql(name: str, kind: str, key: str, same: str, columns: str) -> str:
    return f"""
SELECT '{kind}' AS report_type, day, record_id, change_kind FROM (
  WITH w AS (SELECT scope_slug, day, {key} AS record_id, {columns} FROM ({_won(name, key)})),
  s AS (SELECT scope_slug, day, lag(day) OVER (PARTITION BY scope_slug ORDER BY day) AS before FROM (SELECT DISTINCT scope_slug, day FROM w))
  SELECT s.day, coalesce(n.record_id, o.record_id) AS record_id,
    CASE WHEN o.record_id IS NULL THEN 'added' WHEN n.record_id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
  FROM (SELECT w.*, s.before FROM w JOIN s USING (scope_slug, day) WHERE s.before IS NOT NULL) n
  FULL JOIN (SELECT w.*, s.day AS later FROM w JOIN s ON w.scope_slug = s.scope_slug AND w.day = s.before) o
    ON n.scope_slug = o.scope_slug AND n.day = o.later AND n.record_id = o.record_id
  JOIN s ON s.scope_slug = coalesce(n.scope_slug, o.scope_slug) AND s.day = coalesce(n.day, o.later)
  WHERE o.record_id IS NULL OR n.record_id IS NULL OR NOT ({same}))"""


def _same(columns: list[str]) -> str:
    return " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in columns)


_P3 = (
    _diff_sql(USERS, "users", "user_id", _same(["user_login", "organization_id", "ai_adoption_phase"]), "user_login, organization_id, ai_adoption_phase")
    + " UNION ALL "
    + _diff_sql(REPOS, "repositories", "repo_id", _same(["repo_owner_name", "repo_name", "repo_visibility"]), "repo_owner_name, repo_name, repo_visibility")
)

_OBSERVED = f"""
 o AS (
  SELECT 'team' AS entity_kind, team_id AS entity_id, day, max(nullif(lower(trim(slug)), '')) AS v FROM ({_won(TEAMS, "user_id, team_id")}) GROUP BY ALL
  UNION ALL
  SELECT 'user', user_id, day, max(nullif(lower(trim(user_login)), '')) FROM ({_won(USERS, "user_id")}) GROUP BY ALL),
 f AS (SELECT *, lag(v) OVER (PARTITION BY entity_kind, entity_id ORDER BY day) AS before FROM o WHERE v IS NOT NULL AND entity_id IS NOT NULL),
 s AS (SELECT *, lead(day) OVER (PARTITION BY entity_kind, entity_id ORDER BY day) AS valid_to, count(*) OVER (PARTITION BY entity_kind, entity_id) AS n
       FROM f WHERE before IS DISTINCT FROM v)"""

_P7 = f"""
WITH w AS (SELECT user_id, CAST(day AS DATE) AS d, sum(coalesce(code_generation_activity_count, 0)) AS x FROM ({_won(USERS, "user_id")}) GROUP BY ALL),
 c AS (SELECT unnest(generate_series(min(CAST(day AS DATE)), max(CAST(day AS DATE)), INTERVAL 1 DAY))::DATE AS d FROM {USERS}),
 g AS (SELECT u.user_id, c.d, coalesce(w.x, 0) AS x FROM (SELECT DISTINCT user_id FROM {USERS} WHERE user_id IS NOT NULL AND try_cast(day AS DATE) IS NOT NULL) u CROSS JOIN c LEFT JOIN w ON w.user_id = u.user_id AND w.d = c.d),
 r AS (SELECT user_id, strftime(d, '%Y-%m-%d') AS day,
   CAST(sum(x) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS total_7,
   CAST(sum(x) OVER (PARTITION BY user_id ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS total_30 FROM g)
SELECT user_id, day, total_7, total_7 / 7.0::DOUBLE AS average_7, total_30, total_30 / 30.0::DOUBLE AS average_30 FROM r"""


def _typed_sql(name: str, key: str, array: str, members: list[str]) -> str:
    picked = ", ".join(f"e.{m} AS {m}" for m in members)
    return f"""SELECT source_ingestion_id, source_line, {key}, CAST(k - 1 AS INTEGER) AS position, {picked}
    FROM (SELECT source_ingestion_id, source_line, {key}, unnest({array}) AS e, generate_subscripts({array}, 1) AS k FROM {name} WHERE len({array}) > 0)
    WHERE e IS NOT NULL"""


def _struct_sql(name: str, key: str, struct: str, members: str) -> str:
    return f"SELECT source_ingestion_id, source_line, {key}, {', '.join(f'{struct}.{m} AS {m}' for m in members.split())} FROM {name} WHERE {struct} IS NOT NULL"


#: Every object of a line with its path; a lone object or a JSON text stands for an array in the fields named here.
_LONE = "json_keys(n.x)[i] IN ('totals_by_feature', 'totals_by_ide', 'totals_by_language_feature', 'totals_by_mcp', 'totals_by_slash_cmd', 'day_totals', 'pull_request_review_times')"
_MEMBER = """'$."' || json_keys(n.x)[i] || '"'"""
_P4 = f"""WITH RECURSIVE nodes AS (
    SELECT record_id, '' AS path, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS x, false AS is_entry FROM {LINES}
      WHERE json_valid(raw_json) AND CASE WHEN json_valid(raw_json) THEN json_type(raw_json) END = 'OBJECT'
    UNION ALL
    SELECT record_id, c.path, c.x, c.is_entry FROM (
      SELECT n.record_id, unnest(CASE WHEN json_type(n.x) = 'ARRAY' THEN
          [{{'path': n.path || '[' || i || ']', 'x': json_extract(n.x, '$[' || i || ']'), 'is_entry': true}} FOR i IN range(0, json_array_length(n.x)::BIGINT)]
        ELSE flatten([CASE WHEN json_type(v.v) = 'OBJECT' THEN [{{'path': v.p || CASE WHEN v.lone THEN '[0]' ELSE '' END, 'x': v.v, 'is_entry': v.lone}}]
            WHEN json_type(v.v) = 'ARRAY' THEN [{{'path': v.p || '[' || i || ']', 'x': json_extract(v.v, '$[' || i || ']'), 'is_entry': true}} FOR i IN range(0, json_array_length(v.v)::BIGINT)]
            WHEN v.lone AND v.t <> '' AND json_valid(v.t) AND CASE WHEN json_valid(v.t) THEN json_type(v.t) END = 'ARRAY' THEN
              [{{'path': v.p || '[' || i || ']', 'x': json_extract(v.t::JSON, '$[' || i || ']'), 'is_entry': true}} FOR i IN range(0, json_array_length(v.t)::BIGINT)]
            ELSE [] END FOR v IN [{{'lone': {_LONE}, 'p': CASE WHEN n.path = '' THEN '' ELSE n.path || '.' END || json_keys(n.x)[i], 'v': json_extract(n.x, {_MEMBER}),
                't': CASE WHEN json_type(n.x, {_MEMBER}) = 'VARCHAR' AND left(ltrim(json_extract_string(n.x, {_MEMBER})), 1) = '[' THEN json_extract_string(n.x, {_MEMBER}) ELSE '' END}}
              FOR i IN range(1, len(json_keys(n.x))::BIGINT + 1)]]) END) AS c
      FROM nodes n WHERE json_type(n.x) IN ('OBJECT', 'ARRAY')))
  SELECT record_id, path AS child_path FROM nodes WHERE is_entry AND json_type(x) = 'OBJECT'"""

ORACLE_SQL = {
    "p1_profile": _P1,
    "p4_found": _P4,
    "p4_typed_phases": _struct_sql(USERS, "user_id", "ai_adoption_phase", "name phase_number version"),
    # p4_typed_pull_requests passes medians that are NaN on as delivered, which text comparison of results cannot match
    "p2_distinct": _P2,
    "p3_found": _P3,
    "p4_typed_features": _typed_sql(USERS, "user_id", "totals_by_feature", ["feature", "code_generation_activity_count", "code_acceptance_activity_count"]),
    "p4_typed_comments": _typed_sql(
        REPOS, "repo_id", "pull_requests.copilot_suggestions_by_comment_type",
        ["comment_type", "total_copilot_suggestions", "total_copilot_applied_suggestions"],
    ),
    "p4_typed_reviews": _typed_sql(
        REPOS, "repo_id", "pull_request_review_times",
        ["authored_by", "reviewed_by", "total_merged", "median_minutes_to_first_review", "p90_minutes_to_first_review"],
    ),
    "p6_found": f"WITH {_OBSERVED} SELECT entity_kind, entity_id, v AS attribute_value, day AS valid_from FROM s WHERE n > 1",
    "p6_history": f"WITH {_OBSERVED} SELECT entity_kind, entity_id, v AS attribute_value, day AS valid_from, valid_to, valid_to IS NULL AS is_current FROM s",
    "p7_trailing": _P7,
}
