"""Queries over the operators on reports: adoption tables, snapshots, validation, maintenance and measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import measures as M
from tidemark import store, windows
from tidemark.contracts import COUNTERS, FLAGS, PULL_REQUESTS, SILVER
from tidemark.functions.dates import iso_date
from tidemark.operators import adoption, latest, silver
from tidemark.plans.report_queries import LINES, REPOS, TEAMS, USERS, _won
from tidemark.session import lookup, spread, table

MANIFESTS = "bronze_manifests"
HAVE = [c for c in COUNTERS[:8]]
HAVE_FLAGS = FLAGS[:6]
WINDOW = (date(2031, 3, 1), date(2031, 4, 20))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, LINES).select("record_id", "scope_slug", "report_type", "report_day", "source_file", "line_no", "raw_json"))


def _snapshot(spark: SparkSession, sf_dir: str, name: str, keys: list[str], columns: list[str]) -> DataFrame:
    """The winning rows of the snapshots of a report with ``columns``; nothing else is read."""
    lineage = ["source_ingestion_id", "source_ingested_at", "source_line"]
    rows = table(spark, sf_dir, name).select("scope_kind", "scope_slug", "day", *keys, *[c for c in columns if c not in lineage], *lineage)
    return latest.winning_rows(latest.snapshot_rows(rows), ["scope_slug", "day", *keys], columns=["scope_kind", *columns]).withColumn("day", iso_date("day"))


ORIGIN = ["source_ingestion_id", "source_ingested_at"]


def user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winning user rows under their cleaned names; values that a check would refuse stay as delivered."""
    columns = ["user_login", "ai_adoption_phase", *HAVE, *HAVE_FLAGS]
    return _snapshot(spark, sf_dir, USERS, ["user_id"], columns).withColumn("adoption_phase", F.col("ai_adoption_phase.name")).drop("ai_adoption_phase")


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _snapshot(spark, sf_dir, TEAMS, ["user_id", "team_id"], ["slug"])
    return rows.select("scope_kind", "scope_slug", "day", "user_id", "team_id", F.nullif(F.lower(F.trim("slug")), F.lit("")).alias("team_slug"))


def primary_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's primary team: the least team id they ever belong to."""
    return table(spark, sf_dir, TEAMS).where("user_id IS NOT NULL").groupBy("user_id").agg(F.min("team_id").alias("team_id"))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _snapshot(spark, sf_dir, USERS, ["user_id"], ["totals_by_feature"]).select("scope_kind", "scope_slug", "day", "user_id", F.explode("totals_by_feature").alias("e"))
    kept = rows.where("e IS NOT NULL AND e.feature IS NOT NULL").select(
        "scope_kind", "scope_slug", "day", "user_id", F.col("e.feature").alias("feature"), *[F.col(f"e.{c}").alias(c) for c in ("code_generation_activity_count", "code_acceptance_activity_count")]
    )
    absent = [c for c in HAVE if c not in kept.columns]
    return kept.withColumns({c: F.lit(None).cast("double" if c == "ai_credits_used" else "bigint") for c in absent})


def repository_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir, REPOS, ["repo_id"], ["repo_owner_name", "repo_name", "repo_visibility", "pull_requests"])


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrived of the three typed reports, under the columns of their contracts."""
    phase = {"adoption_phase": "name", "adoption_phase_number": "phase_number", "adoption_phase_version": "version"}
    users = _snapshot(spark, sf_dir, USERS, ["user_id"], ["enterprise_id", "organization_id", "user_login", "ai_adoption_phase", *HAVE, *HAVE_FLAGS, *ORIGIN])
    teams = _snapshot(spark, sf_dir, TEAMS, ["user_id", "team_id"], ["organization_id", "user_login", "slug", *ORIGIN])
    repos = _snapshot(spark, sf_dir, REPOS, ["repo_id"], ["enterprise_id", "organization_id", "repo_owner_name", "repo_name", "repo_visibility", "pull_requests", *ORIGIN])
    pulled = {f"pr_{c}": F.when(~F.isnan(f"pull_requests.{c}"), F.col(f"pull_requests.{c}")) if c.startswith("median_") else F.col(f"pull_requests.{c}") for c in PULL_REQUESTS}
    parts = [
        (users.withColumns({n: F.col(f"ai_adoption_phase.{m}") for n, m in phase.items()}), "users", "user_daily"),
        (teams.withColumn("team_slug", F.nullif(F.trim("slug"), F.lit(""))), "user-teams", "user_team_daily"),
        (repos.withColumns(pulled), "repositories", "repository_daily"),
    ]
    found = [adoption.observed_reports(rows, kind, SILVER[name]) for rows, kind, name in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


def out(df: DataFrame) -> DataFrame:
    """Dates as text and amounts rounded, so that results compare exactly."""
    fixed = {}
    for name, kind in df.dtypes:
        if kind == "date":
            fixed[name] = F.date_format(name, "yyyy-MM-dd")
        elif name == "ai_credits_used":
            fixed[name] = F.round(name, 2)
        elif kind in ("timestamp", "timestamp_ntz"):
            fixed[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumns(fixed)


def entity_adoption_daily(spark, d):
    return out(adoption.entity_adoption(user_daily(spark, d)))


def entity_fallback_reported(spark, d):
    m = latest.latest_manifests(table(spark, d, MANIFESTS).where("report_type = 'users'"))
    reported = m.select("scope_kind", "scope_slug", iso_date("report_day").alias("day"), F.col("record_count").alias("daily_active_users"))
    return out(adoption.entity_adoption(user_daily(spark, d), reported))


def team_adoption_daily(spark, d):
    return out(adoption.team_adoption(memberships(spark, d), user_daily(spark, d), primary_mapping(spark, d)))


def repository_impact_daily(spark, d):
    return out(adoption.repository_impact(repository_daily(spark, d)))


def feature_usage_daily(spark, d):
    return out(adoption.dimension_usage(feature_rows(spark, d), "feature"))


def user_adoption_daily(spark, d):
    return out(adoption.user_adoption(user_daily(spark, d)))


def user_adoption_current(spark, d):
    return out(adoption.user_current(user_daily(spark, d)))


def rolling_entity(spark, d):
    return out(adoption.rolling_entity(user_daily(spark, d)))


def rolling_team(spark, d):
    return out(adoption.rolling_team(user_daily(spark, d), memberships(spark, d)))


def rolling_primary_team(spark, d):
    return out(adoption.rolling_team(user_daily(spark, d), memberships(spark, d), primary_mapping(spark, d)))


def _fresh(spark, d):
    m = latest.latest_manifests(table(spark, d, MANIFESTS))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    statuses = m.select(
        "scope_kind", "scope_slug", iso_date("report_day").alias("day"), "report_type", F.when(F.col("status") == "success", "complete").otherwise("no_data").alias("status"),
        stamp("ingested_at").alias("ingested"),
    )
    calendar = windows.report_calendar(m, ["scope_kind", "scope_slug"], *WINDOW, ["users", "user-teams", "repositories"])
    return adoption.freshness(observed(spark, d).withColumn("latest_ingested", stamp("latest_ingested")), statuses, calendar, WINDOW[1])


def data_freshness_daily(spark, d):
    return out(_fresh(spark, d))


def latest_wins_dedup(spark, d):
    keys = ["scope_slug", "day", "user_id", "team_id"]
    return latest.winning_rows(table(spark, d, TEAMS), keys, ["source_ingested_at", "source_ingestion_id", "source_line"]).select(*keys, "source_ingestion_id", "source_line")


def _latest_users(spark, d):
    return latest.snapshot_rows(table(spark, d, USERS).select("scope_slug", "day", "user_id", "source_ingestion_id", "source_ingested_at"))


def correction_counts(spark, d):
    teams = latest.snapshot_rows(table(spark, d, TEAMS))
    tables = {USERS: (_latest_users(spark, d), ["scope_slug", "day", "user_id"]), TEAMS: (teams, ["scope_slug", "day", "user_id", "team_id"])}
    return latest.correction_counts(tables, ["scope_slug", "day"])


def duplicate_issues(spark, d):
    return silver.duplicate_issues(_latest_users(spark, d), "user_daily", ["scope_slug", "day", "user_id"]).select("target_table", "upsert_key_json", "check_name", "severity", "message")


def latest_manifest(spark, d):
    return latest.latest_manifests(table(spark, d, MANIFESTS)).select("scope_slug", "report_type", "report_day", "ingestion_id", "status", "record_count")


def snapshot_filter(spark, d):
    rows = latest.snapshot_rows(table(spark, d, USERS))
    return rows.groupBy("scope_slug", "day", "source_ingestion_id").agg(F.count(F.lit(1)).alias("kept_rows"))


def manifest_filter(spark, d):
    """The manifests with one success in seven turned into a later no_data: its rows must go."""
    m = table(spark, d, MANIFESTS)
    gone = m.where("report_type = 'users' AND status = 'success' AND day(to_date(report_day)) % 7 = 0").select(
        "scope_kind", "scope_slug", "report_type", "report_day", F.concat("ingestion_id", F.lit("-later")).alias("ingestion_id"),
        (F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"), F.lit("no_data").alias("status"), F.lit(0).cast("bigint").alias("record_count"), "content_fingerprint",
    )
    rows = latest.manifest_filter(table(spark, d, USERS), m.unionByName(gone), "users")
    return rows.groupBy("scope_slug", "day").agg(F.count(F.lit(1)).alias("kept_rows"))


def content_duplicates(spark, d):
    """The manifests with the reports of every seventh day of a month landed a second time a day later: planted, as real ones are rare."""
    m = table(spark, d, MANIFESTS)
    again = m.where("day(to_date(report_day)) % 7 = 0").withColumns(
        {"ingestion_id": F.concat("ingestion_id", F.lit("-again")), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")}
    )
    return latest.content_duplicates(m.unionByName(again)).select("ingestion_id", "original_id")


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), "o_totalprice")


def _order_changes(spark, d):
    changed = _orders(spark, d).where("o_custkey % 5 = 0 AND year(day) = 1995 AND o_orderkey % 3 <> 0")
    return changed.withColumn("o_orderstatus", F.lit("X"))


def upsert_merge(spark, d):
    return out(store.upserted(_orders(spark, d), _order_changes(spark, d), ["o_orderkey"]))


def bounded_replacement(spark, d):
    predicate = (F.col("o_custkey") % 5 == 0) & (F.year("day") == 1995)
    return out(store.replaced(_orders(spark, d), _order_changes(spark, d), ["o_orderkey"], predicate))


def containment_violations(spark, d):
    return out(store.outside_predicate(_order_changes(spark, d), F.col("day").between(F.lit("1995-02-01").cast("date"), F.lit("1995-11-30").cast("date"))))


def window_coalesce(spark, d):
    m = table(spark, d, MANIFESTS).where("status = 'success'")
    start = iso_date("report_day")
    ranges = m.select("scope_slug", "report_type", start.alias("start_day"), F.date_add(start, (F.col("record_count") % 3).cast("int")).alias("end_day"))
    return out(windows.coalesce_ranges(ranges, ["scope_slug", "report_type"]))


def unknown_fields(spark, d):
    contract = table(spark, d, "report_field_contracts").groupBy("report_type").agg(F.sort_array(F.collect_list("field_path")).alias("names"))
    expected = {r["report_type"]: r["names"] for r in contract.collect()}  # a fixed table of 60 rows
    return silver.unknown_fields(_lines(spark, d), expected).select("record_id", "report_type", "field_path", "observed_type")


def calendar_dimension(spark, d):
    return out(adoption.date_dimension(spark))


def report_calendar(spark, d):
    m = table(spark, d, MANIFESTS)
    calendar = windows.report_calendar(m, ["scope_slug"], *WINDOW, ["users", "user-teams", "repositories"])
    have = m.select("scope_slug", iso_date("report_day").alias("day"), "report_type").distinct()
    return out(calendar.join(lookup(have), ["scope_slug", "day", "report_type"], "left_anti"))


def audit_completed(spark, d):
    m = table(spark, d, MANIFESTS).where("report_type = 'users'")
    audit = m.select(F.when(F.col("status") == "success", "succeeded").otherwise("failed").alias("status"), "scope_slug", F.to_json(F.struct(F.col("report_day").alias("start"), F.col("report_day").alias("end"))).alias("details_json"))
    scope = m.agg(F.min("scope_slug")).first()[0]
    return store.is_completed(audit, scope, "2031-03-10", "2031-03-10")


def _measured(kind, base):
    def run(spark, d):
        names = [n for n, (t, _) in M.measures().items() if t == kind]
        return out(M.evaluate(base(spark, d), names, ["scope_slug"]))

    return run


def _rolled(spark, d):
    return adoption.rolling_entity(user_daily(spark, d))


QUERIES = {
    f.__name__: f
    for f in [
        entity_adoption_daily, entity_fallback_reported, team_adoption_daily, repository_impact_daily, feature_usage_daily,
        user_adoption_daily, user_adoption_current, rolling_entity, rolling_team, rolling_primary_team, data_freshness_daily,
        latest_wins_dedup, correction_counts, duplicate_issues, latest_manifest, snapshot_filter, manifest_filter, content_duplicates, upsert_merge,
        bounded_replacement, containment_violations, window_coalesce, unknown_fields, calendar_dimension, report_calendar,
        audit_completed,
    ]
} | {
    "measures_entity": _measured(M.ENTITY, lambda s, d: adoption.entity_adoption(user_daily(s, d))),
    "measures_rolling": _measured(M.ROLLING, _rolled),
    "measures_team": _measured(M.TEAM, lambda s, d: adoption.team_adoption(memberships(s, d), user_daily(s, d), primary_mapping(s, d))),
    "measures_feature": _measured(M.FEATURE, lambda s, d: adoption.dimension_usage(feature_rows(s, d), "feature")),
    "measures_repository": _measured(M.REPOSITORY, lambda s, d: adoption.repository_impact(repository_daily(s, d))),
    "measures_freshness": _measured(M.FRESHNESS, _fresh),
}

# ---- oracles: spelled out again, so that they share no names, rules or days with the operators

SQL_COUNTERS = (
    "ai_credits_used user_initiated_interaction_count code_generation_activity_count code_acceptance_activity_count loc_suggested_to_add_sum "
    "loc_suggested_to_delete_sum loc_added_sum loc_deleted_sum"
).split()
SQL_FLAGS = "used_agent used_chat used_cli used_copilot_app used_copilot_coding_agent used_copilot_cloud_agent".split()
SQL_PULLS = (
    "total_reviewed total_created total_created_by_copilot total_reviewed_by_copilot total_merged total_suggestions total_applied_suggestions "
    "total_merged_created_by_copilot total_copilot_suggestions total_copilot_applied_suggestions total_merged_reviewed_by_copilot"
).split()
SQL_MEDIANS = "median_minutes_to_merge median_minutes_to_merge_copilot_authored median_minutes_to_merge_copilot_reviewed".split()

_ENGAGED = "greatest(0, " + ", ".join(f"coalesce({c}, 0)" for c in ("user_initiated_interaction_count", "code_generation_activity_count", "code_acceptance_activity_count", "loc_added_sum", "loc_deleted_sum")) + ") > 0"
_ACTIVE = f"({_ENGAGED}) OR " + " OR ".join(f"coalesce({c}, false)" for c in SQL_FLAGS)
_UD = f"ud AS (SELECT w.* EXCLUDE (day), CAST(w.day AS DATE) AS day, ai_adoption_phase.name AS adoption_phase, {_ENGAGED} AS engaged, ({_ACTIVE}) AS active FROM ({_won(USERS, 'user_id')}) w)"
_MEM = f"mem AS (SELECT scope_kind, scope_slug, CAST(day AS DATE) AS day, user_id, team_id, nullif(lower(trim(slug)), '') AS team_slug FROM ({_won(TEAMS, 'user_id, team_id')}))"
_PRIM = f"prim AS (SELECT user_id, min(team_id) AS main FROM {TEAMS} WHERE user_id IS NOT NULL GROUP BY user_id)"
_KEY = "CAST(strftime(day, '%Y%m%d') AS BIGINT) AS day_key"
_DAY = "strftime(day, '%Y-%m-%d') AS day"
_COUNTED = """count(DISTINCT user_id) AS observed_users, count(DISTINCT CASE WHEN active THEN user_id END) AS active_users,
  count(DISTINCT CASE WHEN engaged THEN user_id END) AS engaged_users,"""
_SUMS = """CAST(sum(user_initiated_interaction_count) AS BIGINT) AS interaction_count, CAST(sum(code_generation_activity_count) AS BIGINT) AS generation_count,
  CAST(sum(code_acceptance_activity_count) AS BIGINT) AS acceptance_count,
  coalesce(sum(code_acceptance_activity_count), 0)::DOUBLE / nullif(sum(code_generation_activity_count), 0)::DOUBLE AS acceptance_rate,
  CAST(sum(loc_suggested_to_add_sum) AS BIGINT) AS loc_suggested, CAST(sum(loc_added_sum) AS BIGINT) AS loc_accepted,
  coalesce(sum(loc_added_sum), 0)::DOUBLE / nullif(sum(loc_suggested_to_add_sum), 0)::DOUBLE AS loc_acceptance_rate,
  round(sum(ai_credits_used), 2) AS ai_credits_used"""
_ENTITY = f"SELECT scope_kind, scope_slug, {_DAY}, {_KEY}, {_COUNTED} {_SUMS} FROM ud GROUP BY scope_kind, scope_slug, ud.day"
_NEWEST = f"""nm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scope_kind, scope_slug, report_type, report_day ORDER BY ingested_at DESC, ingestion_id DESC) AS k
  FROM {MANIFESTS} WHERE status IN ('success', 'no_data')) WHERE k = 1)"""
_TEAM = f"""
 members AS (SELECT *, 'all_memberships' AS allocation_method, false AS is_additive FROM mem
   UNION ALL SELECT mem.*, 'primary_team', true FROM mem JOIN prim ON prim.user_id = mem.user_id AND prim.main = mem.team_id),
 team AS (SELECT m.scope_kind, m.scope_slug, m.day, m.team_id, m.allocation_method, m.is_additive, min(m.team_slug) AS team_slug,
   count(DISTINCT m.user_id) AS membership_count, count(DISTINCT u.user_id) AS observed_users,
   count(DISTINCT CASE WHEN active THEN u.user_id END) AS active_users, count(DISTINCT CASE WHEN engaged THEN u.user_id END) AS engaged_users, {_SUMS}
   FROM members m LEFT JOIN ud u ON u.scope_kind = m.scope_kind AND u.scope_slug = m.scope_slug AND u.day = m.day AND u.user_id = m.user_id GROUP BY ALL)"""
_FEATURE_ROWS = f"""fr AS (SELECT *, coalesce(greatest(0, coalesce(g, 0), coalesce(a, 0)) > 0, false) AS engaged, coalesce(greatest(0, coalesce(g, 0), coalesce(a, 0)) > 0, false) AS active,
   g AS code_generation_activity_count, a AS code_acceptance_activity_count, NULL::BIGINT AS user_initiated_interaction_count, NULL::BIGINT AS loc_suggested_to_add_sum,
   NULL::BIGINT AS loc_added_sum, NULL::DOUBLE AS ai_credits_used
  FROM (SELECT scope_kind, scope_slug, day, user_id, e.feature AS feature, e.code_generation_activity_count AS g, e.code_acceptance_activity_count AS a
    FROM (SELECT scope_kind, scope_slug, day, user_id, unnest(totals_by_feature) AS e FROM ud) WHERE e IS NOT NULL AND e.feature IS NOT NULL))"""
_FEATURE = f"SELECT scope_kind, scope_slug, {_DAY}, {_KEY}, feature, {_COUNTED} {_SUMS} FROM fr GROUP BY scope_kind, scope_slug, fr.day, feature"


def _rate(a: str, b: str) -> str:
    return f"coalesce({a}, 0)::DOUBLE / nullif({b}, 0)::DOUBLE"


_REPO = f"""SELECT scope_kind, scope_slug, day, CAST(replace(day, '-', '') AS BIGINT) AS day_key, repo_id, repo_owner_name, repo_name, repo_visibility,
  p.total_created AS pull_requests_created, p.total_created_by_copilot AS pull_requests_created_by_copilot, {_rate('p.total_created_by_copilot', 'p.total_created')} AS copilot_authored_pr_rate,
  p.total_reviewed AS pull_requests_reviewed, p.total_reviewed_by_copilot AS pull_requests_reviewed_by_copilot, {_rate('p.total_reviewed_by_copilot', 'p.total_reviewed')} AS copilot_reviewed_pr_rate,
  p.total_suggestions AS suggestions, p.total_applied_suggestions AS applied_suggestions, {_rate('p.total_applied_suggestions', 'p.total_suggestions')} AS suggestion_apply_rate,
  p.total_merged AS pull_requests_merged, CASE WHEN NOT isnan(p.median_minutes_to_merge) THEN p.median_minutes_to_merge END AS median_minutes_to_merge
  FROM (SELECT *, pull_requests AS p FROM ({_won(REPOS, 'repo_id')}))"""


def _rolled_sql(rows: str, kind: str, dimension: str, keep_zero: bool, method: str, additive: bool) -> str:
    """Distinct users by a range join of emitted days and active rows, unlike the spans of the plan."""
    join = " AND ".join(f"a.{k} = e.{k}" for k in ("scope_kind", "scope_slug"))
    group = "" if dimension == "scope_slug" else ", a.team_id"
    ident = "e.scope_slug" if dimension == "scope_slug" else "CAST(a.team_id AS VARCHAR)"
    name = "e.scope_slug" if dimension == "scope_slug" else "min(a.team_slug)"
    kept = "" if keep_zero else "HAVING count(DISTINCT a.user_id) > 0"
    return f"""SELECT e.scope_kind, e.scope_slug, strftime(e.day, '%Y-%m-%d') AS day, CAST(strftime(e.day, '%Y%m%d') AS BIGINT) AS day_key, '{kind}' AS dimension_type, {ident} AS dimension_id, {name} AS dimension_name,
      CAST(w.n AS BIGINT) AS window_days, count(DISTINCT a.user_id) AS distinct_active_users, '{method}' AS allocation_method, {additive} AS is_additive
    FROM (SELECT DISTINCT scope_kind, scope_slug, day FROM ud) e CROSS JOIN (VALUES (7), (28)) w(n)
    LEFT JOIN ({rows}) a ON {join} AND a.day BETWEEN e.day - (w.n - 1)::INTEGER AND e.day
    GROUP BY e.scope_kind, e.scope_slug, e.day, w.n{group} {kept}"""


_ACTIVE_ROWS = "SELECT * FROM ud WHERE active AND user_id IS NOT NULL"
_TEAM_ACTIVE = "SELECT u.scope_kind, u.scope_slug, u.day, u.user_id, m.team_id, m.team_slug FROM ud u JOIN mem m USING (scope_kind, scope_slug, day, user_id) WHERE u.active"
_PRIMARY_ACTIVE = _TEAM_ACTIVE.replace(" WHERE", " JOIN prim ON prim.user_id = u.user_id AND prim.main = m.team_id WHERE")
_FRESH = f"""{_UD}, {_NEWEST},
 cal AS (SELECT s.*, d.day::DATE AS day, t.report_type FROM (SELECT DISTINCT scope_kind, scope_slug FROM nm) s
   CROSS JOIN (SELECT unnest(generate_series(DATE '2031-03-01', DATE '2031-04-20', INTERVAL 1 DAY)) AS day) d CROSS JOIN (VALUES ('users'), ('user-teams'), ('repositories')) t(report_type)),
 obs AS (SELECT scope_kind, scope_slug, day, 'users' AS report_type, count(*) AS n, max(source_ingested_at) AS newest, sum(42 + {' + '.join(f'({c} IS NULL)::BIGINT' for c in [*SQL_COUNTERS, *SQL_FLAGS, "enterprise_id", "organization_id", "user_login", "source_ingestion_id", "source_ingested_at"])}
       + {' + '.join(f'(ai_adoption_phase.{c} IS NULL)::BIGINT' for c in ("name", "phase_number", "version"))}) AS sparse FROM ud GROUP BY ALL
   UNION ALL SELECT scope_kind, scope_slug, CAST(day AS DATE), 'user-teams', count(*), max(source_ingested_at), sum(2 + (organization_id IS NULL)::BIGINT + (user_login IS NULL)::BIGINT + (nullif(trim(slug), '') IS NULL)::BIGINT
       + (source_ingestion_id IS NULL)::BIGINT + (source_ingested_at IS NULL)::BIGINT) FROM ({_won(TEAMS, "user_id, team_id")}) GROUP BY ALL
   UNION ALL SELECT scope_kind, scope_slug, CAST(day AS DATE), 'repositories', count(*), max(source_ingested_at), sum(1 + {' + '.join(f'({c} IS NULL)::BIGINT' for c in ("enterprise_id", "organization_id", "repo_owner_name", "repo_name", "repo_visibility", "source_ingestion_id", "source_ingested_at"))}
       + {' + '.join(f'(pull_requests.{c} IS NULL)::BIGINT' for c in SQL_PULLS)} + {' + '.join(f'(pull_requests.{c} IS NULL OR isnan(pull_requests.{c}))::BIGINT' for c in SQL_MEDIANS)}) FROM ({_won(REPOS, "repo_id")}) GROUP BY ALL),
 st AS (SELECT c.*, CASE WHEN nm.status = 'success' THEN 'complete' WHEN nm.status = 'no_data' THEN 'no_data' WHEN obs.n IS NOT NULL THEN 'complete'
     WHEN DATE '2031-04-20' - c.day <= 2 THEN 'within_lag' ELSE 'missing' END AS availability_status, nm.ingested_at, obs.n, obs.newest, obs.sparse
   FROM cal c LEFT JOIN nm ON nm.scope_kind = c.scope_kind AND nm.scope_slug = c.scope_slug AND nm.report_type = c.report_type AND nm.report_day = strftime(c.day, '%Y-%m-%d')
   LEFT JOIN obs ON obs.scope_kind = c.scope_kind AND obs.scope_slug = c.scope_slug AND obs.day = c.day AND obs.report_type = c.report_type),
 fresh AS (SELECT scope_kind, scope_slug, {_DAY}, report_type, {_KEY}, availability_status, availability_status = 'complete' AS has_data,
   availability_status = 'no_data' AS is_no_data, availability_status IN ('complete', 'no_data') AS is_complete, DATE '2031-04-20' - st.day <= 2 AS is_within_telemetry_lag,
   greatest(0, DATE '2031-04-20' - st.day - 2)::BIGINT AS days_late,
   strftime(coalesce(ingested_at, CASE WHEN availability_status = 'complete' THEN newest END), '%Y-%m-%d %H:%M:%S.%f') AS latest_source_ingested_at,
   CASE WHEN availability_status = 'complete' THEN coalesce(sparse, 0) ELSE 0 END::BIGINT AS sparse_metric_count FROM st)"""

_ORDERS = "o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders)"
_ORDER_CHANGES = "s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, day, o_totalprice FROM o WHERE o_custkey % 5 = 0 AND year(day) = 1995 AND o_orderkey % 3 <> 0)"
_ORDER_OUT = "o_orderkey, o_custkey, o_orderstatus, strftime(day, '%Y-%m-%d') AS day, o_totalprice"


def _measure_sql(base: str, exprs: dict[str, str], prefix: str) -> str:
    return f"WITH {prefix} SELECT scope_slug, {', '.join(f'{e} AS {n}' for n, e in exprs.items())} FROM ({base}) GROUP BY scope_slug"


def _d(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def _s(column: str, where: str = "") -> str:
    return f"CAST(sum({column}) {f'FILTER ({where})' if where else ''} AS BIGINT)"


#: Objects of a line are followed along the paths of the contract; a lone object or a JSON text stands for an array in the fields named here.
_LONE = "key IN ('totals_by_feature', 'totals_by_ide', 'totals_by_language_feature', 'totals_by_mcp', 'totals_by_slash_cmd', 'day_totals', 'pull_request_review_times')"
_UNKNOWN = f"""WITH RECURSIVE known AS (SELECT report_type, field_path FROM report_field_contracts),
  nodes AS (SELECT record_id, report_type, '' AS path, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS x, CAST([] AS BIGINT[]) AS place FROM {LINES}
      WHERE json_valid(raw_json) AND CASE WHEN json_valid(raw_json) THEN json_type(raw_json) END = 'OBJECT' AND report_type IN (SELECT report_type FROM known)
    UNION ALL
    SELECT record_id, report_type, c.path, c.x, list_concat(place, c.place) FROM (
      SELECT n.record_id, n.report_type, n.place, unnest(CASE WHEN json_type(n.x) = 'ARRAY' THEN
          [{{'path': n.path || '[]', 'x': json_extract(n.x, '$[' || i || ']'), 'place': [i]}} FOR i IN range(0, json_array_length(n.x)::BIGINT)]
        ELSE flatten([CASE WHEN json_type(v.v) = 'OBJECT' AND NOT v.lone THEN [{{'path': v.p, 'x': v.v, 'place': [v.i, 0]}}]
            WHEN json_type(v.v) = 'OBJECT' THEN [{{'path': v.p || '[]', 'x': v.v, 'place': [v.i, 0]}}]
            WHEN json_type(v.v) = 'ARRAY' THEN [{{'path': v.p || '[]', 'x': json_extract(v.v, '$[' || i || ']'), 'place': [v.i, i]}} FOR i IN range(0, json_array_length(v.v)::BIGINT)]
            WHEN v.lone AND v.t <> '' AND json_valid(v.t) AND CASE WHEN json_valid(v.t) THEN json_type(v.t) END = 'ARRAY' THEN
              [{{'path': v.p || '[]', 'x': json_extract(v.t::JSON, '$[' || i || ']'), 'place': [v.i, i]}} FOR i IN range(0, json_array_length(v.t)::BIGINT)]
            ELSE [] END FOR v IN [{{'i': i, 'lone': {_LONE.replace('key', 'json_keys(n.x)[i]')}, 'p': CASE WHEN n.path = '' THEN '' ELSE n.path || '.' END || json_keys(n.x)[i],
                'v': json_extract(n.x, '$."' || json_keys(n.x)[i] || '"'),
                't': CASE WHEN json_type(n.x, '$."' || json_keys(n.x)[i] || '"') = 'VARCHAR' AND left(ltrim(json_extract_string(n.x, '$."' || json_keys(n.x)[i] || '"')), 1) = '['
                  THEN json_extract_string(n.x, '$."' || json_keys(n.x)[i] || '"') ELSE '' END}} FOR i IN range(1, len(json_keys(n.x))::BIGINT + 1)]
              IF list_contains(ks.paths, v.p) AND NOT contains(v.p[len(CASE WHEN n.path = '' THEN '' ELSE n.path || '.' END) + 1:], '.')]) END) AS c
      FROM nodes n JOIN (SELECT report_type, list(field_path) AS paths FROM known GROUP BY ALL) ks ON ks.report_type = n.report_type WHERE json_type(n.x) IN ('OBJECT', 'ARRAY'))),
  members AS (SELECT record_id, report_type, place, path, x, unnest(json_keys(x)) AS key, generate_subscripts(json_keys(x), 1) AS i FROM nodes WHERE json_type(x) = 'OBJECT'),
  named AS (SELECT record_id, report_type, key, list_append(place, i) AS place, CASE WHEN path = '' THEN '' ELSE path || '.' END || key AS field_path, json_type(x, '$."' || key || '"') AS t FROM members)
  SELECT record_id, report_type, field_path, CASE t WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS observed_type
  FROM named WHERE (report_type, field_path) NOT IN (SELECT report_type, field_path FROM known) OR contains(key, '.')
  QUALIFY row_number() OVER (PARTITION BY record_id, field_path ORDER BY place) = 1"""

ORACLE_SQL = {
    "entity_adoption_daily": f"WITH {_UD} {_ENTITY}",
    "entity_fallback_reported": f"""WITH {_UD}, {_NEWEST}, own AS (SELECT scope_kind, scope_slug, ud.day AS d, {_COUNTED} {_SUMS} FROM ud GROUP BY ALL),
      rep AS (SELECT scope_kind, scope_slug, CAST(report_day AS DATE) AS d, record_count FROM nm WHERE report_type = 'users')
      SELECT scope_kind, scope_slug, strftime(d, '%Y-%m-%d') AS day, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS day_key, coalesce(observed_users, 0) AS observed_users,
        CASE WHEN observed_users IS NULL THEN coalesce(record_count, 0) ELSE active_users END AS active_users, coalesce(engaged_users, 0) AS engaged_users,
        interaction_count, generation_count, acceptance_count, acceptance_rate, loc_suggested, loc_accepted, loc_acceptance_rate, ai_credits_used,
        record_count AS source_reported_daily_active_users, NULL::BIGINT AS source_reported_weekly_active_users, NULL::BIGINT AS source_reported_monthly_active_users
      FROM own FULL JOIN rep USING (scope_kind, scope_slug, d)""",
    "team_adoption_daily": f"WITH {_UD}, {_MEM}, {_PRIM}, {_TEAM} SELECT * EXCLUDE (day), {_DAY}, {_KEY} FROM team",
    "repository_impact_daily": _REPO,
    "feature_usage_daily": f"WITH {_UD}, {_FEATURE_ROWS} {_FEATURE}",
    "user_adoption_daily": f"""WITH {_UD} SELECT scope_kind, scope_slug, {_DAY}, {_KEY}, user_id, user_login,
      CASE WHEN engaged THEN 'engaged' WHEN active THEN 'active' ELSE 'inactive' END AS adoption_status, adoption_phase, {_SUMS} FROM ud
      GROUP BY scope_kind, scope_slug, ud.day, user_id, user_login, engaged, active, adoption_phase""",
    "user_adoption_current": f"""WITH {_UD}, h AS (SELECT scope_kind, scope_slug, max(day) AS as_of FROM ud GROUP BY ALL),
      l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scope_kind, scope_slug, user_id ORDER BY day DESC) AS k,
        max(CASE WHEN active THEN day END) OVER (PARTITION BY scope_kind, scope_slug, user_id) AS last_active FROM ud) WHERE k = 1)
      SELECT scope_kind, scope_slug, user_id, user_login, strftime(as_of, '%Y-%m-%d') AS as_of_day, CAST(strftime(as_of, '%Y%m%d') AS BIGINT) AS as_of_day_key,
        CASE WHEN engaged THEN 'engaged' WHEN active THEN 'active' ELSE 'inactive' END AS adoption_status, adoption_phase,
        CAST(as_of - last_active AS BIGINT) AS days_since_activity, as_of - day > 2 AS is_stale FROM l JOIN h USING (scope_kind, scope_slug)""",
    "rolling_entity": f"WITH {_UD} {_rolled_sql(_ACTIVE_ROWS, 'entity', 'scope_slug', True, 'entity', True)}",
    "rolling_team": f"WITH {_UD}, {_MEM} {_rolled_sql(_TEAM_ACTIVE, 'team', 'team_id', False, 'all_memberships', False)}",
    "rolling_primary_team": f"WITH {_UD}, {_MEM}, {_PRIM} {_rolled_sql(_PRIMARY_ACTIVE, 'primary_team', 'team_id', False, 'primary_team', True)}",
    "data_freshness_daily": f"WITH {_FRESH} SELECT * FROM fresh",
    "latest_wins_dedup": f"""SELECT scope_slug, day, user_id, team_id, source_ingestion_id, source_line FROM (SELECT *, row_number() OVER (PARTITION BY scope_slug, day, user_id, team_id
      ORDER BY source_ingested_at DESC, source_ingestion_id DESC, source_line DESC) AS k FROM {TEAMS}) WHERE k = 1""",
    "correction_counts": f"""SELECT scope_slug, day, CAST(sum(n) AS BIGINT) AS source_correction_count FROM (
      {" UNION ALL ".join(f"SELECT t.scope_slug, t.day, count(*) - 1 AS n FROM {n} t JOIN (SELECT scope_slug, day, max(source_ingested_at) AS a FROM {n} GROUP BY ALL) l ON t.scope_slug = l.scope_slug AND t.day = l.day AND t.source_ingested_at = l.a GROUP BY t.scope_slug, t.day, {k}" for n, k in ((USERS, "user_id"), (TEAMS, "user_id, team_id")))}) GROUP BY ALL""",
    "duplicate_issues": f"""SELECT 'user_daily' AS target_table, '["' || scope_slug || '","' || day || '",' || user_id || ']' AS upsert_key_json,
      'duplicate_upsert_key' AS check_name, 'warning' AS severity, count(*) || ' rows shared an upsert key; the deterministic latest row was retained' AS message
      FROM {USERS} t SEMI JOIN (SELECT scope_slug, day, max(source_ingested_at) AS source_ingested_at FROM {USERS} GROUP BY ALL) l USING (scope_slug, day, source_ingested_at)
      GROUP BY scope_slug, day, user_id HAVING count(*) > 1""",
    "latest_manifest": f"WITH {_NEWEST} SELECT scope_slug, report_type, report_day, ingestion_id, status, record_count FROM nm",
    "snapshot_filter": f"""SELECT scope_slug, day, source_ingestion_id, count(*) AS kept_rows FROM {USERS}
      SEMI JOIN (SELECT scope_slug, day, max(source_ingested_at) AS source_ingested_at FROM {USERS} GROUP BY ALL) l USING (scope_slug, day, source_ingested_at) GROUP BY ALL""",
    "manifest_filter": f"""SELECT t.scope_slug, t.day, count(*) AS kept_rows FROM {USERS} t JOIN (SELECT scope_slug, day, max(source_ingested_at) AS a FROM {USERS} GROUP BY ALL) l
      ON t.scope_slug = l.scope_slug AND t.day = l.day AND t.source_ingested_at = l.a WHERE day(CAST(t.day AS DATE)) % 7 <> 0 GROUP BY ALL""",
    "content_duplicates": f"""WITH m AS (SELECT scope_slug, report_type, report_day, status, content_fingerprint, ingestion_id, ingested_at FROM {MANIFESTS} UNION ALL
        SELECT scope_slug, report_type, report_day, status, content_fingerprint, ingestion_id || '-again', ingested_at + INTERVAL 1 DAY FROM {MANIFESTS} WHERE day(CAST(report_day AS DATE)) % 7 = 0)
      SELECT ingestion_id, original_id FROM (SELECT *, first_value(ingestion_id) OVER (PARTITION BY scope_slug, report_type, report_day, status, content_fingerprint
      ORDER BY ingested_at, ingestion_id) AS original_id FROM m) WHERE ingestion_id <> original_id""",
    "upsert_merge": f"WITH {_ORDERS}, {_ORDER_CHANGES} SELECT {_ORDER_OUT} FROM (SELECT * FROM s UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s))",
    "bounded_replacement": f"""WITH {_ORDERS}, {_ORDER_CHANGES} SELECT {_ORDER_OUT} FROM (SELECT * FROM s UNION ALL
      SELECT * FROM o WHERE NOT (o_custkey % 5 = 0 AND year(day) = 1995) AND o_orderkey NOT IN (SELECT o_orderkey FROM s))""",
    "containment_violations": f"WITH {_ORDERS}, {_ORDER_CHANGES} SELECT {_ORDER_OUT} FROM s WHERE day < DATE '1995-02-01' OR day > DATE '1995-11-30'",
    "window_coalesce": f"""WITH d AS (SELECT DISTINCT scope_slug, report_type, unnest(generate_series(CAST(report_day AS DATE), CAST(report_day AS DATE) + (record_count % 3)::INTEGER, INTERVAL 1 DAY))::DATE AS day
        FROM {MANIFESTS} WHERE status = 'success'),
      g AS (SELECT *, day - row_number() OVER (PARTITION BY scope_slug, report_type ORDER BY day)::INTEGER AS island FROM d)
      SELECT scope_slug, report_type, strftime(min(day), '%Y-%m-%d') AS start_day, strftime(max(day), '%Y-%m-%d') AS end_day FROM g GROUP BY scope_slug, report_type, island""",
    "unknown_fields": _UNKNOWN,
    "calendar_dimension": """SELECT strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%b') AS month, strftime(d, '%Y-%b') AS year_month,
      CAST(year(d) * 100 + month(d) AS INTEGER) AS year_month_number FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS d)""",
    "report_calendar": f"""SELECT s.scope_slug, strftime(d.day, '%Y-%m-%d') AS day, t.report_type FROM (SELECT DISTINCT scope_slug FROM {MANIFESTS}) s
      CROSS JOIN (SELECT unnest(generate_series(DATE '2031-03-01', DATE '2031-04-20', INTERVAL 1 DAY)) AS day) d CROSS JOIN (VALUES ('users'), ('user-teams'), ('repositories')) t(report_type)
      WHERE (s.scope_slug, strftime(d.day, '%Y-%m-%d'), t.report_type) NOT IN (SELECT scope_slug, report_day, report_type FROM {MANIFESTS})""",
    "audit_completed": f"""SELECT count(*) > 0 AS completed FROM {MANIFESTS} WHERE report_type = 'users' AND status = 'success' AND report_day = '2031-03-10'
      AND scope_slug = (SELECT min(scope_slug) FROM {MANIFESTS} WHERE report_type = 'users')""",
    "measures_entity": _measure_sql(
        _ENTITY,
        {
            "daily_active_users": _s("active_users"), "observed_users": _s("observed_users"), "engaged_users": _s("engaged_users"),
            "engagement_rate": _d("sum(engaged_users)", "sum(observed_users)"), "generations": _s("generation_count"), "acceptances": _s("acceptance_count"),
            "acceptance_rate": _d("sum(acceptance_count)", "sum(generation_count)"), "lines_suggested": _s("loc_suggested"), "lines_accepted": _s("loc_accepted"),
            "loc_acceptance_rate": _d("sum(loc_accepted)", "sum(loc_suggested)"), "interactions_per_active_user": _d("sum(interaction_count)", "sum(active_users)"),
            "ai_credits_used": "round(sum(ai_credits_used), 2)", "latest_metric_date": "max(day)",
        },
        _UD,
    ),
    "measures_rolling": _measure_sql(
        _rolled_sql(_ACTIVE_ROWS, "entity", "scope_slug", True, "entity", True),
        {"weekly_active_users": _s("distinct_active_users", "WHERE window_days = 7"), "active_users_28_days": _s("distinct_active_users", "WHERE window_days = 28")},
        _UD,
    ),
    "measures_team": _measure_sql(
        "SELECT * FROM team",
        {
            "team_active_users": _s("active_users", "WHERE is_additive"), "team_observed_users": _s("observed_users", "WHERE is_additive"),
            "team_adoption_rate": _d("sum(active_users) FILTER (WHERE is_additive)", "sum(observed_users) FILTER (WHERE is_additive)"),
            "team_acceptance_rate": _d("sum(acceptance_count) FILTER (WHERE is_additive)", "sum(generation_count) FILTER (WHERE is_additive)"),
            "non_additive_team_rows": "nullif(count(*) FILTER (WHERE NOT is_additive), 0)",
            "team_additivity_warning": "CASE WHEN count(*) FILTER (WHERE NOT is_additive) > 0 THEN 'Warning: all-memberships rows can double-count users; executive totals use primary-team rows only.' ELSE 'Additive team allocation is available.' END",
        },
        f"{_UD}, {_MEM}, {_PRIM}, {_TEAM}",
    ),
    "measures_feature": _measure_sql(
        _FEATURE,
        {
            "feature_active_users": _s("active_users"), "feature_observed_users": _s("observed_users"),
            "feature_adoption_rate": _d("sum(active_users)", "sum(observed_users)"), "feature_acceptance_rate": _d("sum(acceptance_count)", "sum(generation_count)"),
        },
        f"{_UD}, {_FEATURE_ROWS}",
    ),
    "measures_repository": _measure_sql(
        "SELECT * FROM rp",
        {
            "pull_requests_created": _s("pull_requests_created"), "assisted_pull_requests": _s("pull_requests_created_by_copilot"),
            "assisted_pr_rate": _d("sum(pull_requests_created_by_copilot)", "sum(pull_requests_created)"), "pull_requests_reviewed": _s("pull_requests_reviewed"),
            "assisted_reviews": _s("pull_requests_reviewed_by_copilot"), "assisted_review_rate": _d("sum(pull_requests_reviewed_by_copilot)", "sum(pull_requests_reviewed)"),
            "suggestion_apply_rate": _d("sum(applied_suggestions)", "sum(suggestions)"),
            "median_minutes_to_merge": "median(median_minutes_to_merge) FILTER (WHERE NOT isnan(median_minutes_to_merge))",
        },
        f"rp AS ({_REPO})",
    ),
    "measures_freshness": _measure_sql(
        "SELECT * FROM fresh",
        {
            "incomplete_report_days": "nullif(count(*) FILTER (WHERE NOT is_complete AND NOT is_within_telemetry_lag), 0)", "maximum_days_late": "max(days_late)",
            "sparse_metric_count": _s("sparse_metric_count"), "latest_source_ingested_at": "max(latest_source_ingested_at)",
            "freshness_status": "CASE WHEN count(*) FILTER (WHERE NOT is_complete AND NOT is_within_telemetry_lag) > 0 THEN 'Attention required' WHEN max(days_late) > 0 THEN 'Within telemetry lag' ELSE 'Current' END",
        },
        _FRESH,
    ),
}
