"""Table contracts: columns with one of five types, nullability and the upsert key.

A contract turns into a Spark schema, projects any DataFrame onto itself (absent
columns become null, extra ones are dropped) and exports itself as JSON.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType()}


def fields(ddl: str) -> tuple[T.StructField, ...]:
    """The fields of a DDL column list, one column a line; read here, as Spark's own parser needs a running session."""
    parts = [line.split() for line in ddl.splitlines() if line.strip()]
    return tuple(T.StructField(name, TYPES[kind], rest != ["NOT", "NULL"]) for name, kind, *rest in parts)


@dataclass(frozen=True)
class Contract:
    """A table: its ``columns`` and its upsert ``key``."""

    name: str
    columns: tuple[T.StructField, ...]
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.columns))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def project(self, df: DataFrame) -> DataFrame:
        """``df`` with exactly the contract's columns and types; values that do not cast become null."""
        have = set(df.columns)
        return df.select(*[(F.col(f"`{c.name}`") if c.name in have else F.lit(None)).try_cast(c.dataType).alias(c.name) for c in self.columns])

    def bind(self, df: DataFrame) -> DataFrame:
        """``project`` with the contract's nullability; a null in a required column fails when it is read."""
        missing = lambda c: F.raise_error(F.lit(f"{self.name}.{c.name} must not be null")).cast(c.dataType)
        return self.project(df).select(*[F.col(c.name) if c.nullable else F.coalesce(F.col(c.name), missing(c)).alias(c.name) for c in self.columns])

    def export(self) -> dict:
        return {"name": self.name, "key": list(self.key), "columns": self.schema.jsonValue()["fields"]}


# ---- fixed values: names, types, order and keys of the tables and of the report fields

COUNTERS = """
ai_credits_used user_initiated_interaction_count code_generation_activity_count code_acceptance_activity_count
loc_suggested_to_add_sum loc_suggested_to_delete_sum loc_added_sum loc_deleted_sum
distinct_custom_agent_use_count distinct_mcp_use_count distinct_plugin_use_count distinct_skill_use_count distinct_slash_cmd_use_count
daily_active_users daily_active_cli_users daily_active_copilot_app_users daily_active_copilot_cloud_agent_users
daily_active_copilot_code_review_users daily_active_vscode_agent_users daily_passive_copilot_code_review_users
weekly_active_users weekly_active_copilot_cloud_agent_users weekly_active_copilot_code_review_users
weekly_active_vscode_agent_users weekly_passive_copilot_code_review_users
monthly_active_users monthly_active_agent_users monthly_active_chat_users monthly_active_copilot_cloud_agent_users
monthly_active_copilot_code_review_users monthly_active_vscode_agent_users monthly_passive_copilot_code_review_users
""".split()
FLAGS = """
used_agent used_chat used_cli used_copilot_app used_copilot_coding_agent used_copilot_cloud_agent
used_copilot_code_review_active used_copilot_code_review_passive used_vscode_agent
""".split()
PULL_REQUESTS = """
total_reviewed total_created total_created_by_copilot total_reviewed_by_copilot total_merged median_minutes_to_merge
total_suggestions total_applied_suggestions total_merged_created_by_copilot median_minutes_to_merge_copilot_authored
total_copilot_suggestions total_copilot_applied_suggestions total_merged_reviewed_by_copilot median_minutes_to_merge_copilot_reviewed
""".split()
BREAKDOWN = """
user_initiated_interaction_count interaction_count session_count code_generation_activity_count code_acceptance_activity_count
loc_suggested_to_add_sum loc_suggested_to_delete_sum loc_added_sum loc_deleted_sum
""".split()
#: Nested arrays of a usage report: the child table and its dimensions.
ARRAYS = {
    "totals_by_feature": ("feature_daily", ("feature",)),
    "totals_by_ide": ("ide_daily", ("ide",)),
    "totals_by_language_feature": ("language_feature_daily", ("language", "feature")),
    "totals_by_language_model": ("language_model_daily", ("language", "model")),
    "totals_by_model_feature": ("model_feature_daily", ("model", "feature")),
    "totals_by_custom_agent": ("custom_agent_daily", ("custom_agent",)),
    "totals_by_3rd_party_agent": ("third_party_agent_daily", ("agent_id",)),
    "totals_by_mcp": ("mcp_daily", ("mcp",)),
    "totals_by_plugin": ("plugin_daily", ("plugin",)),
    "totals_by_skill": ("skill_daily", ("skill",)),
    "totals_by_slash_cmd": ("slash_command_daily", ("slash_command",)),
    "totals_by_ai_adoption_phase": ("adoption_phase_daily", ("phase",)),
}
#: Single nested objects of a usage report and their child table.
OBJECTS = {"totals_by_cli": "cli_daily", "totals_by_copilot_app": "copilot_app_daily", "totals_by_vscode_agent": "vscode_agent_daily"}
#: Where a dimension's field is spelled otherwise in the source.
SOURCE_NAMES = {"slash_command": "slash_cmd"}
#: Child totals that must not exceed their total.
CHILD_OF = {
    "total_created_by_copilot": "total_created",
    "total_reviewed_by_copilot": "total_reviewed",
    "total_merged_created_by_copilot": "total_merged",
    "total_merged_reviewed_by_copilot": "total_merged",
    "total_copilot_suggestions": "total_suggestions",
    "total_copilot_applied_suggestions": "total_applied_suggestions",
}
REPORT_TYPES = ("entity", "users", "user-teams", "repositories")
REPORT_ALIASES = {"user": "users", "user_teams": "user-teams", "repository": "repositories", "repos": "repositories"}

_BASE = fields("""
    scope_kind string NOT NULL
    scope_slug string NOT NULL
    day date NOT NULL
    day_key bigint NOT NULL
    enterprise_id string
    organization_id string
""")
_LINEAGE = fields("""
    source_report_type string NOT NULL
    source_report_day date NOT NULL
    source_ingestion_id string
    source_ingested_at string
    source_path string
    source_record_hash string NOT NULL
""")
_COUNTERS = tuple(T.StructField(n, TYPES["double" if n == "ai_credits_used" else "bigint"]) for n in COUNTERS)
_FLAGS = tuple(T.StructField(n, TYPES["boolean"]) for n in FLAGS)
_PULL_REQUESTS = tuple(T.StructField(f"pr_{n}", TYPES["double" if n.startswith("median_") else "bigint"]) for n in PULL_REQUESTS)
_BREAKDOWN = tuple(T.StructField(n, TYPES["bigint"]) for n in BREAKDOWN)
_SCOPE_DAY = ("scope_kind", "scope_slug", "day")


def _silver(name: str, own: tuple[T.StructField, ...], *key: str) -> Contract:
    return Contract(name, (*_BASE, *own, *_LINEAGE), (*_SCOPE_DAY, *key))


def _breakdown(name: str, dimensions: str, *key: str) -> Contract:
    return _silver(name, (*fields("user_id bigint"), *fields(dimensions), *_BREAKDOWN), "user_id", *key)


_SILVER = [
    _silver(
        "entity_daily",
        (
            *_COUNTERS,
            *_PULL_REQUESTS,
            *fields("""
                report_start_day date
                report_end_day date
            """),
        ),
    ),
    _silver(
        "user_daily",
        (
            *fields("""
                user_id bigint NOT NULL
                user_login string
            """),
            *_COUNTERS,
            *_FLAGS,
            *_PULL_REQUESTS,
            *fields("""
                adoption_phase string
                adoption_phase_number bigint
                adoption_phase_version string
            """),
        ),
        "user_id",
    ),
    _silver(
        "user_team_daily",
        fields("""
            user_id bigint NOT NULL
            user_login string
            team_id bigint NOT NULL
            team_slug string
        """),
        "user_id",
        "team_id",
    ),
    _silver(
        "repository_daily",
        (
            *fields("""
                repo_id bigint NOT NULL
                repo_owner_name string
                repo_name string
                repo_visibility string
            """),
            *_PULL_REQUESTS,
        ),
        "repo_id",
    ),
    _breakdown("feature_daily", "feature string NOT NULL", "feature"),
    _breakdown(
        "ide_daily",
        """
        ide string NOT NULL
        ide_version string
        ide_version_sampled_at string
        plugin string
        plugin_version string
        plugin_version_sampled_at string
        """,
        "ide",
    ),
    _breakdown(
        "language_feature_daily",
        """
        language string NOT NULL
        feature string NOT NULL
        """,
        "language",
        "feature",
    ),
    _breakdown(
        "language_model_daily",
        """
        language string NOT NULL
        model string NOT NULL
        """,
        "language",
        "model",
    ),
    _breakdown(
        "model_feature_daily",
        """
        model string NOT NULL
        feature string NOT NULL
        """,
        "model",
        "feature",
    ),
    _breakdown("custom_agent_daily", "custom_agent string NOT NULL", "custom_agent"),
    # an agent's name may change or be absent, so its id alone is the key
    _breakdown(
        "third_party_agent_daily",
        """
        agent_id string NOT NULL
        agent_name string
        """,
        "agent_id",
    ),
    _breakdown("mcp_daily", "mcp string NOT NULL", "mcp"),
    _breakdown("plugin_daily", "plugin string NOT NULL", "plugin"),
    _breakdown("skill_daily", "skill string NOT NULL", "skill"),
    _breakdown("slash_command_daily", "slash_command string NOT NULL", "slash_command"),
    _silver(
        "adoption_phase_daily",
        fields("""
            user_id bigint
            phase string NOT NULL
            phase_number bigint
            total_engaged_users bigint
            users_in_phase_28d bigint
            total_pull_requests_merged bigint
            avg_code_acceptance_activities double
            avg_code_generation_activities double
            avg_loc_added double
            avg_loc_deleted double
            avg_pull_requests_created double
            avg_pull_requests_median_minutes_to_merge double
            avg_pull_requests_merged double
            avg_pull_requests_minutes_to_review double
            avg_pull_requests_review_cycles double
            avg_pull_requests_reviewed double
            avg_user_initiated_interactions double
        """),
        "user_id",
        "phase",
    ),
    _silver(
        "cli_daily",
        fields("""
            user_id bigint
            prompt_count bigint
            request_count bigint
            session_count bigint
            avg_tokens_per_request double
            output_tokens_sum bigint
            prompt_tokens_sum bigint
            last_known_cli_version string
            last_known_cli_version_sampled_at string
        """),
        "user_id",
    ),
    _silver(
        "copilot_app_daily",
        fields("""
            user_id bigint
            prompt_count bigint
            request_count bigint
            session_count bigint
            avg_tokens_per_request double
            output_tokens_sum bigint
            prompt_tokens_sum bigint
        """),
        "user_id",
    ),
    _silver(
        "vscode_agent_daily",
        fields("""
            user_id bigint
            session_count bigint
            total_user_messages bigint
        """),
        "user_id",
    ),
    _silver(
        "feature_engagement_daily",
        fields("""
            feature string NOT NULL
            active_user_count bigint
            engaged_user_count bigint
        """),
        "feature",
    ),
    _silver(
        "repository_pr_comment_type_daily",
        fields("""
            repo_id bigint NOT NULL
            comment_type string NOT NULL
            total_copilot_suggestions bigint
            total_copilot_applied_suggestions bigint
        """),
        "repo_id",
        "comment_type",
    ),
    _silver(
        "repository_pr_review_time_daily",
        fields("""
            repo_id bigint NOT NULL
            authored_by string NOT NULL
            reviewed_by string NOT NULL
            total_merged bigint
            median_minutes_ready_to_first_review double
            p90_minutes_ready_to_first_review double
            median_minutes_first_to_final_review double
            p90_minutes_first_to_final_review double
            median_minutes_final_review_to_merge double
            p90_minutes_final_review_to_merge double
        """),
        "repo_id",
        "authored_by",
        "reviewed_by",
    ),
    Contract(
        "silver_quarantine",
        fields("""
            scope_kind string NOT NULL
            scope_slug string NOT NULL
            report_type string NOT NULL
            target_table string NOT NULL
            day date
            source_ingestion_id string
            source_path string
            source_record_hash string NOT NULL
            nested_field string
            nested_index bigint
            reason_codes_json string NOT NULL
            raw_record_json string NOT NULL
        """),
        ("source_record_hash", "target_table", "nested_field", "nested_index"),
    ),
    Contract(
        "silver_schema_drift",
        fields("""
            scope_kind string NOT NULL
            scope_slug string NOT NULL
            report_type string NOT NULL
            day date
            source_record_hash string NOT NULL
            field_path string NOT NULL
            observed_type string NOT NULL
            sample_value_json string NOT NULL
        """),
        ("source_record_hash", "field_path"),
    ),
    Contract(
        "silver_quality_issues",
        fields("""
            target_table string NOT NULL
            upsert_key_json string
            check_name string NOT NULL
            severity string NOT NULL
            message string NOT NULL
        """),
        ("target_table", "upsert_key_json", "check_name"),
    ),
]
SILVER: dict[str, Contract] = {c.name: c for c in _SILVER}

_GOLD_BASE = fields("""
    scope_kind string NOT NULL
    scope_slug string NOT NULL
    day date NOT NULL
    day_key bigint NOT NULL
""")
_BUILD = fields("""
    gold_built_at string NOT NULL
    source_correction_count bigint NOT NULL
""")
_ACTIVITY = fields("""
    interaction_count bigint
    generation_count bigint
    acceptance_count bigint
    acceptance_rate double
    loc_suggested bigint
    loc_accepted bigint
    loc_acceptance_rate double
    ai_credits_used double
""")
_ADOPTION = (
    *fields("""
        observed_users bigint NOT NULL
        active_users bigint NOT NULL
        engaged_users bigint NOT NULL
    """),
    *_ACTIVITY,
)


def _gold(name: str, own: tuple[T.StructField, ...], *key: str) -> Contract:
    return Contract(name, (*_GOLD_BASE, *own, *_BUILD), (*_SCOPE_DAY, *key))


_GOLD = [
    _gold(
        "entity_adoption_daily",
        (
            *_ADOPTION,
            *fields("""
                source_reported_daily_active_users bigint
                source_reported_weekly_active_users bigint
                source_reported_monthly_active_users bigint
            """),
        ),
    ),
    _gold(
        "team_adoption_daily",
        (
            *fields("""
                team_id bigint NOT NULL
                team_slug string
            """),
            *_ADOPTION,
            *fields("""
                membership_count bigint NOT NULL
                allocation_method string NOT NULL
                is_additive boolean NOT NULL
            """),
        ),
        "team_id",
        "allocation_method",
    ),
    _gold(
        "repository_copilot_impact_daily",
        fields("""
            repo_id bigint NOT NULL
            repo_owner_name string
            repo_name string
            repo_visibility string
            pull_requests_created bigint
            pull_requests_created_by_copilot bigint
            copilot_authored_pr_rate double
            pull_requests_reviewed bigint
            pull_requests_reviewed_by_copilot bigint
            copilot_reviewed_pr_rate double
            suggestions bigint
            applied_suggestions bigint
            suggestion_apply_rate double
            pull_requests_merged bigint
            median_minutes_to_merge double
        """),
        "repo_id",
    ),
    _gold("feature_usage_daily", (*fields("feature string NOT NULL"), *_ADOPTION), "feature"),
    _gold("language_usage_daily", (*fields("language string NOT NULL"), *_ADOPTION), "language"),
    _gold("ide_usage_daily", (*fields("ide string NOT NULL"), *_ADOPTION), "ide"),
    _gold(
        "user_adoption_daily",
        (
            *fields("""
                user_id bigint NOT NULL
                user_login string
                adoption_status string NOT NULL
                adoption_phase string
            """),
            *_ACTIVITY,
        ),
        "user_id",
    ),
    Contract(
        "user_adoption_current",
        (
            *fields("""
                scope_kind string NOT NULL
                scope_slug string NOT NULL
                user_id bigint NOT NULL
                user_login string
                as_of_day date NOT NULL
                as_of_day_key bigint NOT NULL
                adoption_status string NOT NULL
                adoption_phase string
                days_since_activity bigint
                is_stale boolean NOT NULL
            """),
            *_BUILD,
        ),
        ("scope_kind", "scope_slug", "user_id"),
    ),
    _gold(
        "adoption_rolling_daily",
        fields("""
            dimension_type string NOT NULL
            dimension_id string NOT NULL
            dimension_name string
            window_days bigint NOT NULL
            distinct_active_users bigint NOT NULL
            allocation_method string NOT NULL
            is_additive boolean NOT NULL
        """),
        "dimension_type",
        "dimension_id",
        "window_days",
    ),
    _gold(
        "data_freshness_daily",
        fields("""
            report_type string NOT NULL
            availability_status string NOT NULL
            has_data boolean NOT NULL
            is_no_data boolean NOT NULL
            is_complete boolean NOT NULL
            is_within_telemetry_lag boolean NOT NULL
            days_late bigint NOT NULL
            latest_source_ingested_at string
            sparse_metric_count bigint NOT NULL
        """),
        "report_type",
    ),
]
GOLD: dict[str, Contract] = {c.name: c for c in _GOLD}


def export() -> dict[str, list[dict]]:
    """All contracts as plain JSON values."""
    return {"silver": [c.export() for c in SILVER.values()], "gold": [c.export() for c in GOLD.values()]}
