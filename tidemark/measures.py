"""Named measures over the adoption tables, as aggregate expressions for any filter and grouping.

A rate is the ratio of sums under the current grouping; a null numerator or a
null or zero denominator gives null. Sums over nothing are null, and so is a
count of no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import divide


def _sum(column: str, where: Column | None = None) -> Column:
    return F.sum(F.col(column) if where is None else F.when(where, F.col(column)))


def _count(where: Column) -> Column:
    return F.nullif(F.count(F.when(where, 1)), F.lit(0))


ENTITY, ROLLING, TEAM, FEATURE, REPOSITORY, FRESHNESS = "entity", "rolling", "team", "feature", "repository", "freshness"


def measures() -> dict[str, tuple[str, Column]]:
    """Every measure by name: the table it reads and its aggregate expression."""
    additive = F.col("is_additive")
    entity_rows = F.col("dimension_type") == "entity"
    late = ~F.col("is_complete") & ~F.col("is_within_telemetry_lag")
    incomplete = _count(late)
    extra_rows = _count(~additive)
    warning = "Warning: all-memberships rows can double-count users; executive totals use primary-team rows only."
    return {
        "daily_active_users": (ENTITY, _sum("active_users")),
        "observed_users": (ENTITY, _sum("observed_users")),
        "engaged_users": (ENTITY, _sum("engaged_users")),
        "engagement_rate": (ENTITY, divide(_sum("engaged_users"), _sum("observed_users"))),
        "generations": (ENTITY, _sum("generation_count")),
        "acceptances": (ENTITY, _sum("acceptance_count")),
        "acceptance_rate": (ENTITY, divide(_sum("acceptance_count"), _sum("generation_count"))),
        "lines_suggested": (ENTITY, _sum("loc_suggested")),
        "lines_accepted": (ENTITY, _sum("loc_accepted")),
        "loc_acceptance_rate": (ENTITY, divide(_sum("loc_accepted"), _sum("loc_suggested"))),
        "interactions_per_active_user": (ENTITY, divide(_sum("interaction_count"), _sum("active_users"))),
        "ai_credits_used": (ENTITY, F.round(_sum("ai_credits_used"), 2)),
        "latest_metric_date": (ENTITY, F.max("day")),
        "weekly_active_users": (ROLLING, _sum("distinct_active_users", entity_rows & (F.col("window_days") == 7))),
        "active_users_28_days": (ROLLING, _sum("distinct_active_users", entity_rows & (F.col("window_days") == 28))),
        "team_active_users": (TEAM, _sum("active_users", additive)),
        "team_observed_users": (TEAM, _sum("observed_users", additive)),
        "team_adoption_rate": (TEAM, divide(_sum("active_users", additive), _sum("observed_users", additive))),
        "team_acceptance_rate": (TEAM, divide(_sum("acceptance_count", additive), _sum("generation_count", additive))),
        "non_additive_team_rows": (TEAM, extra_rows),
        "team_additivity_warning": (TEAM, F.when(extra_rows > 0, warning).otherwise("Additive team allocation is available.")),
        "feature_active_users": (FEATURE, _sum("active_users")),
        "feature_observed_users": (FEATURE, _sum("observed_users")),
        "feature_adoption_rate": (FEATURE, divide(_sum("active_users"), _sum("observed_users"))),
        "feature_acceptance_rate": (FEATURE, divide(_sum("acceptance_count"), _sum("generation_count"))),
        "pull_requests_created": (REPOSITORY, _sum("pull_requests_created")),
        "assisted_pull_requests": (REPOSITORY, _sum("pull_requests_created_by_copilot")),
        "assisted_pr_rate": (REPOSITORY, divide(_sum("pull_requests_created_by_copilot"), _sum("pull_requests_created"))),
        "pull_requests_reviewed": (REPOSITORY, _sum("pull_requests_reviewed")),
        "assisted_reviews": (REPOSITORY, _sum("pull_requests_reviewed_by_copilot")),
        "assisted_review_rate": (REPOSITORY, divide(_sum("pull_requests_reviewed_by_copilot"), _sum("pull_requests_reviewed"))),
        "suggestion_apply_rate": (REPOSITORY, divide(_sum("applied_suggestions"), _sum("suggestions"))),
        "median_minutes_to_merge": (REPOSITORY, F.median(F.when(~F.isnan("median_minutes_to_merge"), F.col("median_minutes_to_merge")))),
        "incomplete_report_days": (FRESHNESS, incomplete),
        "maximum_days_late": (FRESHNESS, F.max("days_late")),
        "sparse_metric_count": (FRESHNESS, _sum("sparse_metric_count")),
        "latest_source_ingested_at": (FRESHNESS, F.max("latest_source_ingested_at")),
        "freshness_status": (
            FRESHNESS,
            F.when(incomplete > 0, "Attention required").when(F.max("days_late") > 0, "Within telemetry lag").otherwise("Current"),
        ),
    }


def evaluate(df: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """The measures ``names`` over ``df``, grouped by ``by``."""
    known = measures()
    return df.groupBy(*(by or [])).agg(*[known[n][1].alias(n) for n in names])


def latest_only(df: DataFrame, day: str = "day") -> DataFrame:
    """Rows of the last day: for semi-additive measures that must not be summed over days."""
    last = df.agg(F.max(day).alias("_last"))
    return df.join(F.broadcast(last), F.col(day) == F.col("_last"), "left_semi")  # one row
