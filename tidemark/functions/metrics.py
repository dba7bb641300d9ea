"""Rates, activity flags and aggregate bundles that every adoption table shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contracts import FLAGS

#: Counters any of which makes a user engaged.
ENGAGING = ("user_initiated_interaction_count", "code_generation_activity_count", "code_acceptance_activity_count", "loc_added_sum", "loc_deleted_sum")


def ratio(numerator: Column, denominator: Column) -> Column:
    """A stored rate: null for a null or zero denominator, a null numerator counts as 0."""
    return F.try_divide(F.coalesce(numerator, F.lit(0)).cast("double"), F.nullif(denominator, F.lit(0)).cast("double"))


def divide(numerator: Column, denominator: Column) -> Column:
    """A measure's rate: null for a null or zero denominator, and for a null numerator."""
    return F.try_divide(numerator.cast("double"), F.nullif(denominator, F.lit(0)).cast("double"))


def is_engaged(columns: list[str]) -> Column:
    """Whether any engaging counter among ``columns`` is above 0 (null counts as 0)."""
    used = [F.coalesce(F.col(c), F.lit(0)) for c in ENGAGING if c in columns]
    return F.greatest(*used, F.lit(0)) > 0 if used else F.lit(False)


def is_active(columns: list[str]) -> Column:
    """Engaged, or any usage flag exactly true."""
    out = is_engaged(columns)
    for flag in FLAGS:
        if flag in columns:
            out = out | F.coalesce(F.col(flag), F.lit(False))
    return out


def status(active: Column, engaged: Column) -> Column:
    return F.when(engaged, "engaged").when(active, "active").otherwise("inactive")


def activity_sums() -> list[Column]:
    """The six sums of activity; a sum is null if nothing was present."""
    return [
        F.sum("user_initiated_interaction_count").alias("interaction_count"),
        F.sum("code_generation_activity_count").alias("generation_count"),
        F.sum("code_acceptance_activity_count").alias("acceptance_count"),
        F.sum("loc_suggested_to_add_sum").alias("loc_suggested"),
        F.sum("loc_added_sum").alias("loc_accepted"),
        F.sum("ai_credits_used").alias("ai_credits_used"),
    ]


def activity_rates() -> list[Column]:
    """Ratios of sums, never means of rates."""
    return [
        ratio(F.col("acceptance_count"), F.col("generation_count")).alias("acceptance_rate"),
        ratio(F.col("loc_accepted"), F.col("loc_suggested")).alias("loc_acceptance_rate"),
    ]


ACTIVITY = ["interaction_count", "generation_count", "acceptance_count", "acceptance_rate", "loc_suggested", "loc_accepted", "loc_acceptance_rate", "ai_credits_used"]
USERS = ["observed_users", "active_users", "engaged_users"]
