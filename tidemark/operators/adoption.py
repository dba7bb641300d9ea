"""Adoption tables from cleaned reports: scope, team, dimension, user, rolling and freshness grain.

All functions are lazy. Rows are reduced to user grain before users are counted,
so no plan needs a distinct aggregate over wide rows; sums stay null where
nothing was reported, and rates are ratios of sums.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import Contract
from tidemark.functions.dates import day_key
from tidemark.functions.metrics import ACTIVITY, USERS, activity_rates, activity_sums, is_active, is_engaged, ratio, status
from tidemark.operators.latest import winning_rows
from tidemark.session import lookup

SCOPE = ["scope_kind", "scope_slug"]
SCOPE_DAY = [*SCOPE, "day"]
WINDOWS = (7, 28)
LAG_DAYS = 2


def flagged(users: DataFrame) -> DataFrame:
    """Adds ``active`` and ``engaged``."""
    return users.withColumn("active", is_active(users.columns)).withColumn("engaged", is_engaged(users.columns))


def _users_and_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Users counted once each and activity summed per ``keys``; ``rows`` carry active and engaged.

    Rows are first combined to one per key and user (map-side too), so a key that
    holds a large part of all rows is counted in parallel.
    """
    sums = activity_sums()
    per_user = rows.groupBy(*keys, "user_id").agg(F.max("active").alias("active"), F.max("engaged").alias("engaged"), *sums)
    known = F.col("user_id").isNotNull()
    names = [n for n in ACTIVITY if not n.endswith("_rate")]
    return (
        per_user.groupBy(*keys)
        .agg(
            F.count("user_id").alias("observed_users"),
            F.count(F.when(known & F.col("active"), 1)).alias("active_users"),
            F.count(F.when(known & F.col("engaged"), 1)).alias("engaged_users"),
            *[F.sum(n).alias(n) for n in names],
        )
        .select("*", *activity_rates())
    )


def entity_adoption(users: DataFrame, entity: DataFrame | None = None) -> DataFrame:
    """Adoption per scope and day.

    ``entity`` (scope, day, daily_active_users and optionally weekly, monthly and
    activity columns) adds the figures the source itself reports, and stands in
    for scope-days without user rows: then observed and engaged are 0 and active
    is the reported number (0 if null).
    """
    own = _users_and_sums(flagged(users), SCOPE_DAY)
    if entity is None:
        return own.select(*SCOPE_DAY, day_key(F.col("day")).alias("day_key"), *USERS, *ACTIVITY)
    have = entity.columns
    names = {
        "interaction_count": "user_initiated_interaction_count", "generation_count": "code_generation_activity_count",
        "acceptance_count": "code_acceptance_activity_count", "loc_suggested": "loc_suggested_to_add_sum",
        "loc_accepted": "loc_added_sum", "ai_credits_used": "ai_credits_used",
    }
    reported = entity.select(
        *SCOPE_DAY,
        F.lit(True).alias("_reported"),
        *[(F.col(f"{p}_active_users") if f"{p}_active_users" in have else F.lit(None)).cast("bigint").alias(f"source_reported_{p}_active_users") for p in ("daily", "weekly", "monthly")],
        *[(F.col(c) if c in have else F.lit(None)).cast("double" if n == "ai_credits_used" else "bigint").alias(f"_{n}") for n, c in names.items()],
    )
    both = own.withColumn("_own", F.lit(True)).join(reported, SCOPE_DAY, "full_outer")
    mine = F.col("_own").isNotNull()
    picked = both.select(
        *SCOPE_DAY,
        F.coalesce("observed_users", F.lit(0)).alias("observed_users"),
        F.when(mine, F.col("active_users")).otherwise(F.coalesce("source_reported_daily_active_users", F.lit(0))).alias("active_users"),
        F.coalesce("engaged_users", F.lit(0)).alias("engaged_users"),
        *[F.when(mine, F.col(n)).otherwise(F.col(f"_{n}")).alias(n) for n in names],
        *[f"source_reported_{p}_active_users" for p in ("daily", "weekly", "monthly")],
    )
    return picked.select(
        *SCOPE_DAY, day_key(F.col("day")).alias("day_key"), *USERS, *[n for n in names], *activity_rates(),
        *[f"source_reported_{p}_active_users" for p in ("daily", "weekly", "monthly")],
    )


def with_primary(memberships: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """``memberships`` with ``is_primary``: whether the team is the user's primary one.

    ``mapping`` has user_id, team_id and optionally scope_kind and scope_slug; an
    entry with the member's scope goes before one without. Without a mapping no
    team is primary.
    """
    if mapping is None:
        return memberships.withColumn("is_primary", F.lit(False))
    have = set(mapping.columns)
    scoped = mapping.where("scope_slug IS NOT NULL").select(*SCOPE, "user_id", F.col("team_id").alias("_scoped")) if "scope_slug" in have else None
    plain = (mapping.where("scope_slug IS NULL") if scoped is not None else mapping).select("user_id", F.col("team_id").alias("_plain"))
    out = memberships.join(plain, "user_id", "left")
    mapped = F.col("_plain")
    if scoped is not None:
        out = out.join(scoped, [*SCOPE, "user_id"], "left")
        mapped = F.coalesce("_scoped", "_plain")
    return out.withColumn("is_primary", F.coalesce(F.col("team_id") == mapped, F.lit(False))).drop("_plain", "_scoped")


def team_adoption(memberships: DataFrame, users: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Adoption per team and day by all memberships (not additive), and by primary team if a mapping is given (additive).

    Members meet users once; both methods are folded from the same member rows.
    """
    members = with_primary(memberships.select(*SCOPE_DAY, "user_id", "team_id", "team_slug"), mapping)
    usage = flagged(users).withColumn("_has_row", F.lit(True)).drop("user_login", "team_id", "team_slug", "is_primary")
    keys = [*SCOPE_DAY, "team_id"]
    names = [n for n in ACTIVITY if not n.endswith("_rate")]
    per_user = members.join(usage, [*SCOPE_DAY, "user_id"], "left").groupBy(*keys, "user_id").agg(
        F.min(F.nullif("team_slug", F.lit(""))).alias("team_slug"), F.max("is_primary").alias("is_primary"), F.max("_has_row").alias("_has_row"),
        F.max("active").alias("active"), F.max("engaged").alias("engaged"), *activity_sums(),
    )

    def bundle(where, method: str):
        counted = lambda c: F.count(F.when(where & F.col("user_id").isNotNull() & c, 1))
        return F.struct(
            F.min(F.when(where, F.col("team_slug"))).alias("team_slug"),
            *[counted(F.col(f)).alias(n) for n, f in zip(USERS, ("_has_row", "active", "engaged"))],
            *[F.sum(F.when(where, F.col(n))).alias(n) for n in names],
            F.count(F.when(where, F.col("user_id"))).alias("membership_count"),
            F.lit(method).alias("allocation_method"),
            F.lit(method == "primary_team").alias("is_additive"),
            F.count(F.when(where, 1)).alias("_rows"),
        )

    both = per_user.groupBy(*keys).agg(bundle(F.lit(True), "all_memberships").alias("a"), bundle(F.col("is_primary"), "primary_team").alias("p"))
    each = both.select(*keys, F.inline(F.array("a", "p"))).where("_rows > 0")
    return each.select("*", *activity_rates()).select(
        *SCOPE_DAY, day_key(F.col("day")).alias("day_key"), "team_id", "team_slug", *USERS, *ACTIVITY, "membership_count", "allocation_method", "is_additive"
    )


def dimension_usage(rows: DataFrame, dimension: str) -> DataFrame:
    """Adoption per value of ``dimension`` and day, from breakdown rows (a null user is a row of the whole scope)."""
    out = _users_and_sums(flagged(rows), [*SCOPE_DAY, dimension])
    return out.select(*SCOPE_DAY, day_key(F.col("day")).alias("day_key"), dimension, *USERS, *ACTIVITY)


def repository_impact(repositories: DataFrame) -> DataFrame:
    """Pull-request figures and rates of each repository and day; ``pull_requests`` is a struct.

    A median that is NaN is no number of minutes and comes out as null.
    """
    p = lambda name: F.col(f"pull_requests.{name}")
    known = lambda c: F.when(~F.isnan(c), c)
    return repositories.select(
        *SCOPE_DAY, day_key(F.col("day")).alias("day_key"), "repo_id", "repo_owner_name", "repo_name", "repo_visibility",
        p("total_created").alias("pull_requests_created"), p("total_created_by_copilot").alias("pull_requests_created_by_copilot"),
        ratio(p("total_created_by_copilot"), p("total_created")).alias("copilot_authored_pr_rate"),
        p("total_reviewed").alias("pull_requests_reviewed"), p("total_reviewed_by_copilot").alias("pull_requests_reviewed_by_copilot"),
        ratio(p("total_reviewed_by_copilot"), p("total_reviewed")).alias("copilot_reviewed_pr_rate"),
        p("total_suggestions").alias("suggestions"), p("total_applied_suggestions").alias("applied_suggestions"),
        ratio(p("total_applied_suggestions"), p("total_suggestions")).alias("suggestion_apply_rate"),
        p("total_merged").alias("pull_requests_merged"), known(p("median_minutes_to_merge")).alias("median_minutes_to_merge"),
    )


def user_adoption(users: DataFrame) -> DataFrame:
    """Status and activity of each user and day."""
    marked = flagged(users).select(
        *SCOPE_DAY, day_key(F.col("day")).alias("day_key"), "user_id", "user_login", status(F.col("active"), F.col("engaged")).alias("adoption_status"),
        "adoption_phase", F.col("user_initiated_interaction_count").alias("interaction_count"), F.col("code_generation_activity_count").alias("generation_count"),
        F.col("code_acceptance_activity_count").alias("acceptance_count"), F.col("loc_suggested_to_add_sum").alias("loc_suggested"),
        F.col("loc_added_sum").alias("loc_accepted"), "ai_credits_used",
    )
    return marked.select("*", *activity_rates())


def user_current(users: DataFrame, lag_days: int = LAG_DAYS) -> DataFrame:
    """The last known state of each user over the whole history.

    ``as_of_day`` is the last day of the scope, ``days_since_activity`` counts
    from the last active day (null if never active), and a user is stale when the
    last row lies more than ``lag_days`` before the end of the scope.
    """
    keys = [*SCOPE, "user_id"]
    state = F.struct("day", "user_login", status(F.col("active"), F.col("engaged")).alias("adoption_status"), "adoption_phase")
    last = flagged(users).groupBy(*keys).agg(F.max_by(state, "day").alias("s"), F.max(F.when(F.col("active"), F.col("day"))).alias("last_active"))
    horizon = users.groupBy(*SCOPE).agg(F.max("day").alias("as_of_day"))
    return last.join(horizon, SCOPE).select(
        *SCOPE, "user_id", F.col("s.user_login").alias("user_login"), "as_of_day", day_key(F.col("as_of_day")).alias("as_of_day_key"),
        F.col("s.adoption_status").alias("adoption_status"), F.col("s.adoption_phase").alias("adoption_phase"),
        F.datediff("as_of_day", "last_active").cast("bigint").alias("days_since_activity"),
        (F.datediff("as_of_day", F.col("s.day")) > lag_days).alias("is_stale"),
    )


def _rolling(active: DataFrame, emitted: DataFrame, keys: list[str], windows: tuple[int, ...]) -> DataFrame:
    """Distinct users of the trailing ``windows`` for each emitted key and day, with the least ``name`` of the window's rows.

    An active day makes its user count for the next ``w`` days, or until the
    user's next active day, which takes over. These spans do not overlap, so a
    user enters the count with +1 at the start of a span and leaves with -1 at its
    end, and a running sum over days is the number of distinct users: no set of
    users is held, nothing is counted twice, and the work does not grow with the
    window. Repeated rows give spans of length 0, which cancel.
    """
    following = F.lead("day").over(Window.partitionBy(*keys, "user_id").orderBy("day"))
    spans = active.select(*keys, "user_id", "day", "name").withColumn("_next", following)
    none = F.lit(None).cast("string")

    def event(at, step: int, w: int):
        # only the row of the active day itself carries its name
        return F.struct(at.alias("day"), *[F.lit(step if v == w else 0).alias(f"w{v}") for v in windows], (F.col("name") if step > 0 else none).alias("name"))

    events = []
    for w in windows:
        left = F.date_add("day", w)
        events += [event(F.col("day"), 1, w), event(F.least(left, F.coalesce("_next", left)), -1, w)]
    totals = [*[F.sum(f"w{w}").alias(f"w{w}") for w in windows], F.min("name").alias("name")]
    steps = spans.select(*keys, F.inline(F.array(*events))).groupBy(*keys, "day").agg(*totals)
    asked = emitted.select(*keys, "day", *[F.lit(0).cast("bigint").alias(f"w{w}") for w in windows], none.alias("name"), F.lit(True).alias("_asked"))
    every = steps.withColumn("_asked", F.lit(False)).unionByName(asked).groupBy(*keys, "day").agg(*totals, F.max("_asked").alias("_asked"))
    placed = every.withColumn("_n", F.datediff("day", F.lit("1970-01-01").cast("date")))
    order = Window.partitionBy(*keys).orderBy("_n")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    each = F.array(*[
        F.struct(F.lit(w).cast("bigint").alias("window_days"), F.sum(f"w{w}").over(running).alias("distinct_active_users"), F.min("name").over(order.rangeBetween(1 - w, 0)).alias("name"))
        for w in windows
    ])
    return placed.select(*keys, "day", "_asked", each.alias("_each")).where("_asked").select(*keys, "day", F.inline("_each"))


def rolling_entity(users: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Distinct active users of trailing windows for each scope and each day that has a user row; 0 where none was active."""
    marked = flagged(users).where("active AND user_id IS NOT NULL").withColumn("name", F.col("scope_slug"))
    out = _rolling(marked, users.select(*SCOPE_DAY).distinct(), SCOPE, windows)
    return out.select(
        *SCOPE_DAY, day_key(F.col("day")).alias("day_key"), F.lit("entity").alias("dimension_type"), F.col("scope_slug").alias("dimension_id"), F.col("scope_slug").alias("dimension_name"),
        "window_days", "distinct_active_users", F.lit("entity").alias("allocation_method"), F.lit(True).alias("is_additive"),
    )


def rolling_team(users: DataFrame, memberships: DataFrame, mapping: DataFrame | None = None, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """The same per team, by the membership on the day of activity; a team has a row only where a member counts.

    With ``mapping`` only primary memberships count. A team's name is the least
    name its counting members had within the window.
    """
    members = memberships if mapping is None else with_primary(memberships, mapping).where("is_primary")
    active = flagged(users).where("active AND user_id IS NOT NULL").select(*SCOPE_DAY, "user_id")
    named = members.select(*SCOPE_DAY, "user_id", "team_id", F.nullif("team_slug", F.lit("")).alias("name"))
    joined = active.join(named, [*SCOPE_DAY, "user_id"])
    keys = [*SCOPE, "team_id"]
    lives = joined.groupBy(*keys).agg(F.min("day").alias("_first"), F.date_add(F.max("day"), max(windows) - 1).alias("_last"))
    # a scope has at most a few thousand days, so they travel as one array and each team keeps those of its life
    days = users.select(*SCOPE_DAY).distinct().groupBy(*SCOPE).agg(F.sort_array(F.collect_list("day")).alias("_days"))
    own = F.filter("_days", lambda d: d.between(F.col("_first"), F.col("_last")))
    emitted = lives.join(lookup(days), SCOPE).select(*keys, F.explode(own).alias("day"))
    out = _rolling(joined, emitted, keys, windows).where("distinct_active_users > 0")
    kind = "team" if mapping is None else "primary_team"
    return out.select(
        *SCOPE_DAY, day_key(F.col("day")).alias("day_key"), F.lit(kind).alias("dimension_type"), F.col("team_id").cast("string").alias("dimension_id"), F.col("name").alias("dimension_name"),
        "window_days", "distinct_active_users", F.lit("all_memberships" if mapping is None else "primary_team").alias("allocation_method"), F.lit(mapping is not None).alias("is_additive"),
    )


def freshness(observed: DataFrame, statuses: DataFrame, calendar: DataFrame, as_of: date, lag_days: int = LAG_DAYS) -> DataFrame:
    """Availability of every scope, report type and day of ``calendar``.

    ``observed``: scope, day, report_type, rows, latest_ingested, sparse (nulls in
    core rows). ``statuses``: scope, day, report_type, status (complete or
    no_data), ingested; they override, and rows count only where complete. Where
    neither exists a day within ``lag_days`` of ``as_of`` is within_lag, else missing.
    ``is_within_telemetry_lag`` says so of every such day, whatever arrived.
    """
    keys = [*SCOPE_DAY, "report_type"]
    joined = calendar.join(statuses, keys, "left").join(observed, keys, "left")
    seen = F.col("rows").isNotNull()
    recent = F.datediff(F.lit(as_of).cast("date"), "day") <= lag_days
    state = F.coalesce("status", F.when(seen, "complete"), F.when(recent, "within_lag").otherwise("missing"))
    counted = F.when(state == "complete", F.coalesce("rows", F.lit(0))).otherwise(0)
    late = F.greatest(F.lit(0), F.datediff(F.lit(as_of).cast("date"), "day") - lag_days)
    return joined.select(
        *keys, day_key(F.col("day")).alias("day_key"), state.alias("availability_status"),
        ((counted > 0) | (state == "complete")).alias("has_data"), (state == "no_data").alias("is_no_data"),
        state.isin("complete", "no_data").alias("is_complete"), recent.alias("is_within_telemetry_lag"),
        late.cast("bigint").alias("days_late"), F.coalesce("ingested", F.when(state == "complete", F.col("latest_ingested"))).alias("latest_source_ingested_at"),
        F.when(state == "complete", F.coalesce("sparse", F.lit(0))).otherwise(0).cast("bigint").alias("sparse_metric_count"),
    )


def observed_reports(rows: DataFrame, report_type: str, contract: Contract) -> DataFrame:
    """Per scope and day the rows of a report, the newest ingestion and the nulls among the columns of its contract.

    A nullable column that ``rows`` does not have is null in every row.
    """
    have = set(rows.columns)
    absent = sum(c.nullable and c.name not in have for c in contract.columns)
    nulls = sum((F.col(c.name).isNull().cast("bigint") for c in contract.columns if c.name in have), F.lit(absent).cast("bigint"))
    return rows.groupBy(*SCOPE_DAY).agg(
        F.count(F.lit(1)).alias("rows"), F.max("source_ingested_at").alias("latest_ingested"), F.sum(nulls).alias("sparse")
    ).withColumn("report_type", F.lit(report_type))


def date_dimension(spark, start: str = "2020-01-01", end: str = "2035-12-31") -> DataFrame:
    """One row per day with the year, month and year-month labels and their sort keys."""
    days = spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}')) AS date")
    return days.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month_number"), F.date_format("date", "MMM").alias("month"),
        F.date_format("date", "yyyy-MMM").alias("year_month"), (F.year("date") * 100 + F.month("date")).alias("year_month_number"),
    )


def trim_to(df: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the output days; applied after rolling windows, which need the days before."""
    return df.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))) if "day" in df.columns else df


def with_corrections(gold: DataFrame, corrections: DataFrame, built_at: str) -> DataFrame:
    """Stamps each row with the build time and the corrections of its scope and day."""
    out = gold.join(corrections.select(*SCOPE_DAY, "source_correction_count"), SCOPE_DAY, "left")
    return out.withColumn("source_correction_count", F.coalesce("source_correction_count", F.lit(0))).withColumn("gold_built_at", F.lit(built_at))


def last_known(df: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """The row of the last day of each of ``keys``."""
    return winning_rows(df, keys, [day])
