"""Queries over raw report lines: one per cleaned table, bound to its contract, and the checks behind them.

The raw lines of users, repositories and entity reports are those of the data
directory. There are none of user-teams reports, so these are spelled from the
typed table, one JSON line per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import SILVER
from tidemark.operators import adoption, silver
from tidemark.plans.line_oracles import ORACLE_SQL  # noqa: F401
from tidemark.plans.report_queries import LINES, TEAMS
from tidemark.session import materialized, spread, table


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spread(table(spark, sf_dir, LINES)).withColumn("scope_kind", F.lit("enterprise"))
    members = F.struct("day", "organization_id", "user_id", "user_login", "team_id", "slug")
    teams = table(spark, sf_dir, TEAMS).select(
        F.lit("organization").alias("scope_kind"), "scope_slug", F.lit("user_teams").alias("report_type"), F.col("day").alias("report_day"), "source_ingestion_id",
        "source_ingested_at", F.col("source_line").alias("line_no"), F.to_json(members, {"ignoreNullFields": "false"}).alias("raw_json"),
    )
    return own.unionByName(teams, allowMissingColumns=True)


def normalizer(spark: SparkSession, sf_dir: str, keep=lambda df: df) -> silver.Normalizer:
    return silver.Normalizer(raw_lines(spark, sf_dir), keep=keep)


def dated(df: DataFrame) -> DataFrame:
    """Dates as text."""
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n, t in df.dtypes if t == "date"})


def _table(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # the hash of the canonical form is compared in the tests: SQL has no canonical JSON
        return dated(normalizer(spark, sf_dir).table(name).drop("source_record_hash"))

    return run


def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarantined record and entry, before rows of equal records are united; counted without the raw JSON and its hash."""
    rows = SILVER["silver_quarantine"].bind(normalizer(spark, sf_dir, materialized).quarantine())
    kept = [c for c in rows.columns if c not in ("source_record_hash", "raw_record_json")]
    return dated(rows.groupBy(*kept).agg(F.count(F.lit(1)).alias("copies")))


def silver_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unknown field of a record or entry, before rows of equal records are united; counted without the sample and the hash."""
    rows = SILVER["silver_schema_drift"].bind(normalizer(spark, sf_dir, materialized).drift())
    kept = [c for c in rows.columns if c not in ("source_record_hash", "sample_value_json")]
    return dated(rows.groupBy(*kept).agg(F.count(F.lit(1)).alias("copies")))


def silver_quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalizer(spark, sf_dir, materialized).table("silver_quality_issues")


def _validation(report_type: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bad = normalizer(spark, sf_dir).checked(report_type).where(F.size("reasons") > 0)
        return bad.select("record_id", "day_index", F.array_join("reasons", ",").alias("reasons"))

    return run


def _usage(name: str, dimension: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = normalizer(spark, sf_dir).table(name).where("user_id IS NOT NULL").withColumn("ai_credits_used", F.lit(None).cast("double"))
        return dated(adoption.dimension_usage(rows, dimension))

    return run


QUERIES = {
    **{f"silver_{n}": _table(n) for n in SILVER if not n.startswith("silver_")},
    "silver_quarantine": silver_quarantine,
    "silver_schema_drift": silver_schema_drift,
    "silver_quality_issues": silver_quality_issues,
    "validation_users": _validation("users"),
    "validation_entity": _validation("entity"),
    "validation_repositories": _validation("repositories"),
    "language_usage_daily": _usage("language_feature_daily", "language"),
    "ide_usage_daily": _usage("ide_daily", "ide"),
}
