"""Which delivery of a report counts, and which of its rows.

A *delivery* is one ``source_ingestion_id``. The *snapshot* of a scope and day
is its delivery with the greatest ``source_ingested_at`` (ties: the greatest
id); earlier deliveries are superseded as a whole. Within a delivery the row
with the greatest ``source_line`` wins for each key.

Defined cases: rows without a scope, day or ingestion id belong to no snapshot
and are dropped; a null time ranks below every other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import lookup

SCOPE_DAY = ("scope_slug", "day")


def latest_deliveries(df: DataFrame, keys: tuple[str, ...] = SCOPE_DAY) -> DataFrame:
    """One row per ``keys``: the columns of ``keys``, ``source_ingestion_id`` and ``snapshot_seq``.

    ``snapshot_seq`` numbers the snapshots of a scope from 1 in order of day.
    Only the four lineage columns are scanned and pre-aggregated map-side, so
    what is shuffled is one row per delivery and task.
    """
    per_delivery = (
        df.select(*keys, "source_ingestion_id", "source_ingested_at")
        .na.drop(subset=[*keys, "source_ingestion_id"])
        .groupBy(*keys, "source_ingestion_id")
        .agg(F.max("source_ingested_at").alias("_at"))
    )
    newest = Window.partitionBy(*keys).orderBy(F.col("_at").desc_nulls_last(), F.col("source_ingestion_id").desc())
    order = Window.partitionBy(*keys[:-1]).orderBy(keys[-1])
    return (
        per_delivery.withColumn("__rank", F.row_number().over(newest))
        .where("__rank = 1")
        .select(*keys, "source_ingestion_id", F.row_number().over(order).alias("snapshot_seq"))
    )


def snapshot_rows(df: DataFrame, keys: tuple[str, ...] = SCOPE_DAY, deliveries: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` that belong to the snapshot of their scope and day."""
    winners = lookup(latest_deliveries(df, keys)) if deliveries is None else deliveries
    return df.join(winners.select(*keys, "source_ingestion_id"), [*keys, "source_ingestion_id"], "left_semi")


def winning_values(rows: DataFrame, keys: list[str], value: Column, name: str, line: str = "source_line") -> DataFrame:
    """For each of ``keys`` the ``value`` of the row with the greatest ``line``.

    ``max_by`` combines map-side, so a key that holds a large part of the rows
    reaches the reducers as one row per task. Of rows that share a line the
    greater value wins, so the result does not depend on the order of input.
    A null line ranks below every other.
    """
    ranked = rows.select(*keys, value.alias("_value"), F.col(line).alias("_line"))
    return ranked.groupBy(*keys).agg(
        F.max(F.struct(F.coalesce("_line", F.lit(-(2**63))).alias("l"), F.col("_value").alias("v"))).alias("_win")
    ).select(*keys, F.col("_win.v").alias(name))


def winning_rows(df: DataFrame, keys: list[str], rank: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The rows that win among those with equal ``keys``: the greatest by ``rank`` (default ``source_line``), nulls least.

    ``columns`` are those wanted besides the keys (default: all); nothing else is
    read or shuffled. ``max`` combines map-side, so a key that holds a large part
    of the rows reaches the reducers as one row per task. Rows that share a rank
    are told apart by the greater remaining values.
    """
    wanted = [c for c in (columns or df.columns) if c not in keys]
    rest = [F.struct(*wanted).alias("row")] if wanted else []
    whole = F.max(F.struct(*[F.col(c).alias(f"r{k}") for k, c in enumerate(rank or ["source_line"])], *rest)).alias("_win")
    kept = [c for c in df.columns if c in keys or c in wanted]
    return df.groupBy(*keys).agg(whole).select(*[c if c in keys else F.col(f"_win.row.{c}").alias(c) for c in kept])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with ``copies``; null keys compare equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def correction_counts(tables: dict[str, tuple[DataFrame, list[str]]], by: list[str]) -> DataFrame:
    """Surplus rows per ``by`` over all tables: for every key of a table its copies less one."""
    parts = [df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("surplus")).select(*by, "surplus") for df, keys in tables.values()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*by).agg(F.sum("surplus").alias("source_correction_count"))


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """Of each scope, report type and day the newest manifest with a final status (ties: the greatest id)."""
    final = manifests.where(F.col("status").isin("success", "no_data"))
    keys = ["scope_kind", "scope_slug", "report_type", "report_day"]
    if "scope_kind" not in manifests.columns:
        keys = keys[1:]
    return winning_rows(final, keys, ["ingested_at", "ingestion_id"])


def manifest_filter(rows: DataFrame, manifests: DataFrame, report_type: str) -> DataFrame:
    """Rows of deliveries that are the newest of their scope and day, and rows of scope-days without a manifest.

    A newest manifest with status no_data removes every row of its scope and day.
    """
    newest = latest_manifests(manifests.where(F.col("report_type") == report_type)).select(
        "scope_slug", F.col("report_day").alias("day"), F.col("ingestion_id").alias("__id"), F.col("status").alias("__status")
    )
    joined = rows.join(lookup(newest), ["scope_slug", "day"], "left")
    keep = F.col("__status").isNull() | ((F.col("__status") == "success") & (F.col("__id") == F.col("source_ingestion_id")))
    return joined.where(keep).drop("__id", "__status")


def content_duplicates(manifests: DataFrame) -> DataFrame:
    """Manifests whose status and content an earlier one of the same scope, type and day already has."""
    same = Window.partitionBy("scope_slug", "report_type", "report_day", "status", "content_fingerprint").orderBy("ingested_at", "ingestion_id")
    return manifests.withColumn("original_id", F.first("ingestion_id").over(same)).where("original_id <> ingestion_id")
