"""Type-two history: every version of an attribute with the period it held.

``type_two_merge`` takes the current dimension (its open and closed versions)
and a batch of dated observations. The hash of an observed attribute is
compared with that of the version before it; where it differs the open version
is closed with the day before and a new open version is inserted. A batch may
cover one day or many: merging day by day and merging all days at once give the
same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.latest import snapshot_rows, winning_values
from tidemark.session import written

#: Outer characters that are blank.
BLANKS = " \t\r\n\f\v 　"
KEYS = ("entity_kind", "entity_id")
#: Batches of days that a rebuild from all snapshots is merged in.
MERGES = 4
COLUMNS = (*KEYS, "attribute_value", "attribute_hash", "valid_from", "valid_to", "is_current")


def tidy(value: Column) -> Column:
    """``value`` without outer blanks and in lower case; blank becomes null."""
    return F.nullif(F.lower(F.btrim(value, F.lit(BLANKS))), F.lit(""))


def type_two_merge(observations: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Merges ``observations`` (keys, ``attribute_value``, ``day``) into ``current``.

    Columns of the result: ``entity_kind, entity_id, attribute_value,
    attribute_hash, valid_from, valid_to, is_current``. ``valid_to`` is the first
    day of the next version (exclusive), null while open. Null values, entities
    or days are ignored; of several values on one day the greatest counts.
    Observations not later than the start of an open version that repeat or
    contradict it are ignored: late data needs a rebuild from the snapshots.
    """
    seen = (
        observations.where("entity_id IS NOT NULL AND attribute_value IS NOT NULL AND day IS NOT NULL")
        .groupBy(*KEYS, "day")
        .agg(F.max("attribute_value").alias("attribute_value"))
        .select(*KEYS, F.col("day").alias("valid_from"), "attribute_value", F.lit(False).alias("_open"))
    )
    closed = None
    if current is not None:
        closed = current.where("NOT is_current").select(*COLUMNS)
        held = current.where("is_current").select(*KEYS, "valid_from", "attribute_value", F.lit(True).alias("_open"))
        seen = seen.unionByName(held)
    by_entity = Window.partitionBy(*KEYS)
    order = by_entity.orderBy("valid_from", F.col("_open").desc())
    hashed = seen.withColumn("attribute_hash", F.xxhash64("attribute_value"))
    if current is not None:
        start = F.max(F.when(F.col("_open"), F.col("valid_from"))).over(by_entity)
        hashed = hashed.withColumn("_start", start).where("_open OR _start IS NULL OR valid_from > _start")
    # hashes differ in all but 2^-64 of the cases; equal ones are settled by the values
    marked = hashed.withColumn("_before", F.lag("attribute_hash").over(order)).withColumn("_value", F.lag("attribute_value").over(order))
    versions = marked.where("_before IS NULL OR _before <> attribute_hash OR _value <> attribute_value")
    ends = F.lead("valid_from").over(by_entity.orderBy("valid_from"))
    merged = versions.withColumn("valid_to", ends).withColumn("is_current", F.col("valid_to").isNull()).select(*COLUMNS)
    return merged if closed is None else closed.unionByName(merged)


def folded(observations: DataFrame, merges: int = MERGES) -> DataFrame:
    """The dimension after merging ``observations`` in ``merges`` batches of days, each against the versions the one before left.

    Every batch compares its hashes with the current versions, closes those that
    changed and inserts new open ones, as a scheduled load would. Observations
    are written once, and so is the dimension after each merge but the last; what
    comes to the driver is the list of days.
    """
    held = written(observations.where("day IS NOT NULL"))
    days = [r["day"] for r in held.select("day").distinct().orderBy("day").collect()]
    if not days:
        return type_two_merge(held)
    current = None
    size = -(-len(days) // merges)
    for k in range(0, len(days), size):
        batch = held.where(F.col("day").between(days[k], days[min(k + size, len(days)) - 1]))
        merged = type_two_merge(batch, current)
        current = merged if k + size >= len(days) else written(merged)
    return current


def team_slugs(teams: DataFrame) -> DataFrame:
    """Observations of team slugs: the tidied slug that most winning rows of a team and day carry."""
    won = winning_values(snapshot_rows(teams), ["scope_slug", "day", "user_id", "team_id"], F.col("slug"), "slug")
    counted = won.withColumn("value", tidy(F.col("slug"))).where("value IS NOT NULL").groupBy("team_id", "day", "value").count()
    most = F.max(F.struct("count", "value"))["value"]
    return counted.groupBy("team_id", "day").agg(most.alias("attribute_value")).select(
        F.lit("team").alias("entity_kind"), F.col("team_id").alias("entity_id"), "attribute_value", "day"
    )


def user_logins(users: DataFrame) -> DataFrame:
    """Observations of user logins from the winning rows of the users report."""
    won = winning_values(snapshot_rows(users), ["scope_slug", "day", "user_id"], F.col("user_login"), "login")
    return won.select(
        F.lit("user").alias("entity_kind"), F.col("user_id").alias("entity_id"), tidy(F.col("login")).alias("attribute_value"), "day"
    )


def changed_entities(versions: DataFrame) -> DataFrame:
    """All versions of the entities that have two or more."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*KEYS))
    return versions.withColumn("_n", n).where("_n > 1").drop("_n")
