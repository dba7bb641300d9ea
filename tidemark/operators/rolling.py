"""Trailing totals from event-contribution deltas.

An amount on day ``d`` adds to every trailing total of ``w`` days from ``d`` on
and leaves it on day ``d + w``. So each amount becomes a ``+x`` at ``d`` and a
``-x`` at ``d + w``; a running sum of these deltas over the days is the total,
and the work does not depend on the length of the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import day_number, number_to_iso
from tidemark.operators.latest import snapshot_rows, winning_values


def trailing_totals(
    amounts: DataFrame, entity: str, number: str, amount: str, windows: tuple[int, ...], first: int, last: int
) -> DataFrame:
    """Trailing totals and averages for every ``entity`` and every day from ``first`` to ``last``.

    ``amounts`` has an entity, a day number and an amount; several rows of one
    entity and day add up, null amounts count as 0, rows without an entity or
    day are dropped, and days after ``last`` are ignored (amounts before
    ``first`` still count). The average divides by the full window length, as
    days without activity are days too. Columns: entity, day number,
    ``total_<w>``, ``average_<w>``.

    One exchange on the entity serves the aggregation of deltas and the running
    sum. Amounts must be pre-aggregated per entity and day, so that an entity
    has at most as many rows as there are days.
    """
    amounts = amounts.where(F.col(entity).isNotNull() & F.col(number).isNotNull() & (F.col(number) <= last))
    placed = amounts.select(entity, F.col(number).cast("int").alias("_n"), F.coalesce(F.col(amount), F.lit(0)).alias("_x"))
    placed = placed.repartition(entity)
    zero = F.lit(0).cast(placed.schema["_x"].dataType)

    def event(at, w: int | None, value):
        return F.struct(
            at.cast("int").alias("n"),
            *[(value if w is None or v == w else zero).alias(f"d{v}") for v in windows],
        )

    changes = F.array(event(F.col("_n"), None, F.col("_x")), *[event(F.col("_n") + w, w, -F.col("_x")) for w in windows])
    calendar = F.transform(F.sequence(F.lit(first), F.lit(last)), lambda n: event(n, 0, zero))
    # one row of each entity also brings the days without an amount
    once = F.row_number().over(Window.partitionBy(entity).orderBy("_n")) == 1
    events = placed.withColumn("_once", once).select(
        entity, F.explode(F.when(F.col("_once"), F.concat(changes, calendar)).otherwise(changes)).alias("e")
    )
    summed = (
        events.where(F.col("e.n") <= last)
        .groupBy(entity, F.greatest(F.col("e.n"), F.lit(first - 1)).alias(number))
        .agg(*[F.sum(f"e.d{w}").alias(f"_d{w}") for w in windows])
    )
    running = Window.partitionBy(entity).orderBy(number).rowsBetween(Window.unboundedPreceding, 0)
    totals = summed.select(entity, number, *[F.sum(f"_d{w}").over(running).alias(f"total_{w}") for w in windows])
    return totals.where(F.col(number) >= first).select(
        entity, number, *[c for w in windows for c in (f"total_{w}", (F.col(f"total_{w}") / w).alias(f"average_{w}"))]
    )


def user_trailing_totals(
    users: DataFrame, amount: str = "code_generation_activity_count", windows: tuple[int, ...] = (7, 30)
) -> DataFrame:
    """Trailing totals of ``amount`` per user and calendar day of the users report.

    The amounts are those of the snapshots' winning rows. The calendar runs from
    the first to the last day of the table, for every user with
    a readable day in it, be it in superseded deliveries only.
    """
    rows = snapshot_rows(users)
    won = winning_values(rows, ["scope_slug", "day", "user_id"], F.col(amount), "amount")
    placed = won.select("user_id", day_number("day").alias("day_number"), "amount")
    span = users.select(F.min(day_number("day")).alias("a"), F.max(day_number("day")).alias("b")).first()
    if span is None or span["a"] is None:
        placed, first, last = placed.limit(0), 0, 0
    else:
        first, last = span["a"], span["b"]
        # an amount of 0 brings in users without a winning row; distinct combines map-side
        every = users.where(day_number("day").isNotNull()).select("user_id").distinct()
        zero = F.lit(0).cast(placed.schema["amount"].dataType)
        placed = placed.unionByName(every.select("user_id", F.lit(first).alias("day_number"), zero.alias("amount")))
    out = trailing_totals(placed, "user_id", "day_number", "amount", windows, first, last)
    return out.select(
        "user_id",
        number_to_iso(F.col("day_number")).alias("day"),
        *[c for w in windows for c in (f"total_{w}", f"average_{w}")],
    )
