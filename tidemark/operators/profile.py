"""Column profiles per delivery, and the deliveries whose profile breaks.

One scan compiles every check of every profiled column into additive states:
the rows of each delivery and column are counted per *value bin* (null, NaN,
zero, and signed half-octaves of the magnitude; of texts the same for their
length, blanks apart) together with sums, extremes, violations of rules and
patterns and cross moments with a companion column. States of parts of the data
merge by adding (or taking the least or greatest), so they are stored per load
and a new load never needs the old rows. Profiles are folds of the states.

A delivery is judged against the other deliveries of its scope on days of the
same kind (weekend or not): the expected share of each bin is the median over
the deliveries, and the *excess* of a delivery is the share of its rows lying
above expectation, i.e. the share of rows that must be different. Historical
control limits (median plus a multiple of the median absolute deviation of the
excess) keep sampling noise of small deliveries from being reported. New loads
can be judged by stored states of earlier ones alone (``history``).

Defined cases: an empty table gives no states; rows without a scope or delivery
are counted in the states but not judged; NaN and infinities have their own
bins; an unreadable day counts as a weekday; a delivery judged with fewer than
``MIN_PEERS`` peers of its day kind is judged against all days of the scope.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_date

#: The share of rows that makes a break (by the statement of the problem), and how much of it may land in bins where rows
#: lie anyway: broken values are seen as excess only outside of these, so the least excess is what must be left.
BROKEN_SHARE, HIDDEN = 0.1, 0.3
LEAST_EXCESS = BROKEN_SHARE * (1 - HIDDEN)
#: Width of the control limits in standard deviations: one false alarm in about 30,000 for normal noise.
LIMIT_WIDTH, MIN_PEERS = 4.0, 4
#: The same for the loss of correlation with the companion column.
LEAST_CORRELATION_LOSS, CORRELATION_WIDTH = 0.25, 8.0
#: Standard deviation per median absolute deviation of a normal distribution.
MAD_SCALE = 1.4826


@dataclass(frozen=True)
class ColumnCheck:
    """A profiled column: its (nested) name, a companion it should agree with, row rules and a pattern.

    ``rules`` maps a rule's name to a Column that is true where a row violates it.
    A ``text`` column is profiled by its length; values that do not match
    ``pattern`` (a regular expression for the whole value) are violations.
    """

    column: str
    companion: str | None = None
    rules: dict[str, Column] = field(default_factory=dict)
    text: bool = False
    pattern: str | None = None

    def violations(self) -> list[Column]:
        own = [F.coalesce(v, F.lit(False)).cast("int") for v in self.rules.values()]
        if self.pattern:
            own.append(F.coalesce(~F.col(self.column).rlike(self.pattern), F.lit(False)).cast("int"))
        return own


def value_bin(x: Column) -> Column:
    """The bin of a number: 0 null, 1 NaN, 2 zero, else 1000 + half-octave (positive) or -1000 - half-octave."""
    octave = F.greatest(F.lit(-200), F.least(F.lit(400), F.floor(F.log2(F.abs(x)) * 2))).cast("int")
    return (
        F.when(x.isNull(), 0).when(F.isnan(x), 1).when(x == 0, 2).when(x > 0, 1000 + octave).otherwise(-1000 - octave)
    ).cast("int")


def profile_states(df: DataFrame, table_name: str, checks: list[ColumnCheck], distinct: bool = False) -> DataFrame:
    """Mergeable states: one row per scope, delivery, column and value bin.

    All columns share one scan and one map-side aggregation; the shuffle carries
    at most bins x columns rows per delivery and task, whatever its rows.
    With ``distinct`` each state also carries a HyperLogLog sketch of its values.
    """
    parts = []
    for c in checks:
        x = (F.length(F.btrim(F.col(c.column))) if c.text else F.col(c.column)).cast("double")
        y = F.col(c.companion).cast("double") if c.companion else F.lit(None).cast("double")
        finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
        violations = c.violations()
        parts.append(
            F.struct(
                F.lit(c.column).alias("column_name"),
                F.when(finite, x).alias("x"),
                F.col(c.column).cast("string").alias("raw"),
                value_bin(x).alias("bin"),
                F.when(finite, F.log1p(F.abs(x))).alias("lx"),
                F.when(finite, F.log1p(F.abs(y))).alias("ly"),
                (F.greatest(*violations) if len(violations) > 1 else violations[0] if violations else F.lit(0)).alias("bad"),
            )
        )
    weekend = F.coalesce(F.dayofweek(iso_date("day")).isin(1, 7), F.lit(False))
    rows = df.select("scope_slug", "source_ingestion_id", "day", weekend.alias("weekend"), F.explode(F.array(*parts)).alias("c"))
    both = F.col("c.lx").isNotNull() & F.col("c.ly").isNotNull()
    moment = lambda e: F.sum(F.when(both, e))
    sketch = [F.hll_sketch_agg("c.raw").alias("sketch")] if distinct else []
    return (
        rows.groupBy("scope_slug", "source_ingestion_id", F.col("c.column_name").alias("column_name"), F.col("c.bin").alias("bin"))
        .agg(
            F.max("day").alias("day"),
            F.max("weekend").alias("weekend"),
            F.count(F.lit(1)).alias("n"),
            F.min("c.x").alias("least"),
            F.max("c.x").alias("greatest"),
            F.sum("c.x").alias("total"),
            F.sum("c.bad").alias("violations"),
            F.count(F.when(both, 1)).alias("pairs"),
            moment(F.col("c.lx")).alias("sx"),
            moment(F.col("c.ly")).alias("sy"),
            moment(F.col("c.lx") * F.col("c.lx")).alias("sxx"),
            moment(F.col("c.ly") * F.col("c.ly")).alias("syy"),
            moment(F.col("c.lx") * F.col("c.ly")).alias("sxy"),
            *sketch,
        )
        .withColumn("table_name", F.lit(table_name))
    )


ADDITIVE = ("n", "total", "violations", "pairs", "sx", "sy", "sxx", "syy", "sxy")
STATE_KEYS = ("table_name", "scope_slug", "source_ingestion_id", "column_name", "bin")


def merge_states(*states: DataFrame) -> DataFrame:
    """States of the union of the data behind ``states``."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    sketch = [F.hll_union_agg("sketch").alias("sketch")] if "sketch" in every.columns else []
    return every.groupBy(*STATE_KEYS).agg(
        F.max("day").alias("day"),
        F.max("weekend").alias("weekend"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        *[F.sum(c).alias(c) for c in ADDITIVE],
        *sketch,
    )


PROFILE_KEYS = ("table_name", "column_name", "scope_slug", "source_ingestion_id")


def profiles(states: DataFrame) -> DataFrame:
    """One row per delivery and column: counts, ranges, violations, correlation with the companion."""
    share = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    sketch = [F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")] if "sketch" in states.columns else []
    s = {k: F.sum(k) for k in ("pairs", "sx", "sy", "sxx", "syy", "sxy")}
    vx = s["pairs"] * s["sxx"] - s["sx"] * s["sx"]
    vy = s["pairs"] * s["syy"] - s["sy"] * s["sy"]
    r = F.when((vx > 1e-6) & (vy > 1e-6), (s["pairs"] * s["sxy"] - s["sx"] * s["sy"]) / F.sqrt(vx * vy))
    return states.groupBy(*PROFILE_KEYS).agg(
        F.max("day").alias("day"),
        F.max("weekend").alias("weekend"),
        F.sum("n").alias("row_count"),
        share(F.col("bin") == 0).alias("null_count"),
        share(F.col("bin") == 1).alias("nan_count"),
        share(F.col("bin") == 2).alias("zero_count"),
        share(F.col("bin") < 0).alias("negative_count"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.sum("total").alias("total"),
        F.sum("violations").alias("violations"),
        r.alias("correlation"),
        *sketch,
    )


def _median_with_zeros(values: Column, n: Column) -> Column:
    """Median of ``n`` numbers of which ``values`` lists those that are not 0."""
    ordered = F.sort_array(values)
    at = lambda k: F.when(k < n - F.size(ordered), F.lit(0.0)).otherwise(
        F.get(ordered, (k - (n - F.size(ordered))).cast("int"))
    )
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def excess(states: DataFrame) -> DataFrame:
    """The share of each delivery's rows in bins above what its peers have there: ``excess``, ``peers``.

    Peers are the deliveries of rows with ``_ref``, or all where there is no such column.
    """
    keys = ["table_name", "column_name", "scope_slug"]
    total = Window.partitionBy(*PROFILE_KEYS)
    ref = F.col("_ref") if "_ref" in states.columns else F.lit(True)
    shares = states.select(*PROFILE_KEYS, "bin", "weekend", ref.alias("_ref"), (F.col("n") / F.sum("n").over(total)).alias("share"))
    counts = shares.where("_ref").select(*PROFILE_KEYS, "weekend").distinct().groupBy(*keys).pivot("weekend", [False, True]).agg(F.count(F.lit(1)))
    counts = counts.select(*keys, F.inline(F.array(*[F.struct(F.lit(w).alias("weekend"), F.coalesce(str(w).lower(), F.lit(0)).alias("n_kind"), (F.coalesce("false", F.lit(0)) + F.coalesce("true", F.lit(0))).alias("n_scope")) for w in (False, True)])))
    # where a day kind is rare, its deliveries are judged against all days of the scope
    kinds = counts.withColumn("kind", F.when(F.col("n_kind") > MIN_PEERS, F.col("weekend").cast("string")).otherwise("any"))
    shares = shares.join(kinds, [*keys, "weekend"])
    of_kind = shares.where("kind <> 'any' AND _ref").groupBy(*keys, "kind", "bin").agg(F.collect_list("share").alias("v"), F.max("n_kind").alias("n"))
    of_scope = shares.where("_ref").groupBy(*keys, F.lit("any").alias("kind"), "bin").agg(F.collect_list("share").alias("v"), F.max("n_scope").alias("n"))
    expected = of_kind.unionByName(of_scope).select(*keys, "kind", "bin", _median_with_zeros(F.col("v"), F.col("n")).alias("expected"))
    over = F.greatest(F.col("share") - F.coalesce("expected", F.lit(0.0)), F.lit(0.0))
    return (
        shares.join(expected, [*keys, "kind", "bin"], "left")
        .groupBy(*PROFILE_KEYS, "kind")
        .agg(F.sum(over).alias("excess"), F.max(F.when(F.col("kind") == "any", F.col("n_scope")).otherwise(F.col("n_kind"))).alias("peers"))
    )


def _limits(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Adds ``<value>_center`` and ``<value>_sigma`` over the reference rows of ``keys``."""
    w = Window.partitionBy(*keys)
    centred = df.withColumn(f"{value}_center", F.median(F.when(F.col("_ref"), F.col(value))).over(w))
    gap = F.abs(F.col(value) - F.col(f"{value}_center"))
    return centred.withColumn(f"{value}_sigma", F.median(F.when(F.col("_ref"), gap)).over(w) * MAD_SCALE)


def judged(states: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Profiles with their excess, control limits and ``broken``.

    With ``history``, the stored states of earlier loads, the deliveries of
    ``states`` are judged by those alone, and only they come out; a scope without
    history is not judged. A delivery belongs to one of the two.
    """
    every = states.withColumn("_ref", F.lit(history is None))
    if history is not None:
        every = every.unionByName(history.withColumn("_ref", F.lit(True)))
    of = every.select(*PROFILE_KEYS, "_ref").distinct()
    table = profiles(every).join(excess(every), list(PROFILE_KEYS)).join(of, list(PROFILE_KEYS))
    peers = ["table_name", "column_name", "scope_slug", "kind"]
    table = table.withColumn("violation_share", F.col("violations") / F.col("row_count"))
    for value in ("excess", "correlation", "violation_share"):
        table = _limits(table, value, peers)

    def beyond(value: str, least: float, width: float, sign: int = 1) -> Column:
        gap = (F.col(value) - F.col(f"{value}_center")) * sign
        return F.coalesce((gap > least) & (gap > width * F.col(f"{value}_sigma")), F.lit(False))

    verdict = table.withColumn(
        "broken",
        beyond("excess", LEAST_EXCESS, LIMIT_WIDTH)
        | beyond("violation_share", LEAST_EXCESS, LIMIT_WIDTH)
        | beyond("correlation", LEAST_CORRELATION_LOSS, CORRELATION_WIDTH, -1),
    )
    return (verdict if history is None else verdict.where("NOT _ref")).drop("_ref")
