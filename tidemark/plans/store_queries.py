"""Queries over landing, the versioned store, streams and a whole run from lines to an adoption table, with their SQL.

Each writes what it needs below the shared checkpoint folder and reads it back,
so the files are what is compared.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import GOLD, SILVER
from tidemark.functions.dates import iso_date
from tidemark.operators import adoption, latest, silver
from tidemark.plans import line_oracles
from tidemark.plans.adoption_queries import MANIFESTS, _orders, _order_changes, out, user_daily
from tidemark.plans.line_queries import dated, normalizer
from tidemark.plans.report_queries import LINES, TEAMS, USERS, _won
from tidemark.session import ensure_checkpoint_dir, spread, table, table_stream, written
from tidemark.sources import landing
from tidemark.store import AUDIT, Table, audit_row, is_completed, replaced_where, window_days
from tidemark.streaming import reports


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/queries/{uuid.uuid4().hex}"


def manifest_scan(spark, d):
    """The manifests written as JSON documents and read back for some days of March."""
    root = _folder(spark)
    m = table(spark, d, MANIFESTS)
    scope = F.struct(F.col("scope_kind").alias("kind"), F.col("scope_slug").alias("slug"))
    files = F.array(F.struct(F.lit("part-00000.ndjson").alias("path"), F.col("content_fingerprint").alias("sha256"), F.lit(0).cast("bigint").alias("byte_count"), "record_count"))
    whole = m.select(F.lit(1).alias("schema_version"), scope.alias("scope"), "report_type", "report_day", "ingestion_id", F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"), "status", "content_fingerprint", files.alias("files"))
    # one document a line; a line is a document of its own to the reader as well
    whole.write.json(f"{root}/_manifests")
    found = landing.read_manifests(spark, root, start="2031-03-05", end="2031-03-20", lines=True)
    return found.select("scope_kind", "scope_slug", "report_type", "report_day", "ingestion_id", "ingested_at", "status", F.expr("aggregate(files, 0L, (a, f) -> a + f.record_count)").alias("record_count"))


def table_scan(spark, d):
    name = f"users_{uuid.uuid4().hex}"
    table(spark, d, USERS).createOrReplaceTempView(name)
    rows = landing.table_rows(spark, name, start="2031-03-10", end="2031-03-16")
    return rows.groupBy("scope_slug", "day").agg(F.count(F.lit(1)).alias("rows"))


def _landed(spark, d):
    """The raw lines landed as one file per source file, in order of line."""
    root = _folder(spark)
    lines = table(spark, d, LINES).where("raw_json IS NOT NULL").select("source_file", "line_no", "raw_json")
    placed = lines.repartition("source_file").sortWithinPartitions("source_file", "line_no")
    placed.select(F.sha2("source_file", 256).alias("ingestion_id"), "raw_json").write.partitionBy("ingestion_id").option("compression", "none").text(f"{root}/landed")
    return f"{root}/landed"


def file_facts(spark, d):
    facts = landing.file_facts(spark, _landed(spark, d))
    return facts.select(F.regexp_extract("path", "ingestion_id=([^/]+)", 1).alias("ingestion_id"), "sha256", "byte_count", "record_count", "bad_lines")


def landed_differences(spark, d):
    """Files whose records differ from what their manifest states; a tenth of the manifests state one too many."""
    facts = landing.file_facts(spark, _landed(spark, d))
    stated = table(spark, d, LINES).where("trim(raw_json) <> ''").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.min("record_id").alias("k"))
    manifests = stated.select(F.sha2("source_file", 256).alias("ingestion_id"), F.array(F.struct((F.col("n") + F.when(F.col("k") % 10 == 0, 1).otherwise(0)).alias("record_count"))).alias("files"))
    return landing.reconcile(facts, manifests)


def content_fingerprints(spark, d):
    """The content fingerprint of each feed, from the hashes of its files."""
    feeds = table(spark, d, LINES).select(F.sha2("source_file", 256).alias("ingestion_id"), "scope_slug", "report_type").distinct()
    facts = landing.file_facts(spark, _landed(spark, d)).withColumn("ingestion_id", F.regexp_extract("path", "ingestion_id=([^/]+)", 1))
    return landing.fingerprints(facts.join(feeds, "ingestion_id").withColumn("path", F.col("ingestion_id")), ["scope_slug", "report_type"])


def reusable_manifests(spark, d):
    return landing.reusable(table(spark, d, MANIFESTS), "2031-03-20")


def store_upsert(spark, d):
    t = Table(spark, _folder(spark), ("year",))
    year = F.year("day").alias("year")
    t.write(_orders(spark, d).select("*", year))
    t.upsert(_order_changes(spark, d).select("*", year), ["year", "o_orderkey"])
    return out(t.read().drop("year"))


def store_replace(spark, d):
    t = Table(spark, _folder(spark), ("year",))
    t.write(_orders(spark, d).withColumn("year", F.year("day")))
    inside = (F.col("o_custkey") % 5 == 0) & (F.col("year") == 1995)
    t.replace(_order_changes(spark, d).withColumn("year", F.year("day")), ["year", "o_orderkey"], inside)
    return out(t.read().drop("year"))


def store_append(spark, d):
    """Orders appended year by year, compacted and freed of old versions."""
    t = Table(spark, _folder(spark), ("o_orderstatus",))
    orders = _orders(spark, d)
    t.write(orders.where("year(day) < 1995"))
    t.append(orders.where("year(day) = 1995"))
    t.append(orders.where("year(day) > 1995"))
    t.compact()
    t.vacuum(keep=1)
    return t.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("least_key"), F.max("o_orderkey").alias("greatest_key"))


def audit_trail(spark, d):
    """Runs appended to the audit table, and whether a range of days is covered."""
    t = Table(spark, _folder(spark))
    values = dict.fromkeys(AUDIT, "x") | {"scope_slug": "s"}
    for status, start, end in (("failed", "2031-03-01", "2031-03-31"), ("succeeded", "2031-03-01", "2031-03-09"), ("succeeded", "2031-03-05", "2031-03-20")):
        t.append(audit_row(spark, **values | {"status": status, "details_json": f'{{"start": "{start}", "end": "{end}"}}'}))
    asked = [("2031-03-02", "2031-03-09"), ("2031-03-02", "2031-03-10"), ("2031-03-06", "2031-03-20"), ("2031-03-01", "2031-03-31")]
    parts = [is_completed(t.read(), "s", a, b).select(F.lit(a).alias("start"), F.lit(b).alias("end"), "completed") for a, b in asked]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def window_replacement(spark, d):
    """Winning memberships of ten days replaced by those of users with an even id: the windows come as a table."""
    rows = latest.winning_rows(latest.snapshot_rows(table(spark, d, TEAMS)), ["scope_slug", "day", "user_id", "team_id"], columns=["scope_kind"]).withColumn("day", iso_date("day"))
    scopes = rows.select("scope_kind", "scope_slug").distinct()
    windows = scopes.select("*", F.lit("2031-03-10").alias("start_day"), F.lit("2031-03-15").alias("end_day")).unionByName(
        scopes.select("*", F.lit("2031-03-14").alias("start_day"), F.lit("2031-03-19").alias("end_day"))
    )
    source = rows.where("day BETWEEN '2031-03-10' AND '2031-03-19' AND user_id % 2 = 0")
    return out(replaced_where(rows, source, ["scope_slug", "day", "user_id", "team_id"], window_days(windows)))


def date_join(spark, d):
    """Active users by month: the daily table joined with the date table."""
    daily = adoption.entity_adoption(user_daily(spark, d))
    months = daily.join(F.broadcast(adoption.date_dimension(spark)), F.col("day") == F.col("date"))
    return months.groupBy("scope_slug", "year_month", "year_month_number").agg(F.sum("active_users").alias("active_users"), F.count(F.lit(1)).alias("days"))


def output_window(spark, d):
    """Rolling users of the output days; the days before them still count."""
    return out(adoption.trim_to(adoption.rolling_entity(user_daily(spark, d)), date(2031, 3, 20), date(2031, 3, 26)))


def stream_snapshots(spark, d):
    """The users report as a stream, applied to the store delivery by delivery."""
    columns = ["scope_slug", "day", "user_id", "source_ingestion_id", "source_ingested_at", "source_line"]
    root = _folder(spark)
    stream = table_stream(spark, d, USERS).select(*columns).where("day IS NOT NULL AND scope_slug IS NOT NULL")
    store = Table(spark, f"{root}/table", ("scope_slug", "day"), gathered=True)
    reports.snapshot_stream(stream, store, ["user_id"], f"{root}/checkpoint").awaitTermination()
    return store.read().select("scope_slug", "day", "user_id", "source_ingestion_id", "source_line")


def _windowed(window: str, slide: str | None):
    def run(spark, d):
        root = _folder(spark)
        schema = table(spark, d, "events").schema
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
        counts = reports.active_users_stream(stream, "ts", "user_id", window=window, slide=slide)
        reports.to_files(counts, f"{root}/windows", f"{root}/checkpoint").awaitTermination()
        stamp = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
        done = spark.read.schema(counts.schema).parquet(f"{root}/windows")
        return done.select(stamp("window_start"), stamp("window_end"), "rows")

    return run


def pipeline_entity_gold(spark, d):
    """A whole run: lines to the cleaned users table in the store, from there adoption per scope and day, corrections, contract, bounded replacement."""
    root, built_at = _folder(spark), "2031-05-01T00:00:00Z"
    rows = written(normalizer(spark, d).rows("user_daily"))
    # there are as many pairs of scope and day as rows of gold, so only the days make partitions
    cleaned = Table(spark, f"{root}/user_daily", ("day",), gathered=True)
    cleaned.upsert(silver.bound(rows, SILVER["user_daily"]), list(SILVER["user_daily"].key))
    users = cleaned.read()
    corrections = latest.correction_counts({"user_daily": (rows, list(SILVER["user_daily"].key))}, ["scope_kind", "scope_slug", "day"])
    contract = GOLD["entity_adoption_daily"]
    gold = written(contract.bind(adoption.with_corrections(adoption.entity_adoption(users), corrections, built_at)))
    built = Table(spark, f"{root}/gold", ("day",), gathered=True)
    built.write(gold.where("day < '2031-03-20'"))
    first, last = date(2031, 3, 1), date(2031, 4, 30)
    windows = gold.select("scope_kind", "scope_slug").distinct().select("*", F.lit(first).alias("start_day"), F.lit(last).alias("end_day"))
    built.replace(adoption.trim_to(gold, first, last), list(contract.key), windows)
    return dated(built.read()).withColumn("ai_credits_used", F.round("ai_credits_used", 2))


QUERIES = {
    f.__name__: f
    for f in [
        manifest_scan, table_scan, file_facts, landed_differences, content_fingerprints, reusable_manifests, store_upsert, store_replace, store_append, audit_trail,
        window_replacement, date_join, output_window, stream_snapshots, pipeline_entity_gold,
    ]
} | {"stream_tumbling": _windowed("1 day", None), "stream_sliding": _windowed("7 days", "1 day")}

# ---- SQL

_ORDERS = "o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders)"
_CHANGED = "s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, day, o_totalprice FROM o WHERE o_custkey % 5 = 0 AND year(day) = 1995 AND o_orderkey % 3 <> 0)"
_FILES = f"""f AS (SELECT sha256(source_file) AS ingestion_id, source_file, scope_slug, report_type, min(record_id) AS k, sha256(string_agg(raw_json || chr(10), '' ORDER BY line_no)) AS sha256,
    CAST(sum(octet_length(encode(raw_json)) + 1) AS BIGINT) AS byte_count, count(*) FILTER (trim(raw_json) <> '') AS record_count,
    count(*) FILTER (trim(raw_json) <> '' AND coalesce(CASE WHEN json_valid(raw_json) THEN json_type(raw_json) END, '') <> 'OBJECT') AS bad_lines FROM {LINES} WHERE raw_json IS NOT NULL GROUP BY ALL)"""
_GENERATED = "coalesce(user_initiated_interaction_count, 0) + coalesce(code_generation_activity_count, 0) + coalesce(code_acceptance_activity_count, 0) + coalesce(loc_added_sum, 0) + coalesce(loc_deleted_sum, 0) > 0"
_USED = " OR ".join(
    f"coalesce({c}, false)"
    for c in "used_agent used_chat used_cli used_copilot_app used_copilot_coding_agent used_copilot_cloud_agent used_copilot_code_review_active used_copilot_code_review_passive used_vscode_agent".split()
)
_ACTIVE_USERS = " OR ".join(
    [f"coalesce({c}, 0) > 0" for c in "user_initiated_interaction_count code_generation_activity_count code_acceptance_activity_count loc_added_sum loc_deleted_sum".split()]
    + [f"coalesce({c}, false)" for c in "used_agent used_chat used_cli used_copilot_app used_copilot_coding_agent used_copilot_cloud_agent".split()]
)
_DAILY = f"a AS (SELECT scope_kind, scope_slug, day, user_id, ({_ACTIVE_USERS}) AS active FROM ({_won(USERS, 'user_id')}))"


def _windows_sql(days: int, closed: str) -> str:
    return f"""SELECT strftime(w, '%Y-%m-%d') AS window_start, strftime(w + INTERVAL {days} DAY, '%Y-%m-%d') AS window_end, count(*) AS rows
      FROM (SELECT unnest(generate_series(date_trunc('day', ts) - INTERVAL {days - 1} DAY, date_trunc('day', ts), INTERVAL 1 DAY)) AS w FROM events WHERE ts IS NOT NULL) GROUP BY w {closed}"""


ORACLE_SQL = {
    "manifest_scan": f"""SELECT scope_kind, scope_slug, report_type, report_day, ingestion_id, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at, status, record_count
      FROM {MANIFESTS} WHERE report_day BETWEEN '2031-03-05' AND '2031-03-20'""",
    "table_scan": f"SELECT scope_slug, day, count(*) AS rows FROM {USERS} WHERE day BETWEEN '2031-03-10' AND '2031-03-16' GROUP BY ALL",
    "file_facts": f"WITH {_FILES} SELECT ingestion_id, sha256, byte_count, record_count, bad_lines FROM f",
    "landed_differences": f"WITH {_FILES}, s AS (SELECT source_file, min(record_id) AS k FROM {LINES} WHERE trim(raw_json) <> '' GROUP BY ALL) SELECT ingestion_id, record_count + 1 AS stated, record_count AS landed FROM f JOIN s USING (source_file) WHERE s.k % 10 = 0",
    "content_fingerprints": f"WITH {_FILES} SELECT scope_slug, report_type, sha256(string_agg(sha256, chr(10) ORDER BY ingestion_id)) AS content_fingerprint, CAST(sum(record_count) AS BIGINT) AS record_count FROM f GROUP BY ALL",
    "reusable_manifests": f"""SELECT scope_slug, report_type, report_day, ingestion_id FROM {MANIFESTS} WHERE report_day < '2031-03-20' AND status IN ('success', 'no_data')
      QUALIFY row_number() OVER (PARTITION BY scope_slug, report_type, report_day ORDER BY ingested_at DESC, ingestion_id DESC) = 1""",
    "store_upsert": f"WITH {_ORDERS}, {_CHANGED} SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day) FROM (SELECT * FROM s UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s))",
    "store_replace": f"""WITH {_ORDERS}, {_CHANGED} SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day) FROM (SELECT * FROM s UNION ALL
      SELECT * FROM o WHERE NOT (o_custkey % 5 = 0 AND year(day) = 1995) AND o_orderkey NOT IN (SELECT o_orderkey FROM s))""",
    "store_append": "SELECT o_orderstatus, count(*) AS orders, min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key FROM orders GROUP BY ALL",
    "audit_trail": """SELECT * FROM (VALUES ('2031-03-02', '2031-03-09', true), ('2031-03-02', '2031-03-10', false), ('2031-03-06', '2031-03-20', true), ('2031-03-01', '2031-03-31', false)) v("start", "end", completed)""",
    "window_replacement": f"""SELECT scope_slug, day, user_id, team_id, scope_kind FROM ({_won(TEAMS, "user_id, team_id")}) WHERE day NOT BETWEEN '2031-03-10' AND '2031-03-19' OR user_id % 2 = 0""",
    "date_join": f"""WITH {_DAILY}, e AS (SELECT scope_slug, day, count(DISTINCT CASE WHEN active THEN user_id END) AS n FROM a GROUP BY ALL)
      SELECT scope_slug, strftime(CAST(day AS DATE), '%Y-%b') AS year_month, CAST(strftime(CAST(day AS DATE), '%Y%m') AS INTEGER) AS year_month_number, CAST(sum(n) AS BIGINT) AS active_users, count(*) AS days FROM e GROUP BY ALL""",
    "output_window": f"""WITH {_DAILY} SELECT e.scope_kind, e.scope_slug, e.day, CAST(replace(e.day, '-', '') AS BIGINT) AS day_key, 'entity' AS dimension_type, e.scope_slug AS dimension_id, e.scope_slug AS dimension_name,
        CAST(w.n AS BIGINT) AS window_days, count(DISTINCT a.user_id) AS distinct_active_users, 'entity' AS allocation_method, true AS is_additive
      FROM (SELECT DISTINCT scope_kind, scope_slug, day FROM a WHERE day BETWEEN '2031-03-20' AND '2031-03-26') e CROSS JOIN (VALUES (7), (28)) w(n)
      LEFT JOIN a ON a.scope_slug = e.scope_slug AND a.active AND CAST(a.day AS DATE) BETWEEN CAST(e.day AS DATE) - (w.n - 1)::INTEGER AND CAST(e.day AS DATE) GROUP BY ALL""",
    "stream_snapshots": f"SELECT scope_slug, day, user_id, source_ingestion_id, source_line FROM ({_won(USERS, 'user_id')})",
    # windows whose end the watermark (two days behind the newest event) has not passed are not final and not written
    "stream_tumbling": _windows_sql(1, "HAVING w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"),
    "stream_sliding": _windows_sql(7, "HAVING w + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"),
    "pipeline_entity_gold": f"""WITH u AS ({line_oracles.ORACLE_SQL['silver_user_daily']}), n AS (SELECT scope_slug, d, count(*) - count(DISTINCT user_id) AS extra FROM (
        WITH {line_oracles._RECORDS}, {line_oracles.checked('users', 'c')} SELECT scope_slug, strftime(d, '%Y-%m-%d') AS d, {line_oracles.integer('j', 'user_id')} AS user_id FROM c WHERE len(reasons) = 0) GROUP BY ALL)
      SELECT u.scope_kind, u.scope_slug, u.day, u.day_key, count(*) AS observed_users, count(*) FILTER ({_GENERATED} OR {_USED}) AS active_users, count(*) FILTER ({_GENERATED}) AS engaged_users,
        CAST(sum(user_initiated_interaction_count) AS BIGINT) AS interaction_count, CAST(sum(code_generation_activity_count) AS BIGINT) AS generation_count, CAST(sum(code_acceptance_activity_count) AS BIGINT) AS acceptance_count,
        coalesce(sum(code_acceptance_activity_count), 0)::DOUBLE / nullif(sum(code_generation_activity_count), 0)::DOUBLE AS acceptance_rate, CAST(sum(loc_suggested_to_add_sum) AS BIGINT) AS loc_suggested,
        CAST(sum(loc_added_sum) AS BIGINT) AS loc_accepted, coalesce(sum(loc_added_sum), 0)::DOUBLE / nullif(sum(loc_suggested_to_add_sum), 0)::DOUBLE AS loc_acceptance_rate, round(sum(ai_credits_used), 2) AS ai_credits_used,
        CAST(NULL AS BIGINT) AS source_reported_daily_active_users, CAST(NULL AS BIGINT) AS source_reported_weekly_active_users, CAST(NULL AS BIGINT) AS source_reported_monthly_active_users,
        '2031-05-01T00:00:00Z' AS gold_built_at, any_value(n.extra) AS source_correction_count FROM u JOIN n ON n.scope_slug = u.scope_slug AND n.d = u.day GROUP BY u.scope_kind, u.scope_slug, u.day, u.day_key""",
}
