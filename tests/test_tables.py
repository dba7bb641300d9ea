"""Contracts, windows, adoption tables, measures, store, landing and streams."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import contracts, measures, store, windows
from tidemark.operators import adoption
from tidemark.plans import store_queries
from tidemark.sources import landing
from tidemark.streaming import reports

USER = "scope_kind string, scope_slug string, day date, user_id bigint, user_login string, adoption_phase string, user_initiated_interaction_count bigint, code_generation_activity_count bigint, code_acceptance_activity_count bigint, loc_suggested_to_add_sum bigint, loc_added_sum bigint, ai_credits_used double, used_chat boolean"


def day(n):
    return date(2031, 3, n)


def users(spark, *rows):
    """(day, user, generations, acceptances, used_chat)"""
    return spark.createDataFrame([("organization", "s", day(d), u, f"u{u}", None, None, g, a, None, None, None, chat) for d, u, g, a, chat in rows], USER)


def test_contracts_are_complete_and_bind(spark):
    assert len(contracts.SILVER) == 25 and len(contracts.GOLD) == 10
    assert all(set(c.key) <= set(c.names) for c in [*contracts.SILVER.values(), *contracts.GOLD.values()])
    assert len(contracts.COUNTERS) == 32 and len(contracts.PULL_REQUESTS) == 14
    c = contracts.Contract("t", contracts.fields("k bigint NOT NULL\n d date\n x double"), ("k",))
    lineage = {f.name: f.nullable for f in contracts.SILVER["user_daily"].columns}
    assert [lineage[n] for n in ("source_ingestion_id", "source_ingested_at", "source_path", "source_record_hash")] == [True, True, True, False]
    df = spark.createDataFrame([("1", "2031-03-01", "extra"), ("2", "no date", "")], "k string, d string, other string")
    bound = c.bind(df)
    assert [tuple(r) for r in bound.collect()] == [(1, day(1), None), (2, None, None)]
    with pytest.raises(Exception, match="t.k must not be null"):
        c.bind(df.withColumn("k", F.lit("none"))).collect()
    assert json.dumps(contracts.export())


def test_run_days():
    back = windows.run_days("backfill", date(2026, 3, 1), start=date(2026, 1, 28), end=date(2026, 2, 10))
    assert (back.read_from, back.read_to) == (date(2026, 1, 1), date(2026, 2, 10))
    daily = windows.run_days("daily", date(2026, 2, 1))
    assert (daily.replace_from, daily.replace_to, daily.read_from) == (date(2026, 1, 4), date(2026, 1, 31), date(2025, 12, 8))
    assert windows.run_days("daily", date(2026, 2, 1), earliest=date(2026, 1, 2)).read_from == date(2026, 1, 2)
    for bad in ({"mode": "hourly"}, {"mode": "backfill"}, {"mode": "backfill", "start": day(2), "end": day(1)}):
        with pytest.raises(ValueError):
            windows.run_days(today=day(1), **bad)
    assert windows.report_types(" user, repos,users") == ["users", "repositories"]
    for bad in ("x", "", ["users", "y"]):
        with pytest.raises(ValueError):
            windows.report_types(bad)


def test_ranges_unite_if_they_touch(spark):
    df = spark.createDataFrame([("a", day(1), day(3)), ("a", day(2), day(2)), ("a", day(4), day(5)), ("a", day(7), day(8)), ("b", day(1), day(1)), ("a", None, day(9))], "k string, start_day date, end_day date")
    got = sorted(tuple(r) for r in windows.coalesce_ranges(df, ["k"]).collect())
    assert got == [("a", day(1), day(5)), ("a", day(7), day(8)), ("b", day(1), day(1))]


def test_rates_are_ratios_of_sums_and_users_count_once(spark):
    df = users(spark, (1, 1, 1, 1, False), (1, 2, 9, 0, None), (1, 3, None, None, True), (1, 4, None, None, None), (1, None, 5, 0, True))
    r = adoption.entity_adoption(df).first()
    assert (r.observed_users, r.active_users, r.engaged_users) == (4, 3, 2)
    assert r.acceptance_rate == pytest.approx(1 / 15) and r.loc_accepted is None and r.loc_acceptance_rate is None


def test_reported_figures_stand_in_where_users_are_missing(spark):
    reported = spark.createDataFrame([("organization", "s", day(1), 50), ("organization", "s", day(2), 7), ("organization", "s", day(3), None)], "scope_kind string, scope_slug string, day date, daily_active_users bigint")
    got = {r.day: r for r in adoption.entity_adoption(users(spark, (1, 1, 1, 0, None)), reported).collect()}
    assert (got[day(1)].active_users, got[day(1)].source_reported_daily_active_users) == (1, 50)
    assert (got[day(2)].active_users, got[day(2)].observed_users) == (7, 0) and got[day(3)].active_users == 0


def test_rolling_counts_distinct_users_of_the_window(spark):
    df = users(spark, (1, 1, 1, 0, None), (2, 1, 1, 0, None), (2, 2, 1, 0, None), (9, 3, 0, 0, None))
    got = {(r.day, r.window_days): r.distinct_active_users for r in adoption.rolling_entity(df).collect()}
    assert {(r.dimension_name, r.allocation_method, r.is_additive) for r in adoption.rolling_entity(df).collect()} == {("s", "entity", True)}
    assert got == {(day(1), 7): 1, (day(1), 28): 1, (day(2), 7): 2, (day(2), 28): 2, (day(9), 7): 0, (day(9), 28): 2}
    assert adoption.rolling_entity(df.limit(0)).count() == 0


def test_teams_survive_without_users_and_primary_rows_are_additive(spark):
    members = spark.createDataFrame([("organization", "s", day(1), 1, 10, "core"), ("organization", "s", day(1), 1, 11, ""), ("organization", "s", day(1), 8, 12, None)], "scope_kind string, scope_slug string, day date, user_id bigint, team_id bigint, team_slug string")
    mapping = spark.createDataFrame([(None, None, 1, 11), ("organization", "s", 1, 10)], "scope_kind string, scope_slug string, user_id bigint, team_id bigint")
    got = {(r.team_id, r.allocation_method): r for r in adoption.team_adoption(members, users(spark, (1, 1, 4, 2, None)), mapping).collect()}
    assert set(got) == {(10, "all_memberships"), (11, "all_memberships"), (12, "all_memberships"), (10, "primary_team")}
    assert got[12, "all_memberships"].observed_users == 0 and got[12, "all_memberships"].membership_count == 1
    assert got[10, "primary_team"].is_additive and got[11, "all_memberships"].team_slug is None


def test_current_state_and_staleness(spark):
    df = users(spark, (1, 1, 5, 0, None), (2, 1, 0, 0, None), (9, 2, 0, 0, True))
    got = {r.user_id: r for r in adoption.user_current(df).collect()}
    assert (got[1].days_since_activity, got[1].is_stale, got[1].adoption_status) == (8, True, "inactive")
    assert (got[2].days_since_activity, got[2].is_stale, got[2].adoption_status) == (0, False, "active")


def test_freshness(spark):
    keys = "scope_kind string, scope_slug string, day date, report_type string"
    calendar = spark.createDataFrame([("o", "s", day(d), "users") for d in range(1, 7)], keys)
    statuses = spark.createDataFrame([("o", "s", day(1), "users", "no_data", "t1"), ("o", "s", day(2), "users", "complete", "t2")], keys + ", status string, ingested string")
    observed = spark.createDataFrame([("o", "s", day(1), "users", 5, "x", 1), ("o", "s", day(3), "users", 4, "y", 2)], keys + ", rows bigint, latest_ingested string, sparse bigint")
    got = {r.day.day: r for r in adoption.freshness(observed, statuses, calendar, day(6)).collect()}
    assert [got[d].availability_status for d in range(1, 7)] == ["no_data", "complete", "complete", "within_lag", "within_lag", "within_lag"]
    assert [got[d].days_late for d in range(1, 7)] == [3, 2, 1, 0, 0, 0]
    assert [got[d].is_within_telemetry_lag for d in range(1, 7)] == [False, False, False, True, True, True]
    arrived = adoption.freshness(observed, statuses, calendar, day(3)).where(F.col("day") == day(3)).first()
    assert (arrived.availability_status, arrived.is_within_telemetry_lag) == ("complete", True)
    assert got[1].sparse_metric_count == 0 and got[3].sparse_metric_count == 2 and got[3].latest_source_ingested_at == "y"


def test_measures_follow_the_grouping(spark):
    known = measures.measures()
    assert len(known) == 38
    df = spark.createDataFrame([(day(1), 4, None, 0), (day(2), 6, None, 0)], "day date, active_users bigint, acceptance_count bigint, generation_count bigint")
    r = measures.evaluate(df, ["daily_active_users", "acceptance_rate", "latest_metric_date"]).first()
    assert tuple(r) == (10, None, day(2))
    assert measures.latest_only(df).first().active_users == 6
    empty = spark.createDataFrame([], "is_complete boolean, is_within_telemetry_lag boolean, days_late bigint")
    assert tuple(measures.evaluate(empty, ["incomplete_report_days", "freshness_status"]).first()) == (None, "Current")


ROW = "k int, day date, x string"


def test_replacement_keeps_what_lies_outside(spark):
    target = spark.createDataFrame([(1, day(1), "old"), (2, day(1), "gone"), (3, day(9), "outside"), (None, day(1), "null"), (4, None, "no day")], ROW)
    source = spark.createDataFrame([(1, day(1), "new"), (None, day(1), "null new")], ROW)
    inside = F.col("day") == day(1)
    got = sorted((str(r.k), r.x) for r in store.replaced(target, source, ["k"], inside).collect())
    assert got == [("1", "new"), ("3", "outside"), ("4", "no day"), ("None", "null new")]
    assert sorted(r.x for r in store.upserted(target, source, ["k"]).collect()) == ["gone", "new", "no day", "null new", "outside"]


def test_table_versions(spark, tmp_path):
    t = store.Table(spark, str(tmp_path / "t"))
    assert not t.exists()
    t.upsert(spark.createDataFrame([(1, day(1), "a"), (2, day(2), "b")], ROW), ["k"])
    first = t.version()
    t.replace(spark.createDataFrame([(1, day(1), "c")], ROW), ["k"], F.col("day") == day(1))
    assert t.version() != first and sorted((r.k, r.x) for r in t.read().collect()) == [(1, "c"), (2, "b")]
    before = t.version()
    with pytest.raises(ValueError, match="outside"):
        t.replace(spark.createDataFrame([(1, day(5), "c")], ROW), ["k"], F.col("day") == day(1))
    with pytest.raises(ValueError, match="unique"):
        t.upsert(spark.createDataFrame([(1, day(1), "c"), (1, day(2), "d")], ROW), ["k"])
    assert t.version() == before
    t.append(spark.createDataFrame([(1, day(1), "again")], ROW))
    assert t.read().count() == 3


def test_changes_rewrite_only_the_partitions_they_touch(spark, tmp_path):
    t = store.Table(spark, str(tmp_path / "t"), ("day",))
    t.write(spark.createDataFrame([(1, day(1), "a"), (2, day(2), "b"), (3, None, "c")], ROW))
    before = t._manifest(t.version())["parts"]
    assert set(before) == {"day=2031-03-01", "day=2031-03-02", "day=__HIVE_DEFAULT_PARTITION__"}
    t.upsert(spark.createDataFrame([(1, day(1), "new"), (9, day(1), "more")], ROW), ["day", "k"])
    after = t._manifest(t.version())["parts"]
    assert {p for p in after if after[p] != before[p]} == {"day=2031-03-01"}
    t.append(spark.createDataFrame([(5, day(2), "e")], ROW))
    assert [len(v) for v in t._manifest(t.version())["parts"].values()].count(2) == 1
    assert t.schema().simpleString() == "struct<k:int,day:date,x:string>"
    rows = sorted((r.k, str(r.day), r.x) for r in t.read().collect())
    assert rows == [(1, "2031-03-01", "new"), (2, "2031-03-02", "b"), (3, "None", "c"), (5, "2031-03-02", "e"), (9, "2031-03-01", "more")]
    t.replace(spark.createDataFrame([], ROW), ["day", "k"], F.col("day") == day(2))
    assert sorted(r.k for r in t.read().collect()) == [1, 3, 9]
    t.compact()
    assert t.vacuum(keep=1) >= 2 and sorted(r.k for r in t.read().collect()) == [1, 3, 9]
    with pytest.raises(ValueError, match="outside of the partitions"):
        t.rewrite(["day=2031-03-01"], spark.createDataFrame([(1, day(7), "x")], ROW))


def test_replacement_takes_its_windows_as_a_table(spark, tmp_path):
    row = "scope_kind string, scope_slug string, day date, x string"
    keys = ["scope_kind", "scope_slug", "day"]
    t = store.Table(spark, str(tmp_path / "t"), ("day",), gathered=True)
    t.write(spark.createDataFrame([("o", s, day(d), "old") for s in "ab" for d in (1, 2, 3)] + [(None, "a", day(2), "old")], row))
    # a second window of the same days, and one that no row lies in
    spans = [("o", "a", day(2), day(3)), ("o", "a", day(3), day(3)), ("o", "c", day(1), day(9))]
    windows = spark.createDataFrame(spans, "scope_kind string, scope_slug string, start_day date, end_day date")
    with pytest.raises(ValueError, match="outside of what"):
        t.replace(spark.createDataFrame([("o", "b", day(2), "new")], row), keys, windows)
    t.replace(spark.createDataFrame([("o", "a", day(2), "new"), ("o", "c", day(5), "new")], row), keys, windows)
    got = sorted((str(r.scope_kind), r.scope_slug, r.day.day, r.x) for r in t.read().collect())
    assert got == [("None", "a", 2, "old"), ("o", "a", 1, "old"), ("o", "a", 2, "new"), ("o", "b", 1, "old"), ("o", "b", 2, "old"), ("o", "b", 3, "old"), ("o", "c", 5, "new")]


def test_a_run_over_many_scopes_writes_files_by_day_only(spark, tmp_path, monkeypatch):
    lines = [("enterprise", f"s{s}", day(1 + s % 2), s) for s in range(300)]
    stamp = F.date_format("day", "yyyy-MM-dd")
    raw = F.format_string('{"day": "%s", "enterprise_id": "e", "user_id": %d, "used_chat": true}', stamp, "user_id")
    known = ["scope_slug", F.lit("users").alias("report_type"), stamp.alias("report_day"), F.lit("f").alias("source_file"), F.col("user_id").alias("line_no"), F.lit(datetime(2031, 3, 1)).alias("source_ingested_at"), raw.alias("raw_json")]
    spark.createDataFrame(lines, "scope_kind string, scope_slug string, day date, user_id bigint").select(F.col("user_id").alias("record_id"), *known).write.parquet(str(tmp_path / "silver_users_edge_cases.parquet"))
    members = "scope_slug string, day string, organization_id string, user_id bigint, user_login string, team_id bigint, slug string, source_ingestion_id string, source_ingested_at timestamp, source_line bigint"
    spark.createDataFrame([], members).write.parquet(str(tmp_path / "copilot_user_teams_1_day.parquet"))
    monkeypatch.setattr(store_queries, "_folder", lambda _: str(tmp_path / "run"))
    got = store_queries.pipeline_entity_gold(spark, str(tmp_path)).select("scope_slug", "day", "active_users", "source_correction_count").collect()
    assert sorted(map(tuple, got)) == sorted((f"s{s}", f"2031-03-0{1 + s % 2}", 1, 0) for s in range(300))
    # two days in the users table, in gold, and in gold once more as it is replaced
    assert len(list((tmp_path / "run").rglob("*.parquet"))) == 6


def test_owned_tables_and_conflicts(spark, tmp_path):
    t = store.Table(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, day(1), "a")], ROW)
    t.write(rows, owner="demo")
    t.write(rows, owner="demo")
    with pytest.raises(PermissionError):
        t.write(rows)
    with pytest.raises(store.Conflict):
        t._commit("another version", t._manifest(t.version()))
    assert t.read().count() == 1


def test_audit(spark):
    values = dict.fromkeys(store.AUDIT, "x") | {"status": "succeeded", "scope_slug": "s", "details_json": '{"start": "2031-03-01", "end": "2031-03-09"}'}
    row = store.audit_row(spark, **values)
    assert store.is_completed(row, "s", "2031-03-02", "2031-03-09").first()[0] is True
    assert store.is_completed(row, "s", "2031-03-02", "2031-03-10").first()[0] is False
    with pytest.raises(ValueError, match="stage"):
        store.audit_row(spark, **{k: v for k, v in values.items() if k != "stage"})


def test_landing_commits_once_and_leaves_nothing_on_failure(spark, tmp_path):
    root = str(tmp_path / "landing")
    lands = landing.Landing(spark, root)
    lines = spark.createDataFrame([('{"a": 1}',), ('{"a": 2}',)], "raw_json string").coalesce(1)
    first = lands.commit(lines, "organization", "s", "user", "2031-03-01", "2031-03-02T00:00:00Z", "one")
    assert first == {"status": "success", "ingestion_id": "one", "files": 1}
    assert lands.commit(lines, "organization", "s", "users", "2031-03-01", "2031-03-03T00:00:00Z", "two")["status"] == "duplicate"
    assert lands.commit(None, "organization", "s", "users", "2031-03-02", "2031-03-03T00:00:00Z", "none")["status"] == "no_data"
    with pytest.raises(ValueError, match="object"):
        lands.commit(spark.createDataFrame([("[1]",)], "raw_json string"), "organization", "s", "users", "2031-03-01", "2031-03-03T00:00:00Z", "bad")
    manifests = landing.read_manifests(spark, root)
    assert sorted((r.ingestion_id, r.status) for r in manifests.collect()) == [("none", "no_data"), ("one", "success")]
    path = f"{root}/{landing.partition_path('organization', 's', 'users', '2031-03-01', 'one')}"
    facts = landing.file_facts(spark, path)
    assert [(r.record_count, r.bad_lines) for r in facts.collect()] == [(2, 0)]
    assert landing.reconcile(facts, manifests.where("status = 'success'")).count() == 0
    assert landing.fingerprints(facts, ["record_count"]).first().content_fingerprint == manifests.where("ingestion_id = 'one'").first().content_fingerprint
    assert [r.ingestion_id for r in landing.reusable(manifests, "2031-03-02").collect()] == ["one"]
    assert sorted(r.raw_json for r in landing.read_lines(spark, root).collect()) == ['{"a": 1}', '{"a": 2}']
    with pytest.raises(ValueError, match="unsafe"):
        landing.partition_path("organization", "../s", "users", "2031-03-01", "x")
    assert landing.table_rows(spark, "no_such_table") is None


def test_stream_of_deliveries_ends_in_the_newest_and_can_be_repeated(spark, tmp_path):
    schema = "scope_slug string, day string, source_ingestion_id string, source_ingested_at timestamp, source_line bigint, k int, x string"
    source, table = str(tmp_path / "in"), store.Table(spark, str(tmp_path / "out"), ("scope_slug", "day"))
    for n, ident, rows in ((1, "a", [(1, "old"), (2, "old")]), (2, "b", [(1, "new")])):
        spark.createDataFrame([("s", "d", ident, datetime(2031, 3, n), 1, k, x) for k, x in rows], schema).coalesce(1).write.mode("append").parquet(source)
    for run in ("one", "two"):
        stream = reports.stream_parquet(spark, source, spark.read.parquet(source).schema)
        reports.snapshot_stream(stream, table, ["k"], str(tmp_path / run)).awaitTermination()
        assert [(r.k, r.x) for r in table.read().collect()] == [(1, "new")]


@pytest.mark.parametrize("kind", ["file", "folder", "no rows"])
def test_users_are_streamed_from_a_file_or_a_folder(kind, spark, tmp_path):
    schema = "scope_slug string, day string, user_id bigint, source_ingestion_id string, source_ingested_at timestamp, source_line bigint"
    old = [("s", "d", u, "a", datetime(2031, 3, 1), 1) for u in (1, 2)]
    new = [("s", "d", 1, "b", datetime(2031, 3, 2), n) for n in (1, 2)] + [(None, "d", 3, "b", datetime(2031, 3, 2), 3)]
    rows = spark.createDataFrame([] if kind == "no rows" else old + new, schema)
    path, named = tmp_path / "parts", tmp_path / "data"
    named.mkdir()
    rows.repartition(3).write.parquet(str(path)) if kind == "folder" else rows.coalesce(1).write.parquet(str(path))
    (path if kind == "folder" else next(path.glob("*.parquet"))).rename(named / "copilot_users_1_day.parquet")
    got = store_queries.stream_snapshots(spark, str(named)).collect()
    assert [tuple(r) for r in got] == ([] if kind == "no rows" else [("s", "d", 1, "b", 2)])


def test_gathered_partitions_have_a_file_each(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id AS k", "id % 5 AS p").repartition(8)
    t = store.Table(spark, str(tmp_path / "t"), ("p",), gathered=True)
    t.write(rows)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 5 and t.read().count() == 4000


def test_stream_of_users_per_window(spark, tmp_path):
    source = str(tmp_path / "events")
    spark.createDataFrame([(datetime(2031, 3, 1, h), h % 3) for h in range(10)], "t timestamp, u bigint").coalesce(1).write.parquet(source)
    counts = reports.active_users_stream(reports.stream_parquet(spark, source, spark.read.parquet(source).schema), "t", "u")
    query = counts.writeStream.format("memory").queryName("users_per_day").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.users, r.rows) for r in spark.table("users_per_day").collect()] == [(3, 10)]


def test_team_windows_carry_the_least_name_of_the_window(spark):
    members = spark.createDataFrame([("organization", "s", day(1), 1, 10, "old"), ("organization", "s", day(9), 1, 10, "new"), ("organization", "s", day(9), 2, 10, "")], "scope_kind string, scope_slug string, day date, user_id bigint, team_id bigint, team_slug string")
    df = users(spark, (1, 1, 1, 0, None), (9, 1, 1, 0, None), (9, 2, 1, 0, None), (20, 3, 0, 0, None))
    got = {(r.day.day, r.window_days): (r.dimension_name, r.distinct_active_users) for r in adoption.rolling_team(df, members).collect()}
    assert got == {(1, 7): ("old", 1), (1, 28): ("old", 1), (9, 7): ("new", 2), (9, 28): ("new", 2), (20, 28): ("new", 2)}


def test_medians_that_are_no_number_come_out_null(spark):
    from tidemark.contracts import PULL_REQUESTS

    df = spark.range(1).select(F.lit("o").alias("scope_kind"), F.lit("s").alias("scope_slug"), F.lit(day(1)).alias("day"), F.col("id").alias("repo_id"), *[F.lit("x").alias(c) for c in ("repo_owner_name", "repo_name", "repo_visibility")],
                               F.struct(*[F.lit(float("nan") if c.startswith("median") else 1).alias(c) for c in PULL_REQUESTS]).alias("pull_requests"))
    assert adoption.repository_impact(df).first().median_minutes_to_merge is None
