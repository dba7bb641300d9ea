from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import history, rolling

USERS = (
    "scope_slug string, day string, user_id bigint, user_login string, code_generation_activity_count bigint, source_ingestion_id string, "
    "source_ingested_at timestamp, source_line bigint, total_7 int, amount string, _value string"
)


def user(day, who, amount, line=1, ident="a", login="x", scope="s"):
    return (scope, day, who, login, amount, f"{ident}-{day}", datetime(2031, 4, 1 if ident == "a" else 2), line, 0, "clash", "clash")


def test_trailing_totals_match_brute_force(spark):
    rng = random.Random(3)
    amounts = {(u, d): rng.randrange(-3, 50) for u in range(6) for d in range(45) if rng.random() < 0.4}
    df = spark.createDataFrame([(u, d, x) for (u, d), x in amounts.items()], "u bigint, n int, x bigint")
    got = {(r.u, r.n): r for r in rolling.trailing_totals(df, "u", "n", "x", (7, 30), 0, 44).collect()}
    assert len(got) == len({u for u, _ in amounts}) * 45
    for (u, n), r in got.items():
        for w in (7, 30):
            want = sum(x for (v, d), x in amounts.items() if v == u and n - w < d <= n)
            assert r[f"total_{w}"] == want and abs(r[f"average_{w}"] - want / w) < 1e-9


def test_amounts_before_the_calendar_count_and_later_ones_do_not(spark):
    df = spark.createDataFrame([(1, -2, 5), (1, 9, 7), (None, 1, 3), (1, None, 3), (1, 0, None)], "u bigint, n int, x bigint")
    got = {r.n: r.total_7 for r in rolling.trailing_totals(df, "u", "n", "x", (7,), 0, 5).collect()}
    assert got == {0: 5, 1: 5, 2: 5, 3: 5, 4: 5, 5: 0}


def test_user_totals_use_winning_rows_of_snapshots(spark):
    df = spark.createDataFrame(
        [
            user("2031-03-01", 1, 5, line=1), user("2031-03-01", 1, 9, line=2), user("2031-03-01", 1, 9, line=2),
            user("2031-03-03", 1, 4), user("2031-03-03", 1, 2, ident="b"), user("2031-03-02", 2, None), user("not a day", 3, 8), user("2031-03-02", None, 8),
        ],
        USERS,
    )
    got = {(r.user_id, r.day): r.total_7 for r in rolling.user_trailing_totals(df).collect()}
    assert got == {
        (1, "2031-03-01"): 9, (1, "2031-03-02"): 9, (1, "2031-03-03"): 11,
        (2, "2031-03-01"): 0, (2, "2031-03-02"): 0, (2, "2031-03-03"): 0,
    }
    assert rolling.user_trailing_totals(df.limit(0)).count() == 0


def test_users_of_superseded_deliveries_have_every_day(spark):
    df = spark.createDataFrame([user("2031-03-01", 1, 5), user("2031-03-02", 2, 7), user("2031-03-02", 1, 1, ident="b")], USERS)
    got = {(r.user_id, r.day): r.total_7 for r in rolling.user_trailing_totals(df).collect()}
    assert got == {(1, "2031-03-01"): 5, (1, "2031-03-02"): 6, (2, "2031-03-01"): 0, (2, "2031-03-02"): 0}


def observations(spark, *rows):
    return spark.createDataFrame([("user", *r) for r in rows], "entity_kind string, entity_id bigint, attribute_value string, day string")


def versions(df):
    return sorted((r.entity_id, r.attribute_value, r.valid_from, r.valid_to, r.is_current) for r in df.collect())


def test_versions_close_and_reopen(spark):
    df = observations(
        spark, (1, "a", "2031-03-01"), (1, None, "2031-03-02"), (1, "a", "2031-03-03"), (1, "b", "2031-03-04"), (1, "b", "2031-03-04"),
        (1, "a", "2031-03-06"), (2, None, "2031-03-01"), (None, "x", "2031-03-01"), (3, "x", None),
    )
    assert versions(history.type_two_merge(df)) == [
        (1, "a", "2031-03-01", "2031-03-04", False), (1, "a", "2031-03-06", None, True), (1, "b", "2031-03-04", "2031-03-06", False),
    ]
    assert history.type_two_merge(df.limit(0)).count() == 0


def test_merging_day_by_day_equals_merging_at_once(spark):
    rng = random.Random(5)
    rows = [(e, rng.choice("abc"), f"2031-03-{d:02d}") for e in range(5) for d in range(1, 8) if rng.random() < 0.7]
    whole = history.type_two_merge(observations(spark, *rows))
    current = None
    for d in range(1, 8):
        today = [r for r in rows if r[2] == f"2031-03-{d:02d}"]
        if today:
            merged = history.type_two_merge(observations(spark, *today), current)
            current = spark.createDataFrame(merged.collect(), merged.schema)
    assert versions(current) == versions(whole)
    for merges in (1, 3, 50):
        assert versions(history.folded(observations(spark, *rows), merges)) == versions(whole)
    assert history.folded(observations(spark, *rows).limit(0)).count() == 0


def test_slugs_are_tidied_and_counted(spark):
    schema = "scope_slug string, day string, user_id bigint, team_id bigint, slug string, source_ingestion_id string, source_ingested_at timestamp, source_line bigint, value string"
    at = datetime(2031, 4, 1)
    df = spark.createDataFrame(
        [
            ("s", "2031-03-01", 1, 9, " Core ", "a", at, 1, "clash"), ("s", "2031-03-01", 2, 9, "core", "a", at, 2, ""), ("s", "2031-03-01", 3, 9, "  ", "a", at, 3, ""),
            ("s", "2031-03-01", 4, 9, "old", "a", at, 4, ""), ("s", "2031-03-02", 1, 9, None, "b", at, 1, ""), ("s", "2031-03-03", 1, 9, "edge", "c", at, 1, ""),
        ],
        schema,
    )
    merged = history.type_two_merge(history.team_slugs(df))
    assert versions(merged) == [(9, "core", "2031-03-01", "2031-03-03", False), (9, "edge", "2031-03-03", None, True)]
    assert history.changed_entities(merged).count() == 2


def test_tidy_strips_every_kind_of_blank(spark):
    df = spark.createDataFrame([("\t Aé \n",), ("   ",), (None,)], "x string")
    assert [r[0] for r in df.select(history.tidy(F.col("x"))).collect()] == ["aé", None, None]
