from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import hashruns, snapdiff


@pytest.mark.parametrize("seed", range(5))
def test_runs_round_trip(seed):
    rng = np.random.default_rng(seed)
    runs = [np.unique(rng.integers(0, 2**64, rng.integers(1, 40), dtype=np.uint64)) for _ in range(30)]
    runs += [np.array([0], np.uint64), np.array([2**64 - 1], np.uint64), np.array([0, 1, 2**63, 2**64 - 1], np.uint64)]
    sizes = np.array([len(r) for r in runs])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flat = np.concatenate(runs)
    assert (hashruns.decode_runs(hashruns.encode_runs(flat, starts), sizes) == flat).all()


def test_empty_runs():
    assert hashruns.encode_runs(np.empty(0, np.uint64), np.empty(0, np.int64)) == b""
    assert len(hashruns.decode_runs(b"", np.empty(0, np.int64))) == 0


def usage(spark, seed=1, n=400):
    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    days, orgs = ["2031-03-01", "2031-03-02", None], ["a", "b", None]
    users = [(pick(days), pick(orgs), pick([*range(40), None]), "clash") for _ in range(n)]
    teams = [(pick(days), pick(orgs), pick([*range(40), None]), pick([1, 2, 3, None])) for _ in range(n)]
    return (
        spark.createDataFrame(users, "day string, organization_id string, user_id bigint, kind string"),
        spark.createDataFrame(teams, "day string, organization_id string, user_id bigint, team_id bigint"),
    )


def brute(users, teams):
    rows = [(r.day, r.organization_id, None, r.user_id, False) for r in users.collect()] + [(r.day, r.organization_id, r.team_id, r.user_id, True) for r in teams.collect()]
    out = {}
    for g in range(8):
        for day, org, team, user, has in rows:
            if g & 4 and not has:
                continue
            key = (g, day if g & 1 else None, org if g & 2 else None, team if g & 4 else None)
            sets = out.setdefault(key, (set(), set(), set()))
            for s, x in zip(sets, (user, org, team)):
                if x is not None:
                    s.add(x)
    return {k: tuple(map(len, v)) for k, v in out.items() if any(v)}


def counted(df):
    return {
        (r.by_day + 2 * r.by_organization + 4 * r.by_team, r.day, r.organization_id, r.team_id): (r.distinct_user_ids, r.distinct_organization_ids, r.distinct_team_ids)
        for r in df.collect()
    }


def test_counts_match_exact_sets_for_every_grouping(spark):
    users, teams = usage(spark)
    got = hashruns.merged_counts(hashruns.usage_blocks(users, teams))
    assert counted(got) == brute(users, teams)
    top = got.where("NOT by_day AND NOT by_organization AND NOT by_team").first()
    assert top.user_ids_error_bound == pytest.approx(top.distinct_user_ids * (top.distinct_user_ids - 1) / 2**65)


def test_blocks_of_parts_merge_to_the_whole(spark):
    users, teams = usage(spark, 2)
    whole = hashruns.build_blocks(hashruns.usage_hashes(users, teams), 8)
    days = ["day = '2031-03-01'", "day = '2031-03-02'", "day IS NULL"]
    parts = [hashruns.build_blocks(hashruns.usage_hashes(users.where(d), teams.where(d)), 8) for d in days]
    again = hashruns.build_blocks(hashruns.usage_hashes(users.where(days[0]), teams.where(days[0])), 8)  # a day delivered twice
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(again)
    assert counted(hashruns.merged_counts(merged)) == counted(hashruns.merged_counts(whole))


def test_one_organization_may_hold_nearly_all_cells(spark):
    rng = random.Random(3)
    org = lambda: "big" if rng.random() < 0.9 else rng.choice(["a", None])
    days = [f"2031-03-{d:02d}" for d in range(1, 10)]
    users = spark.createDataFrame([(rng.choice(days), org(), rng.randrange(30), "") for _ in range(500)], "day string, organization_id string, user_id bigint, kind string")
    teams = spark.createDataFrame([(rng.choice(days), org(), rng.choice([*range(30), None]), rng.randrange(90)) for _ in range(900)], "day string, organization_id string, user_id bigint, team_id bigint")
    assert counted(hashruns.merged_counts(hashruns.usage_blocks(users, teams, rows_per_range=100))) == brute(users, teams)


@pytest.mark.parametrize("seed", range(3))
def test_runs_are_merged_in_order(seed):
    rng = np.random.default_rng(seed)
    runs = [np.unique(rng.integers(0, 50, 20).astype(np.uint64)) for _ in range(7)]
    h = np.concatenate(runs)
    order, rank = hashruns.merged_order(h)
    assert (h[order] == np.sort(h)).all() and (np.unique(h)[rank] == h[order]).all()


def test_no_rows_no_counts(spark):
    users, teams = usage(spark)
    assert hashruns.merged_counts(hashruns.usage_blocks(users.limit(0), teams.limit(0))).count() == 0


ROWS = "scope_slug string, day string, source_ingestion_id string, source_ingested_at timestamp, source_line bigint, k bigint, a string, b string, snapshot_seq int, h bigint"


def snapshots(spark, states, line=1):
    """``states``: {(scope, day): {key: (a, b)}} as one delivery each."""
    at = datetime(2031, 4, 1)
    rows = [(s, d, f"{s}{d}", at, line, k, *v, 0, 0) for (s, d), keys in states.items() for k, v in keys.items()]
    return spark.createDataFrame(rows, ROWS)


def changes(df, **more):
    out = snapdiff.snapshot_changes({"t": (df, "k", [F.col("a"), F.col("b")])}, **more)
    return sorted(((r.scope_slug, r.day, r.record_id, r.change_kind) for r in out.collect()), key=str)


def test_added_removed_changed_between_consecutive_snapshots(spark):
    df = snapshots(
        spark,
        {
            ("s", "2031-03-01"): {1: ("x", None), 2: ("x", "y"), 3: (None, "x")},
            ("s", "2031-03-04"): {1: ("x", None), 2: ("x", None), 3: ("x", None), 4: ("n", "n"), None: ("x", "x")},
            ("s", "2031-03-05"): {2: ("x", None), 4: ("n", "n ")},
            ("u", "2031-03-02"): {1: ("x", None)},
        },
    )
    assert changes(df) == [
        ("s", "2031-03-04", 2, "changed"), ("s", "2031-03-04", 3, "changed"), ("s", "2031-03-04", 4, "added"),
        ("s", "2031-03-05", 1, "removed"), ("s", "2031-03-05", 3, "removed"), ("s", "2031-03-05", 4, "changed"),
    ]
    assert changes(df.limit(0)) == []


def test_last_line_wins_and_superseded_deliveries_do_not_count(spark):
    first = snapshots(spark, {("s", "2031-03-01"): {1: ("a", "a")}})
    old = snapshots(spark, {("s", "2031-03-02"): {1: ("zzz", "b")}}, line=9).withColumn("source_ingestion_id", F.lit("old")).withColumn("source_ingested_at", F.lit(datetime(2031, 3, 1)))
    losing = snapshots(spark, {("s", "2031-03-02"): {1: ("b", "b")}}, line=1)
    winning = snapshots(spark, {("s", "2031-03-02"): {1: ("a", "a")}}, line=2)
    assert changes(first.unionByName(old).unionByName(losing).unionByName(winning)) == []


def test_random_snapshots_match_brute_force(spark):
    rng = random.Random(7)
    states = {(s, f"2031-03-{d:02d}"): {k: (rng.choice("ab"), rng.choice([None, "c"])) for k in range(60) if rng.random() < 0.6} for s in "pq" for d in range(1, 7)}
    want = []
    for s in "pq":
        days = sorted(d for t, d in states if t == s)
        for before, now in zip(days, days[1:]):
            old, new = states[s, before], states[s, now]
            want += [(s, now, k, "added") for k in new.keys() - old.keys()] + [(s, now, k, "removed") for k in old.keys() - new.keys()]
            want += [(s, now, k, "changed") for k in old.keys() & new.keys() if old[k] != new[k]]
    assert changes(snapshots(spark, states), rows_per_bucket=10) == sorted(want, key=str)


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 70_000, 200_000])
def test_bitmaps(size):
    rng = np.random.default_rng(size)
    for share in (0.0, 0.01, 0.5, 1.0):
        a, b = (np.flatnonzero(rng.random(size) < share) for _ in range(2))
        x, y = snapdiff.Bitmap(a), snapdiff.Bitmap(b)
        assert set(x.and_not(y)) == set(a) - set(b) and set(x.both(y)) == set(a) & set(b)


def test_a_stored_registry_keeps_ordinals_and_gives_the_same_changes(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(snapdiff, "written", lambda df: kept.append(spark.createDataFrame(df.collect(), df.schema)) or kept[-1])
    first = snapshots(spark, {("s", "2031-03-01"): {k: ("x", None) for k in range(40)}, ("s", "2031-03-02"): {k: ("x", None) for k in range(10, 50)}})
    more = first.unionByName(snapshots(spark, {("s", "2031-03-03"): {k: ("x", str(k % 2)) for k in range(30, 70)}}))
    changes(first, rows_per_bucket=5)
    again = changes(more, registry=kept[0])
    assert again == changes(more, rows_per_bucket=1000)
    old, new = ({(r.scope_slug, r.record_id): (r.bucket, r.ordinal) for r in df.collect()} for df in kept[:2])
    assert len(old) == 50 and len(new) == 70 and all(new[k] == v for k, v in old.items()) and len(set(new.values())) == 70


def test_ordinals_persist_and_new_keys_follow(spark):
    keys = lambda values: spark.createDataFrame([("s", v) for v in values], "scope string, k bigint")
    first = snapdiff.ordinal_registry(keys([*range(50), 3, None]), ["scope", "k"], buckets=4)
    first = spark.createDataFrame(first.collect(), first.schema)
    second = snapdiff.ordinal_registry(keys(range(40, 90)), ["scope", "k"], first, buckets=4)
    old, new = ({r.k: (r.bucket, r.ordinal) for r in df.collect()} for df in (first, second))
    assert len(old) == 50 and len(new) == 90 and len(set(new.values())) == 90
    assert all(new[k] == v for k, v in old.items())
