from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import latest

SCHEMA = "scope_slug string, day string, source_ingestion_id string, source_ingested_at timestamp, source_line bigint, k bigint, x string, __rank int"


def rows(spark, *given):
    return spark.createDataFrame([(*g, 7) for g in given], SCHEMA)


def t(hour):
    return datetime(2031, 3, 1, hour)


def test_newest_delivery_wins_whole_and_ties_take_the_greater_id(spark):
    df = rows(
        spark,
        ("s", "2031-03-01", "a", t(1), 1, 1, "old"),
        ("s", "2031-03-01", "b", t(2), 1, 2, "new"),
        ("s", "2031-03-02", "c", t(1), 1, 1, "p"),
        ("s", "2031-03-02", "d", t(1), 1, 1, "q"),
        ("s", "2031-03-03", "e", None, 1, 1, "r"),
        (None, "2031-03-01", "z", t(9), 1, 1, "no scope"),
        ("s", None, "z", t(9), 1, 1, "no day"),
        ("s", "2031-03-01", None, t(9), 1, 1, "no id"),
    )
    assert {(r.day, r.source_ingestion_id, r.snapshot_seq) for r in latest.latest_deliveries(df).collect()} == {
        ("2031-03-01", "b", 1), ("2031-03-02", "d", 2), ("2031-03-03", "e", 3),
    }
    assert sorted(r.x for r in latest.snapshot_rows(df).collect()) == ["new", "q", "r"]


def test_winning_values_take_the_last_line_and_the_greater_value_on_ties(spark):
    df = rows(
        spark, ("s", "d", "a", t(1), 1, 1, "first"), ("s", "d", "a", t(1), 2, 1, "last"), ("s", "d", "a", t(1), None, 1, "unnumbered"),
        ("s", "d", "a", t(1), 3, 2, "m"), ("s", "d", "a", t(1), 3, 2, "n"), ("s", "d", "a", t(1), None, 3, "only"),
    )
    got = latest.winning_values(df, ["k"], F.col("x"), "x").collect()
    assert {(r.k, r.x) for r in got} == {(1, "last"), (2, "n"), (3, "only")}


def test_winning_rows_keep_every_column(spark):
    df = rows(spark, ("s", "d", "a", t(1), 1, 1, "a"), ("s", "d", "a", t(1), 2, 1, "b"), ("s", "d", "a", t(1), 2, 1, "b"))
    kept = latest.winning_rows(df.drop("__rank"), ["scope_slug", "day", "k"])
    assert [r.x for r in kept.collect()] == ["b"] and kept.columns == df.drop("__rank").columns


def test_corrections_and_duplicates_count_surplus_rows_null_safely(spark):
    df = rows(spark, ("s", "d", "a", t(1), 1, None, "a"), ("s", "d", "a", t(1), 2, None, "b"), ("s", "d", "a", t(1), 3, 1, "c"))
    assert [(r.k, r.copies) for r in latest.duplicate_keys(df, ["k"]).collect()] == [(None, 2)]
    got = latest.correction_counts({"t": (df, ["day", "k"])}, ["day"]).collect()
    assert [(r.day, r.source_correction_count) for r in got] == [("d", 1)]


def test_no_data_removes_rows_and_scope_days_without_a_manifest_stay(spark):
    df = rows(spark, ("s", "2031-03-01", "a", t(1), 1, 1, "x"), ("s", "2031-03-02", "b", t(1), 1, 1, "y"), ("s", "2031-03-03", "c", t(1), 1, 1, "z"))
    m = spark.createDataFrame(
        [
            ("organization", "s", "users", "2031-03-01", "a", "1", "success"),
            ("organization", "s", "users", "2031-03-01", "n", "2", "no_data"),
            ("organization", "s", "users", "2031-03-02", "b", "1", "success"),
            ("organization", "s", "users", "2031-03-02", "f", "9", "failed"),
        ],
        "scope_kind string, scope_slug string, report_type string, report_day string, ingestion_id string, ingested_at string, status string",
    )
    assert sorted(r.x for r in latest.manifest_filter(df, m, "users").collect()) == ["y", "z"]


def test_content_duplicates_need_the_whole_fingerprint(spark, tmp_path):
    import __spark_entry__ as entry

    m = [("s", "users", "2031-03-01", i, t(h), status, f) for i, h, status, f in [
        ("a", 1, "success", "9abc"), ("b", 2, "success", "9abd"), ("c", 3, "success", "9abc"), ("d", 4, "no_data", "9abc"), ("e", 5, "success", "9abc"),
    ]]
    schema = "scope_slug string, report_type string, report_day string, ingestion_id string, ingested_at timestamp, status string, content_fingerprint string"
    spark.createDataFrame(m, schema).write.parquet(f"{tmp_path}/bronze_manifests.parquet")
    got = entry.queries()["content_duplicates"](spark, str(tmp_path)).collect()
    assert {(r.ingestion_id, r.original_id) for r in got} == {("c", "a"), ("e", "a")} and len(got) == 2


def test_empty_tables_give_empty_results(spark):
    df = rows(spark, ("s", "d", "a", t(1), 1, 1, "x")).limit(0)
    assert latest.latest_deliveries(df).count() == latest.snapshot_rows(df).count() == latest.winning_rows(df, ["k"]).count() == 0
