"""Every registered query beside its SQL oracle, and the shapes the contract fixes."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import rows_of

ORACLES = {k: v for k, v in entry.oracle_sql().items() if not k.startswith(("p8", "p9", "p10"))}
FOUND = {
    "p1_found": ["table_name", "column_name", "source_ingestion_id"],
    "p3_found": ["report_type", "day", "record_id", "change_kind"],
    "p4_found": ["record_id", "child_path"],
    "p5_found": ["source_file", "change_kind", "old_field", "new_field"],
    "p6_found": ["entity_kind", "entity_id", "attribute_value", "valid_from"],
}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(name, spark, data, duck):
    df = entry.queries()[name](spark, data)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(FOUND))
def test_found_queries_have_exactly_their_columns(name, spark, data):
    df = entry.queries()[name](spark, data)
    assert df.columns == FOUND[name]
    assert df.count() == df.distinct().count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
