from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, shred
from tidemark.operators.jsonlines import json_object


def children(record):
    """Every object entry of an array by plain recursion."""
    out = []

    def node(value, path):
        for key, v in value.items():
            q = f"{path}.{key}" if path else key
            if key in shred.ARRAY_FIELDS:
                if isinstance(v, dict):
                    v = [v]
                elif isinstance(v, str):
                    try:
                        inner = json.loads(v)
                    except ValueError:
                        inner = None
                    v = inner if isinstance(inner, list) else v
            if isinstance(v, dict):
                node(v, q)
            elif isinstance(v, list):
                array(v, q)

    def array(entries, path):
        for k, e in enumerate(entries):
            if isinstance(e, dict):
                out.append(f"{path}[{k}]")
                node(e, f"{path}[{k}]")
            elif isinstance(e, list):
                array(e, f"{path}[{k}]")

    node(record, "")
    return sorted(out)


def some(rng, depth=0):
    kind = rng.randrange(9 if depth < 5 else 4)
    if kind < 3:
        return rng.choice([None, 1, "x", True, 2.5])
    if kind < 4:
        return rng.choice(["[]", "[{}, 1, {\"a\": [{}]}]", "{}"])
    if kind < 6:
        return [some(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b", "day_totals", "totals_by_mcp", "%d"]): some(rng, depth + 1) for _ in range(rng.randrange(4))}


LINES = "record_id bigint, raw_json string, child_path string"


def lines(spark, *raw):
    return spark.createDataFrame([(k, r, "clash") for k, r in enumerate(raw)], LINES)


def found(df):
    out = {}
    for r in shred.child_objects(df, "record_id", "raw_json").collect():
        out.setdefault(r.record_id, []).append(r.child_path)
    return {k: sorted(v) for k, v in out.items()}


def test_random_records_match_recursion(spark):
    rng = random.Random(11)
    records = [{"a": some(rng), "day_totals": some(rng), "z": some(rng)} for _ in range(400)]
    got = found(lines(spark, *map(json.dumps, records)))
    assert got == {k: c for k, r in enumerate(records) if (c := children(r))}


def test_lines_that_are_no_single_object_have_no_children(spark):
    bad = [None, "", "  ", "[{}]", '"x"', "1", "null", '{"a": [{}]} {}', '{"a": [{}]', '{"a": NaN, "b": [{}]}', '{"a": [{}]}}']
    assert found(lines(spark, *bad)) == {}
    assert found(lines(spark, '{"a": [{}]}').limit(0)) == {}


def test_fields_that_are_arrays_whatever_their_spelling(spark):
    got = found(lines(spark, '{"totals_by_ide": {"x": 1}, "a": {}}', '{"totals_by_ide": "[{}, 3, {}]"}', '{"totals_by_ide": "nothing"}', '{"other": {"day_totals": {}}}'))
    assert got == {0: ["totals_by_ide[0]"], 1: ["totals_by_ide[0]", "totals_by_ide[2]"], 3: ["other.day_totals[0]"]}


def test_levels_follow_the_records():
    s = shred.Shredder()
    for record in ({"a": [{"b": [{}, {}]}, {"b": []}, None]}, {}, {"a": [{"b": [{}]}]}):
        s.feed(record)
    columns = s.columns()
    rep, definition, kinds, _ = columns[("a", "b")]
    assert rep.tolist() == [0, 2, 1, 1, 0, 0] and definition.tolist() == [2, 2, 1, 1, 0, 2]
    assert kinds.tolist() == [1, 1, 0, 0, 0, 1]
    record, names, _ = shred.rebuild(rep, kinds, ("a", "b"))
    assert list(zip(record.tolist(), names)) == [(0, "a[0].b[0]"), (0, "a[0].b[1]"), (2, "a[0].b[0]")]


def test_child_tables_keep_parents_and_values(spark):
    df = lines(spark, '{"a": [{"n": 1, "o": {"t": "x"}, "b": [{"m": true}, 5]}, {"n": null}]}')
    got = {r.child_path: r for r in shred.child_tables(df, "record_id", "raw_json").collect()}
    assert set(got) == {"a[0]", "a[0].b[0]", "a[1]"}
    assert got["a[0]"].attributes == {"n": "1", "o.t": "x"} and got["a[0]"].parent_path == ""
    assert got["a[0].b[0]"].attributes == {"m": "true"} and got["a[0].b[0]"].parent_path == "a[0]" and got["a[0].b[0]"].table_path == "a[].b[]"
    assert got["a[1]"].attributes == {} and got["a[1]"].position == 1


def test_whole_child_tables_have_the_root_and_every_entry(spark):
    df = lines(spark, '{"u": 1, "p": {"t": 2, "q": {"r": false}}, "topics": ["x", null, [3], {}], "a": [{"b": [{"m": 1}]}]}', "{}", "[1]")
    got = {(r.record_id, r.child_path): r for r in shred.child_tables(df, "record_id", "raw_json", every=True).collect()}
    assert {k: r.kind for k, r in got.items()} == {
        (0, ""): "object", (0, "topics[0]"): "scalar", (0, "topics[1]"): "null", (0, "topics[2]"): "array", (0, "topics[2][0]"): "scalar",
        (0, "topics[3]"): "object", (0, "a[0]"): "object", (0, "a[0].b[0]"): "object", (1, ""): "object",
    }
    root = got[0, ""]
    assert root.attributes == {"u": "1", "p.t": "2", "p.q.r": "false"} and (root.table_path, root.parent_path, root.position) == ("", None, None)
    assert got[0, "topics[0]"].attributes == {"": "x"} and got[0, "topics[2][0]"].attributes == {"": "3"} and got[0, "topics[2][0]"].position == 0
    assert all((r.record_id, r.parent_path) in got for k, r in got.items() if k[1])


def test_typed_structs_come_out(spark, data):
    import __spark_entry__ as entry

    repos = spark.read.parquet(f"{data}/copilot_repos_1_day.parquet").where("pull_requests IS NOT NULL")
    got = entry.queries()["p4_typed_pull_requests"](spark, data)
    assert len(got.columns) == 3 + 14 and got.count() == repos.count() > 0
    assert got.agg(F.sum("total_created")).first() == repos.agg(F.sum("pull_requests.total_created")).first()
    phases = spark.read.parquet(f"{data}/copilot_users_1_day.parquet").where("ai_adoption_phase IS NOT NULL")
    counted = entry.queries()["p4_typed_phases"](spark, data).groupBy("name").count()
    assert set(counted.collect()) == set(phases.groupBy("ai_adoption_phase.name").count().collect())


def test_shredded_columns_are_one_row_per_record_and_path(spark):
    got = {(r.record_id, r.path): r for r in shred.shredded_columns(lines(spark, '{"a": [{}, {}]}', "{}"), "record_id", "raw_json").collect()}
    assert set(got) == {(0, "a[]")} and got[0, "a[]"].repetition == [0, 1] and got[0, "a[]"].kinds == [1, 1]


def test_positions_restart_with_each_outer_entry():
    record, at = shred.positions(np.array([0, 2, 1, 2, 0, 1]), 2)
    assert record.tolist() == [0, 0, 0, 0, 1, 1] and at[0].tolist() == [0, 0, 1, 1, 0, 1] and at[1].tolist() == [0, 1, 0, 1, 0, 0]


def test_json_reader():
    assert json_object('{"a": 1, "a": 2}') == {"a": 2} and json_object(' {"a": "é"} ') == {"a": "é"}
    assert json_object("[" * 100_000) is None and json_object('{"a": Infinity}') is None


FILES = "scope_slug string, report_type string, report_day string, source_file string, raw_json string, place string, seq int"


def feed(spark, *files, scope="s"):
    rows = [(scope, "users", f"2031-03-{k:02d}", f"f{k}", x if isinstance(x, (str, type(None))) else json.dumps(x), "", 0) for k, f in enumerate(files, 1) for x in f]
    return spark.createDataFrame(rows, FILES)


def drifted(df):
    out = drift.schema_changes(drift.lifespans(drift.field_observations(df)))
    return sorted((r.source_file, r.change_kind, r.old_field, r.new_field) for r in out.collect())


def test_added_removed_and_back(spark):
    df = feed(spark, [{"a": 1}] * 4, [{"a": 1, "b": "x"}] * 4, [{"a": 1}] * 4, [{"a": 1, "b": "x"}] * 4)
    assert drifted(df) == [("f2", "added", "", "b"), ("f3", "removed", "b", ""), ("f4", "added", "", "b")]


def test_a_quarter_makes_a_field_and_bad_lines_do_not_count(spark):
    stray = [{"a": 1, "b": 1}, *[{"a": 1}] * 3]
    few = [{"a": 1, "c": 1}, *[{"a": 1}] * 4]
    assert drifted(feed(spark, [{"a": 1}] * 4, [*stray, None, "", "[1]", "{"], few)) == [("f2", "added", "", "b"), ("f3", "removed", "b", "")]


def test_type_changes_and_nulls(spark):
    df = feed(spark, [{"a": 1}] * 3, [{"a": None}] * 3, [{"a": "1"}, {"a": "2"}, {"a": 3}], [{"a": None}] * 2)
    assert drifted(df) == [("f3", "type_changed", "a", "a")]


def test_members_come_and_go_with_their_holder(spark):
    df = feed(spark, [{"a": 1}] * 2, [{"a": 1, "o": {"x": 1}}] * 2, [{"a": 1}] * 2, [{"a": 1, "o": {"x": 1, "y": 2}}] * 2, [{"a": 1, "o": "text"}] * 2, [{"a": 1, "o": {"y": 3}}] * 2)
    assert drifted(df) == [
        ("f2", "added", "", "o"), ("f3", "removed", "o", ""), ("f4", "added", "", "o"), ("f4", "added", "", "o.y"),
        ("f5", "type_changed", "o", "o"), ("f6", "removed", "o.x", ""), ("f6", "type_changed", "o", "o"),
    ]


def test_renames_need_the_same_information(spark):
    old = [{"user_login": f"u{k}", "used_cli": True, "loc_added_sum": k, "ai_credits_used": 1.5 * k} for k in range(9)]
    new = [{"handle": f"u{k}", "used_voice_mode": True, "lines_added_sum": k + 1, "ai_credits_budget": 400 + k} for k in range(9)]
    assert drifted(feed(spark, old, new)) == [
        ("f2", "added", "", "ai_credits_budget"), ("f2", "added", "", "used_voice_mode"), ("f2", "removed", "ai_credits_used", ""), ("f2", "removed", "used_cli", ""),
        ("f2", "renamed", "loc_added_sum", "lines_added_sum"), ("f2", "renamed", "user_login", "handle"),
    ]


def test_feeds_do_not_mix_and_empty_has_no_changes(spark):
    df = feed(spark, [{"a": 1}]).unionByName(feed(spark, [{"b": 1}], scope="t"))
    assert drifted(df) == [] and drifted(df.limit(0)) == []


def test_aliases_and_casts(spark):
    df = feed(spark, [{"user_login": "x"}] * 2, [{"login": "x"}] * 2)
    changes = drift.schema_changes(drift.lifespans(drift.field_observations(df)))
    assert [(r.old_field, r.new_field, r.times) for r in drift.alias_table(changes).collect()] == [("user_login", "login", 1)]
    raw = spark.createDataFrame([(1, "s", "users", "f", 1, '{"n": "7"}'), (2, "s", "users", "f", 2, '{"m": "x"}'), (3, "s", "users", "f", 3, None)],
                                "record_id bigint, scope_slug string, report_type string, source_file string, line_no bigint, raw_json string")
    got = drift.consistent_fields(raw, {"n": ("bigint", ["$.n", "$.m"])}).collect()
    assert [(r.record_id, r.n) for r in sorted(got)] == [(1, 7), (2, None), (3, None)]


def test_the_consistent_table_has_every_path_under_its_usual_type(spark):
    old = [{"day": "d", "used_chat": True, "o": {"n": k, "s": "x"}, "es": [{"f": f"v{k}", "c": 1}], "tags": ["p", 2], "m": 0.5, "n": k} for k in range(4)]
    new = [{"day": "d", "chatUsed": True, "o": {"n": str(k), "s": "x"}, "es": [{"f_name": f"v{k}", "c": 2}], "m": 1, "n": k} for k in range(3)]
    odd = {"day": "d", "chatUsed": False, "used_chat": True, "stray": [1], "o": {"n": "many", "z": 1}, "es": [None, 7, {"f": "a"}], "m": 2**60 + 1, "n": 1}
    df = feed(spark, old, [*new, {**new[0], "es": {"f_name": "v3", "c": 3}}], [*old, odd, "{"]).withColumn("record_id", F.monotonically_increasing_id()).withColumn("line_no", F.lit(1).cast("bigint"))
    df = spark.createDataFrame(df.collect(), df.schema)
    schema = drift.target_schema(drift.field_observations(df))
    table = drift.consistent_lines(df, schema)
    types = dict(table.dtypes)
    assert set(types) == {*drift.LINE_COLUMNS, "day", "used_chat", "o", "es", "tags", "m", "n"}
    assert types["o"] == "struct<n:bigint,s:string>" and types["es"] == "array<struct<f:string,c:bigint>>"
    assert (types["used_chat"], types["tags"], types["m"], types["n"]) == ("boolean", "array<string>", "double", "bigint")
    got = sorted(table.collect(), key=lambda r: r.record_id)
    assert len(got) == 14 and got[0].tags == ["p", "2"] and got[0].rescued == {}
    assert (got[4].used_chat, got[4].o.n, got[4].es[0].f, got[4].es[0].c, got[4].m, got[4].rescued) == (True, 0, "v0", 2, 1.0, {})
    assert got[7].es == [got[7].es[0]] and got[7].es[0].f == "v3"
    r = got[12]
    assert r.used_chat is False and r.o.n is None and [e and e.f for e in r.es] == [None, None, "a"]
    assert r.rescued == {"used_chat": "true", "stray": "[1]", "o.n": "many", "o.z": "1", "es[1]": "7", "m": str(2**60 + 1)}
    assert got[13].day is None and got[13].es is None


def test_spellings_side_by_side_stay_fields_of_their_own(spark):
    old, both, new = {"used_cloud_agent": True}, {"used_cloud_agent": True, "used_coding_agent": True}, {"used_coding_agent": True}
    seen = drift.field_observations(feed(spark, [old] * 3, [new] * 3, [both] * 3))
    assert [(r.old_field, r.new_field) for r in drift.alias_table(drift.schema_changes(drift.lifespans(seen))).collect()] == [("used_cloud_agent", "used_coding_agent")]
    assert sorted(t.name for t in drift.target_schema(seen).members()) == ["used_cloud_agent", "used_coding_agent"]


def test_p5_consistent_loses_no_value_of_a_line(spark, data):
    import __spark_entry__ as entry

    def leaves(value):
        if isinstance(value, dict):
            return sum(map(leaves, value.values()))
        if isinstance(value, list):
            return sum(map(leaves, value))
        return value is not None

    df = entry.queries()["p5_consistent"](spark, data)
    fields = [c for c in df.columns if c not in drift.LINE_COLUMNS]
    assert {"enterprise_id", "used_chat", "loc_deleted_sum", "pull_requests", "totals_by_cli", "totals_by_feature", "day_totals"} <= set(fields)
    raw = {r.record_id: json_object(r.raw_json) for r in spark.read.parquet(f"{data}/silver_users_edge_cases.parquet").collect()}
    rows = df.collect()
    assert sorted(r.record_id for r in rows) == sorted(raw)
    for r in rows:
        row = r.asDict(recursive=True)
        got = leaves({c: row[c] for c in fields})
        # texts of whole objects count as one value, texts of arrays as many
        if row["rescued"] or any(isinstance(v, str) and v[:1] in "[{" for v in (raw[r.record_id] or {}).values()):
            assert got + len(row["rescued"]) > 0
        else:
            assert got == leaves(raw[r.record_id])


@pytest.mark.parametrize(("name", "words"), [("chatUsed", {"chat", "used"}), ("a.b[].org_id", {"org", "id"}), ("x", {"x"}), ("classes", {"classe"})])
def test_name_words(name, words):
    assert drift.name_words(name) == words


@pytest.mark.parametrize(("a", "b", "same"), [("org", "organization", True), ("cnt", "count", True), ("id", "identifier", False), ("loc", "lines", False), ("used", "user", False), ("x", "x", True)])
def test_abbreviations_are_the_same_word(a, b, same):
    assert drift.same_word(a, b) is drift.same_word(b, a) is same


def test_whole_numbers_beside_fractions():
    whole, mixed = {"n": 40, "integers": 40}, {"n": 40, "integers": 20}
    assert drift.by_chance(whole, mixed) < 1e-9 and drift.by_chance(mixed, whole) < 1e-9
    assert drift.by_chance({"n": 2, "integers": 2}, mixed) > drift.CHANCE and drift.by_chance(whole, whole) == drift.by_chance(mixed, mixed) == 1.0
