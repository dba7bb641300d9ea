"""Schemas that drift between the files of a feed.

Each file gets a *footer*: per field path how many objects have the key, how
often each JSON type occurs, and small mergeable sketches of the values. The
footers of a feed, exploded to one observation per file and field, form a
lifespan catalogue: ``lag`` over the files of a field splits its observations
into islands of the same type without a gap. A start of an island is an
addition or a type change, an end without a following start a removal. A removal
and an addition at the same place in the same file that carry the same
information are a rename; the pairs feed an alias table, from which casts to one
consistent schema are generated: a tree of target fields with the usual type of
every path of the catalogue and all its spellings.

Defined cases: lines that are no JSON object count for nothing; a file has a
field if at least a quarter of the objects that could hold it have the key; with
only nulls the earlier type stays; members of an object or of array entries are
judged only in files that have their holder in its usual type, against the last
such file; of repeated keys the last counts; an empty table has no changes. In
the consistent table, spellings that stand side by side in a file are fields of
their own; a value without a place in the schema (a stray field, a value that
does not cast, a second spelling in one object) is kept in ``rescued``.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.jsonlines import json_object, json_value

SHARE = 0.25
#: Size of the bottom-k sketch of a field's values in a file: the least hashes of all its values, merged over lines and
#: tasks. It estimates the share of values two fields have in common with a standard error of at most 1 / (2 sqrt(k)).
SKETCH = 32
#: Lines after which a task passes on the footers it has gathered.
FLUSH_LINES = 50_000
#: Whole numbers beside fractions speak against a rename where chance would give them less often than this.
CHANCE = 0.05
STRING, NUMBER, BOOLEAN, OBJECT, ARRAY = range(5)
TYPE_NAMES = ("string", "number", "boolean", "object", "array")
FEED = ("scope_slug", "report_type")

# indices into the statistics of a path
HAS, ENTRIES, LOGSUM, INTEGERS = 5, 6, 7, 8


class Footer:
    """Statistics of the lines of one file: per path [5 type counts, has, object entries, log sum, integers] and value hashes."""

    __slots__ = ("lines", "stats", "values")

    def __init__(self):
        self.lines = 0
        self.stats: dict[str, list] = {}
        self.values: dict[str, set[int]] = {}

    def add(self, record: dict) -> None:
        self.lines += 1
        self._object(record, "")

    def _object(self, node: dict, prefix: str) -> None:
        stats, values = self.stats, self.values
        for key, value in node.items():
            path = prefix + key
            s = stats.get(path)
            if s is None:
                s = stats[path] = [0, 0, 0, 0, 0, 0, 0, 0.0, 0]
            s[5] += 1
            what = type(value)
            if what is str:
                s[0] += 1
                v = values.get(path)
                if v is None:
                    v = values[path] = set()
                v.add(value)
            elif what is int or what is float:
                s[1] += 1
                s[7] += math.log1p(abs(value)) if -1e300 < value < 1e300 else 691.0
                s[8] += what is int
            elif what is bool:
                s[2] += 1
            elif what is dict:
                s[3] += 1
                values.setdefault(path, set()).update(value)
                self._object(value, path + ".")
            elif what is list:
                s[4] += 1
                inner = path + "[]."
                for entry in value:
                    if type(entry) is dict:
                        s[6] += 1
                        values.setdefault(path, set()).update(entry)
                        self._object(entry, inner)

    def merge(self, lines: int, stats: dict[str, list], sketches: dict[str, list[int]], into: dict[str, list[int]]) -> None:
        """Adds the footer of further lines of the same file; ``into`` holds the merged sketches."""
        self.lines += lines
        for path, s in stats.items():
            mine = self.stats.get(path)
            self.stats[path] = s if mine is None else [a + b for a, b in zip(mine, s)]
        for path, sketch in sketches.items():
            into[path] = sorted({*into.get(path, ()), *sketch})[:SKETCH]

    def packed(self) -> str:
        sketches = {p: sorted({zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in v})[:SKETCH] for p, v in self.values.items()}
        return json.dumps([self.lines, self.stats, sketches])


def partial_footers(lines: DataFrame) -> DataFrame:
    """Footers of the lines a task reads: feed, day, file and the packed statistics. No shuffle.

    A footer is written every ``FLUSH_LINES`` lines, so what a file held by many
    lines sends on stays small and no task keeps more than that many values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        footers: dict[tuple, Footer] = {}
        held = 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*[pa.array(k, pa.string()) for k in zip(*footers)], pa.array([f.packed() for f in footers.values()])],
                names=["scope_slug", "report_type", "report_day", "source_file", "footer"],
            )

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for scope, report, day, file, raw in zip(*columns):
                key = (scope, report, day, file)
                footer = footers.get(key)
                if footer is None:
                    footer = footers[key] = Footer()
                record = json_object(raw)
                if record is not None:
                    footer.add(record)
            held += batch.num_rows
            if held >= FLUSH_LINES and footers:
                yield packed()
                footers, held = {}, 0
        if footers:
            yield packed()

    return lines.select(*FEED, "report_day", "source_file", "raw_json").mapInArrow(
        run, "scope_slug string, report_type string, report_day string, source_file string, footer string"
    )


def _holder(path: str) -> str:
    """The place whose objects could hold ``path``: '' for the line itself, ``a`` or ``a[]`` for members."""
    return path.rpartition(".")[0]


def _own_name(path: str) -> str:
    return path.rpartition(".")[2]


def _usual(s: list) -> int:
    """The most frequent type (ties: the first by name), or -1 with only nulls."""
    best = max(s[:5])
    return -1 if not best else max((t for t in range(5) if s[t] == best), key=lambda t: TYPE_NAMES[t])


def judged_fields(lines: int, stats: dict[str, list]) -> dict[str, dict[str, int]]:
    """Of one file: the places whose members can be judged, each with the fields it has and their types (-1: only nulls).

    A place is open where the file itself holds objects in its usual type, so no other file has a say.
    """
    places: dict[str, dict[str, int]] = {"": {}} if lines else {}
    for path in sorted(stats, key=lambda p: (p.count("."), p)):
        s, place = stats[path], _holder(path)
        if place not in places:
            continue
        if not place:
            could = lines
        elif place.endswith("[]"):
            could = stats[place[:-2]][ENTRIES]
        else:
            could = stats[place][OBJECT]
        if not s[HAS] or s[HAS] < SHARE * could:
            continue
        kind = _usual(s)
        places[place][path] = kind
        if kind == OBJECT and s[OBJECT]:
            places.setdefault(path, {})
        elif kind == ARRAY and s[ENTRIES]:
            places.setdefault(path + "[]", {})
    return places


FIELDS = "array<struct<field: string, json_type: string, n: bigint, log_sum: double, integers: bigint, sketch: array<bigint>>>"


def file_places(lines: DataFrame) -> DataFrame:
    """One row per file and place that can be judged in it, with the fields the file has there.

    Footers move by file, so the files of one feed are merged in parallel however
    many it has; a footer holds a few hundred bytes per path, whatever the lines.
    """
    partial = partial_footers(lines)
    keyed = partial.repartition(*FEED, "source_file").sortWithinPartitions(*FEED, "source_file", "report_day")
    entry = pa.struct([("field", pa.string()), ("json_type", pa.string()), ("n", pa.int64()), ("log_sum", pa.float64()), ("integers", pa.int64()), ("sketch", pa.list_(pa.int64()))])
    schema = pa.schema([*[(c, pa.string()) for c in (*FEED, "report_day", "source_file", "place")], ("fields", pa.list_(entry))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, footer, sketches = None, Footer(), {}
        out: list[tuple] = []

        def end_file() -> None:
            for place, fields in judged_fields(footer.lines, footer.stats).items() if file else ():
                rows = []
                for path, kind in fields.items():
                    s = footer.stats[path]
                    rows.append((path, TYPE_NAMES[kind] if kind >= 0 else None, s[kind] if kind >= 0 else 0, float(s[LOGSUM]), s[INTEGERS], sketches.get(path)))
                out.append((*file, place, [dict(zip(entry.names, r)) for r in rows]))

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for scope, report, day, name, packed in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if file is None or (scope, report, name) != (file[0], file[1], file[3]):
                    end_file()
                    file, footer, sketches = (scope, report, day, name), Footer(), {}
                footer.merge(*json.loads(packed), sketches)
            if len(out) > 2_000:
                yield flushed()
                out.clear()
        end_file()
        if out:
            yield flushed()

    return keyed.mapInArrow(run, f"scope_slug string, report_type string, report_day string, source_file string, place string, fields {FIELDS}")


def field_observations(lines: DataFrame) -> DataFrame:
    """The exploded footers: one row per file and field it has.

    ``seq`` numbers the files of a feed in which the field's place was judged and
    ``next_file`` names the following one (null for the last). A field with only
    nulls keeps the type it had before.
    """
    order = Window.partitionBy(*FEED, "place").orderBy("report_day", "source_file")
    placed = file_places(lines).withColumn("seq", F.row_number().over(order)).withColumn("next_file", F.lead("source_file").over(order))
    flat = placed.select(*FEED, "place", "seq", "source_file", "next_file", F.inline("fields"))
    # the place is part of the key, so that the files of a feed's place stay where they are
    so_far = Window.partitionBy(*FEED, "place", "field").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return flat.withColumn("json_type", F.last("json_type", ignorenulls=True).over(so_far))


def lifespans(observations: DataFrame) -> DataFrame:
    """The catalogue: one row per island of a field in which it stayed with one type.

    Adds to the island's first and last observation (structs ``first``, ``last``)
    whether it ``continues`` an earlier island of another type without a gap, and
    whether another one follows it likewise.
    """
    by_field = Window.partitionBy(*FEED, "place", "field").orderBy("seq")
    same = (F.lag("seq").over(by_field) == F.col("seq") - 1) & F.lag("json_type").over(by_field).eqNullSafe(F.col("json_type"))
    islands = observations.withColumn("_start", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn(
        "_island", F.sum("_start").over(by_field.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = F.struct("seq", "source_file", "next_file", "json_type", "n", "log_sum", "integers", "sketch")
    spans = islands.groupBy(*FEED, "place", "field", "_island").agg(
        F.min_by(whole, "seq").alias("first"), F.max_by(whole, "seq").alias("last")
    )
    order = Window.partitionBy(*FEED, "place", "field").orderBy("_island")
    continues = F.coalesce(F.lag("last.seq").over(order) == F.col("first.seq") - 1, F.lit(False))
    followed = F.coalesce(F.lead("first.seq").over(order) == F.col("last.seq") + 1, F.lit(False))
    earlier = F.lag("last.json_type").over(order)
    return spans.withColumn("continues", continues).withColumn("followed", followed).withColumn("earlier_type", earlier)


def name_words(path: str) -> frozenset[str]:
    """The words of a field's own name, camel case and underscores taken apart, without the s of a plural."""
    name = path.rpartition(".")[2]
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])", name)]
    return frozenset(w[:-1] if len(w) > 3 and w.endswith("s") and not w.endswith("ss") else w for w in words)


def same_word(a: str, b: str) -> bool:
    """Whether two words are one, or one abbreviates the other: its letters, three at least, come in order in the other and begin it."""
    short, long = sorted((a, b), key=len)
    if short == long:
        return True
    rest = iter(long)
    return len(short) >= 3 and short[0] == long[0] and all(c in rest for c in short)


def shared_words(a: frozenset[str], b: frozenset[str]) -> int:
    """How many words two names share."""
    return min(sum(any(same_word(x, y) for y in b) for x in a), sum(any(same_word(x, y) for x in a) for y in b))


def by_chance(old: dict, new: dict) -> float:
    """How likely a field of fractions gives the other's whole numbers by chance: all of them whole where one of ``n`` was not."""
    whole, other = (old, new) if old["integers"] == old["n"] else (new, old)
    if (whole["integers"] == whole["n"]) == (other["integers"] == other["n"]):
        return 1.0
    return ((other["integers"] + 1) / (other["n"] + 2)) ** whole["n"]


def same_information(old: dict, new: dict) -> float:
    """How likely the field ``new`` brings on what ``old`` held: 0 (no) to 2.

    Both must have one type. Numbers must agree in magnitude, strings in their
    values or their name; names must share at least half of their words unless
    the values themselves are the same.
    """
    if old["json_type"] != new["json_type"] or not old["n"] or not new["n"]:
        return 0.0
    a, b = name_words(old["field"]), name_words(new["field"])
    shared = shared_words(a, b)
    names = max(shared / (len(a) + len(b) - shared), 0.9 * (shared == min(len(a), len(b)) and shared > 0)) if a and b else 0.0
    if old["json_type"] == "number":
        gap = abs(old["log_sum"] / old["n"] - new["log_sum"] / new["n"])
        if gap > 1.0 or by_chance(old, new) < CHANCE:
            return 0.0
        return names + 0.2 * (1 - gap) if names >= 0.5 else 0.0
    if old["json_type"] == "boolean":
        return names if names >= 0.5 else 0.0
    x, y = (set(f["sketch"] or ()) for f in (old, new))
    union = sorted(x | y)[:SKETCH]
    values = sum(v in x and v in y for v in union) / len(union) if union else 0.0
    if old["json_type"] in ("object", "array"):
        return names + values if values >= 0.5 or names >= 0.5 and not (x and y) else 0.0
    return names + values if values >= 0.2 or names >= 0.5 else 0.0


def paired(events: list[dict]) -> list[tuple[str, str, str]]:
    """The changes of one feed, place and file: removals and additions paired off by falling score."""
    removed = [e for e in events if e["what"] == "removed"]
    added = [e for e in events if e["what"] == "added"]
    scored = sorted((-same_information(r, a), r["field"], a["field"]) for r in removed for a in added)
    out, gone, come = [], set(), set()
    for score, r, a in scored:
        if score < 0 and r not in gone and a not in come:
            gone.add(r)
            come.add(a)
            out.append(("renamed", r, a))
    out += [("type_changed", e["field"], e["field"]) for e in events if e["what"] == "type_changed"]
    out += [("removed", r["field"], "") for r in removed if r["field"] not in gone]
    out += [("added", "", a["field"]) for a in added if a["field"] not in come]
    return out


CHANGE_SCHEMA = "scope_slug string, report_type string, source_file string, change_kind string, old_field string, new_field string"


def schema_changes(spans: DataFrame) -> DataFrame:
    """Every change of the schema: added, removed, renamed and type_changed.

    Only files with both removals and additions at one place go through the
    pairing; a file's place has at most as many of them as it has fields.
    """
    def event(what: str, when: Column, at: str, file: str) -> Column:
        evidence = [F.col(f"{at}.{c}").alias(c) for c in ("json_type", "n", "log_sum", "integers", "sketch")]
        return F.when(when, F.struct(F.lit(what).alias("what"), F.col(f"{at}.{file}").alias("source_file"), *evidence))

    retyped = F.col("continues") & (F.col("earlier_type") != F.col("first.json_type"))
    found = F.array(
        event("added", ~F.col("continues") & (F.col("first.seq") > 1), "first", "source_file"),
        event("removed", ~F.col("followed") & F.col("last.next_file").isNotNull(), "last", "next_file"),
        event("type_changed", F.coalesce(retyped, F.lit(False)), "first", "source_file"),
    )
    events = spans.select(*FEED, "place", "field", F.inline(F.array_compact(found)))
    return events.repartition(*FEED, "place", "source_file").mapInArrow(_pair_partition, CHANGE_SCHEMA)


def _pair_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs off all groups of a partition; events are a few per file, so a partition of them is small."""
    groups: dict[tuple, list[dict]] = {}
    for batch in batches:
        for event in batch.to_pylist():
            groups.setdefault((event["scope_slug"], event["report_type"], event["source_file"], event["place"]), []).append(event)
    rows = [(*key[:3], *change) for key, events in groups.items() for change in paired(events)]
    if rows:
        names = [c.split()[0] for c in CHANGE_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)


def alias_table(changes: DataFrame) -> DataFrame:
    """Per report type the spellings that were renamed into each other, with how often."""
    return changes.where("change_kind = 'renamed'").groupBy("report_type", "old_field", "new_field").agg(F.count(F.lit(1)).alias("times"))


def consistent_fields(lines: DataFrame, fields: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """The lines as one table: each target field with its type and the spellings it may come under.

    ``fields`` maps a target column to (SQL type, spellings as JSON paths such as
    ``$.ai_credits_used``). The first spelling with a value counts; values that do
    not cast become null. Lines that are no JSON object give null fields.
    """
    casts = [
        F.expr(f"try_cast({'coalesce(' + ', '.join(f'get_json_object(raw_json, {p!r})' for p in paths) + ', NULL)'} AS {kind})").alias(name)
        for name, (kind, paths) in fields.items()
    ]
    return lines.select("record_id", *FEED, "source_file", "line_no", *casts)


@dataclass
class Target:
    """A field of the consistent schema: its column, its usual type, and its members by each of their spellings.

    ``kind`` is ``string``, ``bigint``, ``double``, ``boolean``, ``object`` or ``array``. An array without
    catalogued members holds texts; an object without them is a text itself.
    """

    name: str = ""
    kind: str = "object"
    spellings: dict[str, Target] = field(default_factory=dict)

    def members(self) -> list[Target]:
        return list({id(t): t for t in self.spellings.values()}.values())

    def arrow_type(self) -> pa.DataType:
        if self.kind in ("object", "array") and self.spellings:
            entry = pa.struct([pa.field(t.name, t.arrow_type()) for t in self.members()])
            return entry if self.kind == "object" else pa.list_(entry)
        if self.kind == "array":
            return pa.list_(pa.string())
        return {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}.get(self.kind, pa.string())

    def sql_type(self) -> str:
        if self.kind in ("object", "array") and self.spellings:
            entry = f"struct<{', '.join(f'`{t.name}`: {t.sql_type()}' for t in self.members())}>"
            return entry if self.kind == "object" else f"array<{entry}>"
        return "array<string>" if self.kind == "array" else "string" if self.kind == "object" else self.kind


#: Columns of the consistent table that no field may be called.
LINE_COLUMNS = ("record_id", *FEED, "source_file", "line_no", "rescued")
#: Least share of whole numbers that makes a number field one of integers.
WHOLE_SHARE = 0.99


def _aliased_side_by_side(observations: DataFrame, names: list[str]) -> set[tuple[str, str]]:
    """The pairs of ``names`` that some file has both of. Names are a few spellings, so the pairs are too."""
    seen = observations.where(F.col("field").isin(names)).groupBy(*FEED, "source_file").agg(F.array_sort(F.collect_set("field")).alias("f"))
    pairs = seen.select(F.explode("f").alias("a"), "f").select("a", F.explode("f").alias("b")).where("a <> b").distinct()
    return {(r["a"], r["b"]) for r in pairs.collect()}


def target_schema(observations: DataFrame) -> Target:
    """The consistent schema of all feeds, from the lifespan catalogue and the alias table of their changes.

    Every path of the catalogue is in it under its most frequent spelling, with
    the type of most of its values. What comes to the driver is one row per path
    and type and one per pair of spellings, whatever the number of files.
    """
    aliases = alias_table(schema_changes(lifespans(observations))).collect()
    counts = observations.groupBy("field", "json_type").agg(F.sum("n").alias("n"), F.sum("integers").alias("whole")).collect()
    apart = _aliased_side_by_side(observations, sorted({f for r in aliases for f in (r["old_field"], r["new_field"])}))

    values: dict[str, dict[str, int]] = {}
    wholes: dict[str, int] = {}
    for r in counts:
        values.setdefault(r["field"], {})[r["json_type"] or "string"] = r["n"]
        if r["json_type"] == "number":
            wholes[r["field"]] = r["whole"]
    times: dict[tuple[str, str], int] = {}
    for r in aliases:
        pair = tuple(sorted((r["old_field"], r["new_field"])))
        times[pair] = times.get(pair, 0) + r["times"]
    group = {f: {f} for f in values}
    for a, b in sorted(times, key=lambda p: (-times[p], p)):
        one, two = group[a], group[b]
        if one is not two and not any((x, y) in apart for x in one for y in two):
            one |= two
            group.update(dict.fromkeys(two, one))

    root = Target()
    places: dict[str, Target] = {"": root}
    # holders before members; all spellings of a holder share one target, so their members come together
    for depth in sorted({f.count(".") for f in values}):
        below: dict[int, tuple[Target, dict[str, list[str]], dict[str, set[str]]]] = {}
        for f in sorted(f for f in values if f.count(".") == depth and _holder(f) in places):
            holder = places[_holder(f)]
            _, paths, same = below.setdefault(id(holder), (holder, {}, {}))
            paths.setdefault(_own_name(f), []).append(f)
            spellings = {_own_name(x) for x in group[f]}
            spellings = spellings.union(*(same[k] for k in spellings if k in same))
            same.update(dict.fromkeys(spellings, spellings))
        for holder, paths, same in below.values():
            weight = {k: sum(sum(values[f].values()) for f in fs) for k, fs in paths.items()}
            taken = {c.lower() for c in LINE_COLUMNS} if holder is root else set()
            for spellings in sorted({frozenset(m) for m in same.values()}, key=lambda m: (-sum(weight[k] for k in m), min(m))):
                fields = [f for k in spellings for f in paths[k]]
                total = {t: sum(values[f].get(t, 0) for f in fields) for t in TYPE_NAMES}
                kind = max(TYPE_NAMES, key=lambda t: (total[t], t == "string"))
                if kind == "number":
                    kind = "bigint" if sum(wholes.get(f, 0) for f in fields) >= WHOLE_SHARE * total[kind] else "double"
                name = min(spellings, key=lambda k: (-weight[k], k))
                while name.lower() in taken:
                    name += "_field"
                taken.add(name.lower())
                target = Target(name, kind)
                holder.spellings.update(dict.fromkeys(sorted(spellings), target))
                if kind in ("object", "array"):
                    places.update(dict.fromkeys((f if kind == "object" else f + "[]" for f in fields), target))
    return root


_TRUE, _FALSE = {"t", "true", "y", "yes", "1"}, {"f", "false", "n", "no", "0"}
_NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")


def _text(value) -> str:
    text = value if type(value) is str else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    # half a surrogate pair has no place in UTF-8
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def fitted(value, target: Target, path: str, rescued: list[tuple[str, str]]):
    """``value`` in the shape of ``target``; whatever has no place there goes to ``rescued`` with its path."""
    if value is None:
        return None
    kind, what = target.kind, type(value)
    if kind == "string" or kind == "object" and not target.spellings:
        return _text(value)
    if what is str and kind in ("object", "array") and value.lstrip()[:1] in ("{", "["):
        ok, inner = json_value(value)
        value, what = (inner, type(inner)) if ok else (value, what)
    if kind == "object" and what is dict:
        return _members(value, target, path + ".", rescued)
    if kind == "array" and what in (dict, list):
        entries = [value] if what is dict else value
        if not target.spellings:
            return [None if e is None else _text(e) for e in entries]
        out = []
        for k, e in enumerate(entries):
            if type(e) is dict:
                out.append(_members(e, target, f"{path}[{k}].", rescued))
            else:
                out.append(None)
                if e is not None:
                    rescued.append((f"{path}[{k}]", _text(e)))
        return out
    cast = None
    if kind == "boolean":
        word = value if what is bool else _text(value).strip().lower() if what in (str, int) else None
        cast = word if what is bool else True if word in _TRUE else False if word in _FALSE else None
    elif kind in ("bigint", "double"):
        number = value if what in (int, float) else None
        if what is str and _NUMBER.fullmatch(value.strip()):
            text = value.strip()
            number = int(text) if len(text) < 30 and text.lstrip("+-").isdigit() else float(text)
        if number is not None and abs(number) < 1e300 and (type(number) is int or math.isfinite(number)):
            if kind == "double":
                cast = float(number) if float(number) == number else None
            elif number == int(number) and -(2**63) <= number < 2**63:
                cast = int(number)
    if cast is None:
        rescued.append((path, _text(value)))
    return cast


def _members(node: dict, target: Target, prefix: str, rescued: list[tuple[str, str]]) -> dict:
    out: dict = {}
    for key, value in node.items():
        member = target.spellings.get(key)
        if member is None or value is not None and out.get(member.name) is not None:
            rescued.append((prefix + key, _text(value)))
        elif value is not None:
            out[member.name] = fitted(value, member, prefix + key, rescued)
    return out


def consistent_lines(lines: DataFrame, schema: Target) -> DataFrame:
    """The lines as one table with a column for each target field, nested ones as structs and arrays of structs.

    Casts are generated from ``schema`` and applied batch by batch without a
    shuffle. ``rescued`` maps the path (``a.b``, ``a[0].b``) of every value
    without a place in the schema to its text. Lines that are no JSON object
    give null fields.
    """
    fields = schema.members()
    types = [t.arrow_type() for t in fields]
    rescued_type = pa.map_(pa.string(), pa.string())
    keep = ("record_id", *FEED, "source_file", "line_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, rest = [], []
            for raw in batch.column(len(keep)).to_pylist():
                record, rescued = json_object(raw), []
                rows.append({} if record is None else _members(record, schema, "", rescued))
                rest.append([(_text(p), x) for p, x in dict(rescued).items()])
            columns = [pa.array([r.get(t.name) for r in rows], kind) for t, kind in zip(fields, types)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *columns, pa.array(rest, rescued_type)], names=[*keep, *[t.name for t in fields], "rescued"]
            )

    picked = lines.select(*keep, "raw_json")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    targets = "".join(f", `{t.name}` {t.sql_type()}" for t in fields)
    return picked.mapInArrow(run, f"{kept}{targets}, rescued map<string,string>")
