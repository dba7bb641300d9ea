"""Raw report lines to validated, flat tables; what fails goes to quarantine with its reasons.

Lines are parsed once into VARIANT values, and every check is a column
expression that yields a reason code or null, so validation stays inside the
JVM. A record with any error gives one quarantine row with all reasons and no
rows; a bad nested entry is quarantined alone and never removes its parent. All
nested entries of a record leave it in one generator, whatever their table, so
children, their quarantine and their unknown fields cost one pass.

Defined cases: blank lines are skipped; JSON true is no number and 2.0 no
integer; integers beyond 64 bits are errors; an absent, null or empty array has
no children; a field may come or not, extra fields are reported as drift, nested
ones too. Absent context columns (scope kind, delivery, path) are null. Of rows
with one key the greatest delivery time, delivery, path and line wins, then the
first entry of a line; repeated keys within an object make a line invalid.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import ARRAYS, BREAKDOWN, CHILD_OF, COUNTERS, FLAGS, OBJECTS, PULL_REQUESTS, REPORT_ALIASES, SILVER, SOURCE_NAMES, Contract
from tidemark.operators.jsonlines import json_object, json_value
from tidemark.operators.latest import winning_rows
from tidemark.operators.shred import ARRAY_FIELDS

BLANK = r"^[\s\x{0085}\x{00A0}]*$"
CONTEXT = ("scope_kind", "scope_slug", "report_type", "report_day", "source_ingestion_id", "source_ingested_at", "source_path", "line_no")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column computed once per row.

    The optimizer copies a projected expression into every expression that uses
    it, which would parse a line hundreds of times; it does not do so across a
    generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parsed(lines: DataFrame, raw: str = "raw_json") -> DataFrame:
    """``lines`` that are not blank, with ``v`` (VARIANT or null) and ``line_error`` (null for an object).

    The JSON reader stops after the first value of a text. Reading the line as
    the only entry of an array and as the only member of an object leaves no
    text that both accept after it.
    """
    inside = f"try_parse_json(concat('[', `{raw}`, ']'))"
    alone = F.expr(f"try_parse_json(concat('{{\"v\":', `{raw}`, '}}'))").isNotNull() & F.expr("variant_get(_w, '$[1]', 'variant')").isNull()
    known = once(lines.drop("_w", "v", "line_error", "reasons").where(F.col(raw).isNotNull() & ~F.col(raw).rlike(BLANK)), "_w", F.expr(inside))
    known = once(known, "v", F.when(alone, F.expr("variant_get(_w, '$[0]', 'variant')"))).drop("_w")
    error = F.when(F.col("v").isNull(), "invalid_json").when(F.expr(f"{_members('v')} IS NULL"), "record_must_be_object")
    return known.withColumn("line_error", error)


# ---- SQL texts about one VARIANT value


def _at(v: str, path: str) -> str:
    return f"variant_get({v}, '$.{path}', 'variant')"


def _members(x: str) -> str:
    """The members of an object as a map; null for anything else."""
    return f"try_variant_get({x}, '$', 'map<string,variant>')"


def _given(x: str) -> str:
    return f"({x} IS NOT NULL AND NOT is_variant_null({x}))"


def _is_text(x: str) -> str:
    return f"coalesce(schema_of_variant({x}) = 'STRING', false)"


def _whole(x: str) -> str:
    """Whether the value is a JSON integer of 64 bits that is not negative."""
    return f"coalesce(schema_of_variant({x}) = 'BIGINT' AND try_variant_get({x}, '$', 'bigint') >= 0, false)"


def _number(x: str) -> str:
    """Whether the value is a JSON number that is not negative."""
    t = f"schema_of_variant({x})"
    return f"coalesce(({t} IN ('BIGINT', 'DOUBLE') OR {t} LIKE 'DECIMAL%') AND try_variant_get({x}, '$', 'double') >= 0, false)"


def _text(x: str) -> str:
    """A string without outer white space; null for other types and for blanks."""
    trimmed = f"regexp_replace(CASE WHEN {_is_text(x)} THEN try_variant_get({x}, '$', 'string') END, '^\\\\s+|\\\\s+$', '')"
    return f"nullif({trimmed}, '')"


def _iso(x: str) -> str:
    """The day of a strict ISO text, null for anything else."""
    value = f"try_variant_get({x}, '$', 'string')"
    return f"CASE WHEN {_is_text(x)} AND {value} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN try_cast({value} AS DATE) END"


def _unless(ok: str, code: str) -> str:
    return f"CASE WHEN NOT ({ok}) THEN '{code}' END"


def _when(bad: str, code: str) -> str:
    return f"CASE WHEN {bad} THEN '{code}' END"


def _listed(names) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")" if names else "cast(array() AS array<string>)"


def _codes(*checks: str) -> str:
    return f"array_compact(array({', '.join(checks)}))"


def _member_codes(members: str, whole: str, numbers: str, flags: str, prefix: str = "", suffix: str = "_must_be_nonnegative_number") -> str:
    """Codes of the members with a wrong type or sign, in one pass over the members that are there.

    ``members`` is a map of VARIANT values; ``whole``, ``numbers`` and ``flags``
    are SQL arrays of names. A rule per possible field would look every field up
    in every record.
    """
    flag = f"array_contains({flags}, e.key)"
    wrong = f"""NOT is_variant_null(e.value) AND CASE WHEN array_contains({whole}, e.key) THEN NOT {_whole("e.value")}
        WHEN array_contains({numbers}, e.key) THEN NOT {_number("e.value")} WHEN {flag} THEN schema_of_variant(e.value) <> 'BOOLEAN' ELSE false END"""
    code = f"concat('{prefix}', e.key, CASE WHEN {flag} THEN '_must_be_boolean_or_null' ELSE '{suffix}' END)"
    return f"coalesce(transform(filter(map_entries({members}), e -> {wrong}), e -> {code}), cast(array() AS array<string>))"


# ---- records: one per line, or per day of an entity line


def with_context(lines: DataFrame, scope_kind: str | None = None) -> DataFrame:
    """``lines`` (raw_json and what is known of their origin) with all columns of ``CONTEXT`` under canonical report types."""
    have = set(lines.columns)
    kind = F.col("report_type")
    for alias, name in REPORT_ALIASES.items():
        kind = F.when(F.col("report_type") == alias, name).otherwise(kind)
    stamp = F.col("source_ingested_at") if "source_ingested_at" in have else F.lit(None).cast("string")
    if "source_ingested_at" in have and lines.schema["source_ingested_at"].dataType.typeName().startswith("timestamp"):
        stamp = F.date_format("source_ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    known = {
        "scope_kind": F.lit(scope_kind) if scope_kind or "scope_kind" not in have else F.col("scope_kind"),
        "report_type": kind,
        "source_ingested_at": stamp,
        "source_path": F.col("source_path") if "source_path" in have else F.col("source_file") if "source_file" in have else F.lit(None).cast("string"),
        **{c: F.lit(None).cast(t) for c, t in (("source_ingestion_id", "string"), ("line_no", "bigint")) if c not in have},
    }
    kept = [c for c in ("record_id",) if c in have]
    return lines.select(*kept, *[known.get(c, F.col(c)).alias(c) for c in CONTEXT], "raw_json")


def _hash(v: str) -> str:
    """SHA-256 of the canonical form of a value: keys in order, no blanks; it does not depend on how a line spells it."""
    return f"sha2(to_json({v}), 256)"


def records(lines: DataFrame, report_type: str) -> DataFrame:
    """The records of one report type: context, ``v``, ``w``, ``line_error``, ids and days as VARIANT, and the record's hash.

    An entity line whose ``day_totals`` is an array gives a record for each of
    its entries; ``w`` is the line then, whose ids and report days an entry
    inherits unless it has the keys itself.
    """
    own = parsed(lines.where(F.col("report_type") == report_type))
    if report_type == "entity":
        days = "try_variant_get(v, '$.day_totals', 'array<variant>')"
        each = F.expr(
            f"CASE WHEN {days} IS NOT NULL THEN transform({days}, (e, i) -> named_struct('v', e, 'w', v, 'k', i)) "
            "ELSE array(named_struct('v', v, 'w', cast(null AS variant), 'k', 0)) END"
        )
        own = own.select(*[c for c in own.columns if c not in ("v", "line_error")], "line_error", F.explode(each).alias("r"))
        entry_error = F.when(F.expr(f"r.w IS NOT NULL AND {_members('r.v')} IS NULL"), "day_totals_entry_must_be_object")
        own = own.select(*[c for c in own.columns if c not in ("r", "line_error")], F.coalesce("line_error", entry_error).alias("line_error"), "r.v", "r.w", F.col("r.k").alias("day_index"))
    else:
        own = own.withColumn("w", F.lit(None).cast("variant")).withColumn("day_index", F.lit(0))
    inherited = lambda name: f"coalesce({_at('v', name)}, {_at('w', name)})"
    parts = {"enterprise": "enterprise_id", "organization": "organization_id", "start": "report_start_day", "end": "report_end_day"}
    named = ", ".join([f"'{k}', {inherited(n)}" for k, n in parts.items()] + [f"'day', {_at('v', 'day')}"])
    own = once(own, "b", F.expr(f"named_struct({named})"))
    whole = f"sha2(concat_ws('|', coalesce(to_json(v), 'null'), {', '.join(f'to_json(b.{k})' for k in parts)}), 256)"
    mark = f"CASE WHEN v IS NULL AND w IS NULL THEN sha2(raw_json, 256) WHEN w IS NULL THEN {_hash('v')} ELSE {whole} END"
    return once(own, "source_record_hash", F.expr(mark))


def _base_codes(report_type: str) -> list[str]:
    """Checks every record must pass: its day and that of its file, and the ids its scope needs."""
    day, text = f"({_iso('b.day')})", _text
    needed = [
        _when(f"scope_kind = 'enterprise' AND {text('b.enterprise')} IS NULL", "enterprise_id_is_required_for_enterprise_scope"),
        _when(f"scope_kind = 'organization' AND {text('b.organization')} IS NULL", "organization_id_is_required_for_organization_scope"),
    ]
    if report_type == "repositories":
        needed.append(_when(f"{text('b.organization')} IS NULL", "organization_id_is_required_for_repository"))
    return [
        _when(f"{day} IS NULL", "day_must_be_iso_date"),
        _when(f"{day} <> try_cast(report_day AS DATE)", "day_does_not_match_bronze_partition"),
        *[_when(f"{_given(f'b.{k}')} AND NOT {_is_text(f'b.{k}')}", f"{k}_id_must_be_string") for k in ("enterprise", "organization")],
        *needed,
    ]


def _id_codes(*names: str) -> list[str]:
    return [_unless(_whole(_at("v", n)), f"{n}_must_be_nonnegative_integer") for n in names]


def _string_codes(*names: str, at: str = "v", prefix: str = "") -> list[str]:
    return [_when(f"{_given(_at(at, n))} AND NOT {_is_text(_at(at, n))}", f"{prefix}{n}_must_be_string") for n in names]


def _above(child: str, total: str, code: str) -> str:
    more = f"try_variant_get({child}, '$', 'bigint') > try_variant_get({total}, '$', 'bigint')"
    integer = lambda x: f"schema_of_variant({x}) = 'BIGINT'"
    return _when(f"{integer(child)} AND {integer(total)} AND {more}", code)


def _pull_request_codes() -> str:
    """Codes of the pull-request object: its type, its members, and children above their total."""
    p = _at("v", "pull_requests")
    doubles = [c for c in PULL_REQUESTS if c.startswith("median_")]
    typed = _member_codes(_members(p), _listed([c for c in PULL_REQUESTS if c not in doubles]), _listed(doubles), _listed([]), "pull_requests.")
    pair = lambda c: _at("v", f"pull_requests.{c}")
    above = _codes(*[_above(pair(c), pair(t), f"pull_requests.{c}_exceeds_{t}") for c, t in CHILD_OF.items()])
    return (
        f"CASE WHEN {_members(p)} IS NOT NULL THEN concat({typed}, {above}) "
        f"WHEN {_given(p)} THEN array('pull_requests_must_be_object') ELSE cast(array() AS array<string>) END"
    )


def _usage_codes() -> list[str]:
    """Checks of counters, flags, report days, login and adoption phase."""
    p = "ai_adoption_phase"
    phase, number = _at("v", p), _at("v", f"{p}.phase_number")
    start, end = f"({_iso('b.start')})", f"({_iso('b.end')})"
    generated, accepted = (_at("v", f"code_{x}_activity_count") for x in ("generation", "acceptance"))
    both = f"{_whole(generated)} AND {_whole(accepted)}"
    return [
        *_string_codes("user_login"),
        *[_when(f"{_given(f'b.{k}')} AND ({_iso(f'b.{k}')}) IS NULL", f"report_{k}_day_must_be_iso_date") for k in ("start", "end")],
        _when(f"{start} > {end}", "report_start_day_must_not_follow_report_end_day"),
        _when(f"{_given(phase)} AND {_members(phase)} IS NULL", f"{p}_must_be_object"),
        _when(f"{_given(number)} AND NOT {_whole(number)}", f"{p}.phase_number_must_be_nonnegative_integer"),
        *[_when(f"{_given(_at('v', f'{p}.{m}'))} AND NOT {_is_text(_at('v', f'{p}.{m}'))}", f"{p}.{m}_must_be_string") for m in ("phase", "name", "version")],
        _when(f"{both} AND try_variant_get({accepted}, '$', 'bigint') > try_variant_get({generated}, '$', 'bigint')", "code_acceptance_count_exceeds_generation_count"),
    ]


_USAGE_MEMBERS = _member_codes(_members("v"), _listed(COUNTERS[1:]), _listed(COUNTERS[:1]), _listed(FLAGS))
TARGETS = {"entity": "entity_daily", "users": "user_daily", "user-teams": "user_team_daily", "repositories": "repository_daily"}


def _record_codes(report_type: str) -> str:
    base = _base_codes(report_type)
    parts = {
        "entity": [_codes(*base, *_usage_codes()), _USAGE_MEMBERS, _pull_request_codes()],
        "users": [_codes(*base, *_usage_codes(), *_id_codes("user_id")), _USAGE_MEMBERS, _pull_request_codes()],
        "user-teams": [_codes(*base, *_id_codes("user_id", "team_id"), *_string_codes("user_login", "slug"))],
        "repositories": [_codes(*base, *_id_codes("repo_id"), *_string_codes("repo_owner_name", "repo_name", "repo_visibility")), _pull_request_codes()],
    }[report_type]
    return f"array_sort(array_distinct(concat({', '.join(parts)})))"


def validated(lines: DataFrame, report_type: str) -> DataFrame:
    """The records of one report type with ``reasons`` (empty for good ones); ``lines`` come from ``with_context``."""
    found = records(lines, report_type)
    return once(found, "reasons", F.when(F.col("line_error").isNotNull(), F.array("line_error")).otherwise(F.expr(_record_codes(report_type))))


_BASE = {
    "day": f"({_iso('b.day')})",
    "day_key": f"cast(date_format({_iso('b.day')}, 'yyyyMMdd') AS bigint)",
    "enterprise_id": _text("b.enterprise"),
    "organization_id": _text("b.organization"),
    "source_report_type": "report_type",
    "source_report_day": "try_cast(report_day AS DATE)",
}
_ORIGIN = ("scope_kind", "scope_slug", "source_ingestion_id", "source_ingested_at", "source_path", "source_record_hash", "line_no", "day_index")


def _with_base(df: DataFrame, extra: dict[str, str]) -> list[Column]:
    kept = [c for c in ("record_id",) if c in df.columns]
    return [*[F.col(c) for c in (*kept, *_ORIGIN)], *[F.expr(e).alias(n) for n, e in {**_BASE, **extra}.items()]]


def main_rows(checked: DataFrame, report_type: str) -> DataFrame:
    """The flat rows of the good records of a report, with every column of its contract and ``line_no``."""
    good = checked.where(F.size("reasons") == 0)
    kinds = {"bigint": "bigint", "double": "double", "boolean": "boolean", "string": "string"}
    own = [c for c in SILVER[TARGETS[report_type]].columns if c.name in {*COUNTERS, *FLAGS, "user_id", "team_id", "repo_id"}]
    pulled = [c for c in PULL_REQUESTS if f"pr_{c}" in SILVER[TARGETS[report_type]].names]
    # one cast takes all checked members of a record out at once
    shape = [f"{c.name}: {kinds[c.dataType.simpleString()]}" for c in own]
    if pulled:
        shape.append(f"pull_requests: struct<{', '.join(f'{c}: ' + ('double' if c.startswith('median_') else 'bigint') for c in pulled)}>")
    flat = once(good, "f", F.expr(f"try_variant_get(v, '$', 'struct<{', '.join(shape)}>')"))
    extra = {**{c.name: f"f.{c.name}" for c in own}, **{f"pr_{c}": f"f.pull_requests.{c}" for c in pulled}}
    if report_type in ("users", "user-teams"):
        extra["user_login"] = _text(_at("v", "user_login"))
    if report_type == "users":
        p = "ai_adoption_phase"
        # the name stands in only where the key phase is absent
        extra["adoption_phase"] = f"coalesce({_text(_at('v', f'{p}.phase'))}, CASE WHEN {_at('v', f'{p}.phase')} IS NULL THEN {_text(_at('v', f'{p}.name'))} END)"
        extra["adoption_phase_number"] = f"try_variant_get(v, '$.{p}.phase_number', 'bigint')"
        extra["adoption_phase_version"] = _text(_at("v", f"{p}.version"))
    elif report_type == "entity":
        extra |= {"report_start_day": _iso("b.start"), "report_end_day": _iso("b.end")}
    elif report_type == "user-teams":
        extra["team_slug"] = _text(_at("v", "slug"))
    elif report_type == "repositories":
        extra |= {c: _text(_at("v", c)) for c in ("repo_owner_name", "repo_name", "repo_visibility")}
    return flat.select(*_with_base(flat, extra))


# ---- nested entries


@dataclass(frozen=True)
class Nested:
    """A nested field: its path, child table, dimensions, and whether it is an array or a single object."""

    path: str
    table: str
    dims: tuple[str, ...] = ()
    is_array: bool = True
    #: a value of another type is ignored instead of quarantined
    lenient: bool = False

    @property
    def sources(self) -> list[str]:
        """The dimensions under their names in the source."""
        return [SOURCE_NAMES.get(d, d) for d in self.dims]

    def own(self, *kinds: str) -> list[str]:
        """The contract's columns of this entry with one of ``kinds``, without dimensions and what comes from the parent."""
        parent = {"user_id", "repo_id", *(["active_user_count"] if self.table == "feature_engagement_daily" else [])}
        contract = SILVER[self.table]
        outer = {c.name for c in SILVER["entity_daily"].columns[:6]} | {c.name for c in SILVER["entity_daily"].columns[-6:]}
        return [c.name for c in contract.columns if c.name not in parent | outer | set(self.dims) and c.dataType.simpleString() in kinds]


USAGE_NESTED = [
    *[Nested(path, table, dims) for path, (table, dims) in ARRAYS.items()],
    *[Nested(path, table, is_array=False) for path, table in OBJECTS.items()],
]
NESTED: dict[str, list[Nested]] = {
    "users": USAGE_NESTED,
    "entity": USAGE_NESTED,
    "user-teams": [],
    "repositories": [
        Nested("pull_requests.copilot_suggestions_by_comment_type", "repository_pr_comment_type_daily", ("comment_type",), lenient=True),
        Nested("pull_request_review_times", "repository_pr_review_time_daily", ("authored_by", "reviewed_by")),
    ],
}
ENGAGEMENT = Nested("copilot_feature_engagement.totals_by_feature", "feature_engagement_daily", ("feature",), lenient=True)
TOKEN_USAGE = ["avg_tokens_per_request", "output_tokens_sum", "prompt_tokens_sum"]
OBJECT_COUNTS = ["prompt_count", "request_count", "session_count", "total_user_messages"]


def _by_field(specs: list[Nested], names) -> str:
    """An SQL map from a path to an array of names."""
    return f"map({', '.join(f'{s.path!r}, {_listed(names(s))}' for s in specs)})[field]"


def _explode_entries(good: DataFrame, specs: list[Nested], parent: dict[str, str]) -> DataFrame:
    """Every nested entry of ``good``: base columns, ``parent`` columns, field, idx (null outside of arrays), e, bad and m (its members)."""
    found = []
    for s in specs:
        x, row = _at("v", s.path), lambda e, i, bad, s=s: f"named_struct('field', '{s.path}', 'idx', {i}, 'e', {e}, 'bad', {bad})"
        none = "cast(null AS bigint)"
        other = f"array({row('v', none, repr(f'{s.path}_must_be_' + ('array' if s.is_array else 'object')))})"
        if s.is_array:
            entries = f"try_variant_get(v, '$.{s.path}', 'array<variant>')"
            there = f"WHEN {entries} IS NOT NULL THEN transform({entries}, (e, i) -> {row('e', 'cast(i AS bigint)', 'cast(null AS string)')})"
        else:
            there = f"WHEN {_members(x)} IS NOT NULL THEN array({row(x, none, 'cast(null AS string)')})"
        found.append(f"CASE {there}{'' if s.lenient else f' WHEN {_given(x)} THEN {other}'} END")
    every = F.expr(f"flatten(array_compact(array({', '.join(found)})))")
    base = good.select(*_with_base(good, parent), "report_type", F.explode(every).alias("n"))
    flat = base.select(*[c for c in base.columns if c != "n"], "n.field", "n.idx", "n.e", "n.bad")
    return once(flat, "m", F.expr(f"CASE WHEN bad IS NULL THEN {_members('e')} END"))


def _entry_codes(specs: list[Nested]) -> str:
    missing = f"transform(filter({_by_field(specs, lambda s: s.sources)}, d -> {_text('m[d]')} IS NULL), d -> concat(d, '_is_required'))"
    arrays = [s for s in specs if s.is_array]
    whole = _by_field(specs, lambda s: s.own("bigint") if s.is_array else [])
    numbers = _by_field(specs, lambda s: s.own("double") if s.is_array else [])
    parts = [missing, _member_codes("m", whole, numbers, _listed([]))] if arrays else []
    if any(not s.is_array for s in specs):
        single = _listed([s.path for s in specs if not s.is_array])
        u, version = "m['token_usage']", "m['last_known_cli_version']"
        counts = _member_codes("m", _listed(OBJECT_COUNTS), _listed([]), _listed([]), suffix="_must_be_nonnegative_integer")
        # sums are whole numbers: their columns hold no fractions
        usage = _member_codes(_members(u), _listed(TOKEN_USAGE[1:]), _listed(TOKEN_USAGE[:1]), _listed([]), "token_usage.")
        other = _codes(
            _when(f"{_given(u)} AND {_members(u)} IS NULL", "token_usage_must_be_object"),
            _when(f"field = 'totals_by_cli' AND {_given(version)} AND {_members(version)} IS NULL", "last_known_cli_version_must_be_object"),
        )
        parts.append(f"CASE WHEN array_contains({single}, field) THEN concat({counts}, {usage}, {other}) ELSE cast(array() AS array<string>) END")
    return (
        "CASE WHEN bad IS NOT NULL THEN array(bad) WHEN m IS NULL THEN array('nested_entry_must_be_object') "
        f"ELSE array_sort(array_distinct(concat({', '.join(parts)}))) END"
    )


def nested_entries(checked: DataFrame, report_type: str) -> DataFrame:
    """All nested entries of the good records of a report with ``entry_reasons``; none for reports without nested fields."""
    specs = NESTED[report_type]
    good = checked.where(F.size("reasons") == 0)
    key = {"users": "user_id", "repositories": "repo_id"}.get(report_type)
    parent = {k: f"try_variant_get(v, '$.{k}', 'bigint')" if k == key else "cast(null AS bigint)" for k in ("user_id", "repo_id")}
    entries = _explode_entries(good, specs, {**parent, "active_user_count": "cast(null AS bigint)"})
    return once(entries, "entry_reasons", F.expr(_entry_codes(specs)))


def wrappers(lines: DataFrame) -> DataFrame:
    """Entity lines that hold an array of days, with ``base_ok``: whether their ids and last report day pass the base checks."""
    lines = lines.withColumn("day_index", F.lit(0))
    own = parsed(lines.where(F.col("report_type") == "entity")).where("line_error IS NULL AND try_variant_get(v, '$.day_totals', 'array<variant>') IS NOT NULL")
    named = f"named_struct('enterprise', {_at('v', 'enterprise_id')}, 'organization', {_at('v', 'organization_id')}, 'day', {_at('v', 'report_end_day')})"
    own = once(once(own, "b", F.expr(named)), "source_record_hash", F.expr(_hash("v")))
    return once(own, "base_ok", F.expr(f"size({_codes(*_base_codes('entity'))}) = 0"))


def engagement_entries(wrapped: DataFrame) -> DataFrame:
    """Entries of the feature engagement of entity lines, dated by the last day of their report, with ``entry_reasons``."""
    count = _at("v", "copilot_feature_engagement.active_user_count")
    parent = {"user_id": "cast(null AS bigint)", "repo_id": "cast(null AS bigint)", "active_user_count": f"CASE WHEN {_whole(count)} THEN try_variant_get({count}, '$', 'bigint') END"}
    entries = _explode_entries(wrapped.where("base_ok"), [ENGAGEMENT], parent)
    return once(entries, "entry_reasons", F.expr(_entry_codes([ENGAGEMENT])))


def child_rows(entries: DataFrame, spec: Nested) -> DataFrame:
    """The flat rows of the good entries of one nested field: dimensions and the entry's own values, ids and lineage of the parent."""
    good = entries.where((F.col("field") == spec.path) & (F.size("entry_reasons") == 0))
    number = lambda n, t: F.expr(f"try_variant_get(m['{n}'], '$', '{t}')")
    text = lambda x: F.expr(_text(x))
    member = lambda o, n: f"variant_get(m['{o}'], '$.{n}', 'variant')"
    own: dict[str, Column] = {d: text(f"m['{s}']") for d, s in zip(spec.dims, spec.sources)}
    own |= {n: number(n, "bigint") for n in spec.own("bigint")} | {n: number(n, "double") for n in spec.own("double")}
    own |= {n: text(f"m['{n}']") for n in spec.own("string")}
    if spec.table == "ide_daily":
        for name, source, inner in (("ide_version", "last_known_ide_version", "ide_version"), ("plugin_version", "last_known_plugin_version", "plugin_version")):
            there = F.expr(f"{_members(f'm[{source!r}]')} IS NOT NULL")
            own[name] = F.when(there, text(member(source, inner))).otherwise(own[name])
            own[f"{name}_sampled_at"] = F.when(there, text(member(source, "sampled_at"))).otherwise(own[f"{name}_sampled_at"])
            if inner == "plugin_version":
                own["plugin"] = F.when(there, text(member(source, "plugin"))).otherwise(own["plugin"])
    if not spec.is_array:
        for n in TOKEN_USAGE:
            if n in own:
                own[n] = F.expr(f"try_variant_get(m['token_usage'], '$.{n}', '{'double' if n.startswith('avg_') else 'bigint'}')")
        if spec.table == "cli_daily":
            own["last_known_cli_version"] = text(member("last_known_cli_version", "cli_version"))
            own["last_known_cli_version_sampled_at"] = text(member("last_known_cli_version", "sampled_at"))
    kept = [c for c in ("record_id",) if c in entries.columns]
    parent = ["user_id", "repo_id", "active_user_count"]
    return good.select(*kept, *_ORIGIN, *_BASE, *[c for c in parent if c in SILVER[spec.table].names], F.col("idx").alias("position"), *[c.alias(n) for n, c in own.items()])


# ---- quarantine, drift and quality


def _quarantined(df: DataFrame, target: Column, day: Column, field: Column, index: Column, codes: str, raw: Column) -> DataFrame:
    kept = [c for c in ("record_id",) if c in df.columns]
    return df.select(
        *kept, "scope_kind", "scope_slug", "report_type", target.alias("target_table"), day.alias("day"), "source_ingestion_id", "source_path",
        "source_record_hash", field.alias("nested_field"), index.alias("nested_index"), F.to_json(codes).alias("reason_codes_json"), raw.alias("raw_record_json"),
    )


def record_quarantine(checked: DataFrame, report_type: str) -> DataFrame:
    """One quarantine row per rejected record; what is no JSON object has no target table."""
    bad, error = checked.where(F.size("reasons") > 0), F.col("line_error")
    entry = error == "day_totals_entry_must_be_object"
    unread = F.to_json(F.struct(F.col("raw_json").alias("raw_line")))
    value = F.concat(F.lit('{"value":'), F.coalesce(F.expr("to_json(v)"), F.lit("null")), F.lit("}"))
    return _quarantined(
        bad,
        F.when(error.isNull() | entry, TARGETS[report_type]).otherwise("unknown"),
        F.when(error.isNull(), F.expr(_iso("b.day"))),
        F.when(entry, "day_totals"),
        F.lit(None).cast("bigint"),
        "reasons",
        F.when(error == "invalid_json", unread).when(error.isNotNull(), value).otherwise(F.expr("to_json(v)")),
    )


def entry_quarantine(entries: DataFrame, specs: list[Nested]) -> DataFrame:
    """One quarantine row per rejected nested entry, with its field and index."""
    value = F.concat(F.lit('{"value":'), F.coalesce(F.expr("to_json(e)"), F.lit("null")), F.lit("}"))
    target = F.expr(f"map({', '.join(f'{s.path!r}, {s.table!r}' for s in specs)})[field]")
    raw = F.when(F.col("m").isNotNull() | F.col("bad").isNotNull(), F.expr("to_json(e)")).otherwise(value)
    return _quarantined(entries.where(F.size("entry_reasons") > 0), target, F.col("day"), F.col("field"), F.col("idx"), "entry_reasons", raw)


#: Names of JSON types in the drift table.
_PYTHON_TYPES = """CASE WHEN is_variant_null(d.value) THEN 'NoneType' WHEN t LIKE 'OBJECT%' THEN 'dict' WHEN t LIKE 'ARRAY%' THEN 'list' WHEN t = 'STRING' THEN 'str'
    WHEN t = 'BOOLEAN' THEN 'bool' WHEN t = 'BIGINT' THEN 'int' ELSE 'float' END"""


def _stray(members: str, expected: str, prefix: str) -> str:
    """The members outside ``expected`` with their path."""
    return f"transform(filter(map_entries({members}), e -> NOT array_contains({expected}, e.key)), e -> named_struct('path', concat({prefix}, e.key), 'value', e.value))"


def _drift_rows(df: DataFrame, day: str, found: list[str]) -> DataFrame:
    kept = [c for c in ("record_id",) if c in df.columns]
    each = df.select(*kept, "scope_kind", "scope_slug", "report_type", F.expr(day).alias("day"), "source_record_hash", F.explode(F.expr(f"flatten(array_compact(array({', '.join(found)})))")).alias("d"))
    typed = once(each, "t", F.expr("schema_of_variant(d.value)"))
    return typed.select(
        *kept, "scope_kind", "scope_slug", "report_type", "day", "source_record_hash", F.col("d.path").alias("field_path"), F.expr(_PYTHON_TYPES).alias("observed_type"),
        F.expr("substr(to_json(d.value), 1, 1000)").alias("sample_value_json"),
    )


_IDS = ["day", "enterprise_id", "organization_id"]
_USAGE_KEYS = [*_IDS, *COUNTERS, *FLAGS, *ARRAYS, *OBJECTS, "pull_requests", "pull_request_review_times", "ai_adoption_phase", "user_login", "report_start_day", "report_end_day"]
EXPECTED = {
    "entity": _USAGE_KEYS,
    "users": [*_USAGE_KEYS, "user_id"],
    "user-teams": [*_IDS, "user_id", "user_login", "team_id", "slug"],
    "repositories": [*_IDS, "repo_id", "repo_owner_name", "repo_name", "repo_visibility", "pull_requests", "pull_request_review_times"],
}


def record_drift(checked: DataFrame, report_type: str) -> DataFrame:
    """Unknown members of good records, and of the phase and pull-request objects of all records."""
    found = [f"CASE WHEN size(reasons) = 0 THEN {_stray(_members('v'), _listed(EXPECTED[report_type]), repr(''))} END"]
    if report_type in ("entity", "users"):
        found.append(_stray(_members(_at("v", "ai_adoption_phase")), _listed(["phase", "name", "phase_number", "version"]), "'ai_adoption_phase.'"))
    if report_type != "user-teams":
        found.append(_stray(_members(_at("v", "pull_requests")), _listed([*PULL_REQUESTS, "copilot_suggestions_by_comment_type"]), "'pull_requests.'"))
    return _drift_rows(checked.where("line_error IS NULL"), _iso("b.day"), found)


def _entry_keys(s: Nested) -> list[str]:
    if not s.is_array:
        return [*OBJECT_COUNTS, "token_usage", "last_known_cli_version"]
    extra = ["last_known_ide_version", "last_known_plugin_version"] if s.table == "ide_daily" else []
    return [*s.sources, *s.own("bigint", "double", "string"), *extra]


def entry_drift(entries: DataFrame, specs: list[Nested]) -> DataFrame:
    """Unknown members of good entries (paths ``field[].name``, ``object.name``), and of the objects inside single objects."""
    single = _listed([s.path for s in specs if not s.is_array])
    prefix = f"concat(field, CASE WHEN array_contains({single}, field) THEN '.' ELSE '[].' END)"
    found = [f"CASE WHEN size(entry_reasons) = 0 THEN {_stray('m', _by_field(specs, _entry_keys), prefix)} END"]
    if any(not s.is_array for s in specs):
        found.append(f"CASE WHEN array_contains({single}, field) THEN {_stray(_members(_q('token_usage')), _listed(TOKEN_USAGE), _inner('token_usage'))} END")
        found.append(f"CASE WHEN field = 'totals_by_cli' THEN {_stray(_members(_q('last_known_cli_version')), _listed(['cli_version', 'sampled_at']), _inner('last_known_cli_version'))} END")
    return _drift_rows(entries.where("m IS NOT NULL"), "day", found)


def _q(name: str) -> str:
    return f"m['{name}']"


def _inner(name: str) -> str:
    return f"concat(field, '.{name}.')"


def wrapper_drift(wrapped: DataFrame) -> DataFrame:
    """Unknown members of entity lines that hold days; not where engagement is given without a valid base."""
    known = ["day_totals", "enterprise_id", "organization_id", "report_start_day", "report_end_day", "copilot_feature_engagement"]
    judged = wrapped.where(F.col("base_ok") | F.expr(f"{_members(_at('v', 'copilot_feature_engagement'))} IS NULL"))
    return _drift_rows(judged, "cast(null AS date)", [_stray(_members("v"), _listed(known), "''")])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The order of rows with one key; within a line the first day and the first entry go before later ones.
RANK = ["source_ingested_at", "source_ingestion_id", "source_path", "line_no", "_day", "_entry", "source_record_hash"]


def key_json(keys: list[str]) -> Column:
    """The values of ``keys`` as a JSON array."""
    one = [F.expr(f"substr(to_json(array(`{k}`)), 2, length(to_json(array(`{k}`))) - 2)") for k in keys]
    return F.concat(F.lit("["), F.concat_ws(",", *one), F.lit("]"))


def duplicate_issues(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """A warning for every key of ``rows`` that occurs more than once."""
    dup = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return dup.select(
        F.lit(table).alias("target_table"), key_json(keys).alias("upsert_key_json"), F.lit("duplicate_upsert_key").alias("check_name"),
        F.lit("warning").alias("severity"), F.concat(F.col("copies").cast("string"), F.lit(" rows shared an upsert key; the deterministic latest row was retained")).alias("message"),
    )


class Normalizer:
    """The 25 tables of the lines of all report types, as lazy plans.

    ``keep`` is applied to each frame that several tables share (validated
    records and nested entries); pass ``session.materialized`` where more than one
    table is wanted, so that lines are read and checked once.
    """

    def __init__(self, lines: DataFrame, scope_kind: str | None = None, keep=lambda df: df):
        self.lines, self._keep = with_context(lines, scope_kind), keep
        self._frames: dict[tuple[str, str], DataFrame] = {}

    def _frame(self, what: str, report_type: str, make) -> DataFrame:
        key = (what, report_type)
        if key not in self._frames:
            self._frames[key] = self._keep(make())
        return self._frames[key]

    def checked(self, report_type: str) -> DataFrame:
        return self._frame("checked", report_type, lambda: validated(self.lines, report_type))

    def entries(self, report_type: str) -> DataFrame:
        return self._frame("entries", report_type, lambda: nested_entries(self.checked(report_type), report_type))

    def wrapped(self) -> DataFrame:
        return self._frame("wrapped", "entity", lambda: wrappers(self.lines))

    def engagement(self) -> DataFrame:
        return self._frame("engagement", "entity", lambda: engagement_entries(self.wrapped()))

    def rows(self, table: str) -> DataFrame:
        """All rows of a data table, losing ones of repeated keys too."""
        for report_type, target in TARGETS.items():
            if target == table:
                return main_rows(self.checked(report_type), report_type)
        if table == ENGAGEMENT.table:
            return child_rows(self.engagement(), ENGAGEMENT)
        parts = [child_rows(self.entries(r), s) for r, specs in NESTED.items() for s in specs if s.table == table]
        return _union(parts)

    def quarantine(self) -> DataFrame:
        parts = [record_quarantine(self.checked(r), r) for r in TARGETS]
        parts += [entry_quarantine(self.entries(r), specs) for r, specs in NESTED.items() if specs]
        return _union([*parts, entry_quarantine(self.engagement(), [ENGAGEMENT])])

    def drift(self) -> DataFrame:
        parts = [record_drift(self.checked(r), r) for r in TARGETS]
        parts += [entry_drift(self.entries(r), specs) for r, specs in NESTED.items() if specs]
        return _union([*parts, entry_drift(self.engagement(), [ENGAGEMENT]), wrapper_drift(self.wrapped())])

    def table(self, name: str) -> DataFrame:
        """One of the 25 tables, bound to its contract, with one row per key."""
        contract = SILVER[name]
        if name == "silver_quality_issues":
            return contract.bind(_union([duplicate_issues(self.rows(n), n, list(SILVER[n].key)) for n in SILVER if not n.startswith("silver_")]))
        if name in ("silver_quarantine", "silver_schema_drift"):
            rows = self.quarantine() if name == "silver_quarantine" else self.drift()
            rank = ["source_ingestion_id", "source_path", "reason_codes_json"] if name == "silver_quarantine" else ["sample_value_json"]
            return contract.bind(winning_rows(contract.project(rows), list(contract.key), rank))
        return bound(self.rows(name), contract)


def bound(rows: DataFrame, contract: Contract) -> DataFrame:
    """The winning row of every key of ``rows``, bound to ``contract``."""
    entry = -F.col("position") if "position" in rows.columns else F.lit(0)
    ranked = rows.withColumn("_day", -F.col("day_index")).withColumn("_entry", entry)
    kept = ranked.select(*[c for c in ranked.columns if c in contract.names or c in RANK])
    return contract.bind(winning_rows(kept, list(contract.key), RANK, contract.names))


# ---- unknown fields at any depth, against a list of paths


def _json_type(value) -> str:
    if value is None:
        return "null"
    return {dict: "object", list: "array", str: "string", bool: "boolean"}.get(type(value), "number")


def stray_members(record: dict, known: frozenset[str]) -> dict[str, object]:
    """The keys of a record outside ``known`` with the value first seen, by path (``a``, ``a.b``, ``a[].b``).

    Objects and array entries under known paths are searched, at any depth; what
    lies inside an unknown field is part of that field.
    """
    found: dict[str, object] = {}

    def node(members: dict, prefix: str) -> None:
        for key, value in members.items():
            path = prefix + key
            # a key with a dot of its own is no path of the contract
            if path not in known or "." in key:
                found.setdefault(path, value)
            elif type(value) is dict:
                # a lone object at an array field is its only entry
                node(value, f"{path}[]." if key in ARRAY_FIELDS else f"{path}.")
            elif type(value) is list:
                entries(value, path + "[]")
            elif type(value) is str and key in ARRAY_FIELDS and value.lstrip()[:1] == "[":
                _, inner = json_value(value)
                entries(inner if type(inner) is list else [], path + "[]")

    def entries(values: list, path: str) -> None:
        for entry in values:
            if type(entry) is dict:
                node(entry, path + ".")
            elif type(entry) is list:
                entries(entry, path + "[]")

    node(record, "")
    return found


def unknown_fields(lines: DataFrame, expected: dict[str, list[str]]) -> DataFrame:
    """Keys outside ``expected`` (paths ``a``, ``a.b``, ``a[].b``) of each report type, of the line and of what is nested in it.

    One row per line and path: record_id, report_type, field_path, observed_type,
    sample. Reports that ``expected`` does not have are not judged.
    """
    known = {report: frozenset(paths) for report, paths in expected.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for record_id, report, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                record = json_object(raw)
                for path, value in stray_members(record, known[report]).items() if record is not None else ():
                    sample = json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))[:1000]
                    rows.append((record_id, report, *(t.encode("utf-8", "replace").decode() for t in (path, _json_type(value), sample))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["record_id", "report_type", "field_path", "observed_type", "sample_value_json"])

    picked = lines.where(F.col("report_type").isin(list(expected))).select(F.col("record_id").cast("bigint"), "report_type", "raw_json")
    return picked.mapInArrow(run, "record_id bigint, report_type string, field_path string, observed_type string, sample_value_json string")
