"""Columnar shredding of nested records, and flat child tables rebuilt from it.

A record is taken apart into one column per leaf path. Each column is a
sequence of entries with a *repetition level* (at which repeated ancestor the
entry continues: 0 starts a record) and a *definition level* (how many repeated
ancestors are really there), so absent and empty arrays keep their place. Every
repeated ancestor also has a *kind* column that says for each entry whether it
is an object, an array, a scalar or null; the scalars of an object lie in leaf
columns whose levels are those of their ancestor.

The rows of a child table come from the level sequences alone: counting the
entries of each level gives the position of an entry in every ancestor array.

Defined cases: a line that is not exactly one JSON object has no columns; an
empty object is an entry, a null is an entry of kind null; of repeated keys the
last counts; arrays inside arrays are repeated ancestors of their own; a lone
object where ``lone_as_array`` expects an array is an array of one entry, and a
string there that holds a JSON array is that array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.jsonlines import json_object, json_value

# fixed values: fields that are arrays whatever their spelling
ARRAY_FIELDS = frozenset(
    [
        "totals_by_feature",
        "totals_by_ide",
        "totals_by_language_feature",
        "totals_by_mcp",
        "totals_by_slash_cmd",
        "day_totals",
        "pull_request_review_times",
    ]
)
OBJECT, ARRAY, SCALAR, NULL = 1, 2, 3, 4
KIND_NAMES = np.array([None, "object", "array", "scalar", "null"], object)

Path = tuple[str, ...]  # segments between repeated steps: ("day_totals", "totals_by_mcp") is day_totals[].totals_by_mcp[]


def _text(value) -> str:
    return value if type(value) is str else "true" if value is True else "false" if value is False else repr(value)


class Shredder:
    """Takes records apart; ``columns()`` gives the level sequences of what was fed so far."""

    def __init__(self, lone_as_array: frozenset[str] = ARRAY_FIELDS, scalars: bool = False):
        self.lone = lone_as_array
        self.scalars = scalars
        self.records = 0
        #: of each repeated path: the parent entry and the kind of every entry
        self.parent: dict[Path, list[int]] = {}
        self.kind: dict[Path, list[int]] = {}
        #: of each leaf: the entry of its ancestor and the value as text
        self.leaves: dict[tuple[Path, str], tuple[list[int], list[str]]] = {}

    def feed(self, record: dict) -> None:
        self._object(record, (), "", self.records)
        self.records += 1

    def _object(self, node: dict, path: Path, prefix: str, at: int) -> None:
        for key, value in node.items():
            if type(value) is dict:
                if key in self.lone:
                    self._array([value], (*path, prefix + key), at)
                else:
                    self._object(value, path, f"{prefix}{key}.", at)
            elif type(value) is list:
                self._array(value, (*path, prefix + key), at)
            elif type(value) is str and key in self.lone and value.lstrip()[:1] == "[":
                ok, inner = json_value(value)
                if ok and type(inner) is list:
                    self._array(inner, (*path, prefix + key), at)
            elif self.scalars and value is not None:
                rows, texts = self.leaves.setdefault((path, prefix + key), ([], []))
                rows.append(at)
                texts.append(_text(value))

    def _array(self, entries: list, path: Path, at: int) -> None:
        parent = self.parent.get(path)
        if parent is None:
            parent, self.kind[path] = self.parent.setdefault(path, []), []
        kind = self.kind[path]
        for entry in entries:
            here = len(parent)
            parent.append(at)
            what = type(entry)
            if what is dict:
                kind.append(OBJECT)
                self._object(entry, path, "", here)
            elif what is list:
                kind.append(ARRAY)
                self._array(entry, (*path, ""), here)
            else:
                kind.append(NULL if entry is None else SCALAR)
                if self.scalars and entry is not None:
                    rows, texts = self.leaves.setdefault((path, ""), ([], []))
                    rows.append(here)
                    texts.append(_text(entry))

    def columns(self, root: bool = False) -> dict[Path, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each repeated path its repetition levels, definition levels, kinds and entry numbers (-1 where absent).

        With ``root`` the records themselves come too, as the path ``()``.
        """
        n = self.records
        done = {(): (np.zeros(n, np.int8), np.zeros(n, np.int8), np.full(n, OBJECT, np.int8), np.arange(n))}
        for path in sorted(self.parent, key=len):
            if not self.parent[path]:  # only ever empty
                continue
            depth = len(path)
            rep0, def0, _, entry0 = done[path[:-1]]
            parent = np.asarray(self.parent[path], np.int64)
            # entries were fed record by record, but an entry's number need not follow its parent's
            order = np.argsort(parent, kind="stable")
            count = np.bincount(parent, minlength=int(entry0.max(initial=-1)) + 1)
            children = np.where(entry0 >= 0, count[entry0], 0)
            length = np.maximum(children, 1)
            first = np.cumsum(length) - length
            total = int(length.sum())
            rep = np.full(total, depth, np.int8)
            rep[first] = rep0
            there = np.repeat(children > 0, length)
            definition = np.where(there, depth, np.repeat(def0, length)).astype(np.int8)
            entry = np.full(total, -1, np.int64)
            offset = np.concatenate(([0], np.cumsum(count)))[:-1]
            within = np.arange(total) - np.repeat(first, length)
            start = np.where(entry0 >= 0, offset[entry0], 0)
            entry[there] = order[(np.repeat(start, length) + within)[there]]
            kinds = np.where(there, np.asarray(self.kind[path], np.int8)[entry], 0).astype(np.int8)
            done[path] = (rep, definition, kinds, entry)
        if not root:
            del done[()]
        return done


def positions(rep: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The record of each entry of a level sequence, and its position in each of its ``depth`` arrays."""
    record = np.cumsum(rep == 0) - 1
    at = []
    for level in range(1, depth + 1):
        running = np.cumsum(rep == level)
        reset = np.maximum.accumulate(np.where(rep < level, np.arange(len(rep)), 0))
        at.append(running - running[reset])
    return record, at


def _template(path: Path) -> str:
    """``a[%d].b[%d]`` of a path; an empty segment is an array inside an array."""
    text = ""
    for segment in path:
        text += f"{'.' if text and segment else ''}{segment.replace('%', '%%')}[%d]"
    return text


def path_name(path: Path) -> str:
    """``a[].b[]`` of a path."""
    return "".join(f"{'.' if k and s else ''}{s}[]" for k, s in enumerate(path))


def _named(path: Path, at: list[np.ndarray], rows: np.ndarray) -> list[str]:
    """The path with positions of the entries ``rows``; the record's own is empty."""
    form = _template(path)
    return [form % p for p in zip(*(a[rows].tolist() for a in at))] if path else [""] * len(rows)


def rebuild(rep: np.ndarray, kinds: np.ndarray, path: Path, every: bool = False) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Of the object entries of a column (or all with ``every``): record number, path with positions, and index in the sequence."""
    record, at = positions(rep, len(path))
    rows = np.flatnonzero(kinds != 0) if every else np.flatnonzero(kinds == OBJECT)
    return record[rows], _named(path, at, rows), rows


def _shredded(batch: pa.RecordBatch, lone: frozenset[str], scalars: bool) -> tuple[list[int], Shredder]:
    shredder, ids = Shredder(lone, scalars), []
    for record_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        record = json_object(raw)
        if record is not None:
            ids.append(record_id)
            try:
                shredder.feed(record)
            except RecursionError as e:  # deeper than any real record; naming it beats losing part of it
                raise ValueError(f"record {record_id} is nested too deeply") from e
    return ids, shredder


def shredded_columns(lines: DataFrame, record_id: str, raw: str, lone_as_array: frozenset[str] = ARRAY_FIELDS) -> DataFrame:
    """The kind columns themselves: one row per record and repeated path it has entries of, with its level sequences.

    Columns: record_id, path (``a[].b[]``), depth, repetition, definition, kinds (arrays of tinyint).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shredder = _shredded(batch, lone_as_array, False)
            for path, (rep, definition, kinds, _) in shredder.columns().items():
                cut = np.append(np.flatnonzero(rep == 0), len(rep)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (rep, definition, kinds)]
                whole = pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([path_name(path)] * len(ids)), pa.array(np.full(len(ids), len(path), np.int32)), *lists],
                    names=["record_id", "path", "depth", "repetition", "definition", "kinds"],
                )
                yield whole.filter(pa.array(np.logical_or.reduceat(kinds != 0, cut[:-1])))

    schema = "record_id bigint, path string, depth int, repetition array<tinyint>, definition array<tinyint>, kinds array<tinyint>"
    return lines.select(F.col(record_id).cast("bigint"), raw).mapInArrow(run, schema)


def child_objects(lines: DataFrame, record_id: str, raw: str, lone_as_array: frozenset[str] = ARRAY_FIELDS) -> DataFrame:
    """Every object that is an entry of an array, at any depth: record_id and child_path (``a[0].b[2]``).

    Shredding and rebuilding happen batch by batch in one pass without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shredder = _shredded(batch, lone_as_array, False)
            ids = np.asarray(ids, np.int64)
            for path, (rep, _, kinds, _) in shredder.columns().items():
                record, names, _ = rebuild(rep, kinds, path)
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(ids[record]), pa.array(names)], names=["record_id", "child_path"])

    return lines.select(F.col(record_id).cast("bigint"), raw).mapInArrow(run, "record_id bigint, child_path string")


def child_tables(lines: DataFrame, record_id: str, raw: str, lone_as_array: frozenset[str] = ARRAY_FIELDS, every: bool = False) -> DataFrame:
    """All child tables in one: record_id, table_path, child_path, parent_path, position and the scalars of the entry.

    ``parent_path`` is the entry (or '' for the record) whose array holds the
    child; ``attributes`` maps each scalar leaf, members of plain objects
    included (``a.b``), to its text. Filter on ``table_path`` for one table.

    With ``every`` the tables are whole: the root table (``table_path`` and
    ``child_path`` '', no parent and position) holds one row per record with the
    scalars of the line and its plain objects, entries that are no object come
    too (a scalar's text under the key ''), and ``kind`` (object, array, scalar,
    null) says what an entry is. So each parent_path is a child_path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shredder = _shredded(batch, lone_as_array, True)
            ids = np.asarray(ids, np.int64)
            by_path: dict[Path, list[tuple[str, list[int], list[str]]]] = {}
            for (path, name), (rows, texts) in shredder.leaves.items():
                by_path.setdefault(path, []).append((name, rows, texts))
            for path, (rep, _, kinds, entry) in shredder.columns(every).items():
                record, names, rows = rebuild(rep, kinds, path, every)
                if not names:
                    continue
                attributes: dict[int, list[tuple[str, str]]] = {}
                for name, at, texts in by_path.get(path, ()):
                    for k, text in zip(at, texts):
                        attributes.setdefault(k, []).append((name, text))
                _, at = positions(rep, len(path))
                # the last positions and the last segment belong to the child; what is before names the parent
                parents = _named(path[:-1], at[:-1], rows) if path else [None] * len(rows)
                kind = [pa.array(KIND_NAMES[kinds[rows]], pa.string())] if every else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[record]),
                        pa.array([path_name(path)] * len(rows)),
                        pa.array(names),
                        pa.array(parents, pa.string()),
                        pa.array(at[-1][rows].astype(np.int32)) if path else pa.nulls(len(rows), pa.int32()),
                        pa.array([attributes.get(k, []) for k in entry[rows].tolist()], pa.map_(pa.string(), pa.string())),
                        *kind,
                    ],
                    names=["record_id", "table_path", "child_path", "parent_path", "position", "attributes", *(["kind"] if every else [])],
                )

    schema = "record_id bigint, table_path string, child_path string, parent_path string, position int, attributes map<string,string>"
    schema += ", kind string" if every else ""
    return lines.select(F.col(record_id).cast("bigint"), raw).mapInArrow(run, schema)


def typed_children(df: DataFrame, keys: list[str], array: str, members: list[str]) -> DataFrame:
    """The entries of a typed array of structs with ``keys``, their position and ``members``; null entries keep their place and are left out."""
    flat = df.select(*keys, F.posexplode(F.col(array)).alias("position", "_entry")).where("_entry IS NOT NULL")
    return flat.select(*keys, "position", *[F.col(f"_entry.{m}").alias(m) for m in members])


def typed_struct(df: DataFrame, keys: list[str], struct: str, members: list[str]) -> DataFrame:
    """The typed struct with ``keys`` and ``members``, one row where it is not null."""
    return df.where(F.col(struct).isNotNull()).select(*keys, *[F.col(f"{struct}.{m}").alias(m) for m in members])
