"""What changed between consecutive full snapshots.

Keys map to ordinals that persist: a stored registry numbers the keys of each
hash bucket, known keys keep their number for ever and new ones follow. The
presence of keys in a snapshot is a compressed bitmap over ordinals, and the
compared attributes are a column of 64-bit digests aligned with them. ``next AND
NOT previous`` are the additions, ``previous AND NOT next`` the removals, and
among the keys in both the aligned columns show the changes. All operations work
on the compressed containers. Ordinals are numbered within buckets, so a
bucket's bitmaps of all snapshots fit one task however large the scope is.

Defined cases: snapshots without rows exist only in a calendar that names them;
the first snapshot of a scope yields nothing; rows with a null key are ignored;
of repeated rows the greatest ``source_line`` wins, then the greater digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_deliveries
from tidemark.session import buckets_for, lookup, written

#: Rows of all snapshots together that one bucket should hold.
ROWS_PER_BUCKET = 100_000
EVENT_SCHEMA = "report_type string, scope_slug string, snapshot_seq int, record_id bigint, change_kind string"


def digest(columns: list[Column]) -> Column:
    """A 64-bit digest in which null differs from every value and positions matter."""
    marked = [part for c in columns for part in (c.isNull(), c)]
    return F.xxhash64(*marked)


def ordinal_registry(keys: DataFrame, names: list[str], registry: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """Persistent ordinals: ``names``, ``bucket`` and ``ordinal`` within the bucket.

    Keys already in ``registry`` keep their ordinal for ever; new keys are
    numbered after the greatest of their bucket. Nulls are ignored.
    """
    bucket = F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")
    fresh = keys.select(*names).na.drop().distinct().withColumn("bucket", bucket)
    number = F.row_number().over(Window.partitionBy("bucket").orderBy(*names)).cast("bigint") - 1
    if registry is None:
        return fresh.withColumn("ordinal", number)
    used = registry.groupBy("bucket").agg((F.max("ordinal") + 1).alias("_used"))
    fresh = fresh.join(registry.select(*names), names, "left_anti").withColumn("ordinal", number)
    fresh = fresh.join(lookup(used), "bucket", "left").withColumn("ordinal", F.col("ordinal") + F.coalesce("_used", F.lit(0)))
    return registry.unionByName(fresh.select(*registry.columns))


#: Ordinals of one container, and how many of them are kept as a sorted array before it becomes a bitmap.
SPAN, SPARSE = 1 << 16, 4096
_BIT = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))


def _words(low: np.ndarray) -> np.ndarray:
    """Sorted positions below ``SPAN`` as packed 64-bit words."""
    words = np.zeros(SPAN // 64, np.uint64)
    np.bitwise_or.at(words, low >> 6, _BIT[low & 63])
    return words


def _set_bits(words: np.ndarray) -> np.ndarray:
    """Positions of the set bits; only words that have any are unpacked."""
    some = np.flatnonzero(words)
    bits = np.unpackbits(words[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return (some[row] << 6) + bit


def _has(words: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (words[low >> 6] & _BIT[low & 63]) != 0


class Bitmap:
    """A set of ordinals in containers of ``SPAN``: a sorted array while sparse, packed words beyond."""

    __slots__ = ("containers",)

    def __init__(self, ordinals: np.ndarray):
        ordinals = np.sort(np.asarray(ordinals, np.int64))
        self.containers: dict[int, np.ndarray] = {}
        high = ordinals // SPAN
        for part in np.split(ordinals, np.flatnonzero(np.diff(high)) + 1):
            if len(part):
                low = part % SPAN
                self.containers[int(part[0] // SPAN)] = low if len(low) <= SPARSE else _words(low)

    def _combined(self, other: Bitmap, keep: bool) -> np.ndarray:
        """Ordinals of this set that are (``keep``) or are not in ``other``, container by container."""
        out = []
        for high, mine in self.containers.items():
            theirs = other.containers.get(high)
            if theirs is None:
                low = None if keep else (mine if mine.dtype != np.uint64 else _set_bits(mine))
            elif mine.dtype == np.uint64:
                packed = theirs if theirs.dtype == np.uint64 else _words(theirs)
                low = _set_bits(mine & packed if keep else mine & ~packed)
            elif theirs.dtype == np.uint64:
                low = mine[_has(theirs, mine) == keep]
            else:
                at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
                low = mine[(theirs[at] == mine) == keep]
            if low is not None and len(low):
                out.append(low + high * SPAN)
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def and_not(self, other: Bitmap) -> np.ndarray:
        """Ordinals in this set and not in ``other``."""
        return self._combined(other, False)

    def both(self, other: Bitmap) -> np.ndarray:
        return self._combined(other, True)


def _diff_bucket(keys: pa.Table, t: pa.Table) -> pa.Table:
    """Events of one bucket: ``keys`` is its part of the registry, ``t`` all snapshots of all its keys."""
    coded = [t[c].combine_chunks().dictionary_encode() for c in ("report_type", "scope_slug")]
    kind, scope = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in coded)
    names = [x.dictionary.to_pylist() for x in coded]
    record, seq, h, last = (t[c].to_numpy() for c in ("record_id", "snapshot_seq", "h", "last_seq"))
    place = kind * max(1, len(names[1])) + scope
    order = np.argsort(place, kind="stable")
    place, record, seq, h, last = (x[order] for x in (place, record, seq, h, last))
    # the registry's keys by the same numbers of report and scope
    code = [{n: k for k, n in enumerate(x)} for x in names]
    own = [np.array([c.get(v, -1) for v in keys[n].to_pylist()], np.int64) for c, n in zip(code, ("report_type", "scope_slug"))]
    known = np.where((own[0] < 0) | (own[1] < 0), -1, own[0] * max(1, len(names[1])) + own[1])
    key_of, ordinal_of = keys["record_id"].to_numpy(), keys["ordinal"].to_numpy()
    by_key = np.lexsort((key_of, known))
    known, key_of, ordinal_of = known[by_key], key_of[by_key], ordinal_of[by_key]
    out: dict[str, list] = {k: [] for k in ("place", "seq", "record", "what")}
    cuts = np.flatnonzero(np.diff(place)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)]):
        if a == b:
            continue
        first, end = np.searchsorted(known, [place[a], place[a] + 1])
        ordinal = ordinal_of[first:end][np.searchsorted(key_of[first:end], record[a:b])]
        base = int(ordinal.min())
        size = int(ordinal.max()) - base + 1
        ordinal = ordinal - base
        record_of = np.zeros(size, np.int64)
        record_of[ordinal] = record[a:b]
        s, values = seq[a:b], h[a:b]
        by_seq = np.argsort(s, kind="stable")
        bounds = np.searchsorted(s[by_seq], np.arange(1, int(last[a]) + 2))
        before, column = None, None
        for k in range(int(last[a])):
            rows = by_seq[bounds[k] : bounds[k + 1]]
            now = Bitmap(ordinal[rows])
            aligned = np.zeros(size, np.int64)
            aligned[ordinal[rows]] = values[rows]
            if before is not None:
                common = now.both(before)
                for what, found in enumerate((now.and_not(before), before.and_not(now), common[aligned[common] != column[common]])):
                    out["place"].append(np.full(len(found), place[a]))
                    out["seq"].append(np.full(len(found), k + 1, np.int32))
                    out["record"].append(record_of[found])
                    out["what"].append(np.full(len(found), what, np.int8))
            before, column = now, aligned
    got = {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}
    k, s = np.divmod(got["place"], max(1, len(names[1])))
    take = lambda values, at: pa.array(values, pa.string()).take(pa.array(at, pa.int64()))
    return pa.table(
        {
            "report_type": take(names[0], k),
            "scope_slug": take(names[1], s),
            "snapshot_seq": pa.array(got["seq"], pa.int32()),
            "record_id": pa.array(got["record"], pa.int64()),
            "change_kind": take(["added", "removed", "changed"], got["what"]),
        }
    )


def keyed_snapshots(df: DataFrame, report_type: str, key: str, attributes: list[Column], calendar: DataFrame) -> DataFrame:
    """The winning rows of the snapshots in ``calendar`` as report type, scope, snapshot number, key and digest.

    Winners are chosen with an aggregate that combines map-side, so a key that is
    repeated in a large part of all rows reaches its bucket once per snapshot.
    """
    rows = (
        df.drop("snapshot_seq", "last_seq").join(calendar, ["scope_slug", "day", "source_ingestion_id"])
        .where(F.col(key).isNotNull())
        .select(
            F.lit(report_type).alias("report_type"),
            "scope_slug",
            "snapshot_seq",
            "last_seq",
            F.col(key).cast("bigint").alias("record_id"),
            digest(attributes).alias("h"),
            F.coalesce("source_line", F.lit(-(2**63))).cast("bigint").alias("line"),
        )
    )
    keys = ["report_type", "scope_slug", "snapshot_seq", "last_seq", "record_id"]
    return rows.groupBy(*keys).agg(F.max(F.struct("line", "h")).alias("w")).select(*keys, F.col("w.h").alias("h"))


def snapshot_calendar(df: DataFrame) -> DataFrame:
    """Snapshots of each scope with their number and the number of the last one."""
    return latest_deliveries(df).withColumn("last_seq", F.max("snapshot_seq").over(Window.partitionBy("scope_slug")))


KEY = ("report_type", "scope_slug", "record_id")


def snapshot_changes(reports: dict[str, tuple[DataFrame, str, list[Column]]], rows_per_bucket: int = ROWS_PER_BUCKET, registry: DataFrame | None = None) -> DataFrame:
    """Added, removed and changed records between consecutive snapshots.

    ``reports`` maps a report type to its table, key column and compared
    columns. ``registry`` is the stored one of earlier runs (its number of buckets
    counts); without it a new one is stored. Columns of the result: report_type,
    scope_slug, day (of the later snapshot), record_id, change_kind. Each table is
    read for its lineage columns, for its keys and for keys and attributes; one
    exchange brings the rows of a key bucket together with its ordinals.
    """
    keyed, days, keys, rows = None, None, None, 0
    for report_type, (df, key, attributes) in reports.items():
        calendar = lookup(snapshot_calendar(df))
        part = keyed_snapshots(df, report_type, key, attributes, calendar)
        day = calendar.select(F.lit(report_type).alias("report_type"), "scope_slug", "snapshot_seq", "day")
        # distinct combines map-side: a task passes each key on once, however many snapshots it reads
        own = df.select(F.lit(report_type).alias("report_type"), "scope_slug", F.col(key).cast("bigint").alias("record_id"))
        keyed, days, keys = (part, day, own) if keyed is None else (keyed.unionByName(part), days.unionByName(day), keys.unionByName(own))
        rows += df.count()
    buckets = buckets_for(rows, rows_per_bucket, least=12) if registry is None else registry.agg(F.max("buckets")).first()[0]
    earlier = None if registry is None else registry.select(*KEY, "bucket", "ordinal")
    stored = written(ordinal_registry(keys, list(KEY), earlier, buckets).withColumn("buckets", F.lit(buckets)))
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")
    numbered = stored.select("bucket", *KEY, "ordinal").groupBy("bucket")
    events = numbered.cogroup(keyed.withColumn("bucket", bucket).groupBy("bucket")).applyInArrow(_diff_bucket, EVENT_SCHEMA)
    return events.join(lookup(days), ["report_type", "scope_slug", "snapshot_seq"]).select(
        "report_type", "scope_slug", "day", "record_id", "change_kind"
    )
