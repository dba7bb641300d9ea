"""Tables as immutable versions: create, upsert, bounded replacement, append, guarded overwrite.

A table is a folder of data files, one sub-folder per change, and of manifests:
a manifest lists for each partition the changes whose files make it up, and a
small pointer names the current manifest. A change writes the partitions it
touches and nothing else, then a manifest, then moves the pointer; readers never
see half a change, an interrupted run leaves the table as it was, and an append
only adds files. Manifests that are no longer wanted, and the files only they
name, go with ``vacuum``.

Parquet tables have no MERGE; its result is computed as a plan over the touched
partitions:

    source  +  target rows whose key is not in the source and that are not to be replaced

Keys compare null-safely. The steps below are also available as pure functions
on DataFrames.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import lookup


def upserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``source`` rows, and ``target`` rows whose key the source lacks."""
    return replaced(target, source, keys, F.lit(False))


def replaced(target: DataFrame, source: DataFrame, keys: list[str], predicate: Column) -> DataFrame:
    """Upsert that also removes target rows satisfying ``predicate`` (null: kept) which the source lacks."""
    outside = target.where(~F.coalesce(predicate, F.lit(False))).alias("t")
    s = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys]).alias("s")
    same = None
    for k in keys:
        one = F.col(f"t.{k}").eqNullSafe(F.col(f"s._s_{k}"))
        same = one if same is None else same & one
    kept = outside.join(s, same, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def outside_predicate(source: DataFrame, predicate: Column) -> DataFrame:
    """Source rows that a bounded replacement must not contain (a null predicate passes)."""
    return source.where(~F.coalesce(predicate, F.lit(True)))


def window_predicate(windows: list[tuple[str, str, str, str]], has_day: bool = True) -> Column:
    """True for rows of any (scope_kind, scope_slug, start, end); without a day column the whole scope."""
    out = F.lit(False)
    for kind, slug, start, end in sorted(set(windows)):
        one = (F.col("scope_kind") == kind) & (F.col("scope_slug") == slug)
        out = out | (one & F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")) if has_day else one)
    return out


def snapshot_predicate(snapshots: list[tuple[str, str, str, str]]) -> Column:
    """True for rows of any (scope_kind, scope_slug, report_type, day) snapshot, by their lineage columns."""
    out = F.lit(False)
    for kind, slug, report_type, day in sorted(set(snapshots)):
        out = out | (
            (F.col("scope_kind") == kind) & (F.col("scope_slug") == slug) & (F.col("source_report_type") == report_type)
            & (F.col("source_report_day") == F.lit(day).cast("date"))
        )
    return out


def window_days(windows: DataFrame) -> DataFrame:
    """The days of replacement windows (scope_kind, scope_slug, start_day, end_day), each once, to join rows with."""
    days = F.explode(F.sequence(F.col("start_day").cast("date"), F.col("end_day").cast("date")))
    return windows.where("start_day <= end_day").select("scope_kind", "scope_slug", days.alias("day")).distinct()


def replaced_where(target: DataFrame, source: DataFrame, keys: list[str], marks: DataFrame) -> DataFrame:
    """``replaced`` for what ``marks`` names: target rows that equal a row of ``marks`` in all its columns go unless the source has them.

    ``marks`` are snapshots or window days as a table, of any number, where a
    predicate would be a chain of conditions. Null values match nothing.
    """
    inside = target.join(lookup(marks.distinct()), marks.columns, "left_anti")
    return replaced(inside, source, keys, F.lit(False))


def in_windows(df: DataFrame, windows: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` inside any of ``windows`` (scope_kind, scope_slug, start_day, end_day), or with ``left_anti`` those outside.

    What ``window_predicate`` says of a few windows, for any number of them.
    """
    w = windows.select(F.col("scope_kind").alias("_kind"), F.col("scope_slug").alias("_slug"), *[F.col(c).cast("date").alias(f"_{c}") for c in ("start_day", "end_day")])
    return df.join(w, (F.col("scope_kind") == F.col("_kind")) & (F.col("scope_slug") == F.col("_slug")) & F.col("day").between(F.col("_start_day"), F.col("_end_day")), how)


class Conflict(RuntimeError):
    """Another writer changed the table meanwhile; nothing was changed by this one."""


class Table:
    """A versioned parquet table in ``path`` (any Hadoop file system).

    ``partition_by`` names the columns whose values make a partition, the unit
    that a change rewrites. Partition folders are listed on the driver, as many
    as the table has partitions; rows never come there. ``gathered`` brings the
    rows of a partition together before they are written: without it each task
    adds a file to each partition it has rows of. Large partitions are split.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = (), gathered: bool = False):
        self.spark, self.path, self.partition_by, self.gathered = spark, path.rstrip("/"), tuple(partition_by), gathered
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.path}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(f"{self.path}/{name}"), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def version(self) -> str | None:
        return self._text("_current") if self._fs.exists(self._path(f"{self.path}/_current")) else None

    def exists(self) -> bool:
        return self.version() is not None

    def _manifest(self, version: str | None) -> dict:
        return json.loads(self._text(f"_manifests/{version}.json")) if version else {"schema": None, "owner": None, "parts": {}}

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._manifest(self.version())["schema"])

    def _frame(self, manifest: dict, parts: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/data/change={change}" + (f"/{p}" if p else "") for p in parts for change in manifest["parts"][p]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # partition values are typed by the table's schema, not guessed from their folders
        whole = T.StructType([*schema.fields, T.StructField("change", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    def read(self, version: str | None = None) -> DataFrame:
        """The rows of the current version, or of an earlier one."""
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(self.path)
        manifest = self._manifest(version)
        return self._frame(manifest, sorted(manifest["parts"]))

    def read_partitions(self, parts: list[str]) -> DataFrame:
        """The rows of some partitions (as ``partitions_of`` names them); those that do not exist have none."""
        manifest = self._manifest(self.version())
        return self._frame(manifest, [p for p in parts if p in manifest["parts"]])

    def _write_change(self, df: DataFrame) -> tuple[str, list[str]]:
        """Writes ``df`` as one change; its name and the partitions it has rows of."""
        change = uuid.uuid4().hex
        root = f"{self.path}/data/change={change}"
        if self.gathered and self.partition_by:
            df = df.hint("rebalance", *self.partition_by)
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(root)
        if not self.partition_by:
            return change, [""]
        found = self._fs.globStatus(self._path(root + "/" + "/".join(["*=*"] * len(self.partition_by))))
        base = self._path(root).toUri().getPath()
        return change, sorted(f.getPath().toUri().getPath()[len(base) + 1 :] for f in found)

    def _commit(self, base: str | None, manifest: dict) -> str:
        """Makes ``manifest`` current if the table still is at version ``base``."""
        version = f"v-{uuid.uuid4().hex}"
        self._put(f"_manifests/{version}.json", json.dumps({**manifest, "before": base}))
        self._put(f"_next-{version}", version)
        if self.version() != base:
            raise Conflict(self.path)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        how = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE
        files = hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(self._path(f"{self.path}/_next-{version}"), self._path(f"{self.path}/_current"), how)
        return version

    def write(self, df: DataFrame, owner: str | None = None) -> str:
        """Makes ``df`` the whole table; a failure before the pointer moves changes nothing.

        A table that was written with an ``owner`` is overwritten by the same owner
        only, so that a demonstration never replaces real data.
        """
        base = self.version()
        held = self._manifest(base)["owner"]
        if base and held != owner:
            raise PermissionError(f"{self.path} belongs to {held or 'no owner'}")
        change, parts = self._write_change(df)
        return self._commit(base, {"schema": df.schema.jsonValue(), "owner": owner, "parts": {p: [change] for p in parts}})

    def partitions_of(self, df: DataFrame) -> list[str]:
        """The partitions that rows of ``df`` belong to, as folder names."""
        if not self.partition_by:
            return [""]
        value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        rows = df.select(*[value(c).alias(c) for c in self.partition_by]).distinct().collect()
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return sorted("/".join(f"{escape(c)}={escape(r[c])}" for c in self.partition_by) for r in rows)

    def rewrite(self, touched: list[str], rows: DataFrame) -> str:
        """Makes ``rows`` the content of the ``touched`` partitions; all others stay as they are, unread."""
        base = self.version()
        manifest = self._manifest(base)
        change, parts = self._write_change(rows)
        outside = set(parts) - set(touched)
        if outside:
            raise ValueError(f"rows outside of the partitions to rewrite: {sorted(outside)[:3]}")
        kept = {p: v for p, v in manifest["parts"].items() if p not in set(touched)}
        schema = manifest["schema"] or rows.schema.jsonValue()
        return self._commit(base, {**manifest, "schema": schema, "parts": kept | {p: [change] for p in parts}})

    def _checked(self, source: DataFrame, keys: list[str]) -> None:
        if source.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError("source keys must be unique")

    def _merge(self, source: DataFrame, keys: list[str], inside: Column | DataFrame) -> str:
        source = source.select(*self.schema().names)
        touched = self.partitions_of(source)
        if not set(self.partition_by) <= set(keys):
            # a key may lie in any partition, so all of them have to be looked through
            touched = sorted({*touched, *self._manifest(self.version())["parts"]})
        elif self.partition_by:
            doomed = in_windows(self.read(), inside) if isinstance(inside, DataFrame) else self.read().where(F.coalesce(inside, F.lit(False)))
            touched = sorted({*touched, *self.partitions_of(doomed)})
        target = self.read_partitions(touched)
        if isinstance(inside, DataFrame):
            return self.rewrite(touched, upserted(in_windows(target, inside, "left_anti"), source, keys))
        return self.rewrite(touched, replaced(target, source, keys, inside))

    def upsert(self, source: DataFrame, keys: list[str]) -> str:
        """Source rows go in, those of the same keys out. Only partitions of the source are rewritten if the keys name them."""
        self._checked(source, keys)
        return self._merge(source, keys, F.lit(False)) if self.exists() else self.write(source)

    def replace(self, source: DataFrame, keys: list[str], inside: Column | DataFrame) -> str:
        """Bounded replacement; every source row must lie inside a predicate, or inside windows given as a table (see ``in_windows``)."""
        self._checked(source, keys)
        outside = in_windows(source, inside, "left_anti") if isinstance(inside, DataFrame) else outside_predicate(source, inside)
        if outside.limit(1).count():
            raise ValueError("source rows outside of what is to be replaced")
        return self._merge(source, keys, inside) if self.exists() else self.write(source)

    def append(self, rows: DataFrame) -> str:
        """Adds rows as further files; what is there is neither read nor rewritten."""
        base = self.version()
        if base is None:
            return self.write(rows)
        manifest = self._manifest(base)
        change, parts = self._write_change(rows.select(*T.StructType.fromJson(manifest["schema"]).names))
        return self._commit(base, {**manifest, "parts": manifest["parts"] | {p: [*manifest["parts"].get(p, []), change] for p in parts}})

    def compact(self) -> str:
        """Rewrites the partitions that several changes make up, as appends leave them."""
        many = sorted(p for p, changes in self._manifest(self.version())["parts"].items() if len(changes) > 1)
        return self.rewrite(many, self.read_partitions(many)) if many else self.version()

    def vacuum(self, keep: int = 2) -> int:
        """Removes all but the last ``keep`` versions and the changes only they name; returns how many changes went.

        Not to be run beside a writer: a change that is not committed yet belongs to no version.
        """
        kept, changes, at = [], set(), self.version()
        while at and len(kept) < keep:
            kept.append(at)
            manifest = self._manifest(at)
            changes |= {c for parts in manifest["parts"].values() for c in parts}
            at = manifest["before"] if self._fs.exists(self._path(f"{self.path}/_manifests/{manifest['before']}.json")) else None
        for f in self._fs.listStatus(self._path(f"{self.path}/_manifests")):
            if f.getPath().getName().removesuffix(".json") not in kept:
                self._fs.delete(f.getPath(), False)
        gone = [f.getPath() for f in self._fs.listStatus(self._path(f"{self.path}/data")) if f.getPath().getName().removeprefix("change=") not in changes]
        for path in gone:
            self._fs.delete(path, True)
        return len(gone)


AUDIT = "run_id stage status started_at completed_at scope_kind scope_slug start_date end_date validation_status details_json".split()


def audit_row(spark: SparkSession, **values: str) -> DataFrame:
    """One row of the audit table: eleven strings, none null."""
    missing = [c for c in AUDIT if values.get(c) is None]
    if missing:
        raise ValueError(f"audit values missing: {', '.join(missing)}")
    return spark.createDataFrame([tuple(str(values[c]) for c in AUDIT)], ", ".join(f"{c} string NOT NULL" for c in AUDIT))


def is_completed(audit: DataFrame, scope_slug: str, start: str, end: str) -> DataFrame:
    """Whether a successful audit row covers the scope and days: one row, ``completed``."""
    hits = audit.where(
        (F.col("status") == "succeeded") & (F.col("scope_slug") == scope_slug) & (F.get_json_object("details_json", "$.start") <= start)
        & (F.get_json_object("details_json", "$.end") >= end)
    )
    return hits.agg((F.count(F.lit(1)) > 0).alias("completed"))
