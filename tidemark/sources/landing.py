"""Immutable landing of report files: content hashes, manifests, duplicate detection and readers.

Layout below the landing root (names with a leading underscore are ignored by readers):

    scope_kind=/scope=/report_type=/report_day=/ingestion_id=/part-NNNNN.ndjson
    _manifests/scope_kind=/scope=/report_type=/report_day=/<ingestion_id>.json
"""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import REPORT_ALIASES
from tidemark.operators.silver import parsed

SAFE = re.compile(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")
MANIFEST_SCHEMA = (
    "schema_version bigint, scope struct<kind: string, slug: string>, report_type string, report_day string, ingestion_id string, "
    "ingested_at string, status string, content_fingerprint string, "
    "files array<struct<path: string, sha256: string, byte_count: bigint, record_count: bigint>>"
)


def partition_path(scope_kind: str, scope: str, report_type: str, report_day: str, ingestion_id: str) -> str:
    """Folder of a delivery below the landing root; values that could leave it are refused."""
    parts = {"scope_kind": scope_kind, "scope": scope, "report_type": report_type, "report_day": report_day, "ingestion_id": ingestion_id}
    for name, value in parts.items():
        if not SAFE.match(value) or ".." in value:
            raise ValueError(f"unsafe {name}: {value!r}")
    date.fromisoformat(report_day)
    return "/".join(f"{k}={v}" for k, v in parts.items())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of landed files: source_path, the partition columns and raw_json. Lines end at \\n only."""
    lines = spark.read.option("lineSep", "\n").option("basePath", path).text(path)
    return lines.withColumn("source_path", F.col("_metadata.file_path")).withColumnRenamed("value", "raw_json").where("trim(raw_json) <> ''")


def read_manifests(spark: SparkSession, root: str, scope: str | None = None, start: str | None = None, end: str | None = None, lines: bool = False) -> DataFrame:
    """Manifests below ``root``, optionally of one scope and a range of days; with ``lines`` files may hold one a line."""
    found = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").option("multiLine", str(not lines).lower()).json(f"{root}/_manifests")
    flat = found.select(
        F.col("scope.kind").alias("scope_kind"), F.col("scope.slug").alias("scope_slug"), "report_type", "report_day", "ingestion_id",
        "ingested_at", "status", "content_fingerprint", "files",
    )
    for column, op, value in (("scope_slug", "=", scope), ("report_day", ">=", start), ("report_day", "<=", end)):
        if value is not None:
            flat = flat.where(F.expr(f"{column} {op} {value!r}"))
    return flat


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """Of each file its path, SHA-256, bytes and number of records; every non-blank line must be a JSON object.

    ``bad_lines`` counts the lines that are not. Hashes and lines are computed where the files are read.
    """
    whole = spark.read.format("binaryFile").load(path).select(F.col("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_count"))
    lines = parsed(spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw_json")))
    counts = lines.groupBy("path").agg(F.count(F.lit(1)).alias("record_count"), F.count("line_error").alias("bad_lines"))
    key = F.regexp_replace("path", "^file:/+", "/")
    joined = whole.withColumn("path", key).join(counts.withColumn("path", key), "path", "left")
    return joined.select("path", "sha256", "byte_count", F.coalesce("record_count", F.lit(0)).alias("record_count"), F.coalesce("bad_lines", F.lit(0)).alias("bad_lines"))


def fingerprints(files: DataFrame, keys: list[str]) -> DataFrame:
    """The content fingerprint per ``keys``: SHA-256 of the file hashes in order of path, one per line."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda f: f["sha256"])
    return files.groupBy(*keys).agg(F.sha2(F.array_join(ordered, "\n"), 256).alias("content_fingerprint"), F.sum("record_count").alias("record_count"))


def reconcile(facts: DataFrame, manifests: DataFrame) -> DataFrame:
    """Deliveries whose landed records differ from their manifest."""
    stated = manifests.select("ingestion_id", F.expr("aggregate(files, 0L, (a, f) -> a + f.record_count)").alias("stated"))
    landed = facts.select(F.regexp_extract("path", "ingestion_id=([^/]+)", 1).alias("ingestion_id"), "record_count").groupBy("ingestion_id").agg(
        F.sum("record_count").alias("landed")
    )
    both = stated.join(landed, "ingestion_id", "full_outer")
    return both.where(~F.col("stated").eqNullSafe(F.col("landed")))


class Landing:
    """Commits deliveries: staged, hashed, compared with what is there, moved, and only then named by a manifest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def commit(self, lines: DataFrame | None, scope_kind: str, scope: str, report_type: str, report_day: str, ingested_at: str, ingestion_id: str | None = None) -> dict:
        """Lands ``lines`` (a column raw_json; None for a day reported without data) and returns the result.

        ``status`` is success, no_data, or duplicate when a delivery with the same
        status and content is already landed for the scope, type and day; then
        nothing is kept. A failure leaves neither data nor manifest.
        """
        report_type = REPORT_ALIASES.get(report_type, report_type)
        ingestion_id = ingestion_id or uuid.uuid4().hex
        target = partition_path(scope_kind, scope, report_type, report_day, ingestion_id)
        staging = f"{self.root}/_staging/{ingestion_id}"
        files: list = []
        try:
            if lines is not None:
                lines.select("raw_json").write.option("compression", "none").text(staging)
                files = sorted(file_facts(self.spark, staging).where("byte_count > 0").collect(), key=lambda f: f["path"])
                if any(f["bad_lines"] for f in files):
                    raise ValueError("every line must be a JSON object")
            status = "success" if lines is not None else "no_data"
            hashes = "\n".join(f["sha256"] for f in files)
            fingerprint = self.spark.range(1).select(F.sha2(F.lit(hashes), 256)).first()[0]
            if self._known(scope, report_type, report_day, status, fingerprint):
                return {"status": "duplicate", "ingestion_id": ingestion_id}
            moved = []
            for k, f in enumerate(files):
                to = f"{self.root}/{target}/part-{k:05d}.ndjson"
                self._fs.mkdirs(self._path(f"{self.root}/{target}"))
                if not self._fs.rename(self._path(f["path"]), self._path(to)):
                    raise OSError(f"could not move {f['path']}")
                moved.append((to, f["sha256"], f["byte_count"], f["record_count"]))
            self._manifest(target, scope_kind, scope, report_type, report_day, ingestion_id, ingested_at, status, fingerprint, moved)
            return {"status": status, "ingestion_id": ingestion_id, "files": len(moved)}
        except BaseException:
            self._fs.delete(self._path(f"{self.root}/{target}"), True)
            raise
        finally:
            self._fs.delete(self._path(staging), True)

    def _known(self, scope: str, report_type: str, report_day: str, status: str, fingerprint: str) -> bool:
        if not self._fs.exists(self._path(f"{self.root}/_manifests")):
            return False
        same = read_manifests(self.spark, self.root, scope, report_day, report_day)
        return same.where((F.col("report_type") == report_type) & (F.col("status") == status) & (F.col("content_fingerprint") == fingerprint)).limit(1).count() > 0

    def _manifest(self, target, scope_kind, scope, report_type, report_day, ingestion_id, ingested_at, status, fingerprint, files) -> None:
        row = (1, (scope_kind, scope), report_type, report_day, ingestion_id, ingested_at, status, fingerprint, files)
        text = self.spark.createDataFrame([row], MANIFEST_SCHEMA).toJSON().first()
        path = f"{self.root}/_manifests/{target.rpartition('/')[0]}/{ingestion_id}.json"
        stream = self._fs.create(self._path(path), False)
        stream.write(bytearray(text.encode()))
        stream.close()


def reusable(manifests: DataFrame, cutoff: str) -> DataFrame:
    """The newest complete manifest of each scope, type and day before ``cutoff``: days that need no new download."""
    newest = F.max(F.struct("ingested_at", "ingestion_id"))
    done = manifests.where((F.col("report_day") < cutoff) & F.col("status").isin("success", "no_data"))
    return done.groupBy("scope_slug", "report_type", "report_day").agg(newest.alias("m")).select(
        "scope_slug", "report_type", "report_day", F.col("m.ingestion_id").alias("ingestion_id")
    )


def table_rows(spark: SparkSession, name: str, scope: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame | None:
    """A catalogue table filtered by scope and day, or None if it does not exist."""
    if not spark.catalog.tableExists(name):
        return None
    df = spark.table(name)
    if scope is not None:
        df = df.where(F.col("scope_slug") == scope)
    if start is not None:
        df = df.where(F.col("day") >= start)
    return df if end is None else df.where(F.col("day") <= end)
