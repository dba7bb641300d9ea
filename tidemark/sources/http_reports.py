"""Daily reports over HTTP as a Spark data source: one partition per scope, report type and day.

    spark.dataSource.register(HttpReports)
    spark.read.format("http_reports").options(url="https://host/{kind}/{slug}/{report}?day={day}", requests=..., token=...).load()

``requests`` is a JSON array of ``[scope_kind, scope_slug, report_type, day]``. A
request answers with a JSON object of ``report_day`` and ``download_links``, or
with 204 for a day without data; the links lead to lines of JSON objects, which
are read as a stream, where the tasks run. 429 and 5xx are tried again after
``Retry-After`` (seconds or a date) or twice the time before, within a limit.

Defined cases: a day without data gives one row with status no_data and no line;
blank lines are skipped; a line that is no JSON object, another day than asked
for, links that are none or not signed HTTPS addresses, and other statuses are
errors that fail the task. ``insecure`` = true also takes plain HTTP, for tests.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from datetime import date, datetime, timezone
from email.utils import parsedate_to_datetime
from urllib.parse import quote, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.operators.jsonlines import json_object

SCHEMA = "scope_kind string, scope_slug string, report_type string, report_day string, status string, link_no int, line_no bigint, raw_json string"
# fixed values: attempts, first wait and longest wait in seconds
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 4, 1.0, 30.0


class ReportError(RuntimeError):
    """A report could not be had or is not what it should be."""


def wait_after(retry_after: str | None, attempt: int, now: datetime | None = None) -> float:
    """Seconds to wait after a failed ``attempt`` (from 1), by the server's wish or doubling, never beyond the limit."""
    if retry_after is None:
        return min(FIRST_WAIT * 2 ** (attempt - 1), LONGEST_WAIT)
    try:
        wait = float(retry_after)
    except ValueError:
        try:
            at = parsedate_to_datetime(retry_after)
        except ValueError:
            return 0.0
        at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        wait = (at - (now or datetime.now(timezone.utc))).total_seconds()
    return min(max(0.0, wait), LONGEST_WAIT)


def fetch(url: str, token: str | None = None, sleep=time.sleep):
    """The open response of ``url`` with status 200 or 204; others are tried again or raised."""
    headers = {"Authorization": f"Bearer {token}"} if token else {}
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60)  # noqa: S310
        except urllib.error.HTTPError as e:
            again = e.code == 429 or 500 <= e.code <= 599
            if not again or attempt == ATTEMPTS:
                raise ReportError(f"status {e.code}") from e
            wait = wait_after(e.headers.get("Retry-After"), attempt)
            e.close()
            sleep(wait)
    raise AssertionError("unreachable")


def checked_links(payload: object, day: str, insecure: bool = False) -> list[str]:
    """The download links of a report's metadata."""
    if not isinstance(payload, dict) or payload.get("report_day") != day:
        raise ReportError("metadata is no object of the day asked for")
    links = payload.get("download_links")
    if not isinstance(links, list) or not links:
        raise ReportError("metadata has no download links")
    for link in links:
        parts = urlsplit(link) if isinstance(link, str) else None
        schemes = ("https", "http") if insecure else ("https",)
        if parts is None or parts.scheme not in schemes or not parts.hostname or parts.username or parts.password or not parts.query or parts.fragment:
            raise ReportError("a download link is no signed HTTPS address")
    return links


class _Request(InputPartition):
    def __init__(self, kind: str, slug: str, report: str, day: str):
        self.kind, self.slug, self.report, self.day = kind, slug, report, date.fromisoformat(day).isoformat()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.token = options["url"], options.get("token")
        self.insecure = options.get("insecure", "false").lower() == "true"
        self.requests = [_Request(*r) for r in json.loads(options["requests"])]

    def partitions(self) -> list[InputPartition]:
        return self.requests

    def read(self, partition: _Request) -> Iterator[tuple]:
        p = partition
        named = (p.kind, p.slug, p.report, p.day)
        address = self.url.format(kind=quote(p.kind, safe=""), slug=quote(p.slug, safe=""), report=quote(p.report, safe=""), day=p.day)
        with fetch(address, self.token) as response:
            if response.status == 204:
                yield (*named, "no_data", None, None, None)
                return
            try:
                payload = json.load(response)
            except ValueError as e:
                raise ReportError("metadata is no JSON") from e
        for k, link in enumerate(checked_links(payload, p.day, self.insecure)):
            # links are signed: the token is not for them
            with fetch(link) as lines:
                for n, raw in enumerate(lines):
                    text = raw.decode("utf-8").rstrip("\r\n")
                    if not text.strip():
                        continue
                    if json_object(text) is None:
                        raise ReportError(f"line {n + 1} of link {k + 1} is no JSON object")
                    yield (*named, "success", k, n + 1, text)


class HttpReports(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_reports"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
