from __future__ import annotations

import json
import threading
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tidemark.sources import http_reports as h


@pytest.fixture
def server():
    tries: dict[str, int] = {}

    class Stub(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            tries[self.path] = tries.get(self.path, 0) + 1
            status, body, headers = 404, b"", {}
            if self.path.startswith("/organization/busy") and tries[self.path] < 3:
                status, headers = 503, {"Retry-After": "0"}
            elif self.path.startswith("/organization/none"):
                status = 204
            elif self.path.startswith("/organization/gone"):
                status, headers = 500, {"Retry-After": "0"}
            elif self.path.startswith("/organization"):
                day = self.path.split("=")[1]
                links = [f"http://{self.headers['Host']}/file/{k}?sig=1" for k in (1, 2)]
                status, body = 200, json.dumps({"report_day": day, "download_links": links}).encode()
                assert self.headers["Authorization"] == "Bearer t"
            elif self.path.startswith("/file"):
                assert self.headers["Authorization"] is None
                status, body = 200, b'{"a": 1}\r\n\n{"a": "\xc3\xa9"}' if "/1" in self.path else b'{"b": 2}\n'
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            if status != 204:
                self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def read(spark, server, *requests):
    spark.dataSource.register(h.HttpReports)
    options = {"url": server + "/{kind}/{slug}/{report}?day={day}", "requests": json.dumps(requests), "token": "t", "insecure": "true"}
    return spark.read.format("http_reports").options(**options).load()


def test_lines_of_all_links_come_with_their_request(spark, server):
    got = read(spark, server, ["organization", "a b", "users", "2031-03-01"], ["organization", "none", "users", "2031-03-02"], ["organization", "busy", "entity", "2031-03-03"])
    rows = sorted((r.scope_slug, r.report_day, r.status, r.link_no, r.line_no, r.raw_json) for r in got.collect())
    lines = [(0, 1, '{"a": 1}'), (0, 3, '{"a": "é"}'), (1, 1, '{"b": 2}')]
    assert rows == [
        *[("a b", "2031-03-01", "success", *x) for x in lines], *[("busy", "2031-03-03", "success", *x) for x in lines], ("none", "2031-03-02", "no_data", None, None, None),
    ]


def test_lasting_errors_fail_the_read(spark, server):
    with pytest.raises(Exception, match="status 500"):
        read(spark, server, ["organization", "gone", "users", "2031-03-01"]).collect()
    with pytest.raises(Exception, match="status 404"):
        read(spark, server, ["enterprise", "x", "users", "2031-03-01"]).collect()


def test_waits_follow_the_server_or_double():
    now = datetime(2031, 3, 1, tzinfo=timezone.utc)
    assert [h.wait_after(None, k) for k in (1, 2, 3, 9)] == [1.0, 2.0, 4.0, 30.0]
    assert h.wait_after("7", 1) == 7.0 and h.wait_after("900", 1) == 30.0 and h.wait_after("-1", 1) == 0.0 and h.wait_after("soon", 1) == 0.0
    assert h.wait_after("Sat, 01 Mar 2031 00:00:12 GMT", 1, now) == 12.0


@pytest.mark.parametrize("links", [None, [], ["http://x.test/a?s=1"], ["https://x.test/a"], ["https://u:p@x.test/a?s=1"], ["https://x.test/a?s=1#f"], [3]])
def test_links_must_be_signed_addresses(links):
    with pytest.raises(h.ReportError):
        h.checked_links({"report_day": "2031-03-01", "download_links": links}, "2031-03-01")
    with pytest.raises(h.ReportError):
        h.checked_links({"report_day": "2031-03-02", "download_links": ["https://x.test/a?s=1"]}, "2031-03-01")
    assert h.checked_links({"report_day": "2031-03-01", "download_links": ["https://x.test/a?s=1"]}, "2031-03-01") == ["https://x.test/a?s=1"]
