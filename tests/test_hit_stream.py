"""New hits by day, from a server on this machine that answers by dates."""

import json
import threading
import urllib.parse
from datetime import date, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from docflow.config import default_config
from docflow.sources import client as c
from docflow.sources import service

START = date(2026, 3, 1)


@pytest.fixture
def server():
    hits, asked = {}, []  # hits: id -> day

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            fields = dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode()))
            asked.append((self.path, fields))
            if self.path.endswith("esearch.fcgi"):
                day = lambda s: date(*map(int, s.split("/")))
                found = sorted(i for i, d in hits.items() if day(fields["mindate"]) <= d <= day(fields["maxdate"]))
                most = int(fields["retmax"])
                body = json.dumps({"esearchresult": {"count": str(len(found)), "idlist": [str(i) for i in found[:most]], "webenv": ",".join(map(str, found)), "querykey": "1"}}).encode()
            else:
                found, start = fields["WebEnv"].split(","), int(fields["retstart"])
                body = " ".join(found[start : start + int(fields["retmax"])]).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            return

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_address[1]}/", hits, asked
    made.shutdown()


def go(spark, url, top, until, most=20):
    pages = service.stream_pages(spark, default_config(), START.isoformat(), until=until.isoformat(), query="q", url=url, email="a@b.org", rate="200", batch_size="3", max_results=str(most), tasks="2")
    query = pages.writeStream.format("parquet").option("path", str(top / "out")).option("checkpointLocation", str(top / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema("page long, xml binary").parquet(str(top / "out")).collect()
    ids = [int(i) for r in rows for i in bytes(r["xml"]).split()]
    assert len(ids) == len(set(ids)) and len({r["page"] for r in rows}) == len(rows)
    return sorted(ids)


def test_every_hit_once_over_growing_answers_and_restarts(spark, server, tmp_path):
    url, hits, asked = server
    hits.update({i: START + timedelta(i % 5) for i in range(30)})
    assert go(spark, url, tmp_path, START + timedelta(2)) == [i for i in range(30) if i % 5 <= 2]
    hits.update({i: START + timedelta(5 + i % 3) for i in range(100, 110)})
    asked.clear()
    assert go(spark, url, tmp_path, START + timedelta(9)) == sorted(hits)
    assert min(f["mindate"] for p, f in asked if "mindate" in f) == "2026/03/04"  # nothing from before
    assert go(spark, url, tmp_path, START + timedelta(9)) == sorted(hits)


def test_a_batch_that_is_run_again_has_the_same_pages(spark, server):
    url, hits, _ = server
    hits.update({i: START + timedelta(i % 4) for i in range(50)})
    options = {"query": "q", "url": url, "email": "a@b.org", "rate": "1000", "batch_size": "7", "max_results": "20", "tasks": "3", "since": START.isoformat(), "until": (START + timedelta(3)).isoformat()}
    stream = service.HitStream(options)
    read = lambda: [row for part in stream.partitions(stream.initialOffset(), stream.latestOffset()) for row in stream.read(part)]
    one = read()
    hits.update({i: START + timedelta(9) for i in range(900, 910)})
    assert read() == one and sorted(int(i) for _, xml in one for i in xml.split()) == list(range(50))
    with pytest.raises(c.ServiceError, match="at most"):
        service.HitStream(options | {"max_results": "5"}).partitions(stream.initialOffset(), stream.latestOffset())
