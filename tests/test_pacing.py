"""One rate for all tasks, against a server on this machine that writes down when it was asked."""

import json
import threading
import time
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from docflow.config import default_config
from docflow.sources import client as c
from docflow.sources import service

RATE = 10.0


@pytest.fixture
def server():
    asked, lock = [], threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            fields = dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode()))
            with lock:
                asked.append((time.time(), self.path, fields))
                again = sum(f.get("retstart") == fields.get("retstart") for _, p, f in asked if p == self.path)
            ids = [str(i) for i in range(20)]
            found = {"esearchresult": {"count": "20", "idlist": ids, "webenv": "w", "querykey": "1"}}
            status = 503 if fields.get("retstart") in ("3", "8") and again == 1 else 200
            body = json.dumps(found).encode() if self.path.endswith("esearch.fcgi") else f"<x>{fields.get('retstart', fields.get('id'))}</x>".encode()
            time.sleep(0.15 if fields.get("retstart") == "5" else 0.0)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            return

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_address[1]}/", asked
    made.shutdown()


def apart(times, gap):
    times = sorted(times)
    assert all(b - a > 0.5 * gap for a, b in zip(times, times[1:], strict=False)), [round(b - a, 3) for a, b in zip(times, times[1:], strict=False)]
    assert times[-1] - times[0] > (len(times) - 1) * gap * 0.98


def test_four_tasks_keep_one_rate(spark, server):
    url, asked = server
    config = default_config()
    pages = service.search_pages(spark, config, query="q", url=url, email="a@b.org", batch_size="1", rate=str(RATE), tasks="4")
    assert pages.rdd.getNumPartitions() == 4
    asked.clear()
    rows = sorted((r["page"], bytes(r["xml"])) for r in pages.collect())
    assert rows == [(i, f"<x>{i}</x>".encode()) for i in range(20)]
    assert len([f for _, _, f in asked if f.get("retstart")]) == 22  # two were tried again
    apart([t for t, _, _ in asked], 1 / RATE)


def test_articles_keep_one_rate(spark, server):
    url, asked = server
    survivors = spark.createDataFrame([(f"PMC{i}",) for i in range(20)], "pmcid string")
    rows = service.article_pages(survivors, 1, url=url, email="a@b.org", rate=str(RATE), tasks="4").collect()
    assert sorted(int(bytes(r["xml"])[3:-4]) for r in rows) == list(range(20))
    assert len(asked) == 20
    apart([t for t, _, _ in asked], 1 / RATE)


def test_a_second_attempt_keeps_to_its_slots(server):
    url, asked = server
    options = {"query": "q", "url": url, "email": "a@b.org", "batch_size": "1", "rate": str(RATE), "tasks": "2"}
    reader = service.Reader(options)
    one, two = reader.partitions()
    asked.clear()

    def failing():
        for k, _ in enumerate(reader.read(one)):
            if k == 2:
                break  # the task is lost here
        list(reader.read(one))

    threads = [threading.Thread(target=failing), threading.Thread(target=lambda: list(reader.read(two)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    apart([t for t, _, _ in asked], 1 / RATE)


def test_slots_differ():
    starts = []
    for own in range(3):
        now = [1000.05 + own * 0.01]

        def sleep(s, now=now):
            now[0] += s

        limiter = c.SlotLimiter(4, own, 3, clock=lambda now=now: now[0], sleep=sleep)
        for k in range(20):
            limiter.wait()
            starts.append(now[0])
            now[0] += 0.9 * (k % 4)
    starts.sort()
    assert all(b - a > 0.25 - 1e-6 for a, b in zip(starts, starts[1:], strict=False))
    for bad in ((0, 0, 1), (1, 1, 1), (1, -1, 2)):
        with pytest.raises(ValueError):
            c.SlotLimiter(*bad)
