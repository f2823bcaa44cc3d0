import json

import pytest

from docflow.config import Search, default_config
from docflow.sources import client as c


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def make(answers, **kw):
    clock, sent = Clock(), []

    def transport(endpoint, fields):
        sent.append((endpoint, fields))
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    return c.Client("t", "e", transport, clock=clock, sleep=clock.sleep, **kw), clock, sent


def test_retries_then_answers():
    client, clock, sent = make([c.Answer(503, b"", {}), c.Unreachable("x"), c.Answer(429, b"", {"retry-after": "7"}), c.Answer(200, b"ok", {})])
    assert client.post("efetch.fcgi", {"a": 1}) == b"ok"
    assert [s for s in clock.slept if s >= 1] == [1, 2, 7] and sent[0][1] == {"tool": "t", "email": "e", "a": "1"}


def test_gives_up():
    client, _, sent = make([c.Answer(500, b"", {})] * 3, max_retries=2)
    with pytest.raises(c.ServiceError, match="500"):
        client.post("efetch.fcgi", {})
    assert len(sent) == 3
    client, _, sent = make([c.Answer(404, b"", {})])
    with pytest.raises(c.ServiceError, match="404"):
        client.post("efetch.fcgi", {})
    with pytest.raises(ValueError, match="endpoint"):
        client.post("elink.fcgi", {})
    with pytest.raises(ValueError, match="e-mail"):
        c.Client("t", "", lambda *_: None)


def test_backoff_has_a_limit():
    client, clock, _ = make([c.Answer(500, b"", {"Retry-After": "900"})] * 9 + [c.Answer(200, b"", {})], max_retries=10)
    client.post("esearch.fcgi", {})
    assert max(clock.slept) == 60


def test_rate():
    clock = Clock()
    limiter = c.RateLimiter(10, clock, clock.sleep)
    starts = []
    for _ in range(30):
        limiter.wait()
        starts.append(clock.now)
    assert all(b - a >= 0.1 - 1e-9 for a, b in zip(starts, starts[1:], strict=False))
    with pytest.raises(ValueError):
        c.RateLimiter(0)


def test_retry_after():
    assert [c.retry_after({"Retry-After": v}) for v in ("3", "-1", "Wed, 21 Oct 2026 07:28:00 GMT")] == [3.0, 0.0, None] and c.retry_after({}) is None


FOUND = {"esearchresult": {"count": "5", "idlist": ["1", "2"], "webenv": "w", "querykey": "1"}}


def test_search():
    client, _, sent = make([c.Answer(200, json.dumps(FOUND).encode(), {})])
    assert c.search(client, Search(query="q", extra_filter="f", mindate="2020", maxdate="2021")) == c.Cursor(("1", "2"), 5, "w", "1")
    assert sent[0][1]["term"] == "(q) AND (f)" and sent[0][1]["datetype"] == "pdat"
    for bad in (b"<html>", b'{"esearchresult": {"ERROR": "x"}}', b'{"error": "x"}', b'{"esearchresult": {"idlist": []}}'):
        client, _, _ = make([c.Answer(200, bad, {})])
        with pytest.raises(c.ServiceError):
            c.search(client, Search(query="q"))
    with pytest.raises(ValueError, match="together"):
        Search(query="q", mindate="2020")


def test_pages():
    assert list(c.pages(250, 100)) == [(0, 100), (100, 100), (200, 50)] and list(c.pages(0, 100)) == []


def test_config_is_strict():
    good = default_config().model_dump()
    for part, key, value in (("ncbi", "batch_size", 501), ("search", "max_results", 0), ("mapping", "evidence_tier", {"other": 5}), ("quality", "surprise", 1), ("search", "mindate", "May 2020")):
        with pytest.raises(ValueError):
            type(default_config()).model_validate(good | {part: good[part] | {key: value}})


def test_a_run_needs_a_query_and_an_address(tmp_path):
    from docflow.config import load_config

    good = default_config().model_dump(mode="json")
    for query, email, fine in (("q", "a@b.org", True), (" ", "a@b.org", False), ("q", "nobody", False)):
        good["search"]["query"], good["ncbi"]["email"] = query, email
        path = tmp_path / "c.yaml"
        path.write_text(json.dumps(good))
        if fine:
            assert load_config(path).search.query == "q"
        else:
            with pytest.raises(ValueError):
                load_config(path)
