"""The HTTP transport against a stand-in connection; no port is opened."""

import http.client
import json

import pytest

from docledger.operators.dispatch import AttemptPolicy, ServiceError, _call
from docledger.sources.http import HttpPost

ROW = {"full_path": "\\\\s\\h\\f", "ar_number": "AR1", "document_id": "d"}


class Connection:
    """Plays back answers and records requests."""

    made: list = []

    def __init__(self, host, timeout):
        self.host, self.timeout, self.closed, self.requests = host, timeout, 0, []
        self.answers = []
        Connection.made.append(self)

    def request(self, method, target, body, headers):
        self.requests.append((method, target, json.loads(body), headers))

    def getresponse(self):
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    def close(self):
        self.closed += 1


class Answer:
    def __init__(self, status, text, **headers):
        self.status, self._text, self._headers = status, text, headers

    def read(self):
        return self._text.encode()

    def getheader(self, name):
        return self._headers.get(name.replace("-", "_"))


@pytest.fixture
def post(monkeypatch):
    Connection.made = []
    monkeypatch.setattr(http.client, "HTTPSConnection", Connection)
    return HttpPost("https://copy.example/api/copy?v=1", headers={"x-key": "k"})


def test_posts_the_row(post):
    with post.open_client() as client:
        client.get().answers = [Answer(200, '{"ok":1}'), Answer(404, "gone")]
        assert post(client, ROW).body == '{"ok":1}'
        assert post(client, ROW).code == 404
    [connection] = Connection.made
    assert (connection.host, connection.timeout, connection.closed) == ("copy.example", 300.0, 1)
    assert connection.requests[0] == (
        "POST", "/api/copy?v=1", {"file_path": "\\\\s\\h\\f", "ar_number": "AR1"},
        {"Content-Type": "application/json", "x-key": "k"})


def test_errors(post):
    with post.open_client() as client:
        client.get().answers = [Answer(429, "slow", Retry_After="7"), http.client.BadStatusLine("x"),
                                TimeoutError("late")]
        with pytest.raises(ServiceError) as caught:
            post(client, ROW)
        assert (caught.value.code, caught.value.retry_after) == (429, 7.0)
        with pytest.raises(ConnectionError):
            post(client, ROW)
        with pytest.raises(TimeoutError):
            post(client, ROW)


def test_retries_wait_as_the_server_asks(post):
    waits = []
    with post.open_client() as client:
        client.get().answers = [Answer(503, "busy", Retry_After="30"), http.client.BadStatusLine("x"),
                                Answer(200, "{}")]
        done = _call(post, client, ROW, AttemptPolicy(sleep=waits.append))
    assert (done["code"], done["attempts"], done["kind"]) == (200, 3, None)
    assert waits[0] == 30 and waits[1] <= 1.0
