"""Transport that posts each row to an HTTP copy service."""

from __future__ import annotations

import http.client
import json
import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from docledger.operators.dispatch import Reply, ServiceError


class _Connections:
    """One kept-alive connection per thread of a task."""

    def __init__(self, url: str, timeout: float):
        self._parts, self._timeout = urlsplit(url), timeout
        self._local, self._all, self._lock = threading.local(), [], threading.Lock()

    def get(self) -> http.client.HTTPConnection:
        connection = getattr(self._local, "connection", None)
        if connection is None:
            kind = (http.client.HTTPSConnection if self._parts.scheme == "https"
                    else http.client.HTTPConnection)
            connection = self._local.connection = kind(self._parts.netloc, timeout=self._timeout)
            with self._lock:
                self._all.append(connection)
        return connection

    def close(self) -> None:
        for connection in self._all:
            connection.close()


@dataclass(frozen=True)
class HttpPost:
    """Posts a JSON object made of the row's columns and returns the service's answer.

    ``fields`` maps the service's field names to row columns. Use with
    ``dispatch(due, post, open_client=post.open_client, concurrency=...)``.
    """

    url: str
    fields: Mapping[str, str] = field(
        default_factory=lambda: {"file_path": "full_path", "ar_number": "ar_number"})
    headers: Mapping[str, str] = field(default_factory=dict)
    timeout: float = 300.0

    @contextmanager
    def open_client(self) -> Iterator[_Connections]:
        connections = _Connections(self.url, self.timeout)
        try:
            yield connections
        finally:
            connections.close()

    def __call__(self, client: _Connections, row: dict) -> Reply:
        connection = client.get()
        parts = urlsplit(self.url)
        target = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        body = json.dumps({name: row[column] for name, column in self.fields.items()})
        try:
            connection.request("POST", target, body,
                               {"Content-Type": "application/json", **self.headers})
            answer = connection.getresponse()
            text = answer.read().decode("utf-8", "replace")
        except http.client.HTTPException as error:
            connection.close()
            raise ConnectionError(str(error) or type(error).__name__) from error
        except OSError:
            connection.close()
            raise
        wait = answer.getheader("Retry-After")
        if not 200 <= answer.status < 300 and wait and wait.strip().isdigit():
            raise ServiceError(answer.status, text, float(wait))
        return Reply(answer.status, text)
