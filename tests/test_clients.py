"""Clients that outlive a task, and appends that can be repeated."""

import os
import uuid
from contextlib import contextmanager

import pytest

from docledger.operators import clients
from docledger.operators.clients import kept_client, key_of
from docledger.operators.dispatch import AttemptPolicy, Reply, dispatch
from docledger.operators.worklist import worklist
from docledger.schemas import AUDIT, MANIFEST
from docledger.sources.http import HttpPost
from docledger.sources.tables import append_once, read_appended
from tests.helpers import failure, manifest, rows, success


class Opened:
    """Counts what is opened and closed."""

    def __init__(self):
        self.events = []

    @contextmanager
    def open_client(self):
        number = sum(e.startswith("open") for e in self.events)
        self.events.append(f"open {number}")
        try:
            yield number
        finally:
            self.events.append(f"close {number}")


@pytest.fixture(autouse=True)
def nothing_kept():
    clients._kept.clear()
    yield
    clients._kept.clear()


def test_a_client_is_kept_until_idle():
    opened, now = Opened(), [0.0]

    def task(idle=10.0, key="k"):
        with kept_client(opened.open_client, 2, key, idle, lambda: now[0]) as (client, pool):
            assert pool.submit(lambda: client).result() == client
            return client, pool
    first = task()
    assert task() == first  # client and threads
    now[0] = 9.0
    assert task() == first
    now[0] = 19.0
    assert task() == first
    now[0] = 29.1
    assert task()[0] == 1 and opened.events == ["open 0", "close 0", "open 1"]
    assert task(key="other")[0] == 2
    now[0] = 100.0
    assert task(idle=0)[0] == 3  # one task only; the others have been idle for too long
    assert sorted(opened.events) == sorted(["open 0", "close 0", "open 1", "open 2", "close 1", "close 2", "open 3", "close 3"])
    assert clients._kept == {}


def test_a_failed_task_closes_its_client():
    opened = Opened()
    with pytest.raises(RuntimeError):
        with kept_client(opened.open_client, 1, "k", 10.0):
            raise RuntimeError
    assert opened.events == ["open 0", "close 0"] and clients._kept == {}


def test_without_a_client():
    with kept_client(None, 1) as (client, pool):
        assert client is None and pool is None


def test_keys():
    post, same, other = HttpPost("http://a"), HttpPost("http://a"), HttpPost("http://b")
    assert key_of(post.open_client, 1) == key_of(same.open_client, 1)
    assert len({key_of(post.open_client, 1), key_of(other.open_client, 1), key_of(post.open_client, 2)}) == 3
    assert key_of(Opened().open_client, 1) != key_of(Opened().open_client, 1)


@pytest.mark.parametrize("keep,most", [(60.0, 8), (0.0, 24)])
def test_fewer_connections_than_tasks(spark, tmp_path, keep, most):
    folder = str(tmp_path / "connections")
    os.makedirs(folder)

    @contextmanager
    def open_client():
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield folder

    due = worklist(manifest(spark, *[("a", f"d{i}") for i in range(240)]), success(spark), failure(spark))
    out = dispatch(due, lambda client, row: Reply(200, '{"azure_blob_path":"t"}'), stage_path=str(tmp_path / "s"),
                   correlation_id="r", policy=AttemptPolicy(attempts=1), open_client=open_client, partitions=24, keep_clients=keep)
    assert out.filter("ok").count() == 240
    assert 1 <= len(os.listdir(folder)) <= most
    assert keep or len(os.listdir(folder)) == 24


def test_appending_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = manifest(spark, ("a", "x"), ("a", "y")), manifest(spark, ("a", "z"))
    for _ in range(2):
        append_once(one, path, "run 1/é")
        append_once(two, path, "run 1/é", batch=1)
        append_once(two, path, "run-2")
    assert rows(read_appended(spark, path, MANIFEST), "document_id") == [("x",), ("y",), ("z",), ("z",)]
    append_once(one.limit(1), path, "run 1/é")  # the batch as it is now
    assert read_appended(spark, path, MANIFEST).count() == 3
    assert read_appended(spark, path, MANIFEST).columns == MANIFEST.fieldNames()
    none = spark.createDataFrame([], AUDIT)
    append_once(none, str(tmp_path / "none"), "r")
