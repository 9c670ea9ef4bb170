"""Transports in tasks: one call per row, retries, pacing, rejects, staging."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from docledger.operators.dispatch import (
    _call,
    AttemptPolicy, Reply, ServiceError, _parcels, _Throttle, call_rows, dispatch, most_running, read_calls,
    split_outcomes,
)
from docledger.operators.worklist import worklist
from tests.helpers import failure, manifest, rows, success

NO_WAIT = AttemptPolicy(sleep=lambda seconds: None)


def due(spark, *docs):
    return worklist(manifest(spark, *[("a", d) for d in docs]), success(spark), failure(spark))


def run(spark, tmp_path, send, docs, **options):
    options.setdefault("policy", AttemptPolicy(sleep=lambda seconds: None))
    return dispatch(due(spark, *docs), send, stage_path=str(tmp_path / uuid.uuid4().hex),
                    correlation_id="run-1", **options)


def counting(folder):
    """A transport that leaves a file per call."""
    os.makedirs(folder, exist_ok=True)

    def send(client, row):
        import uuid as u
        open(f"{folder}/{row['document_id']}-{u.uuid4().hex}", "w").close()
        return Reply(200, '{"azure_blob_path":"t"}')
    return send


@pytest.mark.parametrize("concurrency", [1, 4])
def test_one_call_per_row(spark, tmp_path, concurrency):
    folder = str(tmp_path / "calls")
    docs = [f"d{i}" for i in range(200)]
    out = run(spark, tmp_path, counting(folder), docs, concurrency=concurrency, partitions=3)
    split_outcomes(out)[0].count(), out.count(), out.collect()
    names = sorted(os.path.basename(p).split("-")[0] for p in glob.glob(f"{folder}/*"))
    assert names == sorted(docs)
    assert rows(out, "document_id") == sorted((d,) for d in docs)


def test_a_finished_stage_is_not_called_again(spark, tmp_path):
    folder = str(tmp_path / "calls")
    send, stage = counting(folder), str(tmp_path / "stage")
    for _ in range(2):
        dispatch(due(spark, "x", "y"), send, stage_path=stage, correlation_id="r", policy=NO_WAIT)
    assert len(os.listdir(folder)) == 2


def test_outcomes_of_every_kind(spark, tmp_path):
    def send(client, row):
        kind = row["document_id"]
        if kind == "ok":
            return Reply(200, '{"azure_blob_path":"t/ok","total_bytes":12,"sha256":"ab"}')
        if kind == "empty":
            return Reply(204, "")
        if kind == "404":
            raise ServiceError(404, '{"error":"gone"}')
        if kind == "text":
            return Reply(403, "no entry")
        if kind == "bare":
            return Reply(500, "")
        raise {"conn": ConnectionResetError("reset"), "slow": TimeoutError("late"),
               "odd": RuntimeError("odd")}[kind]

    out = run(spark, tmp_path, send,
              ["ok", "empty", "404", "text", "bare", "conn", "slow", "odd"])
    assert rows(out, "document_id", "ok", "error_code", "error_message", "target_path", "attempts") == [
        ("404", False, 404, "gone", None, 1), ("bare", False, 500, "HTTP error", None, 3),
        ("conn", False, 503, "reset", None, 3), ("empty", True, None, None, "", 1),
        ("odd", False, 500, "odd", None, 1), ("ok", True, None, None, "t/ok", 1),
        ("slow", False, 503, "late", None, 3), ("text", False, 403, "no entry", None, 1)]
    assert rows(out.filter("ok AND bytes IS NOT NULL"), "bytes", "sha256") == [(12, "ab")]


def test_success_after_a_transient_error(spark, tmp_path):
    folder = str(tmp_path / "tries")
    os.makedirs(folder)

    def send(client, row):
        tries = len(os.listdir(folder))
        open(f"{folder}/{tries}", "w").close()
        return Reply(200 if tries == 2 else 429, "{}")
    out = run(spark, tmp_path, send, ["x"])
    assert rows(out, "ok", "attempts", "error_code", "error_message") == [(True, 3, None, None)]


def test_waits_follow_the_policy():
    waits = []
    policy = AttemptPolicy(first=0.5, longest=8.0, sleep=waits.append)
    for n in range(8):
        for _ in range(50):
            policy.wait(n)
        assert max(waits[-50:]) <= min(8.0, 0.5 * 2 ** n)
    policy.wait(0, retry_after=30)
    assert waits[-1] == 30


def test_modes(spark, tmp_path):
    def send(client, row):
        return Reply(200, '{"status":"%s","error":"why"}' % row["document_id"])
    docs = ["Success", "failed", "other"]
    shown = {m: rows(run(spark, tmp_path, send, docs, mode=m), "document_id", "ok", "error_code")
             for m in ("code", "strict", "not_failed")}
    assert [r[1] for r in shown["code"]] == [True, True, True]
    assert shown["strict"] == [("Success", True, None), ("failed", False, 200), ("other", False, 200)]
    assert shown["not_failed"] == [("Success", True, None), ("failed", False, 500),
                                   ("other", True, None)]


def test_client_is_opened_once_per_task(spark, tmp_path):
    folder = str(tmp_path / "clients")
    os.makedirs(folder)

    def open_client():
        import contextlib
        import uuid as u

        @contextlib.contextmanager
        def client():
            name = u.uuid4().hex
            open(f"{folder}/{name}", "w").close()
            yield name
            os.rename(f"{folder}/{name}", f"{folder}/{name}.closed")
        return client()

    def send(client, row):
        return Reply(200, '{"azure_blob_path":"%s"}' % client)
    out = run(spark, tmp_path, send, [f"d{i}" for i in range(40)], open_client=open_client,
              partitions=2)
    left = os.listdir(folder)
    assert len(left) == 2 and all(n.endswith(".closed") for n in left)
    assert {r[0] + ".closed" for r in rows(out, "target_path")} <= set(left)


def test_rejected_rows_are_not_sent(spark, tmp_path):
    folder = str(tmp_path / "calls")
    work = due(spark, "x", "y").withColumns({
        "reject_code": F.when(F.col("document_id") == "x", 400),
        "reject_text": F.when(F.col("document_id") == "x", "Invalid path")})
    out = dispatch(work, counting(folder), stage_path=str(tmp_path / "s"), correlation_id="r")
    assert rows(out, "document_id", "ok", "error_code", "error_message", "attempts") == [
        ("x", False, 400, "Invalid path", 0), ("y", True, None, None, 1)]
    assert [n[0] for n in os.listdir(folder)] == ["y"]


def test_rows_are_dealt_out_evenly_whatever_their_key(spark):
    same = due(spark, *["hot"] * 400)
    assert same.count() == 400
    calls = call_rows(same, lambda client, row: Reply(200, "{}"), partitions=4)
    sizes = [r["count"] for r in calls.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) <= 150


def test_elapsed_time(spark):
    def send(client, row):
        import time
        time.sleep(0.05)
        return Reply(200, "{}", 9 if row["document_id"] == "told" else None)
    out = read_calls(call_rows(due(spark, "told", "timed"), send), "r")
    got = dict(rows(out, "document_id", "execution_time_ms"))
    assert got["told"] == 9 and got["timed"] >= 50


def test_throttle_spaces_calls():
    waits = []
    throttle = _Throttle(10, waits.append)
    for _ in range(5):
        throttle.take()
    assert len(waits) >= 4 and abs(waits[-1] - 0.4) < 0.05  # nothing really slept
    _Throttle(None, waits.append).take()


def test_storage_errors(spark, tmp_path):
    def send(client, row):
        raise {"gone": FileNotFoundError("x"), "locked": PermissionError("x"), "bad": ValueError("x"),
               "text": OSError("STATUS_ACCESS_DENIED"), "full": OSError("disk full")}[row["document_id"]]
    out = run(spark, tmp_path, send, ["gone", "locked", "bad", "text", "full"], errors="storage")
    assert rows(out, "document_id", "error_code") == [
        ("bad", 400), ("full", 500), ("gone", 404), ("locked", 403), ("text", 403)]


def test_large_replies_are_handed_on_in_parcels():
    results = [{"body": "x" * n} for n in (3, 3, 10, 1, 0)] + [{"body": None}]
    assert [len(p) for p in _parcels(iter(results), 6)] == [2, 1, 3]
    assert list(_parcels(iter([]), 6)) == []


# --- limits ---------------------------------------------------------------------------------

def test_rate_is_shared_by_tasks_that_run(spark):
    """More tasks than slots: the limit is neither exceeded nor divided by waiting tasks."""
    import time as clock

    rows = spark.createDataFrame([(str(i), "d", "AR", "p", 0, 0) for i in range(40)],
                                 "auth_request_id string, document_id string, ar_number string, "
                                 "full_path string, retry_count int, reprocess_success int")
    calls = call_rows(rows, lambda client, row: Reply(200, str(clock.time())), partitions=20, rate=20.0)
    at = sorted(float(r.body) for r in calls.select("body").collect())
    assert 1.0 <= at[-1] - at[0] <= 5.0


def test_every_attempt_takes_a_token():
    taken = []
    policy = AttemptPolicy(attempts=3, sleep=lambda seconds: None)

    def failing(client, row):
        raise ServiceError(503)

    done = _call(failing, None, {}, policy, lambda: taken.append(1))
    assert done["attempts"] == len(taken) == 3


def test_calls_are_not_read_ahead():
    from concurrent.futures import ThreadPoolExecutor

    from docledger.operators.dispatch import _window

    started = []
    with ThreadPoolExecutor(2) as pool:
        results = _window(pool, lambda row: started.append(row) or row, list(range(1000)), 4)
        assert next(results) == 0
        assert len(started) <= 5
        assert list(results) == list(range(1, 1000))


def test_threads_share_the_limit():
    import threading
    import time as clock

    from docledger.operators.dispatch import _Throttle

    throttle, at = _Throttle(100.0), []

    def work():
        for _ in range(5):
            throttle.take()
            at.append(clock.monotonic())

    threads = [threading.Thread(target=work) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert max(at) - min(at) >= 0.17


def test_what_a_service_asks_for_is_recorded(spark, tmp_path):
    def send(client, row):
        if row["document_id"] == "ok":
            return Reply(200, "{}")
        raise ServiceError(429, "busy", retry_after={"none": None, "soon": 0.5, "late": 90.0, "never": 1e12}[row["document_id"]])

    out = run(spark, tmp_path, send, ["ok", "none", "soon", "late", "never"],
              policy=AttemptPolicy(attempts=2, first=0.0, hold=60, sleep=lambda seconds: None))
    got = {r.document_id: ((r.retry_at - r.finished_at).total_seconds() if r.retry_at else None, r.attempts, r.retry_count)
           for r in out.collect()}
    assert got == {"ok": (None, 1, 0), "none": (None, 2, 0), "soon": (0.5, 2, 0), "late": (90.0, 1, 0),
                   "never": (10 * 365 * 86400.0, 1, 0)}


def test_a_final_reply_is_not_asked_again(spark, tmp_path):
    out = run(spark, tmp_path, lambda client, row: Reply(500, '{"message":"no"}', final=True), ["x"])
    assert rows(out, "attempts", "error_code", "error_message") == [(1, 500, "no")]


@pytest.mark.parametrize("master,settings,running", [
    ("local", {}, 1), ("local[4]", {}, 4), ("local[4,2]", {}, 4), ("local[*]", {}, 16), ("local[200]", {}, 100),
    ("local-cluster[3,2,1024]", {}, 6), ("yarn", {}, 100),
    ("yarn", {"spark.executor.instances": "5", "spark.executor.cores": "4"}, 20),
    ("yarn", {"spark.executor.instances": "5", "spark.executor.cores": "4", "spark.task.cpus": "2"}, 10),
    ("yarn", {"spark.executor.instances": "2", "spark.executor.cores": "4", "spark.dynamicAllocation.enabled": "true"}, 100),
    ("yarn", {"spark.dynamicAllocation.maxExecutors": "6", "spark.executor.cores": "4", "spark.dynamicAllocation.enabled": "true"}, 24),
])
def test_most_running(master, settings, running):
    assert most_running(master, lambda name, default: settings.get(name, default), 100, 16) == running


def test_the_rate_holds_for_all_tasks_together(spark, tmp_path):
    """More tasks than slots: the calls of all of them together stay within ten per cent of the rate."""
    out = run(spark, tmp_path, lambda client, row: Reply(200, "{}"), [f"d{i}" for i in range(400)], rate=100.0, partitions=8,
              policy=AttemptPolicy(attempts=1))
    times = sorted(r.started_at.timestamp() for r in out.collect())
    per_second = (len(times) - 8) / (times[-1] - times[0])
    assert per_second <= 110
    # Between tasks a worker has to start; apart from that the rate is used.
    assert per_second >= 40


def test_finished_outcomes_are_read_without_the_worklist(spark, tmp_path):
    path = str(tmp_path / "out")
    dispatch(due(spark, "a", "b"), lambda client, row: Reply(200, "{}"), stage_path=path, correlation_id="r")
    never = due(spark, "a", "b").filter(F.raise_error(F.lit("read again")).cast("boolean"))
    again = dispatch(never, lambda client, row: Reply(500), stage_path=path, correlation_id="r")
    assert rows(again, "document_id", "ok") == [("a", True), ("b", True)]


def test_columns_are_handed_on(spark):
    """Values of every kind, nulls and numbers among them, reach the transport and come back as they were."""
    table = due(spark, "a", "b", None).withColumns({
        "retry_count": F.when(F.col("document_id") == "a", 3), "when": F.timestamp_seconds(F.lit(1.5)),
        "list": F.array(F.lit(1), F.lit(None).cast("int")), "size": F.length("document_id").cast("bigint")})
    send = lambda client, row: Reply(200, repr([row["retry_count"], row["list"], row["size"], row["document_id"]]))
    got = call_rows(table, send, partitions=1)
    assert rows(got.select(*table.columns)) == rows(table)
    assert sorted(r.body for r in got.collect()) == [
        "[3, [1, None], 1, 'a']", "[None, [1, None], 1, 'b']", "[None, [1, None], None, None]"]
