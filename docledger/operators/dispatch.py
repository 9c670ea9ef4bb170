"""Calling a transport once per worklist row, as a distributed job.

The call is the only Python in it: a task sends its rows and records raw codes and bodies.
Reading replies, classifying them and choosing messages and codes happens in Spark expressions.
"""

from __future__ import annotations

import os
import random
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from operator import itemgetter
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from docledger.functions import status as st
from docledger.functions.messages import parse_reply
from docledger.operators.clients import kept_client, key_of
from docledger.schemas import CARRIED, OUTCOME
from docledger.sources.staging import is_complete, stage


@dataclass
class Reply:
    """What a transport got back. ``elapsed_ms`` overrides the measured time; a ``final`` one is not asked again."""

    code: int
    body: str | None = None
    elapsed_ms: int | None = None
    final: bool = False


class ServiceError(Exception):
    """A reply that is an error by its HTTP code; ``retry_after`` is the server's wish in seconds."""

    def __init__(self, code: int, body: str | None = None, retry_after: float | None = None):
        super().__init__(body or "")
        self.code, self.body, self.retry_after = code, body, retry_after


@dataclass(frozen=True)
class AttemptPolicy:
    """Up to ``attempts`` calls, waiting U(0, min(longest, first * 2**n)) seconds in between.

    A service that asks for a longer pause than ``hold`` seconds ends the attempts: the outcome tells when it
    wants to be called again (``retry_at``), and the task does not wait for it.
    """

    attempts: int = 3
    first: float = 0.5
    longest: float = 8.0
    hold: float = float("inf")
    codes: tuple[int, ...] = st.RETRYABLE_CODES
    other_kinds: tuple[str, ...] = ()
    sleep: Callable[[float], None] = time.sleep

    def again(self, kind: str | None, code: int | None) -> bool:
        return kind in self.other_kinds or st.should_retry(kind, code, self.codes)

    def wait(self, n: int, retry_after: float | None = None) -> None:
        pause = random.uniform(0, min(self.longest, self.first * 2 ** n))
        self.sleep(pause if retry_after is None else max(pause, retry_after))


# Raised errors by kind, most specific first; ConnectionError and the like are all OSErrors.
_KINDS = ((TimeoutError, st.TIMEOUT), (ConnectionError, st.CONNECTION),
          (FileNotFoundError, st.NOT_FOUND), (PermissionError, st.DENIED), (ValueError, st.BAD_PATH))

#: Seconds; a service cannot ask for more than ten years.
LONGEST_PAUSE = 10 * 365 * 86_400.0

_CALL = [
    StructField("code", IntegerType()), StructField("body", StringType()),
    StructField("kind", StringType()), StructField("failure_text", StringType()),
    StructField("attempts", IntegerType()), StructField("execution_time_ms", LongType()),
    StructField("retry_after", DoubleType()), StructField("started_at", TimestampType()), StructField("finished_at", TimestampType()),
]


def _now() -> int:
    """Microseconds, as the timestamps of an Arrow column are made of."""
    return time.time_ns() // 1_000


def _call(send: Callable, client: Any, row: dict, policy: AttemptPolicy,
          take: Callable[[], None] = lambda: None) -> dict:
    """One row through the transport, waiting for a token before every attempt. Never raises."""
    started = _now()
    clock = time.perf_counter()
    for n in range(max(1, policy.attempts)):
        reply, kind, text, code, body, hint = None, None, None, None, None, None
        take()
        try:
            reply = send(client, row)
            code, body = reply.code, reply.body
            if not 200 <= code < 300:
                kind = st.HTTP
        except ServiceError as error:
            kind, code, body, hint = st.HTTP, error.code, error.body, error.retry_after
        except Exception as error:
            kind = next((k for cls, k in _KINDS if isinstance(error, cls)), st.OTHER)
            text = str(error)
        if kind is None or n + 1 >= policy.attempts or not policy.again(kind, code):
            break
        if (reply is not None and reply.final) or (hint or 0) > policy.hold:
            break
        policy.wait(n, hint)
    elapsed = int((time.perf_counter() - clock) * 1000)
    if reply is not None and reply.elapsed_ms is not None:
        elapsed = reply.elapsed_ms
    return {**row, "code": code, "body": body, "kind": kind, "failure_text": text,
            "attempts": n + 1, "execution_time_ms": elapsed, "retry_after": hint if kind else None,
            "started_at": started, "finished_at": _now()}


class _Throttle:
    """At most ``rate`` calls per second in this task, whatever its threads; no limit without a rate."""

    def __init__(self, rate: float | None, sleep: Callable[[float], None] = time.sleep):
        self.gap = 1.0 / rate if rate else 0.0
        self.sleep = sleep
        self.next = time.monotonic()
        self.lock = threading.Lock()

    def take(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            mine = max(self.next, now)
            self.next = mine + self.gap
        if mine > now:
            self.sleep(mine - now)


def _window(pool: ThreadPoolExecutor, one: Callable, rows: list[dict], width: int) -> Iterator[dict]:
    """Results in order, with at most ``width`` rows handed to the pool and not yet taken."""
    waiting: deque = deque()
    for row in rows:
        if len(waiting) >= width:
            yield waiting.popleft().result()
        waiting.append(pool.submit(one, row))
    while waiting:
        yield waiting.popleft().result()


def _parcels(results: Iterator[dict], limit: int = 16 * 1024 * 1024) -> Iterator[list[dict]]:
    """Results in lists whose bodies and messages stay near ``limit`` characters."""
    held, size = [], 0
    for result in results:
        held.append(result)
        size += len(result.get("body") or "") + len(result.get("failure_text") or "")
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _caller(send: Callable, open_client: Callable | None, policy: AttemptPolicy,
            rate: float | None, concurrency: int, keep_clients: float, arrow_schema: pa.Schema) -> Callable:
    key = key_of(open_client, concurrency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        throttle = _Throttle(rate, policy.sleep)
        with kept_client(open_client, concurrency, key, keep_clients) as (client, pool):
            def one(row: dict) -> dict:
                if row["reject_code"] is not None:
                    now = _now()
                    return {**row, "code": row["reject_code"], "kind": st.HTTP, "attempts": 0,
                            "body": row["reject_text"], "failure_text": None, "execution_time_ms": 0,
                            "retry_after": None, "started_at": now, "finished_at": now}
                return _call(send, client, row, policy, throttle.take)

            for batch in batches:
                rows = _rows(batch)
                results = _window(pool, one, rows, 2 * concurrency) if pool else map(one, rows)
                at = 0
                for done in _parcels(results):
                    yield _answered(batch.slice(at, len(done)), done, arrow_schema)
                    at += len(done)
    return run


def _values(column: pa.Array) -> list:
    """``to_pylist``, which takes values one by one, where there is no faster way."""
    if column.null_count == len(column):
        return [None] * len(column)
    if pa.types.is_string(column.type) or pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _rows(batch: pa.RecordBatch) -> list[dict]:
    names = batch.schema.names
    return [dict(zip(names, values, strict=True))
            for values in zip(*map(_values, batch.columns), strict=True)]


def _answered(batch: pa.RecordBatch, done: list[dict], arrow_schema: pa.Schema) -> pa.RecordBatch:
    """The rows with what their calls returned: their own columns are handed on as they came."""
    kept = [column if column.type == field.type else column.cast(field.type)
            for column, field in zip(batch.columns, arrow_schema)]
    fields = list(arrow_schema)[len(kept):]
    values = zip(*map(itemgetter(*(field.name for field in fields)), done), strict=True)
    found = [pa.array(column, field.type) for column, field in zip(values, fields, strict=True)]
    return pa.RecordBatch.from_arrays(kept + found, schema=arrow_schema)


def most_running(master: str, conf: Callable[[str, str], str], tasks: int, cores_here: int) -> int:
    """How many of some tasks can run at the same time at most, as far as the settings tell; else all of them.

    A rate is shared by that many: with fewer running it is not reached, but never exceeded. The default parallelism
    does not tell it: that is a setting of its own, and under dynamic allocation what there was at the start.
    """
    local = re.match(r"local(?:\[(\d+|\*)(?:,\d+)?\])?$", master)
    cluster = re.match(r"local-cluster\[(\d+),(\d+),\d+\]$", master)
    if local:
        slots = cores_here if local[1] == "*" else int(local[1] or 1)
    elif cluster:
        slots = int(cluster[1]) * int(cluster[2])
    else:
        dynamic = conf("spark.dynamicAllocation.enabled", "false").lower() == "true"
        executors = conf("spark.dynamicAllocation.maxExecutors" if dynamic else "spark.executor.instances", "")
        cores = conf("spark.executor.cores", "")
        slots = int(executors) * int(cores) if executors.isdigit() and cores.isdigit() else tasks
    return max(1, min(tasks, slots // int(conf("spark.task.cpus", "1"))))


def call_rows(worklist: DataFrame, send: Callable[[Any, dict], Reply], *,
              open_client: Callable | None = None, partitions: int | None = None,
              policy: AttemptPolicy = AttemptPolicy(), rate: float | None = None,
              concurrency: int = 1, rows_per_task: int = 20_000,
              keep_clients: float = 0.0) -> DataFrame:
    """The worklist with what the transport returned. Lazy: each evaluation calls again.

    Rows are dealt out evenly, whatever their keys, ``rows_per_task`` to a task if ``partitions``
    is not given; that takes a count of the worklist. ``reject_code`` marks rows answered without a
    call. ``rate`` limits attempts, repeated ones too, over the whole job: tasks that can run at
    the same time (``most_running``) share it. ``open_client`` opens a client for each task; with ``keep_clients`` it
    serves later tasks of its Python worker too, until it has been idle for that many seconds.
    """
    if "reject_code" not in worklist.columns:
        worklist = worklist.withColumns({"reject_code": F.lit(None).cast("int"),
                                         "reject_text": F.lit(None).cast("string")})
    context = worklist.sparkSession.sparkContext
    tasks = partitions or max(context.defaultParallelism, -(-worklist.count() // rows_per_task))
    running = most_running(context.master, context.getConf().get, tasks, os.cpu_count() or 1)
    schema = StructType(worklist.schema.fields + _CALL)
    run = _caller(send, open_client, policy, rate / running if rate else None, concurrency,
                  keep_clients, to_arrow_schema(schema))
    return worklist.repartition(tasks).mapInArrow(run, schema)


def read_calls(calls: DataFrame, correlation_id: str, mode: str = "code",
               errors: str = "service") -> DataFrame:
    """Raw calls as outcomes.

    ``errors`` says how raised errors become codes: ``service`` or ``storage``. A 2xx reply that
    ``not_failed`` turns down is stored as 500; one that ``strict`` turns down keeps its code.
    """
    reply = calls.withColumn("reply", parse_reply("body"))
    # ``least`` passes over a NULL, which stands for no wish.
    pause = F.when(F.col("retry_after").isNotNull(), F.least("retry_after", F.lit(LONGEST_PAUSE)))
    asked = F.col("finished_at") + F.make_dt_interval(secs=pause.cast("decimal(18,6)"))
    kind_code = (st.storage_error_code("kind", "failure_text") if errors == "storage"
                 else st.exception_code("kind", "code"))
    good = F.col("kind").isNull() & st.classify("code", F.col("reply.status"), mode)
    code = F.coalesce(F.col("code"), kind_code)
    if mode == "not_failed":
        code = F.when(F.col("code").between(200, 299), F.lit(500)).otherwise(code)
    text = F.when(F.col("failure_text").isNotNull(), F.col("failure_text")).otherwise(
        st.error_message("reply.message", "reply.error", "reply.detail"))
    return reply.withColumn("ok", good).select(
        "auth_request_id", "document_id", "ar_number", "full_path",
        F.lit(correlation_id).alias("correlation_id"), "ok",
        F.when(~F.col("ok"), code).cast("int").alias("error_code"),
        F.when(~F.col("ok"), text).alias("error_message"),
        F.when(F.col("ok"), F.coalesce(st.first_filled(
            "reply.azure_blob_path", "reply.blob_url", "reply.blob_path"), F.lit("")))
        .alias("target_path"),
        F.when(F.col("ok"), F.col("reply.total_bytes").try_cast("bigint")).alias("bytes"),
        F.when(F.col("ok"), F.col("reply.sha256")).alias("sha256"),
        "attempts", "execution_time_ms", "started_at", "finished_at",
        (F.col("retry_count") if "retry_count" in calls.columns else F.lit(None)).cast("int").alias("retry_count"),
        F.when(~F.col("ok"), asked).alias("retry_at"))


def dispatch(worklist: DataFrame, send: Callable[[Any, dict], Reply], *, stage_path: str,
             correlation_id: str, mode: str = "code", errors: str = "service",
             **calling: Any) -> DataFrame:
    """Call ``send(client, row)`` for every row and return the staged outcomes.

    A lost executor repeats the calls of its unfinished tasks, so a transport must give the
    same result when a row is sent again. Outcomes also carry the count their row came with and when the
    service asked to be called again. Further arguments are those of ``call_rows``.
    """
    spark = worklist.sparkSession
    if is_complete(spark, stage_path):
        # The worklist need not even be counted.
        return spark.read.schema(StructType(OUTCOME.fields + CARRIED.fields)).parquet(stage_path)
    calls = call_rows(worklist, send, **calling)
    outcomes = read_calls(calls, correlation_id, mode, errors)
    return stage(outcomes.select(*OUTCOME.fieldNames(), *CARRIED.fieldNames()), stage_path)


def split_outcomes(outcomes: DataFrame, at: Column | None = None,
                   counted: bool = False) -> tuple[DataFrame, DataFrame]:
    """Successes and failures, each in the columns its ledger takes.

    Rows are stamped ``at`` the given run time, or when their call finished. With ``counted`` both
    sides have ``retry_count``: what the attempt carried, and for a failure one more.
    """
    ok = F.coalesce(F.col("ok"), F.lit(False))
    moment = F.col("finished_at") if at is None else at
    dates = (moment.alias("date_created"), moment.alias("date_updated"))
    count = F.coalesce(F.col("retry_count"), F.lit(0)) if counted else None
    good = outcomes.filter(ok).select(
        "auth_request_id", "document_id", "correlation_id", "full_path", "target_path",
        "execution_time_ms", *dates, "ar_number",
        *([count.cast("int").alias("retry_count")] if counted else []))
    bad = outcomes.filter(~ok).select(
        "auth_request_id", "document_id", F.col("correlation_id").alias("latest_correlation_id"),
        "full_path", F.lit(0).alias("reprocess_success"),
        F.col("error_message").alias("latest_error_message"),
        F.col("error_code").alias("latest_error_code"), *dates, "ar_number",
        *([(count + 1).cast("int").alias("retry_count")] if counted else []))
    return good, bad
