"""Batches of a manifest folder, finished and recorded one after the other."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docledger.operators.worklist import TARGET_COUNTED, Backoff, RetryPolicy, due_failures, worklist
from docledger.plans.job import Dispatcher, run_folder
from docledger.plans.ledgers import claim_counting, commit_outcomes, is_small, read_failures
from docledger.schemas import KEYS, MANIFEST
from docledger.sources.ledger import Ledgers, read_ledger
from docledger.sources.staging import is_complete, written

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def per_batch_apply(spark: SparkSession, folder: str, schema: StructType,
                    apply: Callable[[DataFrame, int], None], checkpoint: str, *,
                    files_per_batch: int = 1000, every: str | None = None,
                    idle: bool = False) -> StreamingQuery:
    """Run ``apply(rows, batch_id)`` on the folder's new files, a few at a time.

    The checkpoint remembers finished files over restarts. Without ``every`` the query ends when
    all files present are done; with it, it looks for new ones at that interval. With ``idle`` it then calls
    ``apply`` also when there is none: a second source that ticks, and has no rows, starts the batch.
    """
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(folder))
    if idle:
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load().filter("value < 0")
        rows = rows.unionByName(ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def transfer_stream(spark: SparkSession, manifest_folder: str, ledgers: Ledgers,
                    dispatcher: Dispatcher, *, run_id: str, work_dir: str,
                    at: Column | None = None, policy: RetryPolicy = TARGET_COUNTED,
                    path_mode: str = "single", files_per_batch: int = 1000,
                    every: str | None = None, backoff: Backoff | None = None,
                    clock: Clock = utc_now) -> StreamingQuery:
    """The transfer job per micro-batch, with the ledgers as its only state.

    Failures that earlier runs left are retried before the first micro-batch, whether or not a file is new
    (``retry_due``): all of them once per run, or with ``backoff`` those whose time has come. Micro-batches take
    their own new documents, and with ``backoff`` every failure that has become due in the meantime; a query
    that never ends (``every``) then looks for them at each interval, new files or not. What is due follows
    from the failure ledger and from what services asked for, both in the ledgers, so that a pause, however long,
    holds no task and survives a restart. ``clock`` tells the time that pauses are measured by.

    A micro-batch that is replayed finds its staged outcomes and calls nothing again,
    and so does a restart under the same run id. A micro-batch that is small, as most are, is
    looked up in the ledgers without shuffling them.
    """
    folder, staged = f"{run_folder(work_dir, run_id)}/outcomes", f"{run_folder(work_dir, run_id)}/due"
    timed = backoff is not None
    retry_due(spark, ledgers, dispatcher, run_id=run_id, work_dir=work_dir, at=at, policy=policy,
              path_mode=path_mode, backoff=backoff, clock=clock)

    def one(rows: DataFrame, batch_id: int) -> None:
        session, path = rows.sparkSession, f"{folder}/batch={batch_id}"
        failure = read_failures(session, ledgers)
        due = worklist(rows, read_ledger(session, ledgers.success), failure,
                       policy=policy, path_mode=path_mode, small_docs=is_small(rows.select(*KEYS)),
                       retries=_due(session, ledgers, failure, backoff, clock) if timed else None,
                       retry_only_if=None if timed else F.lit(False))
        if not is_complete(session, path):
            if timed and every and due.isEmpty():
                return  # most ticks find nothing, and leave nothing behind
            # A dispatcher reads them more than once.
            due = written(due, f"{staged}/batch={batch_id}")
        outcomes = dispatcher(due, path, f"{run_id}-{batch_id}")
        commit_outcomes(session, ledgers, outcomes, at, counted=policy.counted)

    # A query that ticks has a second source, which its checkpoint knows.
    ticking = timed and every is not None
    return per_batch_apply(spark, manifest_folder, MANIFEST, one,
                           f"{work_dir}/checkpoint{'-ticking' if ticking else ''}",
                           files_per_batch=files_per_batch, every=every, idle=ticking)


def _due(spark: SparkSession, ledgers: Ledgers, failure: DataFrame, backoff: Backoff, clock: Clock) -> DataFrame:
    return due_failures(failure, read_ledger(spark, ledgers.asked), F.lit(clock()), backoff)


def retry_due(spark: SparkSession, ledgers: Ledgers, dispatcher: Dispatcher, *, run_id: str,
              work_dir: str, at: Column | None = None, policy: RetryPolicy = TARGET_COUNTED,
              path_mode: str = "single", backoff: Backoff | None = None,
              clock: Clock = utc_now) -> dict[str, int]:
    """Retry every failure that is due, without any manifest; returns the counters.

    Without ``backoff`` every failure with retries left is.
    """
    claim_counting(spark, ledgers, policy.counted)
    failure = read_failures(spark, ledgers)
    due = worklist(spark.createDataFrame([], MANIFEST), read_ledger(spark, ledgers.success), failure,
                   policy=policy, path_mode=path_mode,
                   retries=None if backoff is None else _due(spark, ledgers, failure, backoff, clock))
    path = f"{run_folder(work_dir, run_id)}/outcomes/retry"
    if not is_complete(spark, path):
        due = written(due, f"{run_folder(work_dir, run_id)}/due/retry")
    outcomes = dispatcher(due, path, f"{run_id}-retry")
    return commit_outcomes(spark, ledgers, outcomes, at, counted=policy.counted)
