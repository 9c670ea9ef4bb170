"""A whole transfer run: manifest, worklist, dispatch, ledgers, summary."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from docledger.operators.dispatch import dispatch
from docledger.operators.worklist import TARGET_COUNTED, RetryPolicy, multiply_rows, worklist
from docledger.plans.ledgers import claim_counting, commit_outcomes, measure, read_failures
from docledger.schemas import CARRIED, KEYS, OUTCOME, WORKLIST
from docledger.session import fresh_dir
from docledger.sources.ledger import Ledgers, read_ledger, read_seen
from docledger.sources.staging import children, is_complete, written
from docledger.sources.tables import ensure_tables

# dispatcher(worklist, stage_path, correlation_id) -> staged outcomes
Dispatcher = Callable[[DataFrame, str, str], DataFrame]


def sending(send: Callable, **options: Any) -> Dispatcher:
    """A dispatcher that calls ``send(client, row)``; options as for ``dispatch``."""
    def run(rows: DataFrame, stage_path: str, correlation_id: str) -> DataFrame:
        return dispatch(rows, send, stage_path=stage_path, correlation_id=correlation_id, **options)
    return run


@dataclass
class JobOptions:
    """Settings and switches of a run.

    policy      which failures are due, and by that the way of counting: ``TARGET_COUNTED`` adds one
                in the ledger, ``SOURCE_COUNTED`` stores the count the attempt carried, plus one
    batches     cut the run into that many commits, each over its own buckets of the ledgers, so
                that the commits together read and write every bucket once
    copy        without it the run does everything but call the service
    multiply    replace every manifest row by this many numbered copies (test data)
    database    create the cross-reference tables there where they are missing
    """

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    at: Column | None = None
    policy: RetryPolicy = TARGET_COUNTED
    path_mode: str = "single"
    batches: int = 1
    skip_succeeded_retries: bool = False
    work_dir: str | None = None
    copy: bool = True
    multiply: int | None = None
    database: str | None = None


def transfer_job(spark: SparkSession, manifest: DataFrame, ledgers: Ledgers, dispatcher: Dispatcher,
                 options: JobOptions | None = None) -> dict[str, int]:
    """Copy what is due and record it; returns total, successes and failures.

    The worklist is written once and fixed for the run. A failed run may be repeated with the same
    ``run_id`` and ``work_dir``, also with another number of ``batches``: finished batches, of
    whatever cut, are recognised by their staged outcomes and committed (again), which changes nothing that was
    committed before; their rows are not called again, and all other rows of the run's worklist are. Another
    run may use the same ``work_dir``; each has a folder of its own there.
    """
    options = options or JobOptions()
    work = run_folder(options.work_dir or fresh_dir(spark, "runs"), options.run_id)
    batches = options.batches
    if not 1 <= batches <= ledgers.failure.buckets:
        raise ValueError(f"{batches} batches asked, but batches are cut by bucket and the ledgers "
                         f"have {ledgers.failure.buckets}")
    totals = {"total": 0, "successes": 0, "failures": 0}
    if options.database:
        ensure_tables(spark, database=options.database)
    if options.multiply:
        manifest = multiply_rows(manifest, options.multiply)
    if not options.copy:
        return totals
    claim_counting(spark, ledgers, options.policy.counted)

    def commit(outcomes: DataFrame, measured: dict | None = None) -> None:
        counts = commit_outcomes(spark, ledgers, outcomes, options.at, counted=options.policy.counted,
                                 measured=measured)
        for name in totals:
            totals[name] += counts[name]

    staged = _staged_worklist(spark, manifest, ledgers, work, options)
    finished = _outcomes_of_other_cuts(spark, work, batches)
    if finished is not None:
        known = measure(finished, ledgers.failure)
        commit(finished, known)
    for batch in range(batches):
        rows, path = staged.filter(F.col("batch") == batch).drop("batch"), f"{work}/outcomes/of={batches}/batch={batch}"
        if finished is not None and not is_complete(spark, path):
            # A dispatcher reads them more than once.
            rows = written(_without_finished(rows, finished, ledgers.failure.bucket_of().isin(known["buckets"])),
                           f"{work}/rest/of={batches}/batch={batch}")
        commit(dispatcher(rows, path, options.run_id))
    return totals


def run_folder(work_dir: str, run_id: str) -> str:
    """Where a run keeps its staged results: no other run id leads there."""
    return f"{work_dir.rstrip('/')}/run={quote(run_id, safe='')}"


def _cuts(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{name}" for name in children(spark, folder) if name.startswith("of=")]


def _staged_worklist(spark: SparkSession, manifest: DataFrame, ledgers: Ledgers, work: str,
                     options: JobOptions) -> DataFrame:
    """The run's worklist, written once, a folder per batch, so that each batch reads only its own.

    An earlier try of the run that cut it otherwise has written the same rows: these are cut anew,
    because the ledgers may have changed since.
    """
    schema = StructType(WORKLIST.fields + [StructField("batch", IntegerType())])
    folder, path = f"{work}/worklist", f"{work}/worklist/of={options.batches}"
    if not is_complete(spark, path):
        earlier = [cut for cut in _cuts(spark, folder) if is_complete(spark, cut)]
        if earlier:
            due = spark.read.schema(schema).parquet(earlier[0]).drop("batch")
            if options.batches == 1:
                return due.withColumn("batch", F.lit(0))  # all of them, whichever way they lie
        else:
            due = worklist(manifest, read_ledger(spark, ledgers.success), read_failures(spark, ledgers),
                           policy=options.policy, path_mode=options.path_mode,
                           skip_succeeded_retries=options.skip_succeeded_retries,
                           seen=read_seen(spark, ledgers.success, ledgers.failure))
        batch = (ledgers.failure.bucket_of() % options.batches).alias("batch")
        cut = due.select("*", batch)
        if options.batches > 1:
            cut = cut.hint("rebalance", F.col("batch"))
        cut.write.mode("overwrite").partitionBy("batch").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _outcomes_of_other_cuts(spark: SparkSession, work: str, batches: int) -> DataFrame | None:
    """What earlier tries with other numbers of batches have finished; all rows of a document lie in one batch."""
    found = []
    for cut in _cuts(spark, f"{work}/outcomes"):
        if cut.endswith(f"/of={batches}"):
            continue
        found += [f"{cut}/{name}" for name in children(spark, cut)
                  if name.startswith("batch=") and is_complete(spark, f"{cut}/{name}")]
    schema = StructType(OUTCOME.fields + CARRIED.fields)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*found) if found else None


def _without_finished(rows: DataFrame, finished: DataFrame, touched: Column) -> DataFrame:
    """Rows that no finished batch has an outcome for; NULL keys are told apart by path.

    ``touched`` tells which rows fall into a bucket that a finished outcome falls into: only they are joined.
    """
    columns = [*KEYS, "full_path"]
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}"))
    rest = rows.filter(touched).alias("r").join(finished.select(*columns).alias("k"), same, "left_anti")
    return rows.filter(~touched).unionAll(rest)


def tagged_ledgers(spark: SparkSession, ledgers: Ledgers) -> DataFrame:
    """All three ledgers as one table, told apart by a ``ledger`` column."""
    success = read_ledger(spark, ledgers.success).withColumn("ledger", F.lit("success"))
    failure = read_ledger(spark, ledgers.failure).withColumn("ledger", F.lit("failure"))
    details = read_ledger(spark, ledgers.details).withColumn("ledger", F.lit("details"))
    return (success.unionByName(failure, allowMissingColumns=True)
            .unionByName(details, allowMissingColumns=True))
