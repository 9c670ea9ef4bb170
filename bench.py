"""Headline timings as one JSON line.

Inputs (manifest, ledgers, outcomes) are derived from the given tables and written first, so that
each figure times one operator reading parquet. ``$BENCH_SF_DIR`` and ``$BENCH_CPUS`` choose the
scale and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from docledger.functions.timing import instant  # noqa: E402
from docledger.operators import batching, keys, worklist as wl  # noqa: E402
from docledger.operators.dispatch import Reply, dispatch  # noqa: E402
from docledger.plans import ledgers as plans  # noqa: E402
from docledger.plans.copying import copy_files  # noqa: E402
from docledger.plans.job import JobOptions, sending, transfer_job  # noqa: E402
from docledger.registry.copies import shared_files  # noqa: E402
from docledger.registry.inputs import RUN_AT, derived, load  # noqa: E402
from docledger.registry.runs import NO_WAIT, answer  # noqa: E402
from docledger.session import build_session, fresh_dir, ship  # noqa: E402
from docledger.sources import files  # noqa: E402
from docledger.sources.ledger import Ledgers, write_version  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def accept(client, row):
    """A service that takes no time."""
    return Reply(200, '{"status":"Success","azure_blob_path":"x"}', 1)


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(times: int, work) -> float:
    spent = []
    for _ in range(times):
        start = time.perf_counter()
        work()
        spent.append(time.perf_counter() - start)
    return round(min(spent), 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.sql.shuffle.partitions": CPUS})
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    folder = fresh_dir(spark, "bench")
    table = {}
    for name in ("manifest", "success", "failure", "details", "outcomes"):
        derived(spark, SF_DIR, name).write.parquet(f"{folder}/{name}")
        table[name] = spark.read.parquet(f"{folder}/{name}")
    good, bad = plans.split_outcomes(table["outcomes"])
    due = wl.worklist(table["manifest"], table["success"], table["failure"])
    stage = lambda: fresh_dir(spark, "bench-stage")

    seconds, rates = {}, {}
    seconds["worklist"] = best(3, lambda: run_all(due))
    seconds["pending_only"] = best(3, lambda: run_all(
        keys.pending_only(table["manifest"], table["success"], table["failure"])))
    seconds["multiply_rows"] = best(2, lambda: run_all(wl.multiply_rows(
        load(spark, SF_DIR, "orders").select(
            F.format_string("%08x-0-0-0-%012x", "o_orderkey", "o_custkey").alias("document_id"),
            F.format_string("%08x-1-0-0-%012x", "o_orderkey", "o_custkey").alias("auth_request_id")),
        100, partitions=int(CPUS))))
    seconds["failure_upsert_increment"] = best(3, lambda: run_all(
        plans.failure_upsert_increment(table["failure"], bad)))
    seconds["success_insert_if_absent"] = best(3, lambda: run_all(
        plans.success_insert_if_absent(table["success"], good)))
    seconds["mark_reprocessed"] = best(3, lambda: run_all(
        plans.mark_reprocessed(table["failure"], good)))
    before = plans.LedgerState(table["success"], table["failure"], table["details"])
    after = plans.apply_outcomes(before, table["outcomes"])
    seconds["apply_outcomes"] = best(2, lambda: [
        run_all(df) for df in (after.success, after.failure, after.details)])
    seconds["assign_batches"] = best(2, lambda: run_all(
        batching.assign_batches(table["manifest"], 5000)))
    seconds["dispatch"] = best(2, lambda: dispatch(
        due, accept, stage_path=stage(), correlation_id="bench"))

    def job(batches: int):
        ledgers = Ledgers.at(fresh_dir(spark, "bench-ledgers"), 8)
        for ledger, name in ((ledgers.success, "success"), (ledgers.failure, "failure"),
                             (ledgers.details, "details")):
            write_version(spark, ledger, table[name])
        start = time.perf_counter()
        transfer_job(spark, table["manifest"], ledgers, sending(answer, policy=NO_WAIT),
                     JobOptions(run_id="bench", at=instant(RUN_AT), batches=batches))
        return round(time.perf_counter() - start, 3)

    seconds["transfer_job"] = job(1)
    seconds["transfer_job_4_batches"] = job(4)

    rows, root = shared_files(spark, SF_DIR)
    target = fresh_dir(spark, "bench-copied")
    copied = []
    seconds["copy_files"] = best(1, lambda: copied.append(
        copy_files(rows, root, target, stage_path=stage(), correlation_id="bench")))
    seconds["verify_copy"] = best(1, lambda: run_all(files.verify_copy(
        rows.select("source_file", "target_key"), root, target)))

    documents, due_rows = table["manifest"].count(), due.count()
    copied_bytes = copied[0].agg(F.sum("bytes")).first()[0]
    rates["worklist_rows_per_second"] = round(documents / seconds["worklist"])
    rates["merge_rows_per_second"] = round(
        (table["failure"].count() + bad.count()) / seconds["failure_upsert_increment"])
    rates["dispatch_rows_per_second"] = round(due_rows / seconds["dispatch"])
    rates["job_rows_per_second"] = round(due_rows / seconds["transfer_job"])
    rates["copy_mb_per_second"] = round(copied_bytes / 1048576 / seconds["copy_files"], 2)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "rates": rates, "sf": Path(SF_DIR).name,
        "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
