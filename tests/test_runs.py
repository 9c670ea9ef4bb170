"""Whole runs, batch and stream; batching, counters and table sources."""

import os
import uuid
from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame, Window, functions as F

from docledger.functions.timing import instant
from docledger.operators import batching, summary
from docledger.operators.dispatch import AttemptPolicy, Reply
from docledger.operators.worklist import SOURCE_COUNTED, RetryPolicy, worklist
from docledger.plans import job, ledgers as plans_of
from docledger.plans.job import JobOptions, sending, tagged_ledgers, transfer_job
from docledger.plans.ledgers import commit_outcomes, failure_upsert_source, latest_failures, read_state
from docledger.schemas import AUDIT, CROSS_REFERENCE, MANIFEST, OUTCOME
from docledger.session import shared_dir
from docledger.sources import tables
from docledger.sources.ledger import Ledgers, read_ledger
from docledger.streaming.microbatch import per_batch_apply, transfer_stream
from tests.helpers import T0, failure, manifest, outcomes, rows, success

NO_WAIT = AttemptPolicy(attempts=1, sleep=lambda seconds: None)


def service(broken=()):
    def send(client, row):
        if row["document_id"] in broken:
            return Reply(500, '{"message":"down"}', 1)
        return Reply(200, '{"azure_blob_path":"t/%s"}' % row["document_id"], 1)
    return sending(send, policy=NO_WAIT)


def docs(spark, n=12):
    return manifest(spark, *[("a", f"d{i}") for i in range(n)])


def option(i, **more):
    return JobOptions(run_id=f"run-{i}", at=instant(f"2024-01-{i + 1:02d} 00:00:00"), **more)


@pytest.mark.parametrize("batches", [1, 3])
def test_runs_until_everything_is_copied(spark, tmp_path, batches):
    ledgers = Ledgers.at(str(tmp_path), buckets=4)
    assert transfer_job(spark, docs(spark), ledgers, service(["d1", "d2"]),
                        option(0, batches=batches)) == {"total": 12, "successes": 10, "failures": 2}
    assert transfer_job(spark, docs(spark, 14), ledgers, service(["d2"]),
                        option(1, batches=batches)) == {"total": 4, "successes": 3, "failures": 1}
    state = read_state(spark, ledgers)
    assert state.success.count() == 13
    assert rows(state.failure, "document_id", "retry_count", "reprocess_success") == [
        ("d1", 0, 1), ("d2", 1, 0)]
    assert rows(state.details, "document_id", "correlation_id") == [
        ("d1", "run-0"), ("d2", "run-0"), ("d2", "run-1")]
    assert transfer_job(spark, docs(spark, 14), ledgers, service(), option(2))["total"] == 1
    assert transfer_job(spark, docs(spark, 14), ledgers, service(), option(3))["total"] == 0


def test_seven_attempts(spark, tmp_path):
    ledgers = Ledgers.at(str(tmp_path), buckets=2)
    tried = [transfer_job(spark, docs(spark, 1), ledgers, service(["d0"]), option(i))["total"]
             for i in range(9)]
    assert tried == [1] * 7 + [0, 0]
    assert rows(read_state(spark, ledgers).failure, "retry_count") == [(6,)]


def test_five_attempts_when_the_source_counts(spark):
    ledger, tried = failure(spark), []
    for i in range(7):
        due = worklist(docs(spark, 1), success(spark), ledger, policy=SOURCE_COUNTED)
        tried.append(due.count())
        failed = due.select(
            "auth_request_id", "document_id", F.lit(f"run-{i}").alias("latest_correlation_id"),
            (F.col("retry_count") + 1).alias("retry_count"), "full_path", "reprocess_success",
            F.lit("m").alias("latest_error_message"), F.lit(500).alias("latest_error_code"),
            F.lit(T0).alias("date_created"), F.lit(T0).alias("date_updated"), "ar_number")
        merged = failure_upsert_source(ledger, failed)
        ledger = spark.createDataFrame(merged.collect(), ledger.schema)
    assert tried == [1] * 5 + [0, 0]
    assert rows(ledger, "retry_count") == [(5,)]


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    ledgers = Ledgers.at(str(tmp_path / "l"), buckets=4)
    same = option(0, work_dir=str(tmp_path / "w"), batches=2)
    transfer_job(spark, docs(spark), ledgers, service(["d1"]), same)
    before = rows(tagged_ledgers(spark, ledgers))
    transfer_job(spark, docs(spark), ledgers, service(), same)
    assert rows(tagged_ledgers(spark, ledgers)) == before


def test_stream_equals_batch(spark, tmp_path):
    batch, stream = (Ledgers.at(str(tmp_path / n), buckets=4) for n in ("batch", "stream"))
    docs(spark, 20).repartition(5).write.parquet(str(tmp_path / "manifest"))
    for i, broken in enumerate((["d1", "d7"], ["d7"])):
        transfer_job(spark, docs(spark, 20), batch, service(broken), option(i))
        if i == 1:  # a later run sees new files; retries ride along
            manifest(spark, ("a", "late")).write.mode("append").parquet(str(tmp_path / "manifest"))
            transfer_job(spark, manifest(spark, ("a", "late")), batch, service(broken), option(1))
        query = transfer_stream(spark, str(tmp_path / "manifest"), stream, service(broken),
                                run_id=f"run-{i}", work_dir=str(tmp_path / "work"),
                                at=option(i).at, files_per_batch=2)
        query.awaitTermination()
    keep = ["ledger", "document_id", "full_path", "reprocess_success", "error_code"]
    left, right = tagged_ledgers(spark, batch), tagged_ledgers(spark, stream)
    assert left.filter("ledger = 'success'").count() == 20
    ok = "ledger = 'success' OR document_id <> 'd7'"
    assert rows(left.filter(ok).select(keep)) == rows(right.filter(ok).select(keep))
    assert rows(right.filter("ledger = 'failure' AND document_id = 'd7'"), "retry_count") == [(1,)]


def test_per_batch_apply(spark, tmp_path):
    docs(spark, 30).repartition(6).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):  # the checkpoint keeps the second query from seeing files again
        per_batch_apply(spark, str(tmp_path / "in"), MANIFEST,
                        lambda df, i: seen.append((i, df.count())), str(tmp_path / "cp"),
                        files_per_batch=2).awaitTermination()
    assert [i for i, _ in seen] == [0, 1, 2] and sum(n for _, n in seen) == 30


# --- batches and counters -------------------------------------------------------------------

def test_assign_batches(spark):
    keys = [("a", f"{i:04d}") for i in range(1003)]
    cut = batching.assign_batches(manifest(spark, *keys).repartition(7), 100)
    got = {d: b for d, b in rows(cut, "document_id", "batch_id")}
    assert got == {f"{i:04d}": i // 100 for i in range(1003)}
    assert cut.columns == MANIFEST.fieldNames() + ["batch_id"]


def test_assign_batches_with_a_hot_key(spark):
    hot = manifest(spark, *[("a", "hot")] * 500, *[("a", f"x{i}") for i in range(500)])
    cut = batching.assign_batches(hot.repartition(8), 64)
    sizes = [n for _, n in sorted((r["batch_id"], r["count"])
                                  for r in cut.groupBy("batch_id").count().collect())]
    assert sizes == [64] * 15 + [40]


def test_assign_batches_of_nothing(spark):
    assert batching.assign_batches(manifest(spark), 5).count() == 0
    with pytest.raises(ValueError):
        batching.assign_batches(manifest(spark), 0)


def test_num_batches(spark):
    assert [batching.num_batches(spark.range(n), 5).first()["batches"]
            for n in (0, 1, 5, 6, 10, 11)] == [0, 1, 1, 2, 2, 3]


def test_running_totals_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(summary, "_BLOCK", 10)
    df = spark.range(1, 96).select((F.col("id") * 3).alias("n"), F.col("id").alias("v"))
    got = summary.running_totals(df, "n", ["v"])
    plain = df.withColumn("cumulative_v", F.sum("v").over(Window.orderBy("n")))
    assert rows(got) == rows(plain)


def test_counters(spark):
    some = outcomes(spark, ("a", "x", 200), ("a", "y", 404), ("a", "z", 200))
    assert summary.outcome_counts(some).first().asDict() == {
        "total": 3, "successes": 2, "failures": 1}
    rates = summary.run_rates(some, 2.0).first()
    assert (rates["success_rate"], rates["rows_per_second"]) == (66.67, 1.5)
    none = summary.run_rates(outcomes(spark), 0).first()
    assert none["total"] == 0 and none["success_rate"] is None and none["rows_per_second"] is None
    stats = summary.copy_stats(some).first()
    assert (stats["total_bytes"], stats["seconds"]) == (20, 0.021)
    assert summary.copy_stats(outcomes(spark)).first()["mb_per_second"] == 0.0


def test_batch_payloads(spark):
    import json
    cut = batching.assign_batches(manifest(spark, ("a", "x"), ("a", "y"), ("a", "z")), 2)
    got = batching.batch_payloads(cut, "document_id", "container_folder")
    assert [json.loads(p) for _, p in rows(got, "batch_id", "payload")] == [
        [{"document_id": "x", "container_folder": "in"}, {"document_id": "y", "container_folder": "in"}],
        [{"document_id": "z", "container_folder": "in"}]]


# --- tables ---------------------------------------------------------------------------------

def test_records_with_nothing_but_null(spark):
    none = (None,) * len(OUTCOME)
    assert tables.from_records(spark, [none], OUTCOME).schema == OUTCOME


def test_csv_round_trip(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('full_path,auth_request_id,annotation_id\n"\\\\s\\h\\a ""q"", b.pdf",A,N\n')
    got = tables.read_manifest_csv(spark, str(path))
    assert rows(got) == [('\\\\s\\h\\a "q", b.pdf', "A", "N")]
    audit = got.withColumns({"file_name": F.lit("f"), "uploaded_at": F.lit("now")})
    back = tables.write_audit_csv(audit, str(tmp_path), instant("2024-01-01 10:20:30"))
    assert rows(back, "full_path", "file_name") == [('\\\\s\\h\\a "q", b.pdf', "f")]
    assert os.listdir(tmp_path / "audit-logs") == ["uploaded_2024-01-01T10_20_30.csv"]


def test_ensure_tables_twice(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    first = tables.ensure_tables(spark, database=name, renames={"fhir_id": "FHIR_Id"})
    spark.sql(f"INSERT INTO {name}.note_fhir VALUES ('a', 'n', 't', 'f', 1, NULL, NULL)")
    assert tables.ensure_tables(spark, database=name) == first and len(first) == len(CROSS_REFERENCE)
    got = tables.read_table(spark, f"{name}.note_fhir")
    assert got.count() == 1 and "FHIR_Id" in got.columns
    assert dict(got.dtypes)["fhir_network"] == "int" and dict(got.dtypes)["date_created"] == "timestamp"


def test_append_and_view(spark, tmp_path):
    rows_in = spark.createDataFrame([(None,) * len(AUDIT)], AUDIT)
    for _ in range(2):
        tables.append(rows_in, str(tmp_path / "audit"))
    tables.as_view(tables.read_path(spark, str(tmp_path / "audit"), schema=AUDIT), "audit_rows")
    assert spark.sql("SELECT count(*) FROM audit_rows").first()[0] == 2


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_switches(spark, tmp_path):
    ledgers = Ledgers.at(str(tmp_path), buckets=2)
    name = f"db_{uuid.uuid4().hex[:8]}"
    off = transfer_job(spark, docs(spark), ledgers, service(), option(0, copy=False, database=name))
    assert off["total"] == 0 and tables.read_table(spark, f"{name}.document_fhir").count() == 0
    ids = spark.createDataFrame([("1-2-3-4-abcd", "5-6-7-8-efgh", "AR", "r", "c", "f")], MANIFEST)
    assert transfer_job(spark, ids, ledgers, service(), option(1, multiply=20))["total"] == 20
    assert read_state(spark, ledgers).success.select("document_id").distinct().count() == 20


# --- runs that die, and cuts that change ------------------------------------------------------

def dying(broken=(), calls=1):
    """A dispatcher that ends the run after ``calls`` batches."""
    inner, left = service(broken), [calls]

    def run(rows, stage_path, correlation_id):
        if not left[0]:
            raise RuntimeError("the run dies here")
        left[0] -= 1
        return inner(rows, stage_path, correlation_id)
    return run


def logged(folder, broken=()):
    """A dispatcher whose calls leave a file each."""
    os.makedirs(folder, exist_ok=True)

    def send(client, row):
        open(f"{folder}/{row['document_id']}-{uuid.uuid4().hex}", "w").close()
        if row["document_id"] in broken:
            return Reply(500, '{"message":"down"}', 1)
        return Reply(200, '{"azure_blob_path":"t/%s"}' % row["document_id"], 1)
    return sending(send, policy=NO_WAIT)


@pytest.mark.parametrize("cuts", [(4, 2), (4, 1), (1, 4), (4, 2, 4), (2, 4, 1)])
def test_no_row_is_lost_when_batches_change(spark, tmp_path, cuts):
    ledgers, work, log = Ledgers.at(str(tmp_path / "l"), buckets=4), str(tmp_path / "w"), str(tmp_path / "calls")
    broken = [f"d{i}" for i in range(0, 60, 7)]
    inner = logged(log, broken)
    for batches in cuts[:-1]:
        left = [1]

        def run(rows, stage_path, correlation_id):
            if not left[0]:
                raise RuntimeError("the run dies here")
            left[0] -= 1
            return inner(rows, stage_path, correlation_id)

        try:
            transfer_job(spark, docs(spark, 60), ledgers, run, option(0, work_dir=work, batches=batches))
        except RuntimeError as error:
            assert "dies here" in str(error)
    totals = transfer_job(spark, docs(spark, 60), ledgers, inner, option(0, work_dir=work, batches=cuts[-1]))
    assert totals == {"total": 60, "successes": 60 - len(broken), "failures": len(broken)}
    state = read_state(spark, ledgers)
    assert state.success.count() == 60 - len(broken)
    assert rows(state.failure, "document_id", "retry_count") == sorted((d, 0) for d in broken)
    assert state.details.count() == len(broken)
    called = sorted(name.split("-")[0] for name in os.listdir(log))
    assert called == sorted(f"d{i}" for i in range(60))  # finished batches were not called again


def test_null_keys_over_changed_cuts(spark, tmp_path):
    ledgers = Ledgers.at(str(tmp_path / "l"), buckets=4)
    some = docs(spark, 20).union(manifest(spark, ("a", None), (None, "x"), (None, None)))
    with pytest.raises(RuntimeError):
        transfer_job(spark, some, ledgers, dying(), option(0, work_dir=str(tmp_path / "w"), batches=4))
    assert transfer_job(spark, some, ledgers, service(), option(0, work_dir=str(tmp_path / "w")))["total"] == 23


def test_the_worklist_of_a_run_is_fixed(spark, tmp_path):
    """What becomes due while a run is down waits for the next run."""
    ledgers, work = Ledgers.at(str(tmp_path / "l"), buckets=4), str(tmp_path / "w")
    with pytest.raises(RuntimeError):
        transfer_job(spark, docs(spark, 40), ledgers, dying(["d3"]), option(0, work_dir=work, batches=4))
    assert transfer_job(spark, docs(spark, 50), ledgers, service(["d3"]), option(0, work_dir=work, batches=2))["total"] == 40
    assert transfer_job(spark, docs(spark, 50), ledgers, service(), option(1, work_dir=work))["total"] == 11


# --- source-counted runs ------------------------------------------------------------------------

@pytest.mark.parametrize("history", [False, True])
def test_five_attempts_in_source_counted_runs(spark, tmp_path, history):
    ledgers = Ledgers.at(str(tmp_path), buckets=2, history=history)
    tried = [transfer_job(spark, docs(spark, 2), ledgers, service(["d0"]), option(i, policy=SOURCE_COUNTED))["total"]
             for i in range(7)]
    assert tried == [2] + [1] * 4 + [0, 0]
    assert rows(read_state(spark, ledgers).failure, "document_id", "retry_count") == [("d0", 5)]
    assert read_ledger(spark, ledgers.failure).count() == (5 if history else 1)


@pytest.mark.parametrize("history", [False, True])
def test_a_success_ends_source_counted_retries(spark, tmp_path, history):
    ledgers = Ledgers.at(str(tmp_path / "l"), buckets=2, history=history)
    for i, broken in enumerate((["d0", "d1"], ["d0"], ["d0"])):
        same = option(i, policy=SOURCE_COUNTED, work_dir=str(tmp_path / "w"))
        transfer_job(spark, docs(spark, 3), ledgers, service(broken), same)
        before = rows(tagged_ledgers(spark, ledgers))
        transfer_job(spark, docs(spark, 3), ledgers, service(), same)  # committed again: nothing changes
        assert rows(tagged_ledgers(spark, ledgers)) == before
    state = read_state(spark, ledgers)
    assert rows(state.failure, "document_id", "retry_count", "reprocess_success", "latest_correlation_id") == [
        ("d0", 3, 0, "run-2" if history else "run-0"), ("d1", 1, 1, "run-1" if history else "run-0")]
    if history:
        assert rows(read_ledger(spark, ledgers.failure), "document_id", "retry_count", "reprocess_success") == [
            ("d0", 1, 0), ("d0", 2, 0), ("d0", 3, 0), ("d1", 1, 0), ("d1", 1, 1)]


def test_latest_failures_against_plain_reduction(spark):
    import random
    rng = random.Random(2)
    some = [("a", f"d{rng.randrange(6)}", rng.randrange(4), rng.randrange(2)) for _ in range(60)]
    table = reduce(DataFrame.unionAll, [
        failure(spark, row, at=datetime(2024, 1, 1 + rng.randrange(5))) for row in some])
    best = {}
    for row in table.collect():
        order = (row.date_updated, row.reprocess_success, row.retry_count)
        if row.document_id not in best or order > best[row.document_id][0]:
            best[row.document_id] = order, (row.document_id, row.retry_count, row.reprocess_success)
    assert rows(latest_failures(table), "document_id", "retry_count", "reprocess_success") == sorted(b for _, b in best.values())
    loose = failure(spark, (None, "x", 1, 0), (None, "x", 2, 0))
    assert latest_failures(loose).count() == 2


def test_counting_cannot_be_mixed(spark, tmp_path):
    ledgers = Ledgers.at(str(tmp_path / "l"), buckets=2)
    transfer_job(spark, docs(spark, 1), ledgers, service(["d0"]), option(0))
    with pytest.raises(ValueError, match="counted_by_target"):
        transfer_job(spark, docs(spark, 1), ledgers, service(), option(1, policy=SOURCE_COUNTED))
    with pytest.raises(ValueError, match="history"):
        transfer_job(spark, docs(spark, 1), Ledgers.at(str(tmp_path / "h"), 2, history=True), service(), option(1))
    with pytest.raises(ValueError, match="inclusive"):
        RetryPolicy(5, inclusive=True, counted="source")
    with pytest.raises(ValueError, match="retry_count"):
        commit_outcomes(spark, Ledgers.at(str(tmp_path / "n"), 2), outcomes(spark, ("a", "x", 500)), counted="source")


def test_rows_that_are_left_are_worked_out_once(spark, tmp_path, monkeypatch):
    """Of a run that is cut anew; what was finished is committed at once, and only rows of its buckets are compared."""
    ledgers, plans, commits, left = Ledgers.at(str(tmp_path / "l"), buckets=4), [], [], [2]
    monkeypatch.setattr(job, "commit_outcomes", lambda *a, **k: commits.append(1) or commit_outcomes(*a, **k))
    send = service(["d1"])

    def dying(due, path, run):
        plans.append(due._jdf.queryExecution().optimizedPlan().toString())
        if not left[0]:
            raise InterruptedError
        left[0] -= 1
        return send(due, path, run)
    for batches in (4, 1):
        left[0] = 2 if batches == 4 else 1
        try:
            transfer_job(spark, docs(spark, 40), ledgers, dying, option(0, work_dir=str(tmp_path / "w"), batches=batches))
        except InterruptedError:
            pass
    assert len(plans) == 4 and not [plan for plan in plans if "Join" in plan]
    assert len(commits) == 2 + 2
    state = read_state(spark, ledgers)
    assert state.success.count() == 39 and rows(state.failure, "document_id", "retry_count") == [("d1", 0)]


def test_failures_tell_which_buckets_change(spark, tmp_path, monkeypatch):
    """Known failures are looked for only in buckets without a new one."""
    ledgers = Ledgers.at(str(tmp_path / "l"), buckets=1)
    commit_outcomes(spark, ledgers, outcomes(spark, ("a", "x", 503), run="run-0"))
    monkeypatch.setattr(plans_of, "_changed_buckets", None)
    commit_outcomes(spark, ledgers, outcomes(spark, ("a", "x", 200), ("a", "y", 503)))
    monkeypatch.undo()
    assert rows(read_state(spark, ledgers).failure, "document_id", "reprocess_success") == [("x", 1), ("y", 0)]
    commit_outcomes(spark, ledgers, outcomes(spark, ("a", "z", 500), ("a", "z", 200), ("a", "y", 200), run="run-2"))
    assert rows(read_state(spark, ledgers).failure, "document_id", "reprocess_success") == [("x", 1), ("y", 1)]
