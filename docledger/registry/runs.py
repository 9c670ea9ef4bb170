"""Dispatch, whole runs, streams and table round trips."""

import uuid
from contextlib import contextmanager, nullcontext
from datetime import datetime, timezone

from pyspark.sql import functions as F

from docledger.functions.timing import instant, iso_text
from docledger.operators.dispatch import AttemptPolicy, Reply, ServiceError, dispatch
from docledger.operators.worklist import SOURCE_COUNTED, Backoff, RetryPolicy, worklist
from docledger.plans.job import JobOptions, sending, tagged_ledgers, transfer_job
from docledger.registry.inputs import CREATED, RUN_AT, derived, query
from docledger.registry.ledgers import applied_sql
from docledger.registry.sets import WORKLIST_SQL
from docledger.schemas import CARRIED, MANIFEST, OUTCOME
from docledger.session import fresh_dir
from docledger.sources import tables
from docledger.sources.files import open_root
from docledger.sources.ledger import Ledgers, read_ledger, read_seen, write_version
from docledger.sources.staging import stage
from docledger.streaming.microbatch import per_batch_apply, transfer_stream

NO_WAIT = AttemptPolicy(sleep=lambda seconds: None)
NO_RETRY = RetryPolicy(limit=-1)


def answer(client, row):
    """A service that answers by document number, always the same way."""
    number = int(row["document_id"][len("DOC-"):])
    code = {6: 404, 7: 429, 8: 500, 9: 503}.get(number % 10, 200)
    took = 1 + number % 900
    if code != 200:
        return Reply(code, '{"message":"code %d"}' % code, took)
    return Reply(200, '{"status":"Success","azure_blob_path":"documents/%s/doc_%d.pdf"}'
                 % (row["ar_number"], number), took)


# The rows due, as the service above answers them.
_ANSWERED = """SELECT w.auth_request_id, w.document_id, w.ar_number, w.full_path,
  'run-9' AS correlation_id, code = 200 AS ok,
  CAST(CASE WHEN code <> 200 THEN code END AS INTEGER) AS error_code,
  CASE WHEN code <> 200 THEN 'code '||code END AS error_message,
  CASE WHEN code = 200 THEN 'documents/'||w.ar_number||'/'||file_name END AS target_path,
  CAST(CASE WHEN code IN (429, 500, 503) THEN 3 ELSE 1 END AS INTEGER) AS attempts,
  CAST(1 + o_orderkey % 900 AS BIGINT) AS execution_time_ms,
  TIMESTAMP '2024-02-01 00:00:00' AS finished_at"""
_DUE = f"due AS ({_ANSWERED} FROM ({WORKLIST_SQL}) w JOIN docs USING (document_id))"


def _due(spark, sf_dir):
    return worklist(*[derived(spark, sf_dir, n) for n in ("manifest", "success", "failure")])


@query("dispatch", f"""WITH {_DUE} SELECT auth_request_id, document_id, ar_number, full_path,
  correlation_id, ok, error_code, error_message, target_path, attempts, execution_time_ms FROM due""")
def dispatch_query(spark, sf_dir):
    outcomes = dispatch(_due(spark, sf_dir), answer, stage_path=fresh_dir(spark, "outcomes"),
                        correlation_id="run-9", policy=NO_WAIT)
    return outcomes.drop("bytes", "sha256", "started_at", "finished_at", *CARRIED.fieldNames())


@query("dispatch_concurrent", f"""WITH {_DUE} SELECT document_id, ok, error_code, target_path,
  execution_time_ms FROM due""")
def dispatch_concurrent(spark, sf_dir):
    """The same with several calls at a time in each task, one client per task and a rate limit."""
    outcomes = dispatch(_due(spark, sf_dir), answer, stage_path=fresh_dir(spark, "outcomes"),
                        correlation_id="run-9", policy=NO_WAIT, open_client=nullcontext,
                        concurrency=4, rate=1e9)
    return outcomes.select("document_id", "ok", "error_code", "target_path", "execution_time_ms")


def filled_ledgers(spark, sf_dir, buckets=4, **kind):
    """Ledgers on disk as earlier runs left them."""
    ledgers = Ledgers.at(fresh_dir(spark, "ledgers"), buckets, **kind)
    for ledger, name in ((ledgers.success, "success"), (ledgers.failure, "failure"),
                         (ledgers.details, "details")):
        write_version(spark, ledger, derived(spark, sf_dir, name))
    return ledgers


@query("transfer_job", applied_sql(_DUE))
def transfer_job_query(spark, sf_dir):
    ledgers = filled_ledgers(spark, sf_dir)
    transfer_job(spark, derived(spark, sf_dir, "manifest"), ledgers, sending(answer, policy=NO_WAIT),
                 JobOptions(run_id="run-9", at=instant(RUN_AT)))
    return tagged_ledgers(spark, ledgers)


@query("dispatch_throttled", f"""SELECT count(*) AS calls, TRUE AS all_known, TRUE AS within_rate
  FROM ({WORKLIST_SQL}) w""")
def dispatch_throttled(spark, sf_dir):
    """All calls in about three seconds, by more tasks than can run at a time: never faster than the rate allows."""
    due = stage(_due(spark, sf_dir), fresh_dir(spark, "due"))
    rate = due.count() / 3
    outcomes = dispatch(due, answer, stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-9",
                        policy=AttemptPolicy(attempts=1), rate=rate, partitions=24, concurrency=2)
    spent = (F.unix_micros(F.max("started_at")) - F.unix_micros(F.min("started_at"))) / 1e6
    # Each task may begin with a call at once.
    return outcomes.agg(F.count("*").alias("calls"), F.bool_and(F.col("ok").isNotNull()).alias("all_known"),
                        ((F.count("*") - 24) / spent <= 1.1 * rate).alias("within_rate"))


class Counted:
    """A service whose connections leave a file each in a folder that all tasks share."""

    def __init__(self, folder):
        self.folder = folder

    @contextmanager
    def open_client(self):
        fs, base = open_root(self.folder)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{uuid.uuid4().hex}") as out:
            out.write(b".")  # scans pass over empty files
        yield base


@query("client_reuse", f"""SELECT count(*) AS calls, TRUE AS all_ok_known, CAST(64 AS BIGINT) AS tasks,
  TRUE AS fewer_connections_than_tasks FROM ({WORKLIST_SQL}) w""")
def client_reuse(spark, sf_dir):
    """Clients stay open in their Python workers: many tasks, few connections."""
    service = Counted(fresh_dir(spark, "connections"))
    outcomes = dispatch(_due(spark, sf_dir), answer, stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-9",
                        policy=NO_WAIT, open_client=service.open_client, partitions=64, concurrency=2, keep_clients=60)
    opened = spark.read.format("binaryFile").load(service.folder).select(F.lit(1).alias("n"))
    calls = outcomes.agg(F.count("*").alias("calls"), F.bool_and(F.col("ok").isNotNull()).alias("all_ok_known"))
    few = opened.agg(F.count("n").alias("n")).select(
        F.lit(64).cast("bigint").alias("tasks"), F.col("n").between(1, 63).alias("fewer_connections_than_tasks"))
    return calls.withColumn("one", F.lit(1)).join(few.withColumn("one", F.lit(1)), "one").drop("one")


@query("worklist_filtered", WORKLIST_SQL)
def worklist_filtered(spark, sf_dir):
    """Documents that a Bloom filter over both ledgers does not hold go around the join."""
    ledgers = filled_ledgers(spark, sf_dir, filter_keys=20_000)
    return worklist(derived(spark, sf_dir, "manifest"), read_ledger(spark, ledgers.success),
                    read_ledger(spark, ledgers.failure), seen=read_seen(spark, ledgers.success, ledgers.failure))


@query("transfer_job_batches", applied_sql(_DUE))
def transfer_job_batches(spark, sf_dir):
    """The same run in two commits, each over half of the ledgers' buckets."""
    ledgers = filled_ledgers(spark, sf_dir)
    transfer_job(spark, derived(spark, sf_dir, "manifest"), ledgers, sending(answer, policy=NO_WAIT),
                 JobOptions(run_id="run-9", at=instant(RUN_AT), batches=2))
    return tagged_ledgers(spark, ledgers)


@query("transfer_job_two_runs", applied_sql(_DUE))
def transfer_job_two_runs(spark, sf_dir):
    """Two runs that share a work folder: the first over half of the manifest, its calls not repeated."""
    ledgers, work = filled_ledgers(spark, sf_dir), fresh_dir(spark, "shared-work")
    manifest = derived(spark, sf_dir, "manifest")
    empty = Ledgers.at(fresh_dir(spark, "ledgers"), 4)
    transfer_job(spark, manifest.where("length(document_id) % 2 = 0"), empty, sending(answer, policy=NO_WAIT),
                 JobOptions(run_id="run-8", at=instant(RUN_AT), work_dir=work))
    transfer_job(spark, manifest, ledgers, sending(answer, policy=NO_WAIT),
                 JobOptions(run_id="run-9", at=instant(RUN_AT), work_dir=work))
    return tagged_ledgers(spark, ledgers)


@query("transfer_job_rebatched", applied_sql(_DUE))
def transfer_job_rebatched(spark, sf_dir):
    """A run in four batches that died after the first, repeated in two and, dying again, in one."""
    ledgers, work = filled_ledgers(spark, sf_dir), fresh_dir(spark, "work")
    manifest, whole = derived(spark, sf_dir, "manifest"), sending(answer, policy=NO_WAIT)

    def dies_after(calls):
        left = [calls]

        def run(rows, stage_path, correlation_id):
            if not left[0]:
                raise InterruptedError("died")
            left[0] -= 1
            return whole(rows, stage_path, correlation_id)
        return run

    for batches, dispatcher in ((4, dies_after(1)), (2, dies_after(1)), (1, whole)):
        try:
            transfer_job(spark, manifest, ledgers, dispatcher,
                         JobOptions(run_id="run-9", at=instant(RUN_AT), batches=batches, work_dir=work))
        except InterruptedError:
            pass
    return tagged_ledgers(spark, ledgers)


_DUE_SOURCE = (f"due AS ({_ANSWERED.replace('SELECT', 'SELECT w.retry_count,', 1)} FROM "
               f"({WORKLIST_SQL.replace('<= 5', '< 5')}) w JOIN docs USING (document_id))")


@query("transfer_job_source_counted", applied_sql(_DUE_SOURCE, counted="source"))
def transfer_job_source_counted(spark, sf_dir):
    """Attempts carry their count; the ledger stores it, plus one."""
    ledgers = filled_ledgers(spark, sf_dir)
    transfer_job(spark, derived(spark, sf_dir, "manifest"), ledgers, sending(answer, policy=NO_WAIT),
                 JobOptions(run_id="run-9", at=instant(RUN_AT), policy=SOURCE_COUNTED))
    return tagged_ledgers(spark, ledgers)


@query("transfer_job_history", applied_sql(_DUE_SOURCE, counted="source", history=True))
def transfer_job_history(spark, sf_dir):
    """Failures kept as a row for each attempt, and one for each document that succeeds at last; in two batches."""
    ledgers = filled_ledgers(spark, sf_dir, history=True)
    transfer_job(spark, derived(spark, sf_dir, "manifest"), ledgers, sending(answer, policy=NO_WAIT),
                 JobOptions(run_id="run-9", at=instant(RUN_AT), policy=SOURCE_COUNTED, batches=2))
    return tagged_ledgers(spark, ledgers)


def _without_run_number(df):
    """Micro-batches number the run id; which one a row fell into is not part of the result."""
    return df.withColumns({c: F.regexp_replace(c, "^run-9-([0-9]+|retry)$", "run-9")
                           for c in ("correlation_id", "latest_correlation_id")})


@query("transfer_stream", applied_sql(_DUE))
def transfer_stream_query(spark, sf_dir):
    """The run as micro-batches over a manifest folder of six files."""
    ledgers = filled_ledgers(spark, sf_dir)
    work = fresh_dir(spark, "stream")
    derived(spark, sf_dir, "manifest").repartition(6).write.parquet(f"{work}/manifest")
    stream = transfer_stream(spark, f"{work}/manifest", ledgers, sending(answer, policy=NO_WAIT),
                             run_id="run-9", work_dir=work, at=instant(RUN_AT), files_per_batch=3)
    stream.awaitTermination()
    return _without_run_number(tagged_ledgers(spark, ledgers))


@query("transfer_stream_retries", applied_sql(_DUE))
def transfer_stream_retries(spark, sf_dir):
    """A run without any new file retries what is due; the run before it takes the new documents."""
    ledgers = filled_ledgers(spark, sf_dir)
    work = fresh_dir(spark, "stream")
    derived(spark, sf_dir, "manifest").write.parquet(f"{work}/manifest")
    new = Ledgers.at(fresh_dir(spark, "ledgers"), 4)
    for name in ("success", "failure", "details"):
        write_version(spark, getattr(new, name), derived(spark, sf_dir, name).limit(0))
    send = sending(answer, policy=NO_WAIT)
    transfer_stream(spark, f"{work}/manifest", new, send, run_id="run-9-0", work_dir=work,
                    at=instant(RUN_AT)).awaitTermination()
    transfer_stream(spark, f"{work}/manifest", ledgers, send, run_id="run-9", work_dir=work,
                    at=instant(RUN_AT)).awaitTermination()
    transfer_job(spark, derived(spark, sf_dir, "manifest"), ledgers, send,
                 JobOptions(run_id="run-9", at=instant(RUN_AT), work_dir=work, policy=NO_RETRY))
    return _without_run_number(tagged_ledgers(spark, ledgers))


_LATER = "2024-03-20 00:00:00"
_DUE_TWICE = f"""WITH base AS ({applied_sql(_DUE)}),
again AS (SELECT * FROM base WHERE ledger = 'failure' AND retry_count <= 5 AND reprocess_success = 0
  AND latest_error_code <> 429)
SELECT * FROM base WHERE ledger <> 'failure' UNION ALL BY NAME
SELECT b.* FROM base b WHERE ledger = 'failure'
  AND NOT EXISTS (SELECT 1 FROM again a WHERE a.document_id = b.document_id) UNION ALL BY NAME
SELECT * REPLACE (CAST(retry_count + 1 AS INTEGER) AS retry_count, 'run-10' AS latest_correlation_id,
  TIMESTAMP '{_LATER}' AS date_updated) FROM again UNION ALL BY NAME
SELECT auth_request_id, document_id, 'run-10' AS correlation_id, latest_error_code AS error_code,
  latest_error_message AS error_message, TIMESTAMP '{_LATER}' AS date_created,
  TIMESTAMP '{_LATER}' AS date_updated, ar_number, 'details' AS ledger FROM again"""


def asking(client, row):
    """The service, asking for some years of peace where it answers 429."""
    reply = answer(client, row)
    if reply.code == 429:
        raise ServiceError(429, reply.body, retry_after=5 * 365 * 86_400.0)
    return reply


@query("transfer_stream_due", _DUE_TWICE)
def transfer_stream_due(spark, sf_dir):
    """Three runs by the clock: all is due, nothing is, and then what no service has put off."""
    ledgers = filled_ledgers(spark, sf_dir)
    work = fresh_dir(spark, "stream")
    derived(spark, sf_dir, "manifest").write.parquet(f"{work}/manifest")
    send = sending(asking, policy=AttemptPolicy(hold=60, sleep=lambda seconds: None))
    for run, now in (("run-9", RUN_AT), ("run-none", "2024-02-01 06:00:00"), ("run-10", _LATER)):
        at = datetime.fromisoformat(now).replace(tzinfo=timezone.utc)
        transfer_stream(spark, f"{work}/manifest", ledgers, send, run_id=run, work_dir=work, at=instant(now),
                        backoff=Backoff(first=86_400, longest=30 * 86_400), clock=lambda at=at: at).awaitTermination()
    return tagged_ledgers(spark, ledgers).withColumns({
        c: F.regexp_replace(c, "^(run-[0-9]+)-([0-9]+|retry)$", "$1")
        for c in ("correlation_id", "latest_correlation_id")})


@query("per_batch_apply", "SELECT * FROM manifest")
def per_batch_apply_query(spark, sf_dir):
    """A folder of files taken two at a time, each batch finished before the next."""
    work = fresh_dir(spark, "batches")
    derived(spark, sf_dir, "manifest").repartition(5).write.parquet(f"{work}/in")

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{work}/out/batch={batch_id}")
    per_batch_apply(spark, f"{work}/in", MANIFEST, write, f"{work}/checkpoint",
                    files_per_batch=2).awaitTermination()
    return tables.read_path(spark, f"{work}/out").drop("batch")


# --- tables ---------------------------------------------------------------------------------

@query("append", "SELECT * FROM manifest UNION ALL SELECT * FROM manifest")
def append_query(spark, sf_dir):
    path = fresh_dir(spark, "appended")
    manifest = derived(spark, sf_dir, "manifest")
    tables.append(manifest, path)
    tables.append(manifest, path)
    return tables.read_path(spark, path, schema=MANIFEST)




@query("ledger_round_trip", "SELECT 'success' AS ledger, document_id, ar_number, date_updated FROM "
       "success UNION ALL SELECT 'failure', document_id, ar_number, date_updated FROM failure "
       "UNION ALL SELECT 'details', document_id, ar_number, date_updated FROM details")
def ledger_round_trip(spark, sf_dir):
    """Current snapshot of each ledger, written and read back."""
    tagged = tagged_ledgers(spark, filled_ledgers(spark, sf_dir))
    return tagged.select("ledger", "document_id", "ar_number", "date_updated")


@query("csv_manifest", "SELECT full_path, auth_request_id, document_id AS annotation_id FROM located")
def csv_manifest(spark, sf_dir):
    """Columns in another order, and one that is not asked for."""
    path = fresh_dir(spark, "csv")
    rows = derived(spark, sf_dir, "located").select(
        F.col("document_id").alias("annotation_id"), "ar_number", "auth_request_id", "full_path")
    rows.write.csv(path, header=True, escape='"')
    return tables.read_manifest_csv(spark, path)


@query("csv_audit", """SELECT ' '||file_name||chr(10)||'"x" ' AS file_name, full_path, auth_request_id,
  document_id AS annotation_id, '2024-02-01T00:00:00' AS uploaded_at FROM located""")
def csv_audit(spark, sf_dir):
    """Names with blanks at both ends, a line feed and quotes."""
    rows = derived(spark, sf_dir, "located").withColumns({
        "annotation_id": F.col("document_id"),
        "file_name": F.concat(F.lit(" "), "file_name", F.lit('\n"x" '))})
    return tables.write_audit_csv(tables.audit_rows(rows, iso_text(instant(RUN_AT))),
                                  fresh_dir(spark, "audit-csv"), instant(RUN_AT))


@query("ensure_tables", """SELECT auth_request_id, document_id, file_name, 'F-'||document_id AS fhir_id,
  CAST(1 AS INTEGER) AS fhir_network, TIMESTAMP '2024-01-01 00:00:00' AS date_created,
  TIMESTAMP '2024-01-01 00:00:00' AS date_updated FROM manifest""")
def ensure_tables(spark, sf_dir):
    """Create the cross-reference tables twice, fill one by name and read it as a table."""
    database = f"crossref_{uuid.uuid4().hex[:12]}"
    folder = fresh_dir(spark, "crossref")
    tables.ensure_tables(spark, database=database, location=folder)
    at = instant(CREATED)
    rows = derived(spark, sf_dir, "manifest").select(
        "auth_request_id", "document_id", "file_name",
        F.concat(F.lit("F-"), "document_id").alias("fhir_id"), F.lit(1).alias("fhir_network"),
        at.alias("date_created"), at.alias("date_updated"))
    rows.write.insertInto(f"{database}.document_fhir")
    tables.ensure_tables(spark, database=database, location=folder)
    return tables.read_table(spark, f"{database}.document_fhir")


@query("outcomes_df", "SELECT document_id, ok, error_code, execution_time_ms FROM outcomes")
def outcomes_df(spark, sf_dir):
    """Outcome rows under the fixed schema, whatever is NULL in them."""
    path = fresh_dir(spark, "outcomes")
    tables.append(derived(spark, sf_dir, "outcomes"), path)
    rows = tables.read_path(spark, path, schema=OUTCOME)
    return rows.select("document_id", "ok", "error_code", "execution_time_ms")


@query("bucketed_worklist", WORKLIST_SQL)
def bucketed_worklist(spark, sf_dir):
    """Manifest and ledgers as tables bucketed by key: the worklist needs no shuffle."""
    stem, folder = f"b_{uuid.uuid4().hex[:12]}", fresh_dir(spark, "bucketed")
    parts = [tables.create_bucketed(derived(spark, sf_dir, name), f"{stem}_{name}",
                                    ("auth_request_id", "document_id"), 4, f"{folder}/{name}")
             for name in ("manifest", "success", "failure")]
    return worklist(*parts)
