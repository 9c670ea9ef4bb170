"""Ledger merges: every way a batch of outcomes changes a ledger."""

from pyspark.sql import functions as F

from docledger.operators.dispatch import split_outcomes
from docledger.operators.merge import merge, src, tgt
from docledger.plans import ledgers as plans
from docledger.registry.inputs import derived, query
from docledger.schemas import AUDIT, FAILURE, FAILURE_DETAILS, KEYS, SUCCESS
from docledger.session import fresh_dir
from docledger.sources.staging import stage
from docledger.sources.tables import append, append_once, read_appended, read_path


def _columns(schema, alias=""):
    return ", ".join(f"{alias}{name}" for name in schema.fieldNames())


def _on(a, b, keys=KEYS):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _absent(source, target, keys=KEYS):
    return f"NOT EXISTS (SELECT 1 FROM {target} t WHERE {_on('t', source, keys)})"


def _updated(schema, target, source, changes):
    """Target rows after an update: ``changes`` maps a column to its value on a match."""
    shown = ", ".join(
        f"CASE WHEN {changes[c][0]} THEN {changes[c][1]} ELSE t.{c} END AS {c}"
        if c in changes else f"t.{c}" for c in schema.fieldNames())
    return f"SELECT {shown} FROM {target} t LEFT JOIN {source} s ON {_on('t', 's')}"


_HIT = "s.document_id IS NOT NULL"
_NEW_SUCCESS = f"SELECT {_columns(SUCCESS)} FROM good s WHERE {_absent('s', 'success')}"
_NEW_FAILURE = f"SELECT {_columns(FAILURE)} FROM bad s WHERE {_absent('s', 'failure')}"
_BAD_DETAILS = """SELECT auth_request_id, document_id, latest_correlation_id AS correlation_id,
  latest_error_code AS error_code, latest_error_message AS error_message, date_created,
  date_updated, ar_number FROM bad"""
_NEW_DETAILS = (f"SELECT {_columns(FAILURE_DETAILS)} FROM ({_BAD_DETAILS}) s WHERE "
                + _absent("s", "details", KEYS + ("correlation_id",)))


@query("success_insert_if_absent", f"SELECT {_columns(SUCCESS)} FROM success UNION ALL {_NEW_SUCCESS}")
def success_insert_if_absent(spark, sf_dir):
    return plans.success_insert_if_absent(derived(spark, sf_dir, "success"),
                                          derived(spark, sf_dir, "good"))


@query("success_append", f"SELECT {_columns(SUCCESS)} FROM success UNION ALL "
       f"SELECT {_columns(SUCCESS)} FROM good")
def success_append(spark, sf_dir):
    return plans.success_append(derived(spark, sf_dir, "success"), derived(spark, sf_dir, "good"))


@query("success_upsert_all", _updated(SUCCESS, "success", "good", {
    c: (_HIT, f"s.{c}") for c in SUCCESS.fieldNames() if c not in KEYS})
    + f" UNION ALL {_NEW_SUCCESS}")
def success_upsert_all(spark, sf_dir):
    return plans.success_upsert_all(derived(spark, sf_dir, "success"),
                                    derived(spark, sf_dir, "good"))


# A failure the run has already counted (same correlation id) is left alone.
_COUNTED = f"{_HIT} AND t.latest_correlation_id <> s.latest_correlation_id"
_INCREMENT = _updated(FAILURE, "failure", "bad", {
    "retry_count": (_COUNTED, "t.retry_count + 1"),
    **{c: (_COUNTED, f"s.{c}") for c in ("latest_error_message", "latest_error_code",
                                         "latest_correlation_id", "date_updated")}})


@query("failure_upsert_increment", f"{_INCREMENT} UNION ALL {_NEW_FAILURE}")
def failure_upsert_increment(spark, sf_dir):
    return plans.failure_upsert_increment(derived(spark, sf_dir, "failure"),
                                          derived(spark, sf_dir, "bad"))


_SOURCE = "(SELECT * REPLACE (CAST(3 AS INTEGER) AS retry_count) FROM bad)"


@query("failure_upsert_source", _updated(FAILURE, "failure", _SOURCE, {
    c: (_HIT, f"s.{c}") for c in ("retry_count", "full_path", "reprocess_success",
                                  "latest_error_message", "latest_error_code", "date_updated")})
    + f" UNION ALL SELECT {_columns(FAILURE)} FROM {_SOURCE} s WHERE {_absent('s', 'failure')}")
def failure_upsert_source(spark, sf_dir):
    carried = derived(spark, sf_dir, "bad").withColumn("retry_count", F.lit(3))
    return plans.failure_upsert_source(derived(spark, sf_dir, "failure"), carried)


@query("failure_upsert_source_plain", _updated(FAILURE, "failure", _SOURCE, {
    c: (_HIT, f"s.{c}") for c in ("retry_count", "full_path", "reprocess_success")})
    + f" UNION ALL SELECT {_columns(FAILURE)} FROM {_SOURCE} s WHERE {_absent('s', 'failure')}")
def failure_upsert_source_plain(spark, sf_dir):
    """Without the error and the updated date."""
    carried = derived(spark, sf_dir, "bad").withColumn("retry_count", F.lit(3))
    return plans.failure_upsert_source(derived(spark, sf_dir, "failure"), carried, with_error=False)


@query("failure_upsert_all", _updated(FAILURE, "failure", "bad", {
    c: (_HIT, f"s.{c}") for c in FAILURE.fieldNames() if c not in KEYS})
    + f" UNION ALL {_NEW_FAILURE}")
def failure_upsert_all(spark, sf_dir):
    return plans.failure_upsert_all(derived(spark, sf_dir, "failure"), derived(spark, sf_dir, "bad"))


@query("failure_append", f"SELECT {_columns(FAILURE)} FROM failure UNION ALL "
       f"SELECT {_columns(FAILURE)} FROM bad")
def failure_append(spark, sf_dir):
    return plans.failure_append(derived(spark, sf_dir, "failure"), derived(spark, sf_dir, "bad"))


_OPEN = f"{_HIT} AND t.reprocess_success = 0"


@query("mark_reprocessed_guarded", _updated(FAILURE, "failure", "good", {
    "reprocess_success": (_OPEN, "1"), "date_updated": (_OPEN, "s.date_updated")}))
def mark_reprocessed_guarded(spark, sf_dir):
    return plans.mark_reprocessed(derived(spark, sf_dir, "failure"), derived(spark, sf_dir, "good"))


@query("mark_reprocessed_unguarded", _updated(FAILURE, "failure", "good", {
    "reprocess_success": (_HIT, "1")}))
def mark_reprocessed_unguarded(spark, sf_dir):
    return plans.mark_reprocessed(derived(spark, sf_dir, "failure"), derived(spark, sf_dir, "good"),
                                  guarded=False)


@query("mark_reprocessed_unguarded_dated", _updated(FAILURE, "failure", "good", {
    "reprocess_success": (_HIT, "1"), "date_updated": (_HIT, "s.date_updated")}))
def mark_reprocessed_unguarded_dated(spark, sf_dir):
    return plans.mark_reprocessed(derived(spark, sf_dir, "failure"), derived(spark, sf_dir, "good"),
                                  guarded=False, dated=True)


@query("reprocessed_rows", f"""SELECT auth_request_id, document_id, correlation_id AS
  latest_correlation_id, CAST(2 AS INTEGER) AS retry_count, full_path,
  CAST(1 AS INTEGER) AS reprocess_success, CAST(NULL AS VARCHAR) AS latest_error_message,
  CAST(NULL AS INTEGER) AS latest_error_code, date_created, date_updated, ar_number FROM good s
WHERE EXISTS (SELECT 1 FROM failure t WHERE {_on('t', 's')} AND t.reprocess_success = 0)""")
def reprocessed_rows(spark, sf_dir):
    carried = derived(spark, sf_dir, "good").withColumn("retry_count", F.lit(2))
    return plans.reprocessed_rows(carried, derived(spark, sf_dir, "failure"))


@query("detail_rows", _BAD_DETAILS)
def detail_rows(spark, sf_dir):
    return plans.detail_rows(derived(spark, sf_dir, "bad"))


@query("failure_reasons", """SELECT to_json(struct_pack(auth_request_id := auth_request_id,
  document_id := document_id, ar_number := ar_number, full_path := full_path)) AS record,
  error_message AS reason FROM outcomes WHERE NOT ok""")
def failure_reasons(spark, sf_dir):
    return plans.failure_reasons(derived(spark, sf_dir, "outcomes"))


@query("details_insert_if_absent", f"SELECT {_columns(FAILURE_DETAILS)} FROM details UNION ALL "
       + _NEW_DETAILS)
def details_insert_if_absent(spark, sf_dir):
    return plans.details_insert_if_absent(derived(spark, sf_dir, "details"),
                                          plans.detail_rows(derived(spark, sf_dir, "bad")))


@query("details_append", f"SELECT {_columns(FAILURE_DETAILS)} FROM details UNION ALL {_BAD_DETAILS}")
def details_append(spark, sf_dir):
    return plans.details_append(derived(spark, sf_dir, "details"),
                                plans.detail_rows(derived(spark, sf_dir, "bad")))


_AUDIT_SQL = """SELECT auth_request_id, document_id AS annotation_id, full_path,
  CASE WHEN ok THEN 'Success' ELSE 'Failed' END AS status,
  CAST(CASE WHEN ok THEN 200 ELSE error_code END AS BIGINT) AS status_code,
  target_path AS azure_blob_path, execution_time_ms, COALESCE(error_message, '') AS message
FROM outcomes"""


@query("audit_append", _AUDIT_SQL)
def audit_append(spark, sf_dir):
    """Written as two appends, successes and failures, and read back."""
    path = fresh_dir(spark, "audit")
    outcomes = derived(spark, sf_dir, "outcomes")
    append(plans.audit_entries(outcomes.filter("ok")), path)
    append(plans.audit_entries(outcomes.filter("NOT ok")), path)
    return read_path(spark, path, schema=AUDIT)


@query("audit_append_once", _AUDIT_SQL)
def audit_append_once(spark, sf_dir):
    """Two batches of a run, the second of which died after its append and is repeated, as is the whole first run."""
    path = fresh_dir(spark, "audit")
    entries = [plans.audit_entries(derived(spark, sf_dir, "outcomes").filter(side)) for side in ("ok", "NOT ok")]
    for batch in (0, 1, 1, 0):
        append_once(entries[batch], path, "run-1", batch)
    return read_appended(spark, path, AUDIT)


@query("ledger_append_once", f"SELECT {_columns(FAILURE)} FROM failure UNION ALL SELECT {_columns(FAILURE)} FROM bad")
def ledger_append_once(spark, sf_dir):
    """A failure history as an append-only table; the same run appended three times is there once."""
    path = fresh_dir(spark, "history")
    append_once(derived(spark, sf_dir, "failure"), path, "run-0")
    for _ in range(3):
        append_once(derived(spark, sf_dir, "bad").withColumn("retry_count", F.lit(0)), path, "run-1")
    return read_appended(spark, path, FAILURE)


@query("split_outcomes", f"SELECT document_id, 'good' AS side, correlation_id, date_updated FROM good "
       "UNION ALL SELECT document_id, 'bad', latest_correlation_id, date_updated FROM bad")
def split_outcomes_query(spark, sf_dir):
    good, bad = split_outcomes(derived(spark, sf_dir, "outcomes"))
    return good.select("document_id", F.lit("good").alias("side"), "correlation_id",
                       "date_updated").unionAll(
        bad.select("document_id", F.lit("bad").alias("side"), "latest_correlation_id",
                   "date_updated"))


@query("merge", f"""SELECT t.auth_request_id, t.document_id, t.full_path, CAST(CASE WHEN {_OPEN}
  AND s.ok THEN t.retry_count + s.execution_time_ms ELSE t.retry_count END AS INTEGER) AS retry_count
FROM failure t LEFT JOIN outcomes s ON {_on('t', 's')}
UNION ALL SELECT auth_request_id, document_id, 'new' AS full_path, CAST(execution_time_ms AS INTEGER)
FROM outcomes s WHERE NOT ok AND {_absent('s', 'failure')}""")
def merge_query(spark, sf_dir):
    """The general form: conditional update, conditional insert, values from both sides."""
    target = derived(spark, sf_dir, "failure").select(*KEYS, "full_path", "retry_count",
                                                      "reprocess_success")
    merged = merge(
        target, derived(spark, sf_dir, "outcomes"), KEYS,
        matched_set={"retry_count": (tgt("retry_count") + src("execution_time_ms")).cast("int")},
        matched_if=src("ok") & (tgt("reprocess_success") == 0),
        insert_values={**{k: src(k) for k in KEYS}, "full_path": F.lit("new"),
                       "retry_count": src("execution_time_ms")},
        insert_if=~src("ok"))
    return merged.drop("reprocess_success")


def _tagged(success, failure, details):
    """The three ledgers' SQL as one table with a tag."""
    columns = {}
    for schema in (SUCCESS, FAILURE, FAILURE_DETAILS):
        columns.update({f.name: f.dataType.simpleString() for f in schema.fields})
    sql_types = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT",
                 "timestamp": "TIMESTAMP"}

    def side(tag, schema, sql):
        listed = ", ".join(c if c in schema.fieldNames() else
                           f"CAST(NULL AS {sql_types[kind]}) AS {c}" for c, kind in columns.items())
        return f"SELECT {listed}, '{tag}' AS ledger FROM ({sql})"

    return " UNION ALL ".join((side("success", SUCCESS, success), side("failure", FAILURE, failure),
                               side("details", FAILURE_DETAILS, details)))


def applied_sql(outcomes_cte, counted="target", history=False):
    """All three ledgers after the outcomes of a CTE named ``due``.

    Source-counted outcomes have a ``retry_count``; with ``history`` failures are kept as rows of their own.
    """
    first = "0" if counted == "target" else "retry_count + 1"
    if counted == "target":
        marked = "(" + _updated(FAILURE, "failure", "due_good", {
            "reprocess_success": (_OPEN, "1"), "date_updated": (_OPEN, "s.date_updated")}) + ")"
        kept = _updated(FAILURE, marked, "due_bad", {
            "retry_count": (_COUNTED, "t.retry_count + 1"),
            **{c: (_COUNTED, f"s.{c}") for c in ("latest_error_message", "latest_error_code",
                                                 "latest_correlation_id", "date_updated")}})
    else:
        marked = "(" + _updated(FAILURE, "failure", "due_good", {
            "reprocess_success": (_HIT, "1"), "date_updated": (_HIT, "s.date_updated")}) + ")"
        kept = _updated(FAILURE, marked, "due_bad", {
            c: (_HIT, f"s.{c}") for c in ("retry_count", "full_path", "reprocess_success", "latest_error_message",
                                          "latest_error_code", "date_updated")})
    fresh = f"SELECT {_columns(FAILURE)} FROM due_bad s WHERE {_absent('s', 'failure')}"
    if history:
        kept = f"SELECT {_columns(FAILURE)} FROM failure"
        fresh = f"""SELECT {_columns(FAILURE)} FROM due_bad UNION ALL SELECT auth_request_id, document_id,
  correlation_id, CAST(retry_count AS INTEGER), full_path, CAST(1 AS INTEGER), CAST(NULL AS VARCHAR),
  CAST(NULL AS INTEGER), finished_at, finished_at, ar_number FROM due s WHERE ok
  AND EXISTS (SELECT 1 FROM failure t WHERE {_on('t', 's')} AND t.reprocess_success = 0)"""
    good = f"SELECT {_columns(SUCCESS)} FROM due_good s WHERE {_absent('s', 'success')}"
    due_details = _BAD_DETAILS.replace("FROM bad", "FROM due_bad")
    details = (f"SELECT {_columns(FAILURE_DETAILS)} FROM ({due_details}) s WHERE "
               + _absent("s", "details", KEYS + ("correlation_id",)))
    return f"""WITH {outcomes_cte}, due_good AS (SELECT auth_request_id, document_id,
  correlation_id, full_path, target_path, execution_time_ms, finished_at AS date_created,
  finished_at AS date_updated, ar_number FROM due WHERE ok),
due_bad AS (SELECT auth_request_id, document_id, correlation_id AS latest_correlation_id,
  CAST({first} AS INTEGER) AS retry_count, full_path, CAST(0 AS INTEGER) AS reprocess_success,
  error_message AS latest_error_message, error_code AS latest_error_code,
  finished_at AS date_created, finished_at AS date_updated, ar_number FROM due WHERE NOT ok)
{_tagged(f"SELECT {_columns(SUCCESS)} FROM success UNION ALL {good}",
         f"{kept} UNION ALL {fresh}",
         f"SELECT {_columns(FAILURE_DETAILS)} FROM details UNION ALL {details}")}"""


@query("apply_outcomes", applied_sql("due AS (SELECT * FROM outcomes)"))
def apply_outcomes(spark, sf_dir):
    success, failure, details, outcomes = [
        stage(derived(spark, sf_dir, name), fresh_dir(spark, name))
        for name in ("success", "failure", "details", "outcomes")]
    after = plans.apply_outcomes(plans.LedgerState(success, failure, details), outcomes)
    return (after.success.withColumn("ledger", F.lit("success"))
            .unionByName(after.failure.withColumn("ledger", F.lit("failure")), True)
            .unionByName(after.details.withColumn("ledger", F.lit("details")), True))
