"""Worklist, keyed joins, set operations, batches and counters."""

from pyspark.sql import functions as F

from docledger.functions import messages
from docledger.functions.paths import full_path
from docledger.functions.timing import instant
from docledger.operators import batching, keys, summary, worklist as wl
from docledger.registry.inputs import RUN_AT, derived, load, query
from docledger.sources import tables

_ABSENT = ("NOT EXISTS (SELECT 1 FROM {0} k WHERE k.auth_request_id = d.auth_request_id "
           "AND k.document_id = d.document_id)")
_NEW = f"""SELECT auth_request_id, document_id, ar_number, full_path,
  CAST(0 AS INTEGER) AS retry_count, CAST(0 AS INTEGER) AS reprocess_success
FROM located d WHERE root_folder IS NOT NULL
  AND {_ABSENT.format('success')} AND {_ABSENT.format('failure')}"""
_RETRY = """SELECT auth_request_id, document_id, ar_number, full_path, retry_count, reprocess_success
FROM failure WHERE retry_count <= 5 AND reprocess_success = 0"""
WORKLIST_SQL = f"{_NEW} UNION ALL {_RETRY}"


def _inputs(spark, sf_dir, *names):
    return [derived(spark, sf_dir, n) for n in names]


@query("worklist", WORKLIST_SQL)
def worklist(spark, sf_dir):
    return wl.worklist(*_inputs(spark, sf_dir, "manifest", "success", "failure"))


@query("worklist_skip_succeeded_retries", f"{_NEW} UNION ALL SELECT d.* FROM ({_RETRY}) d WHERE "
       + _ABSENT.format("success"))
def worklist_skip_succeeded_retries(spark, sf_dir):
    return wl.worklist(*_inputs(spark, sf_dir, "manifest", "success", "failure"),
                       skip_succeeded_retries=True)


@query("worklist_over_history", WORKLIST_SQL)
def worklist_over_history(spark, sf_dir):
    """Ledgers that keep a row per attempt: each key is there twice."""
    manifest, success, failure = _inputs(spark, sf_dir, "manifest", "success", "failure")
    old = failure.withColumn("reprocess_success", F.lit(1))
    return wl.worklist(manifest, success.unionAll(success), failure.unionAll(old),
                       repeated_keys=True)


for _mode, _sql in {
    "single": "root_folder||chr(92)||container_folder||chr(92)||file_name",
    "double": "root_folder||chr(92)||chr(92)||container_folder||chr(92)||chr(92)||file_name",
    "unc": "chr(92)||chr(92)||root_folder||chr(92)||container_folder||chr(92)||file_name",
    "skip_null": "concat_ws(chr(92)||chr(92), root_folder, container_folder, file_name)",
}.items():
    @query(f"full_path_{_mode}", f"SELECT document_id, {_sql} AS full_path FROM manifest")
    def _full_path(spark, sf_dir, mode=_mode):
        return derived(spark, sf_dir, "manifest").select(
            "document_id", full_path("root_folder", "container_folder", "file_name",
                                     mode).alias("full_path"))


@query("has_root", "SELECT * FROM manifest WHERE root_folder IS NOT NULL")
def has_root(spark, sf_dir):
    return wl.has_root(derived(spark, sf_dir, "manifest"))


@query("canonicalise", "SELECT auth_request_id, document_id, ar_number, root_folder, "
       "container_folder, file_name FROM manifest")
def canonicalise(spark, sf_dir):
    """The orders table's own names stand for a foreign lake's."""
    foreign = derived(spark, sf_dir, "manifest").select(
        F.col("auth_request_id").alias("Request"), F.col("document_id").alias("Annotation"),
        F.col("ar_number").alias("Name"), "root_folder", "container_folder", "file_name")
    renamed = wl.canonicalise(foreign, {"Request": "auth_request_id", "Annotation": "document_id",
                                        "Name": "ar_number"})
    return wl.project(renamed, ["auth_request_id", "document_id", "ar_number", "root_folder",
                                "container_folder", "file_name"])


@query("column_compat", "SELECT auth_request_id, document_id, COALESCE(root_folder, '') AS "
       "root_folder, '' AS mime_type FROM manifest")
def column_compat(spark, sf_dir):
    shouting = derived(spark, sf_dir, "manifest")
    shouting = shouting.withColumnsRenamed({c: c.upper() for c in shouting.columns})
    return wl.column_compat(shouting, ["auth_request_id", "document_id", "root_folder", "mime_type"])


@query("retryable_le5", "SELECT * FROM failure WHERE retry_count <= 5 AND reprocess_success = 0")
def retryable_le5(spark, sf_dir):
    return wl.retryable(derived(spark, sf_dir, "failure"), wl.TARGET_COUNTED)


@query("retryable_lt5", "SELECT * FROM failure WHERE retry_count < 5 AND reprocess_success = 0")
def retryable_lt5(spark, sf_dir):
    return wl.retryable(derived(spark, sf_dir, "failure"), wl.SOURCE_COUNTED)


@query("not_succeeded", f"SELECT * FROM manifest d WHERE {_ABSENT.format('success')}")
def not_succeeded(spark, sf_dir):
    return keys.not_succeeded(*_inputs(spark, sf_dir, "manifest", "success"))


@query("not_failed", f"SELECT * FROM manifest d WHERE {_ABSENT.format('failure')}")
def not_failed(spark, sf_dir):
    return keys.not_failed(*_inputs(spark, sf_dir, "manifest", "failure"))


@query("pending_only", f"SELECT * FROM manifest d WHERE {_ABSENT.format('success')} AND "
       + _ABSENT.format("failure"))
def pending_only(spark, sf_dir):
    return keys.pending_only(*_inputs(spark, sf_dir, "manifest", "success", "failure"))


@query("previously_failed", "SELECT g.* FROM good g WHERE EXISTS (SELECT 1 FROM failure f WHERE "
       "f.auth_request_id = g.auth_request_id AND f.document_id = g.document_id "
       "AND f.reprocess_success = 0)")
def previously_failed(spark, sf_dir):
    return keys.previously_failed(*_inputs(spark, sf_dir, "good", "failure"))


@query("distinct_keys", "SELECT DISTINCT 'AUTH-'||o_custkey AS auth_request_id, 'DOC-'||l_orderkey "
       "AS document_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def distinct_keys(spark, sf_dir):
    """A key per order, from the far more numerous line items."""
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    rows = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("AUTH-"), "o_custkey").alias("auth_request_id"),
        F.concat(F.lit("DOC-"), "l_orderkey").alias("document_id"))
    return keys.distinct_keys(rows)


@query("except_processed", "SELECT auth_request_id, document_id FROM manifest EXCEPT "
       "SELECT auth_request_id, document_id FROM success EXCEPT "
       "SELECT auth_request_id, document_id FROM failure")
def except_processed(spark, sf_dir):
    return keys.except_processed(*_inputs(spark, sf_dir, "manifest", "success", "failure"))



@query("multiply_rows", """
WITH ids AS (SELECT o_orderkey, printf('%08x', o_orderkey) AS hex, printf('%012x', o_custkey) AS tail
  FROM orders)
SELECT hex||'-0000-4000-8000-'||printf('%02d', i)||substr(tail, 3) AS document_id,
  hex||'-1111-4000-8000-'||printf('%02d', i)||substr(tail, 3) AS auth_request_id, o_orderkey
FROM ids, range(100) r(i)""")
def multiply_rows(spark, sf_dir):
    ids = load(spark, sf_dir, "orders").select(
        F.format_string("%08x-0000-4000-8000-%012x", "o_orderkey", "o_custkey").alias("document_id"),
        F.format_string("%08x-1111-4000-8000-%012x", "o_orderkey", "o_custkey")
        .alias("auth_request_id"), "o_orderkey")
    return wl.multiply_rows(ids, 100, partitions=spark.sparkContext.defaultParallelism)


@query("stamp", f"SELECT document_id, 'run-7' AS correlation_id, TIMESTAMP '2024-02-01 00:00:00' AS "
       "date_created, TIMESTAMP '2024-02-01 00:00:00' AS date_updated FROM manifest")
def stamp(spark, sf_dir):
    rows = derived(spark, sf_dir, "manifest").select("document_id")
    return wl.stamp(wl.with_correlation(rows, "run-7"), instant(RUN_AT))


@query("as_view", "SELECT reprocess_success, COUNT(*) AS n FROM failure GROUP BY reprocess_success")
def as_view(spark, sf_dir):
    tables.as_view(derived(spark, sf_dir, "failure"), "incoming_failures")
    return spark.sql("SELECT reprocess_success, COUNT(*) AS n FROM incoming_failures "
                     "GROUP BY reprocess_success")


# --- counters -------------------------------------------------------------------------------

_COUNTS = ("COUNT(*) AS total, COUNT(*) FILTER (WHERE ok) AS successes, "
           "COUNT(*) FILTER (WHERE NOT ok) AS failures")


@query("count_rows", f"SELECT COUNT(*) AS n FROM ({WORKLIST_SQL})")
def count_rows(spark, sf_dir):
    return worklist(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query("outcome_counts", f"SELECT {_COUNTS} FROM outcomes")
def outcome_counts(spark, sf_dir):
    return summary.outcome_counts(derived(spark, sf_dir, "outcomes"))


@query("run_rates", f"SELECT *, ROUND(100.0 * CAST(successes AS DOUBLE) / total, 2) AS success_rate, "
       f"ROUND(CAST(total AS DOUBLE) / 12.5, 2) AS rows_per_second FROM "
       f"(SELECT {_COUNTS} FROM outcomes)")
def run_rates(spark, sf_dir):
    return summary.run_rates(derived(spark, sf_dir, "outcomes"), 12.5)


@query("copy_stats", """
WITH t AS (SELECT CAST(SUM(bytes) AS BIGINT) AS total_bytes,
  CAST(SUM(execution_time_ms) AS DOUBLE) / 1000 AS s FROM outcomes)
SELECT total_bytes, ROUND(s, 3) AS seconds,
  ROUND(CAST(total_bytes AS DOUBLE) / 1024 / 1024 / s, 2) AS mb_per_second FROM t""")
def copy_stats(spark, sf_dir):
    return summary.copy_stats(derived(spark, sf_dir, "outcomes"))


# --- batches --------------------------------------------------------------------------------

_BATCHED = ("SELECT *, CAST((ROW_NUMBER() OVER (ORDER BY auth_request_id, document_id) - 1) // 1000 "
            "AS BIGINT) AS batch_id FROM {0}")


@query("assign_batches", _BATCHED.format("manifest"))
def assign_batches(spark, sf_dir):
    return batching.assign_batches(derived(spark, sf_dir, "manifest"), 1000)


@query("num_batches", "SELECT CAST(CEIL(COUNT(*) / 1000.0) AS BIGINT) AS batches FROM manifest")
def num_batches(spark, sf_dir):
    return batching.num_batches(derived(spark, sf_dir, "manifest"), 1000)


@query("batch_progress", f"""
WITH cut AS ({_BATCHED.format('outcomes')}), per AS (SELECT batch_id,
  COUNT(*) FILTER (WHERE ok) AS successes, COUNT(*) FILTER (WHERE NOT ok) AS failures
  FROM cut GROUP BY batch_id)
SELECT *, CAST(SUM(successes) OVER (ORDER BY batch_id) AS BIGINT) AS cumulative_successes,
  CAST(SUM(failures) OVER (ORDER BY batch_id) AS BIGINT) AS cumulative_failures FROM per""")
def batch_progress(spark, sf_dir):
    return summary.batch_progress(
        batching.assign_batches(derived(spark, sf_dir, "outcomes"), 1000))


@query("payload_json", """SELECT document_id,
  to_json(struct_pack(file_path := full_path, ar_number := ar_number)) AS payload FROM located""")
def payload_json(spark, sf_dir):
    payload = messages.payload_json(F.col("full_path").alias("file_path"), "ar_number")
    return derived(spark, sf_dir, "located").select("document_id", payload.alias("payload"))


@query("batch_payloads", f"""
WITH cut AS ({_BATCHED.format('located')}), listed AS (SELECT batch_id,
  to_json(struct_pack(document_id := document_id, full_path := full_path)) AS j FROM cut)
SELECT batch_id, '['||string_agg(j, ',' ORDER BY j)||']' AS payload FROM listed GROUP BY batch_id""")
def batch_payloads(spark, sf_dir):
    cut = batching.assign_batches(derived(spark, sf_dir, "located"), 1000)
    return batching.batch_payloads(cut, "document_id", "full_path")


@query("spread", "SELECT document_id FROM manifest")
def spread(spark, sf_dir):
    return batching.spread(derived(spark, sf_dir, "manifest").select("document_id"), 16)
