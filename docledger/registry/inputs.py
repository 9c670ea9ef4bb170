"""Manifest, ledgers and outcomes derived from the order tables.

One SQL text serves both engines: Spark runs it to build the inputs of a query, and the expected
results are written on top of it. ``chr(92)`` is a backslash, whose escaping differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docledger.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CREATED = "2024-01-01 00:00:00"
RUN_AT = "2024-02-01 00:00:00"

_TABLES = ("orders", "lineitem", "documents", "events")

_PLAIN = {
    "docs": """
  SELECT o_orderkey, 'AUTH-'||o_custkey AS auth_request_id, 'DOC-'||o_orderkey AS document_id,
    'AR'||o_custkey AS ar_number,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL
         ELSE chr(92)||chr(92)||'srv'||(o_custkey % 3)||chr(92)||'Share'||(o_custkey % 2)
    END AS root_folder,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE lower(o_orderpriority) END AS container_folder,
    'doc_'||o_orderkey||'.pdf' AS file_name,
    CASE o_orderkey % 10 WHEN 6 THEN 404 WHEN 7 THEN 429 WHEN 8 THEN 500 WHEN 9 THEN 503 ELSE 200
    END AS code
  FROM {orders}""",
    "manifest": """
  SELECT auth_request_id, document_id, ar_number, root_folder, container_folder, file_name
  FROM docs""",
    "located": """
  SELECT docs.*, root_folder||chr(92)||container_folder||chr(92)||file_name AS full_path FROM docs""",
    "success": """
  SELECT auth_request_id, document_id, 'run-0' AS correlation_id, full_path,
    'documents/'||ar_number||'/'||file_name AS target_path,
    CAST(1 + o_orderkey % 900 AS BIGINT) AS execution_time_ms,
    TIMESTAMP '2024-01-01 00:00:00' AS date_created, TIMESTAMP '2024-01-01 00:00:00' AS date_updated,
    ar_number
  FROM located WHERE EXISTS (SELECT 1 FROM {lineitem} WHERE l_orderkey = o_orderkey
    AND l_returnflag = 'A' AND l_linenumber = 1)""",
    "failure": """
  SELECT auth_request_id, document_id, 'run-0' AS latest_correlation_id,
    CAST(o_orderkey % 8 AS INTEGER) AS retry_count, full_path,
    CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS reprocess_success,
    'HTTP error' AS latest_error_message, CAST(503 AS INTEGER) AS latest_error_code,
    TIMESTAMP '2024-01-01 00:00:00' AS date_created, TIMESTAMP '2024-01-01 00:00:00' AS date_updated,
    ar_number
  FROM located WHERE EXISTS (SELECT 1 FROM {lineitem} WHERE l_orderkey = o_orderkey
    AND l_returnflag = 'R' AND l_linenumber = 2)""",
    "details": """
  SELECT auth_request_id, document_id, latest_correlation_id AS correlation_id,
    latest_error_code AS error_code, latest_error_message AS error_message, date_created,
    date_updated, ar_number
  FROM failure""",
    "outcomes": """
  SELECT auth_request_id, document_id, ar_number, full_path,
    CASE WHEN o_orderkey % 4 = 0 THEN 'run-0' ELSE 'run-1' END AS correlation_id, code = 200 AS ok,
    CAST(CASE WHEN code <> 200 THEN code END AS INTEGER) AS error_code,
    CASE WHEN code <> 200 THEN 'code '||code END AS error_message,
    CASE WHEN code = 200 THEN 'documents/'||ar_number||'/'||file_name END AS target_path,
    CAST(CASE WHEN code = 200 THEN 1 + o_orderkey * 7919 % 1000003 END AS BIGINT) AS bytes,
    CAST(NULL AS VARCHAR(64)) AS sha256, CAST(1 AS INTEGER) AS attempts,
    CAST(1 + o_orderkey % 900 AS BIGINT) AS execution_time_ms,
    TIMESTAMP '2024-02-01 00:00:00' AS started_at, TIMESTAMP '2024-02-01 00:00:00' AS finished_at
  FROM located""",
    "good": """
  SELECT auth_request_id, document_id, correlation_id, full_path, target_path, execution_time_ms,
    finished_at AS date_created, finished_at AS date_updated, ar_number
  FROM outcomes WHERE ok""",
    "bad": """
  SELECT auth_request_id, document_id, correlation_id AS latest_correlation_id,
    CAST(0 AS INTEGER) AS retry_count, full_path, CAST(0 AS INTEGER) AS reprocess_success,
    error_message AS latest_error_message, error_code AS latest_error_code,
    finished_at AS date_created, finished_at AS date_updated, ar_number
  FROM outcomes WHERE NOT ok""",
    # Paths of every shape a request may carry.
    "paths": """
  SELECT document_id, ar_number, auth_request_id, file_name, CASE o_orderkey % 7
    WHEN 0 THEN root_folder||chr(92)||lower(ar_number)||chr(92)||file_name
    WHEN 1 THEN ' //srv1/ShareA/dir/'||file_name||'  '
    WHEN 2 THEN chr(92)||chr(92)||'srv0'||chr(92)||'Share1'
    WHEN 3 THEN 'C:'||chr(92)||'local'||chr(92)||file_name
    WHEN 4 THEN chr(92)||chr(92)||'SRV2'||chr(92)||'SHARE0'||chr(92)||'Dir With Space'||chr(92)||
      upper(file_name)
    WHEN 5 THEN '/plain/'||file_name
    ELSE chr(92)||chr(92)||'srv1'||chr(92)||'Share0'||chr(92)||'Share1'||chr(92)||file_name
    END AS path
  FROM docs""",
    # Reply and request bodies, well-formed and not.
    "replies": """
  SELECT document_id, code, CASE o_orderkey % 9
    WHEN 0 THEN '{{"status":"Success","azure_blob_path":"documents/'||ar_number||'/'||file_name||
      '","total_bytes":'||o_orderkey||'}}'
    WHEN 1 THEN '{{"message":"boom '||o_orderkey||'","error":"second"}}'
    WHEN 2 THEN '{{"message":"","error":"denied '||o_orderkey||'"}}'
    WHEN 3 THEN '{{"message":null,"detail":"late '||o_orderkey||'","blob_url":"u/'||file_name||'"}}'
    WHEN 4 THEN 'gateway said '||o_orderkey
    WHEN 5 THEN '[1,'||o_orderkey||']'
    WHEN 6 THEN '"text '||o_orderkey||'"'
    WHEN 7 THEN '{{"message":"cut '||o_orderkey
    ELSE '{{"status":"FAILED","blob_path":"p/'||file_name||'"}} trailing'
    END AS body
  FROM docs""",
    "requests": """
  SELECT document_id, CASE o_orderkey % 6
    WHEN 0 THEN '{{"file_path":"/share/'||file_name||'","ar_number":"'||ar_number||'"}}'
    WHEN 1 THEN '{{"file_path":"/share/'||file_name||'"}}'
    WHEN 2 THEN '{{"file_path":"","ar_number":"'||ar_number||'"}}'
    WHEN 3 THEN '{{"file_path":"/share/'||file_name||'","ar_number":"'||ar_number||
      '","mime_type":"application/pdf"}}'
    WHEN 4 THEN 'not json '||o_orderkey
    ELSE '["'||file_name||'"]'
    END AS body
  FROM docs""",
    # Raised errors: kind, code and message.
    "errors": """
  SELECT document_id, CASE o_orderkey % 7 WHEN 0 THEN 'http' WHEN 1 THEN 'connection'
      WHEN 2 THEN 'timeout' WHEN 3 THEN 'not_found' WHEN 4 THEN 'denied' WHEN 5 THEN 'bad_path'
      ELSE 'other' END AS kind,
    CAST(CASE WHEN code <> 200 THEN code END AS INTEGER) AS code,
    CASE o_orderkey % 5 WHEN 0 THEN 'STATUS_OBJECT_NAME_NOT_FOUND for '||file_name
      WHEN 1 THEN 'Logon_Failure on '||root_folder WHEN 2 THEN 'Path does not exist'
      WHEN 3 THEN 'Permission denied: '||file_name ELSE 'disk quota '||o_orderkey END AS message,
    CASE o_orderkey % 4 WHEN 0 THEN 'Success' WHEN 1 THEN 'success' WHEN 2 THEN 'Failed' END AS status,
    CAST(code AS INTEGER) AS reply_code,
    CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'first '||o_orderkey END AS text1,
    CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'second '||o_orderkey END AS text2,
    CASE o_orderkey % 5 WHEN 0 THEN 'third '||o_orderkey END AS text3
  FROM docs""",
}

_CTES = ",".join(f"\n{name} AS ({text})" for name, text in _PLAIN.items())


def expected(sql: str) -> str:
    """Expected-result SQL on top of the inputs; ``sql`` may add further CTEs before its SELECT."""
    names = {name: name for name in _TABLES}
    joined = "WITH" + _CTES.format(**names)
    sql = sql.strip()
    return f"{joined},\n{sql[5:]}" if sql.upper().startswith("WITH ") else f"{joined}\n{sql}"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the inputs above, computed by Spark."""
    text = f"WITH{_CTES} SELECT * FROM {name}"
    used = {t: load(spark, sf_dir, t) for t in ("orders", "lineitem")}
    return spark.sql(text, **used)


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is what it is checked against, on top of the inputs."""
    def add(run: Callable[[SparkSession, str], DataFrame]):
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)
        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = expected(sql)
        return run
    return add
