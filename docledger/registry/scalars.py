"""Path, status, message and time expressions over every row of the inputs."""

from pyspark.sql import functions as F

from docledger.functions import messages, paths, status, timing
from docledger.operators import worklist as wl
from docledger.registry.inputs import derived, load, query

_B = "chr(92)"
_NORMAL = f"trim(replace(path, '/', {_B}))"
_PATTERNS = [r"\\\\srv[01]\\share\d", r"\\\\SRV2\\", "(unclosed"]


def _paths(spark, sf_dir):
    return derived(spark, sf_dir, "paths")


@query("normalise_path", f"SELECT document_id, {_NORMAL} AS trimmed, replace(path, '/', {_B}) AS "
       "untrimmed FROM paths")
def normalise_path(spark, sf_dir):
    return _paths(spark, sf_dir).select(
        "document_id", paths.normalise_path("path").alias("trimmed"),
        paths.normalise_path("path", strip=False).alias("untrimmed"))


@query("path_allowed", f"""SELECT document_id, COALESCE(
  regexp_matches({_NORMAL}, '^(?:{_PATTERNS[0]})', 'i')
  OR regexp_matches({_NORMAL}, '^(?:{_PATTERNS[1]})', 'i'), FALSE) AS allowed FROM paths""")
def path_allowed(spark, sf_dir):
    normal = _paths(spark, sf_dir).withColumn("p", paths.normalise_path("path"))
    return normal.select("document_id", paths.path_allowed("p", _PATTERNS).alias("allowed"))


_UNC_SQL = r"'^\\\\([^\\]+)\\([^\\]+)\\(.+)$'"


@query("parse_unc", "SELECT document_id, " + ", ".join(
    f"NULLIF(regexp_extract(path, {_UNC_SQL}, {i}), '') AS {name}"
    for i, name in ((1, "server"), (2, "share"), (3, "relative"))) + " FROM paths")
def parse_unc(spark, sf_dir):
    return _paths(spark, sf_dir).select("document_id", paths.parse_unc("path").alias("u")).select(
        "document_id", "u.server", "u.share", "u.relative")


@query("unc_error", f"""SELECT document_id, CAST(CASE WHEN path IS NULL
  OR NOT starts_with(path, {_B}||{_B}) OR len(string_split(trim(path, {_B}), {_B})) < 3
  THEN 400 END AS INTEGER) AS code FROM paths""")
def unc_error(spark, sf_dir):
    return _paths(spark, sf_dir).select("document_id", paths.unc_error("path").alias("code"))


@query("base_name", f"""SELECT document_id, CASE WHEN contains(path, {_B})
  THEN string_split(path, {_B})[-1] ELSE string_split(path, '/')[-1] END AS base FROM paths""")
def base_name(spark, sf_dir):
    return _paths(spark, sf_dir).select("document_id", paths.base_name("path").alias("base"))


def _after(name):
    return f"substr(path, instr(path, '{name}'||{_B}) + {len(name) + 1})"


_HAS = "contains(path, {0}||'{1}'||{0})"


@query("route_share", f"""SELECT document_id,
  CASE WHEN {_HAS.format(_B, 'Share1')} THEN 'Share1' WHEN {_HAS.format(_B, 'Share0')} THEN 'Share0'
  END AS share,
  CASE WHEN {_HAS.format(_B, 'Share1')} THEN {_after('Share1')}
       WHEN {_HAS.format(_B, 'Share0')} THEN {_after('Share0')} END AS relative,
  CAST(CASE WHEN {_HAS.format(_B, 'Share1')} OR {_HAS.format(_B, 'Share0')} THEN NULL
       WHEN TRUE THEN 400 END AS INTEGER) AS code FROM paths""")
def route_share(spark, sf_dir):
    routed = _paths(spark, sf_dir).select(
        "document_id", paths.route_share("path", ["Share1", "Share0"]).alias("r"))
    return routed.select("document_id", "r.share", "r.relative", "r.code")


@query("target_key", """SELECT document_id, 'documents/'||COALESCE(ar_number, 'default')||'/'||
  file_name AS by_ar, auth_request_id||'/'||document_id||'/'||file_name AS by_document,
  auth_request_id||'/'||file_name AS by_auth, 'documents/'||file_name AS by_prefix,
  file_name AS bare, 'documents/default/'||file_name AS without_ar FROM paths""")
def target_key(spark, sf_dir):
    key = paths.target_key
    ids = dict(auth="auth_request_id", doc="document_id")
    return _paths(spark, sf_dir).select(
        "document_id", key("file_name", prefix="documents", ar="ar_number").alias("by_ar"),
        key("file_name", "auth/doc/file", **ids).alias("by_document"),
        key("file_name", "auth/file", **ids).alias("by_auth"),
        key("file_name", "prefix/file", prefix="documents").alias("by_prefix"),
        key("file_name", "file").alias("bare"),
        key("file_name", prefix="documents").alias("without_ar"))


@query("target_uri", "SELECT document_id, 'https://store.example/box/'||ar_number||'/'||file_name "
       "AS uri FROM manifest")
def target_uri(spark, sf_dir):
    key = paths.target_key("file_name", "ar/file", ar="ar_number")
    return derived(spark, sf_dir, "manifest").select(
        "document_id", paths.target_uri("https://store.example/box/", key).alias("uri"))


@query("guid_suffix", """
WITH ids AS (SELECT o_orderkey, printf('%08x-0000-4000-8000-', o_orderkey) AS head,
  printf('%012x', o_custkey) AS tail FROM orders)
SELECT o_orderkey, head||printf('%02d', o_orderkey % 150)||substr(tail, 3) AS five,
  head||printf('%02d', o_orderkey % 150)||substr(tail, 3) AS six, CAST(NULL AS VARCHAR) AS four
FROM ids""")
def guid_suffix(spark, sf_dir):
    ids = load(spark, sf_dir, "orders").withColumn(
        "id", F.format_string("%08x-0000-4000-8000-%012x", "o_orderkey", "o_custkey"))
    i = F.col("o_orderkey") % 150
    return ids.select("o_orderkey", paths.guid_suffix("id", i).alias("five"),
                      paths.guid_suffix(F.concat("id", F.lit("-tail")), i).alias("six"),
                      paths.guid_suffix(F.substring_index("id", "-", 4), i).alias("four"))


# --- status and errors ----------------------------------------------------------------------

@query("is_retryable", """SELECT document_id, kind IN ('connection', 'timeout') OR (kind = 'http'
  AND COALESCE(code IN (408, 429, 500, 502, 503, 504), FALSE)) AS again FROM errors""")
def is_retryable(spark, sf_dir):
    return derived(spark, sf_dir, "errors").select(
        "document_id", status.is_retryable("code", "kind").alias("again"))


@query("classify", """SELECT document_id, reply_code BETWEEN 200 AND 299 AS by_code,
  COALESCE(reply_code = 200 AND lower(status) = 'success', FALSE) AS strict,
  reply_code BETWEEN 200 AND 299 AND COALESCE(lower(status), '') <> 'failed' AS not_failed
FROM errors""")
def classify(spark, sf_dir):
    return derived(spark, sf_dir, "errors").select(
        "document_id", status.classify("reply_code").alias("by_code"),
        status.classify("reply_code", "status", "strict").alias("strict"),
        status.classify("reply_code", "status", "not_failed").alias("not_failed"))


@query("error_message", """SELECT document_id, COALESCE(NULLIF(text1, ''), NULLIF(text2, ''),
  NULLIF(text3, ''), 'HTTP error') AS message FROM errors""")
def error_message(spark, sf_dir):
    return derived(spark, sf_dir, "errors").select(
        "document_id", status.error_message("text1", "text2", "text3").alias("message"))


@query("exception_code", """SELECT document_id, CAST(CASE WHEN kind = 'http' AND code IS NOT NULL
  THEN code WHEN kind IN ('connection', 'timeout') THEN 503 ELSE 500 END AS INTEGER) AS code
FROM errors""")
def exception_code(spark, sf_dir):
    return derived(spark, sf_dir, "errors").select(
        "document_id", status.exception_code("kind", "code").alias("code"))


def _storage(denied):
    return f"""CAST(CASE WHEN kind = 'not_found' THEN 404 WHEN kind = 'denied' THEN {denied}
  WHEN kind = 'bad_path' THEN 400
  WHEN regexp_matches(COALESCE(message, ''),
    'no such file|not found|path does not exist|object_name_not_found', 'i') THEN 404
  WHEN regexp_matches(COALESCE(message, ''), 'access_denied|logon_failure|permission denied', 'i')
    THEN {denied} ELSE 500 END AS INTEGER)"""


@query("storage_error_code", f"SELECT document_id, {_storage(403)} AS forbidden, {_storage(401)} AS "
       "unauthorized FROM errors")
def storage_error_code(spark, sf_dir):
    return derived(spark, sf_dir, "errors").select(
        "document_id", status.storage_error_code("kind", "message").alias("forbidden"),
        status.storage_error_code("kind", "message", denied=401).alias("unauthorized"))


@query("missing_required", """SELECT document_id, CAST(CASE WHEN root_folder IS NULL
  OR root_folder = '' OR container_folder IS NULL OR container_folder = '' THEN 400 END AS INTEGER)
  AS code FROM manifest""")
def missing_required(spark, sf_dir):
    return derived(spark, sf_dir, "manifest").select(
        "document_id", status.missing_required("root_folder", "container_folder").alias("code"))


@query("cast_error_code", "SELECT document_id, TRY_CAST(CASE WHEN code = 404 THEN 'n/a' "
       "ELSE CAST(code AS VARCHAR) END AS INTEGER) AS error_code FROM docs")
def cast_error_code(spark, sf_dir):
    text = F.when(F.col("code") == 404, "n/a").otherwise(F.col("code").cast("string"))
    return wl.cast_error_code(derived(spark, sf_dir, "docs").select("document_id", text.alias("error_code")))


# --- messages -------------------------------------------------------------------------------

_KIND = """WITH typed AS (SELECT *, CASE WHEN NOT COALESCE(json_valid(body), FALSE) THEN 'none'
  WHEN starts_with(body, chr(123)) THEN 'object' WHEN starts_with(body, '"') THEN 'string'
  ELSE 'other' END AS t FROM {0})"""


def _field(name):
    return (f"CASE WHEN t = 'object' THEN json_extract_string(CASE WHEN t = 'object' THEN body END, "
            f"'$.{name}') END")


@query("parse_reply", f"""{_KIND.format('replies')}
SELECT document_id, {_field('status')} AS status, {_field('error')} AS error,
  {_field('detail')} AS detail, {_field('azure_blob_path')} AS azure_blob_path,
  {_field('total_bytes')} AS total_bytes,
  CASE WHEN t = 'object' THEN {_field('message')} WHEN t = 'string' THEN trim(body, '"')
    WHEN t = 'none' THEN body END AS message,
  CASE WHEN t IN ('other', 'string') THEN trim(body, '"') END AS data FROM typed""")
def parse_reply(spark, sf_dir):
    parsed = derived(spark, sf_dir, "replies").select(
        "document_id", messages.parse_reply("body").alias("r"))
    return parsed.select("document_id", "r.status", "r.error", "r.detail", "r.azure_blob_path",
                         "r.total_bytes", "r.message", "r.data")


@query("parse_request", f"""{_KIND.format('requests')}, got AS (SELECT document_id, t,
  {_field('file_path')} AS file_path, {_field('ar_number')} AS ar_number,
  {_field('mime_type')} AS mime FROM typed)
SELECT document_id, file_path, ar_number, COALESCE(NULLIF(mime, ''), 'application/json') AS mime_type,
  CAST(CASE WHEN t <> 'object' OR COALESCE(file_path, '') = '' OR COALESCE(ar_number, '') = ''
    THEN 400 END AS INTEGER) AS code FROM got""")
def parse_request(spark, sf_dir):
    parsed = derived(spark, sf_dir, "requests").select(
        "document_id", messages.parse_request("body").alias("r"))
    return parsed.select("document_id", "r.file_path", "r.ar_number", "r.mime_type", "r.code")


@query("reply_target", f"""{_KIND.format('replies')}
SELECT document_id, COALESCE(NULLIF({_field('blob_url')}, ''), NULLIF({_field('blob_path')}, ''),
  'key/'||document_id) AS target FROM typed""")
def reply_target(spark, sf_dir):
    parsed = derived(spark, sf_dir, "replies").select(
        "document_id", messages.parse_reply("body").alias("r"))
    return parsed.select("document_id", messages.reply_target(
        "r.blob_url", "r.blob_path", F.concat(F.lit("key/"), "document_id")).alias("target"))


# --- times ----------------------------------------------------------------------------------

_ISO = ("strftime({0}, '%Y-%m-%dT%H:%M:%S')||CASE WHEN extract('microsecond' FROM {0}) % 1000000 = 0 "
        "THEN '' ELSE '.'||lpad(CAST(extract('microsecond' FROM {0}) % 1000000 AS VARCHAR), 6, '0') "
        "END")


@query("iso_utc", f"SELECT event_id, {_ISO.format('ts')}||'Z' AS iso, "
       f"{_ISO.format('ts')}||'+00:00' AS offset_kept FROM events")
def iso_utc(spark, sf_dir):
    with_offset = F.concat(timing.iso_text("ts"), F.lit("+00:00"))
    return load(spark, sf_dir, "events").select(
        "event_id", timing.iso_utc("ts").alias("iso"),
        timing.with_zulu(with_offset).alias("offset_kept"))


@query("stamped_name", f"SELECT event_id, 'audit-logs/uploaded_'||replace({_ISO.format('ts')}, ':', "
       "'_') AS name FROM events")
def stamped_name(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        "event_id", timing.stamped_name("ts").alias("name"))


@query("elapsed_ms", """
WITH spans AS (SELECT event_id, CAST(trunc(value * 100) AS BIGINT) AS us FROM events)
SELECT event_id, us // 1000 AS ms, GREATEST(1, us // 1000) AS floored FROM spans""")
def elapsed_ms(spark, sf_dir):
    spans = load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("a"),
        (F.col("value") * 100).cast("bigint").alias("us"))
    ends = spans.withColumn("b", F.timestamp_micros(F.unix_micros("a") + F.col("us")))
    return ends.select("event_id", timing.elapsed_ms("a", "b").alias("ms"),
                       timing.elapsed_ms("a", "b", at_least=1).alias("floored"))
