"""File content and verified copies, over files Spark writes from the documents table."""

from pyspark.sql import functions as F

from docledger.functions.status import OTHER
from docledger.operators.dispatch import AttemptPolicy
from docledger.plans.copying import copy_files, locate
from docledger.registry.inputs import load, query
from docledger.schemas import CARRIED
from docledger.session import fresh_dir
from docledger.sources import files

_PATH = ("chr(92)||chr(92)||'srv'||(doc_id % 3)||chr(92)||'Share'||chr(92)||source||chr(92)||"
         "'doc_'||doc_id||'.txt'")
_NAMED = f"""WITH named AS (SELECT doc_id, 'AUTH-'||(doc_id % 50) AS auth_request_id,
  'DOC-'||doc_id AS document_id, source AS ar_number, {_PATH} AS full_path, text,
  'srv'||(doc_id % 3)||'/Share/'||source||'/doc_'||doc_id||'.txt' AS source_file,
  'documents/'||source||'/doc_'||doc_id||'.txt' AS target_key,
  CAST(octet_length(encode(text)) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents)"""


def named(spark, sf_dir):
    """A worklist whose every file holds the text of one document."""
    rows = load(spark, sf_dir, "documents")
    sep = F.lit("\\")
    name = F.concat(F.lit("doc_"), "doc_id", F.lit(".txt"))
    path = F.concat(F.lit("\\\\srv"), F.col("doc_id") % 3, sep, F.lit("Share"), sep, "source", sep,
                    name)
    return rows.select(
        F.concat(F.lit("AUTH-"), F.col("doc_id") % 50).alias("auth_request_id"),
        F.concat(F.lit("DOC-"), "doc_id").alias("document_id"), F.col("source").alias("ar_number"),
        path.alias("full_path"), F.lit(0).alias("retry_count"), F.lit(0).alias("reprocess_success"),
        "doc_id", "text")


def shared_files(spark, sf_dir, keep=None):
    """Write the documents as a tree of shares; returns the worklist without text and the root."""
    root = fresh_dir(spark, "share")
    rows = locate(named(spark, sf_dir), "documents")
    written = rows if keep is None else rows.filter(keep)
    files.write_text_files(written.select("source_file", "text"), root, "source_file",
                           "text").agg(F.sum("written")).first()
    return rows.drop("text"), root


@query("content_sha256", "SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS "
       "BIGINT) AS bytes FROM documents")
def content_sha256(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", F.sha2("text", 256).alias("sha256"),
        F.octet_length("text").cast("bigint").alias("bytes"))


@query("read_bytes", f"{_NAMED} SELECT document_id, bytes AS length, sha256 FROM named")
def read_bytes(spark, sf_dir):
    rows, root = shared_files(spark, sf_dir)
    read = files.read_bytes(rows.select("document_id", "source_file"), root, "source_file")
    return read.select("document_id", F.octet_length("content").cast("bigint").alias("length"),
                       F.sha2("content", 256).alias("sha256"))


@query("file_digest", f"{_NAMED} SELECT document_id, bytes AS length, sha256 FROM named")
def file_digest(spark, sf_dir):
    rows, root = shared_files(spark, sf_dir)
    return files.with_digest(rows.select("document_id", "source_file"), root,
                             "source_file").drop("source_file")


@query("copy_files", f"""{_NAMED} SELECT auth_request_id, document_id, ar_number, full_path,
  'run-5' AS correlation_id, TRUE AS ok, CAST(NULL AS INTEGER) AS error_code,
  CAST(NULL AS VARCHAR) AS error_message, target_key AS target_path, bytes, sha256,
  CAST(1 AS INTEGER) AS attempts FROM named""")
def copy_files_query(spark, sf_dir):
    rows, root = shared_files(spark, sf_dir)
    outcomes = copy_files(rows.drop("source_file", "target_key", "reject_code", "reject_text"), root,
                          fresh_dir(spark, "copied"), stage_path=fresh_dir(spark, "outcomes"),
                          correlation_id="run-5")
    return outcomes.drop("execution_time_ms", "started_at", "finished_at", *CARRIED.fieldNames())


@query("verify_copy", f"""{_NAMED} SELECT source_file, target_key, bytes AS source_length,
  bytes AS target_length, TRUE AS same FROM named""")
def verify_copy(spark, sf_dir):
    rows, root = shared_files(spark, sf_dir)
    target = fresh_dir(spark, "copied")
    copy_files(rows, root, target, stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-5")
    return files.verify_copy(rows.select("source_file", "target_key"), root, target)


_HEX = "hex(encode(text))"
_STRETCHES = f"""{_NAMED}, stretches AS (SELECT document_id, source_file, target_key, text, part, part * 500 AS start,
  least(500, bytes - part * 500) AS bytes, unhex(substr({_HEX}, part * 1000 + 1, 1000)) AS content
  FROM named, unnest(range(0, greatest(1, (bytes + 499) // 500))) AS u(part))"""


@query("tree_digest", f"""{_STRETCHES} SELECT document_id, CAST(sum(bytes) AS BIGINT) AS length,
  sha256(string_agg(sha256(content), '' ORDER BY part)) AS tree_sha256 FROM stretches GROUP BY document_id""")
def tree_digest(spark, sf_dir):
    """Files read in stretches of 500 bytes by different tasks."""
    rows, root = shared_files(spark, sf_dir)
    return files.with_tree_digest(rows.select("document_id", "source_file"), root, "source_file", size=500).drop("source_file")


@query("damaged_ranges", f"""{_STRETCHES} SELECT document_id, CAST(start AS BIGINT) AS start, CAST(bytes AS BIGINT) AS bytes,
  'content' AS problem FROM stretches WHERE CAST(substr(document_id, 5) AS BIGINT) % 7 = 0
  AND octet_length(encode(right(text, 1))) = 1 AND part = (
    SELECT max(s.part) FROM stretches s WHERE s.document_id = stretches.document_id)
UNION ALL SELECT document_id, NULL, NULL, 'target missing' FROM named WHERE doc_id % 7 = 1""")
def damaged_ranges(spark, sf_dir):
    """The last byte of every seventh copy is changed, and another seventh is gone."""
    rows, root = shared_files(spark, sf_dir)
    target = fresh_dir(spark, "copied")
    changed = F.concat(F.expr("substr(text, 1, length(text) - 1)"), F.when(F.right("text", F.lit(1)) == "x", "y").otherwise("x"))
    ends_in_a_byte = F.octet_length(F.right("text", F.lit(1))) == 1
    content = locate(named(spark, sf_dir), "documents").where("doc_id % 7 <> 1").withColumn(
        "text", F.when((F.col("doc_id") % 7 == 0) & ends_in_a_byte, changed).otherwise(F.col("text")))
    files.write_text_files(content.select("target_key", "text"), target, "target_key", "text").agg(F.sum("written")).first()
    found = files.damaged_ranges(rows.select("document_id", "source_file", "target_key"), root, target, size=500)
    return found.select("document_id", "start", "bytes", "problem")


_MISSING = "doc_id % 5 = 0"


@query("source_exists", f"""{_NAMED} SELECT document_id, CAST(CASE WHEN {_MISSING} THEN 404 END AS
  INTEGER) AS missing_code FROM named""")
def source_exists(spark, sf_dir):
    """Every fifth file is not there."""
    rows, root = shared_files(spark, sf_dir, keep=f"NOT {_MISSING}")
    return files.source_exists(rows.select("document_id", "source_file"), root).drop("source_file")


@query("copy_files_missing", f"""{_NAMED} SELECT document_id, NOT ({_MISSING}) AS ok,
  CAST(CASE WHEN {_MISSING} THEN 404 END AS INTEGER) AS error_code,
  CASE WHEN {_MISSING} THEN 'File not found: '||full_path END AS error_message,
  CASE WHEN NOT ({_MISSING}) THEN bytes END AS bytes FROM named""")
def copy_files_missing(spark, sf_dir):
    rows, root = shared_files(spark, sf_dir, keep=f"NOT {_MISSING}")
    outcomes = copy_files(rows, root, fresh_dir(spark, "copied"),
                          stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-5")
    return outcomes.select("document_id", "ok", "error_code", "error_message", "bytes")


@query("overwrite_guard", f"""{_NAMED} SELECT document_id, {_MISSING} AS ok,
  CAST(CASE WHEN NOT ({_MISSING}) THEN 500 END AS INTEGER) AS error_code,
  CASE WHEN NOT ({_MISSING}) THEN 'Target exists' END AS error_message FROM named""")
def overwrite_guard(spark, sf_dir):
    """A second run without overwrite copies only what the first one left out."""
    rows, root = shared_files(spark, sf_dir)
    target = fresh_dir(spark, "copied")
    copy_files(rows.filter(f"NOT {_MISSING}"), root, target,
               stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-5")
    again = copy_files(rows, root, target, stage_path=fresh_dir(spark, "outcomes"),
                       correlation_id="run-6", overwrite=False)
    return again.select("document_id", "ok", "error_code", "error_message")


class Spoiled(files.FileCopy):
    """A copy that changes a byte of every fifth document on its way."""

    def _write(self, source_fs, source, target_fs, partial):
        size, sha = super()._write(source_fs, source, target_fs, partial)
        number = int(source.rsplit("_", 1)[1].split(".")[0])
        if number % 5 == 0:
            with target_fs.open_output_stream(partial) as out:
                out.write(b"x" * size)
        return size, sha


class Intruded(files.FileCopy):
    """A copy during which somebody else makes the target of every fifth document."""

    def _write(self, source_fs, source, target_fs, partial):
        written = super()._write(source_fs, source, target_fs, partial)
        if int(source.rsplit("_", 1)[1].split(".")[0]) % 5 == 0:
            with target_fs.open_output_stream(partial.rsplit(".", 2)[0]) as out:
                out.write(b"somebody else's")
        return written


@query("overwrite_guard_during_run", f"""{_NAMED} SELECT document_id, NOT ({_MISSING}) AS ok,
  CAST(CASE WHEN {_MISSING} THEN 500 END AS INTEGER) AS error_code,
  CASE WHEN {_MISSING} THEN 'Target exists' END AS error_message, CAST(1 AS INTEGER) AS attempts,
  CASE WHEN {_MISSING} THEN sha256('somebody else''s') ELSE sha256 END AS found FROM named""")
def overwrite_guard_during_run(spark, sf_dir):
    """Targets made by somebody else between the look-up and the end of the copy are refused, and stay as they are."""
    rows, root = shared_files(spark, sf_dir)
    target = fresh_dir(spark, "copied")
    outcomes = copy_files(rows, root, target, stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-8",
                          overwrite=False, transport=Intruded)
    seen = files.with_digest(rows.select("document_id", "target_key"), target, "target_key")
    return outcomes.select("document_id", "ok", "error_code", "error_message", "attempts").join(
        seen.select("document_id", F.col("sha256").alias("found")), "document_id")


@query("discard_bad", f"""{_NAMED} SELECT document_id, NOT ({_MISSING}) AS ok,
  CAST(CASE WHEN {_MISSING} THEN 500 END AS INTEGER) AS error_code,
  CASE WHEN {_MISSING} THEN 'copy failed validation: '||target_key END AS error_message,
  CAST(CASE WHEN {_MISSING} THEN 2 ELSE 1 END AS INTEGER) AS attempts,
  NOT ({_MISSING}) AS target_is_there, CAST(0 AS BIGINT) AS partial_files FROM named""")
def discard_bad(spark, sf_dir):
    """A byte of every fifth copy goes wrong on the way: the copy is deleted, and leaves nothing behind."""
    rows, root = shared_files(spark, sf_dir)
    target = fresh_dir(spark, "copied")
    outcomes = copy_files(rows, root, target, stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-8",
                          transport=Spoiled, policy=AttemptPolicy(attempts=2, sleep=lambda seconds: None, other_kinds=(OTHER,)))
    sizes = files.with_file_size(rows.select("document_id", "target_key"), target, "target_key")
    left = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target)
            .select(F.regexp_extract("path", r"doc_(\d+)\.txt\..*part$", 1).alias("number")).where("number <> ''")
            .select(F.concat(F.lit("DOC-"), "number").alias("document_id")).groupBy("document_id").count())
    return (outcomes.select("document_id", "ok", "error_code", "error_message", "attempts")
            .join(sizes.select("document_id", F.col("file_size").isNotNull().alias("target_is_there")), "document_id")
            .join(left.withColumnRenamed("count", "partial_files"), "document_id", "left").fillna(0, ["partial_files"]))


@query("overwrite_guard_same_run", f"""{_NAMED} SELECT ar_number, count(*) AS files,
  CAST(1 AS BIGINT) AS copied, count(*) - 1 AS refused FROM named GROUP BY ar_number""")
def overwrite_guard_same_run(spark, sf_dir):
    """All files of a source have the same target: one is copied, the others are refused."""
    rows, root = shared_files(spark, sf_dir)
    again = copy_files(rows.withColumn("document_id", F.lit("DOC")), root, fresh_dir(spark, "copied"),
                       stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-7", overwrite=False,
                       template="prefix/ar")
    return again.groupBy("ar_number").agg(
        F.count("*").alias("files"), F.count_if("ok").alias("copied"),
        F.count_if((F.col("error_code") == 500) & (F.col("error_message") == "Target exists")).alias("refused"))


@query("copy_files_path_modes", f"""{_NAMED} SELECT document_id, TRUE AS ok, bytes, sha256 FROM named""")
def copy_files_path_modes(spark, sf_dir):
    """Paths joined with two separators are the same files."""
    rows, root = shared_files(spark, sf_dir)
    doubled = F.concat(F.lit("\\\\"), F.regexp_replace(F.substring("full_path", 3, 10_000), r"\\(?=[^\\]*$)", r"\\\\"))
    outcomes = copy_files(rows.withColumn("full_path", doubled), root, fresh_dir(spark, "copied"),
                          stage_path=fresh_dir(spark, "outcomes"), correlation_id="run-5")
    return outcomes.select("document_id", "ok", "bytes", "sha256")


@query("copy_files_allowed", f"""{_NAMED} SELECT document_id, doc_id % 3 = 1 AS ok,
  CAST(CASE WHEN doc_id % 3 <> 1 THEN 403 END AS INTEGER) AS error_code FROM named""")
def copy_files_allowed(spark, sf_dir):
    """Only paths on the list; a pattern that only Python accepts is skipped."""
    rows, root = shared_files(spark, sf_dir)
    outcomes = copy_files(rows, root, fresh_dir(spark, "copied"), stage_path=fresh_dir(spark, "outcomes"),
                          correlation_id="run-5", allowed=[r"\\\\SRV1\\", "(?P<name>x"])
    return outcomes.select("document_id", "ok", "error_code")
