"""One fixed schema per table. Nothing in the package infers a schema from data."""

from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

KEYS = ("auth_request_id", "document_id")
ATTEMPT_KEYS = KEYS + ("correlation_id",)

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(),
          "boolean": BooleanType(), "timestamp": TimestampType()}


def _schema(**columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


MANIFEST = _schema(
    auth_request_id="string", document_id="string", ar_number="string",
    root_folder="string", container_folder="string", file_name="string",
)

WORKLIST = _schema(
    auth_request_id="string", document_id="string", ar_number="string",
    full_path="string", retry_count="int", reprocess_success="int",
)

OUTCOME = _schema(
    auth_request_id="string", document_id="string", ar_number="string", full_path="string",
    correlation_id="string", ok="boolean", error_code="int", error_message="string",
    target_path="string", bytes="bigint", sha256="string", attempts="int",
    execution_time_ms="bigint", started_at="timestamp", finished_at="timestamp",
)

# What an attempt carries beside its outcome: the count it was started with, and when the service asked to be called again.
CARRIED = _schema(retry_count="int", retry_at="timestamp")

SUCCESS = _schema(
    auth_request_id="string", document_id="string", correlation_id="string", full_path="string",
    target_path="string", execution_time_ms="bigint", date_created="timestamp",
    date_updated="timestamp", ar_number="string",
)

FAILURE = _schema(
    auth_request_id="string", document_id="string", latest_correlation_id="string",
    retry_count="int", full_path="string", reprocess_success="int", latest_error_message="string",
    latest_error_code="int", date_created="timestamp", date_updated="timestamp", ar_number="string",
)

# When a service wants to be called again for a document that failed.
ASKED = _schema(auth_request_id="string", document_id="string", retry_at="timestamp")

FAILURE_DETAILS = _schema(
    auth_request_id="string", document_id="string", correlation_id="string", error_code="int",
    error_message="string", date_created="timestamp", date_updated="timestamp", ar_number="string",
)

AUDIT = _schema(
    auth_request_id="string", annotation_id="string", full_path="string", status="string",
    status_code="bigint", azure_blob_path="string", execution_time_ms="bigint", message="string",
)

CSV_MANIFEST = _schema(full_path="string", auth_request_id="string", annotation_id="string")

CSV_AUDIT = _schema(
    file_name="string", full_path="string", auth_request_id="string", annotation_id="string",
    uploaded_at="string",
)

# The tail every cross-reference table shares.
_FHIR = dict(fhir_id="string", fhir_network="int", date_created="timestamp", date_updated="timestamp")

CROSS_REFERENCE = {
    "authorization_fhir": _schema(auth_request_id="string", **_FHIR),
    "document_fhir": _schema(
        auth_request_id="string", document_id="string", file_name="string", **_FHIR),
    "note_fhir": _schema(
        auth_request_id="string", note_id="string", activity_type="string", **_FHIR),
    "modificationhistory_fhir": _schema(
        auth_request_id="string", activity_id="string", attribute_log_name="string", **_FHIR),
    "claimresponse_fhir": _schema(auth_request_id="string", **_FHIR),
}
