"""Status codes, error text and retry rules as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Codes worth another attempt, and the parts of storage messages that name a cause.
RETRYABLE_CODES = (408, 429, 500, 502, 503, 504)
NOT_FOUND_TEXT = ("no such file", "not found", "path does not exist", "object_name_not_found")
DENIED_TEXT = ("access_denied", "logon_failure", "permission denied")

# Kinds of raised error, as dispatch records them.
HTTP, CONNECTION, TIMEOUT = "http", "connection", "timeout"
NOT_FOUND, DENIED, BAD_PATH, OTHER = "not_found", "denied", "bad_path", "other"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def should_retry(kind: str | None, code: int | None,
                 codes: Sequence[int] = RETRYABLE_CODES) -> bool:
    """The rule of ``is_retryable`` for one call, used inside a task."""
    return kind in (CONNECTION, TIMEOUT) or (kind == HTTP and code in codes)


def is_retryable(code: Column | str, kind: Column | str,
                 codes: Sequence[int] = RETRYABLE_CODES) -> Column:
    """Connection and timeout errors, and HTTP errors with a transient code."""
    by_kind = _col(kind).isin(CONNECTION, TIMEOUT)
    by_code = (_col(kind) == HTTP) & _col(code).isin(*codes)
    return F.coalesce(by_kind, F.lit(False)) | F.coalesce(by_code, F.lit(False))


def classify(code: Column | str, status: Column | str | None = None,
             mode: str = "code") -> Column:
    """True for a successful reply.

    ``code``        any 2xx
    ``strict``      200 and body status ``success``, whatever its case
    ``not_failed``  any 2xx unless the body status is ``failed``
    """
    ok = _col(code).between(200, 299)
    if mode == "strict":
        ok = (_col(code) == 200) & (F.lower(_col(status)) == "success")
    elif mode == "not_failed":
        ok = ok & ~F.coalesce(F.lower(_col(status)) == "failed", F.lit(False))
    elif mode != "code":
        raise ValueError(f"unknown classify mode: {mode}")
    return F.coalesce(ok, F.lit(False))


def first_filled(*columns: Column | str) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.when(_col(c) != "", _col(c)) for c in columns])


def error_message(message: Column | str, error: Column | str, detail: Column | str) -> Column:
    """The first filled of message, error and detail, else ``HTTP error``."""
    return F.coalesce(first_filled(message, error, detail), F.lit("HTTP error"))


def exception_code(kind: Column | str, code: Column | str) -> Column:
    """HTTP errors keep their code, connection and timeout errors are 503, the rest 500."""
    return (F.when((_col(kind) == HTTP) & _col(code).isNotNull(), _col(code))
            .when(_col(kind).isin(CONNECTION, TIMEOUT), F.lit(503))
            .otherwise(F.lit(500)).cast("int"))


def storage_error_code(kind: Column | str, message: Column | str, denied: int = 403) -> Column:
    """Not found 404, denied ``denied``, bad path 400, anything else 500.

    A kind that says nothing is judged by the message text.
    """
    text = F.coalesce(F.lower(_col(message)), F.lit(""))

    def mentions(parts: Sequence[str]) -> Column:
        found = text.contains(parts[0])
        for part in parts[1:]:
            found = found | text.contains(part)
        return found

    return (F.when(_col(kind) == NOT_FOUND, F.lit(404))
            .when(_col(kind) == DENIED, F.lit(denied))
            .when(_col(kind) == BAD_PATH, F.lit(400))
            .when(mentions(NOT_FOUND_TEXT), F.lit(404))
            .when(mentions(DENIED_TEXT), F.lit(denied))
            .otherwise(F.lit(500)).cast("int"))


def missing_required(*columns: Column | str) -> Column:
    """400 when any of the columns is NULL or empty, else NULL."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | _col(c).isNull() | (_col(c) == "")
    return F.when(missing, F.lit(400))


def cast_code(c: Column | str) -> Column:
    """An error code of any type as an int; text that is no number becomes NULL."""
    return _col(c).try_cast("int")
