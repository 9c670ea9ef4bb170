"""JSON requests and replies as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from docledger.functions.status import first_filled, missing_required

REPLY_FIELDS = ("status", "message", "error", "detail", "azure_blob_path", "blob_url",
                "blob_path", "total_bytes", "sha256", "data")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_json(text: Column) -> Column:
    # Inside brackets a whole document is one array element; text after the document, which a
    # plain lookup would overlook, makes the array malformed or longer.
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(one, F.lit(False))


def _starts(text: Column, mark: str) -> Column:
    return F.ltrim(text, F.lit(" \t\r\n")).startswith(mark)


def parse_reply(body: Column | str) -> Column:
    """A reply body as a struct of ``REPLY_FIELDS``.

    Text that is no JSON becomes the message, and so does a bare JSON string. JSON that is not
    an object is kept whole in ``data``. Every body is first brought into the form of an object,
    so that each is parsed only once.
    """
    text = _col(body)
    is_json = _is_json(text)
    as_object = (
        F.when(is_json & _starts(text, "{"), text)
        .when(is_json & _starts(text, '"'),
              F.concat(F.lit('{"message":'), text, F.lit(',"data":'), text, F.lit("}")))
        .when(is_json, F.concat(F.lit('{"data":'), text, F.lit("}")))
        .otherwise(F.to_json(F.struct(text.alias("message")))))
    return F.from_json(as_object, ", ".join(f"{name} string" for name in REPLY_FIELDS))


def parse_request(body: Column | str, fields: Sequence[str] = ("file_path", "ar_number"),
                  required: Sequence[str] = ("file_path", "ar_number")) -> Column:
    """A request body as struct(``fields``, mime_type, code).

    ``code`` is 400 for text that is no JSON object or lacks a required field, else NULL;
    ``mime_type`` falls back to ``application/json``.
    """
    text = _col(body)
    parsed = F.from_json(text, ", ".join(f"{name} string" for name in (*fields, "mime_type")))
    is_object = F.coalesce(_is_json(text) & _starts(text, "{"), F.lit(False))
    mime = F.coalesce(first_filled(parsed["mime_type"]), F.lit("application/json"))
    code = F.when(~is_object, F.lit(400)).otherwise(
        missing_required(*[parsed[name] for name in required]))
    return F.struct(*[F.when(is_object, parsed[name]).alias(name) for name in fields],
                    mime.alias("mime_type"), code.alias("code"))


def reply_target(url: Column | str, path: Column | str, key: Column | str) -> Column:
    """Where the file went: the reply's URL, else its path, else the key asked for, else ''."""
    return F.coalesce(first_filled(url, path, key), F.lit(""))


def payload_json(*columns: Column | str) -> Column:
    """The columns as one JSON object per row, NULL values included."""
    return F.to_json(F.struct(*[_col(c) for c in columns]), {"ignoreNullFields": "false"})
