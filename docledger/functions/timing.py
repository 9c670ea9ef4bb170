"""Time values as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(text: str) -> Column:
    """A fixed run time, given as text in the session time zone."""
    return F.to_timestamp(F.lit(text))


def elapsed_ms(start: Column | str, end: Column | str, at_least: int | None = None) -> Column:
    """Whole milliseconds between two instants, cut toward zero."""
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
    whole = (micros / 1000).cast("bigint")
    return F.greatest(F.lit(at_least).cast("bigint"), whole) if at_least is not None else whole


def with_zulu(text: Column | str) -> Column:
    """Append ``Z`` to ISO text that carries no ``+`` offset."""
    return F.when(_col(text).contains("+"), _col(text)).otherwise(F.concat(_col(text), F.lit("Z")))


def iso_text(ts: Column | str) -> Column:
    """ISO text with microseconds only where there are any, and no offset."""
    fraction = F.date_format(_col(ts), "SSSSSS")
    seconds = F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fraction == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), fraction))


def iso_utc(ts: Column | str) -> Column:
    return with_zulu(iso_text(ts))


def stamped_name(ts: Column | str, folder: str = "audit-logs") -> Column:
    """``folder/uploaded_<iso text>`` with the colons replaced, safe as an object name."""
    return F.concat(F.lit(f"{folder}/uploaded_"), F.translate(iso_text(ts), ":", "_"))
