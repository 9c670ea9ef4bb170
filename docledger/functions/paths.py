"""Path text as Spark expressions. Every function maps columns to a column."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, functions as F

SEP = "\\"

# Every character that counts as white space at either end of a path.
_WHITE_SPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())

_UNC = r"(?d)^\\\\([^\\]+)\\([^\\]+)\\(.+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_path(root: Column | str, container: Column | str, name: Column | str,
              mode: str = "single") -> Column:
    """Join the three path parts.

    ``single``    one separator; NULL when any part is NULL
    ``double``    two separators; NULL when any part is NULL
    ``unc``       leading double separator, then single ones; NULL when any part is NULL
    ``skip_null`` two separators between the parts that are not NULL
    """
    parts = [_col(root), _col(container), _col(name)]
    if mode == "skip_null":
        return F.concat_ws(SEP * 2, *parts)
    if mode not in ("single", "double", "unc"):
        raise ValueError(f"unknown path mode: {mode}")
    gap = F.lit(SEP * 2 if mode == "double" else SEP)
    joined = F.concat(parts[0], gap, parts[1], gap, parts[2])
    return F.concat(F.lit(SEP * 2), joined) if mode == "unc" else joined


def normalise_path(c: Column | str, strip: bool = True) -> Column:
    """Forward slashes become backslashes; white space at both ends goes if ``strip``."""
    turned = F.translate(_col(c), "/", SEP)
    return F.btrim(turned, F.lit(_WHITE_SPACE)) if strip else turned


def path_allowed(c: Column | str, patterns: Sequence[str]) -> Column:
    """True when any pattern matches from the first character, whatever the case.

    Blank patterns are ignored, patterns that the JVM, which runs them, cannot compile are skipped,
    and a list without any pattern is a configuration error. A NULL path is not allowed.
    """
    given = [p for p in patterns if p and p.strip()]
    if not given:
        raise ValueError("no path patterns configured")
    allowed = F.lit(False)
    for pattern in given:
        # U: letters and digits of any script; d: only a line feed ends a line.
        whole = f"(?iUd)^(?:{pattern})"
        if _compiles(pattern) and _compiles(whole):
            allowed = allowed | _col(c).rlike(whole)
    return F.coalesce(allowed, F.lit(False))


def _compiles(pattern: str) -> bool:
    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError("patterns are compiled by Spark: start a session first")
    try:
        context._jvm.java.util.regex.Pattern.compile(pattern)
    except (Py4JJavaError, IllegalArgumentException):
        return False
    return True


def parse_unc(c: Column | str) -> Column:
    r"""``\\server\share\rest`` as struct(server, share, relative); NULL if not of that form."""
    path = _col(c)
    fields = [F.regexp_extract(path, _UNC, i + 1).alias(name)
              for i, name in enumerate(("server", "share", "relative"))]
    return F.when(path.rlike(_UNC), F.struct(*fields))


def unc_error(c: Column | str) -> Column:
    """400 for a path that cannot name a file on a share, else NULL."""
    path = _col(c)
    segments = F.size(F.split(F.btrim(path, F.lit(SEP)), r"\\"))
    good = path.startswith(SEP * 2) & (segments >= 3)
    return F.when(~F.coalesce(good, F.lit(False)), F.lit(400))


def base_name(c: Column | str) -> Column:
    """Text after the last backslash; without any backslash, after the last slash."""
    path = _col(c)
    return F.when(path.contains(SEP), F.substring_index(path, SEP, -1)).otherwise(
        F.substring_index(path, "/", -1))


def route_share(c: Column | str, shares: Sequence[str]) -> Column:
    """struct(share, relative, code) for the first listed share found inside the path.

    ``relative`` is what follows the first occurrence of the share name. A path on none of
    the shares keeps its row and gets code 400.
    """
    path = _col(c)
    share, relative = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in reversed(shares):
        found = path.contains(f"{SEP}{name}{SEP}")
        start = F.instr(path, f"{name}{SEP}") + F.lit(len(name) + 1)
        share = F.when(found, F.lit(name)).otherwise(share)
        relative = F.when(found, F.substr(path, start)).otherwise(relative)
    return F.struct(share.alias("share"), relative.alias("relative"),
                    F.when(share.isNull(), F.lit(400)).alias("code"))


def target_key(file_name: Column | str, template: str = "prefix/ar/file", *,
               prefix: str | None = None, auth: Column | str | None = None,
               doc: Column | str | None = None, ar: Column | str | None = None) -> Column:
    """Object key for a file. ``template`` lists the parts: prefix, auth, doc, ar, file.

    A missing ``ar`` value becomes ``default``; any other missing part makes the key NULL.
    """
    parts = {"file": _col(file_name)}
    if prefix is not None:
        parts["prefix"] = F.lit(prefix)
    if auth is not None:
        parts["auth"] = _col(auth)
    if doc is not None:
        parts["doc"] = _col(doc)
    parts["ar"] = F.coalesce(_col(ar), F.lit("default")) if ar is not None else F.lit("default")
    names = template.split("/")
    unknown = [n for n in names if n not in parts]
    if unknown:
        raise ValueError(f"template {template!r} needs a value for {unknown}")
    pieces: list[Column] = []
    for name in names:
        pieces += [F.lit("/"), parts[name]] if pieces else [parts[name]]
    return F.concat(*pieces) if len(pieces) > 1 else pieces[0]


def target_uri(base: str, key: Column | str) -> Column:
    """Public location text of an object key."""
    return F.concat(F.lit(base.rstrip("/") + "/"), _col(key))


def guid_parts(c: Column | str) -> tuple[Column, Column]:
    """What stays of an identifier before and after the two characters a number replaces."""
    segments = F.split(_col(c), "-")
    head = F.when(F.size(segments) >= 5,
                  F.concat(F.array_join(F.slice(segments, 1, 4), "-"), F.lit("-")))
    return head, F.substr(F.get(segments, 4), F.lit(3))


def two_digits(i: Column) -> Column:
    """A number from 0 on as text of at least two digits."""
    return F.when(i < 10, F.concat(F.lit("0"), i.cast("string"))).otherwise(i.cast("string"))


def guid_suffix(c: Column | str, i: Column) -> Column:
    """Overwrite the first two characters of the fifth ``-`` segment with a number.

    The number has two digits (more from 100 on); segments after the fifth are dropped, and an
    identifier with fewer than five gives NULL.
    """
    head, tail = guid_parts(c)
    return F.concat(head, two_digits(i), tail)
