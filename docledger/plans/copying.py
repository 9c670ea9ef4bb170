"""Verified file copies as a distributed job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, functions as F

from docledger.functions.paths import base_name, parse_unc, path_allowed, target_key, unc_error
from docledger.functions.status import OTHER
from docledger.operators.dispatch import AttemptPolicy, dispatch
from docledger.sources.files import FileCopy
from docledger.sources.staging import stage


def source_file(path: Column | str) -> Column:
    r"""Place of ``\\server\share\rest`` in a tree of mounted shares: ``server/share/rest``.

    Path modes that join with two separators name the same file as those that join with one.
    """
    parts = parse_unc(path)
    slash = F.lit("/")
    return F.concat(parts["server"], slash, parts["share"], slash,
                    F.ltrim(F.regexp_replace(parts["relative"], r"\\+", "/"), slash))


def locate(worklist: DataFrame, prefix: str, template: str = "prefix/ar/file") -> DataFrame:
    """Add where each file is and where it goes; paths that name no file get a reject code."""
    return worklist.withColumns({
        "source_file": source_file("full_path"),
        "target_key": target_key(base_name("full_path"), template, prefix=prefix,
                                 auth="auth_request_id", doc="document_id", ar="ar_number"),
        "reject_code": unc_error("full_path").cast("int"),
        "reject_text": F.when(unc_error("full_path").isNotNull(), F.lit("Invalid path")),
    })


def _refused(located: DataFrame, where: Column, code: int, text: str) -> DataFrame:
    """Give rows that nothing has refused yet this code and text."""
    refused = F.col("reject_code").isNull() & where
    return located.withColumns({
        "reject_code": F.when(refused, F.lit(code)).otherwise(F.col("reject_code")),
        "reject_text": F.when(refused, F.lit(text)).otherwise(F.col("reject_text")),
    })


def claims_folder(correlation_id: str) -> str:
    """Below the target root: what a run that replaces nothing has claimed. May be deleted when the run is over."""
    return f".claims/{quote(correlation_id, safe='')}"


def copy_files(worklist: DataFrame, source_root: str, target_root: str, *, stage_path: str,
               correlation_id: str, prefix: str = "documents", template: str = "prefix/ar/file",
               overwrite: bool = True, policy: AttemptPolicy | None = None,
               allowed: Sequence[str] | None = None, transport: Callable[..., FileCopy] = FileCopy,
               **calling: Any) -> DataFrame:
    """Copy every file of the worklist and return the staged outcomes.

    Without ``overwrite``, of several rows with one target all but one are refused, and a copy is
    published only if there is no such target in that instant, so that also a target somebody else makes during
    the run is refused and kept. Which row it is that may copy is staged first, and what the run itself has copied is
    known by claims in ``claims_folder``: neither a task that runs again nor a run that is repeated takes its
    own copies for foreign ones. ``allowed`` lists patterns of paths that may be copied; others are
    refused with 403.
    """
    located = locate(worklist, prefix, template)
    if allowed is not None:
        located = _refused(located, ~path_allowed("full_path", allowed), 403, "Path not allowed")
    if not overwrite:
        guarded = stage(located.withColumn("_row", F.monotonically_increasing_id()), f"{stage_path}-guard")
        first = (guarded.where("reject_code IS NULL").groupBy("target_key")
                 .agg(F.min("_row").alias("_first")))
        located = _refused(guarded.join(first, "target_key", "left"), F.col("_row") != F.col("_first"),
                           500, "Target exists").select(*located.columns)
    send = transport(source_root, target_root, claims=None if overwrite else claims_folder(correlation_id))
    return dispatch(located, send, stage_path=stage_path, correlation_id=correlation_id,
                    errors="storage", open_client=send.open_client,
                    policy=policy or AttemptPolicy(other_kinds=(OTHER,)), **calling)
