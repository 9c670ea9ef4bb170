"""Quality rules: word counts, repeats, and bands for the zstandard ratio of texts and chunks."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from docledger.llm.text import keep_rows, map_documents, windows, word_hashes

#: From this many bytes on, the ratio (compressed by plain bytes) must lie between the two limits.
#: Prose of the given tables lies at 0.39 to 0.75, the lower the longer it is.
BANDS = (
    (0, 0.38, 1.50),
    (300, 0.36, 0.92),
    (600, 0.34, 0.84),
    (1_200, 0.32, 0.76),
    (2_400, 0.30, 0.70),
    (4_800, 0.28, 0.66),
    (20_000, 0.26, 0.62),
)
CHUNK = 4096
#: A shorter rest at the end of a text belongs to the chunk before it; a shorter text is judged as a whole only.
LEAST_CHUNK = 2048
CHUNK_BAND = (0.27, 0.72)
#: A text with a larger share of chunks outside the band is rejected.
BAD_CHUNKS = 0.2
SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, ratio double, n_chunks int, n_bad_chunks int, base_failed boolean, "
    "reason string, kept boolean")


def _dup_lines(raw: bytes) -> int:
    seen, repeats = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            repeats += 1
        elif line.split(None, 1):
            seen.add(line)
    return repeats


def _repeat_words(h: np.ndarray) -> int:
    """Words inside some 3-word window that the text holds twice or more."""
    grams = windows(h, 3)
    if len(grams) < 2:
        return 0
    _, where, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[j:j + len(grams)] |= again
    return int(covered.sum())


def _code_points(raw: bytes) -> int:
    """Characters that are no blanks."""
    data = np.frombuffer(raw, np.uint8)
    blank = (data == 0x20) | ((data >= 9) & (data <= 13))
    return int(((data & 0xC0) != 0x80).sum() - blank.sum())


def limits(size: int, bands=BANDS) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(bands) if size >= least)


class Rules:
    def __init__(self, level: int = 3, bands=BANDS):
        self.zstd, self.bands = zstandard.ZstdCompressor(level=level), bands

    def ratio(self, raw: bytes) -> float:
        return len(self.zstd.compress(raw)) / len(raw) if raw else 0.0

    def judge(self, doc_id, raw: bytes, h: np.ndarray) -> tuple:
        n, repeats = len(h), _repeat_words(h)
        failed = n < 50 or 100 * repeats > 50 * n
        whole = self.ratio(raw)
        starts = [i for i in range(0, len(raw), CHUNK) if len(raw) - i >= LEAST_CHUNK]
        chunks = [self.ratio(raw[i:end]) for i, end in zip(starts, [*starts[1:], len(raw)])]
        bad = sum(not CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in chunks)
        low, high = limits(len(raw), self.bands)
        reason = ("base" if failed else "repetitive" if whole < low else
                  "incompressible" if whole > high else
                  "chunks" if bad > BAD_CHUNKS * len(chunks) else None)
        return (doc_id, n, _code_points(raw), len(raw) - len(raw.translate(None, SYMBOLS)),
                _dup_lines(raw), repeats, whole, len(chunks), bad, failed, reason, reason is None)


def _grouped(documents, size: int = 200):
    group = []
    for doc in documents:
        group.append(doc)
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            level: int = 3) -> DataFrame:
    """One row for each row of ``docs``: the counts, the ratio, the reason of a rejection, ``kept``.

    A null or empty text has no words and fails; a null id stays null; repeated rows are judged each
    by itself; other columns are not read, so their names cannot clash. Words are compared by 64-bit
    hashes. No shuffle; memory follows the longest text.
    """
    def each(documents):
        rules = Rules(level)
        for group in _grouped(documents):
            h, bounds = word_hashes([raw for _, raw in group], lower=False)
            for i, (doc_id, raw) in enumerate(group):
                yield rules.judge(doc_id, raw, h[bounds[i]:bounds[i + 1]])

    return map_documents(docs, SCHEMA, each, id_col, text_col)


def drop_low_quality(docs: DataFrame, text_col: str = "text", level: int = 3) -> DataFrame:
    """The rows that ``quality`` keeps, with all their columns."""
    def verdicts(texts):
        rules = Rules(level)
        h, bounds = word_hashes(texts, lower=False)
        return [rules.judge(None, raw, h[bounds[i]:bounds[i + 1]])[-1]
                for i, raw in enumerate(texts)]

    return keep_rows(docs, verdicts, text_col)
