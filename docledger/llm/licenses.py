"""License texts in documents, found by diagonal voting.

Every run of three neighbouring words of every document is hashed; a Spark join matches the hashes to
the places where the templates hold them. A match at word ``pos`` of a document and word ``tpos`` of a
template votes for the diagonal ``pos - tpos``: a copy of the template that begins there. Votes are
counted by diagonal; neighbouring diagonals, which words put in or left out shift against one another,
are merged into spans; a span is verified by the longest run of matches that ascends in both texts,
and counts where that covers enough of the template and of the span, and no other license matches the place better.

Phrases are templates that must be whole: a place of a phrase is a diagonal that all its hashes vote for.

Scale: the templates are broadcast (``MOST_TEMPLATE_WORDS`` bounds them), texts are not shuffled, only
matches are. Texts of more than ``STRIDE`` words are voted on in overlapping parts; a span belongs to the
part it begins in, and no group is larger than a part, however long or repetitive a text is.

Odd rows: a null or empty text has no words and no labels, its row has zeros and empty strings; rows that repeat
an id, also with the same text, each give a row; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from docledger.llm.text import windows, word_hashes
from docledger.session import ship

#: Words of a hash.
K = 3
#: Words of a part, and how many of the parts before and behind it reads.
STRIDE, OVERLAP = 32_768, 2_048
#: Words of all templates together: what is broadcast stays below 40 bytes for each.
MOST_TEMPLATE_WORDS = 1_000_000
#: Diagonals no more than this far apart are neighbours, if at most ``GAP`` words lie between their matches.
SHIFT, GAP = 8, 24
#: Least shares of a template's words, and of a span's, that a span must have matched in order.
COVERED, DENSE = 0.6, 0.6
#: Rows handed to Spark at once.
ROWS = 1 << 16

# The phrases of the contract, with their labels.
PHRASES = {
    "mit": ("under the mit license",),
    "apache-2": ("apache license version 2",),
    "cc-by-nc": ("cc by nc",),
}

# Notices of public licenses, as their authors ask to have them quoted.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "gpl-2": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License",
        "under the GNU General Public License, version 2",
    ),
    "gpl-3": (
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
        "under the GNU General Public License, version 3",
    ),
    "lgpl": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "agpl-3": (
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "licensed under CC BY-NC 4.0",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "licensed under CC BY 4.0",
    ),
}

# Bytes of words; A-Z as a-z, all others as a blank.
_WORD = bytes(b | 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
              for b in range(256))
# Joins the row that tells how many words a text has: no template, so a number of its own.
_COUNT = -1
_COUNT_GRAM = 0x6C6963656E736573

#: What a template found: ``whole`` for phrases, else a verified span.
SPANS = StructType([
    StructField("label", StringType()), StructField("whole", StringType()),
    StructField("start", LongType()), StructField("end", LongType()), StructField("covered", DoubleType())])


def word_list(text: str) -> list[bytes]:
    """Words of a text: digits, letters in lower case and all that is not ASCII."""
    return text.encode().translate(_WORD).split()


def _grams(words: np.ndarray) -> np.ndarray:
    return windows(words, K).view(np.int64)


def _listed(phrases: Mapping[str, tuple], templates: Mapping[str, tuple]) -> list[tuple[str, bool, int, list[int]]]:
    """Label, whether it is a phrase, number of words and hashes of each template, by its number."""
    out = []
    for whole, group in ((True, phrases), (False, templates)):
        for label, texts in group.items():
            for text in texts:
                hashes, _ = word_hashes([text.encode().translate(_WORD)], lower=False)
                if len(hashes) < K:
                    raise ValueError(f"a template needs {K} words: {text!r}")
                if 2 * len(hashes) > OVERLAP:
                    raise ValueError(f"a template may have {OVERLAP // 2} words: {text[:40]!r}")
                out.append((label, whole, len(hashes), _grams(hashes).tolist()))
    if sum(t[2] for t in out) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words cannot be broadcast")
    return out


def _rolled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for every run of ``K`` words of every text, and one that tells its number of words."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    schema = StructType([source.schema["doc_id"], source.schema["text_hash"],
                         *[StructField(c, LongType()) for c in ("part", "pos", "gram")]])
    arrow = to_arrow_schema(schema)

    def of_text(words: np.ndarray, row: int) -> Iterator[tuple]:
        """Places in the batch, parts, positions and hashes, in pieces."""
        grams = _grams(words) if len(words) >= K else np.zeros(0, np.int64)
        yield (np.array([row]), np.zeros(1, np.int64), np.array([len(words)]), np.array([_COUNT_GRAM]))
        for at in range(0, len(grams), ROWS):
            piece = grams[at:at + ROWS]
            pos = np.arange(at, at + len(piece))
            part = pos // STRIDE
            # A part also reads the end of the one before and the beginning of the next one.
            first = (part > 0) & (pos - part * STRIDE < OVERLAP)
            last = ((part + 1) * STRIDE - pos <= OVERLAP) & (part < (len(grams) - 1) // STRIDE)
            parts = np.concatenate([part, part[first] - 1, part[last] + 1])
            yield (np.full(len(parts), row), parts, np.concatenate([pos, pos[first], pos[last]]),
                   np.concatenate([piece, piece[first], piece[last]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(batch, held):
            rows, part, pos, gram = (np.concatenate(x) for x in zip(*held, strict=True))
            at = pa.array(rows)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(part), pa.array(pos), pa.array(gram)],
                schema=arrow)

        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                hashes, bounds = word_hashes([t.translate(_WORD) for t in batch.column(2).to_pylist()], lower=False)
                held, size = [], 0
                for row in range(batch.num_rows):
                    for piece in of_text(hashes[bounds[row]:bounds[row + 1]], row):
                        held.append(piece)
                        size += len(piece[0])
                        if size >= ROWS:
                            yield batch_of(batch, held)
                            held, size = [], 0
                if held:
                    yield batch_of(batch, held)

    return source.mapInArrow(run, schema)


def merged(diagonals: list[tuple[int, list[int]]], words: int) -> list[tuple[int, int, float]]:
    """Verified spans from the votes of one template: first word, word behind the last, covered share.

    ``diagonals`` are offsets with the positions that voted for them; ``words`` is the template's length.
    """
    cells = sorted((pos, pos - diagonal) for diagonal, at in diagonals for pos in at)
    groups: list[list[tuple[int, int]]] = []
    open_ones: list[tuple[int, int, int]] = []  # last position, diagonal and number of a group
    for pos, tpos in cells:
        diagonal = pos - tpos
        open_ones = [g for g in open_ones if pos - g[0] <= GAP + K]  # others are too far behind
        near = [g for g in open_ones if abs(diagonal - g[1]) <= SHIFT]
        if near:
            # The nearest diagonal; of these the group that was touched last.
            taken = min(near, key=lambda g: (abs(diagonal - g[1]), -g[0]))
            open_ones.remove(taken)
            number = taken[2]
        else:
            number = len(groups)
            groups.append([])
        groups[number].append((pos, tpos))
        open_ones.append((pos, diagonal, number))
    out = []
    for group in groups:
        chain = ascending(group)
        covered = set().union(*(range(t, t + K) for _, t in chain))
        taken = set().union(*(range(p, p + K) for p, _ in chain))
        start, end = min(taken), max(taken) + 1
        share = len(covered) / words
        if share >= COVERED and len(taken) >= DENSE * (end - start):
            out.append((start, end, share))
    return out


def strongest(spans: list[tuple]) -> list[tuple]:
    """Without spans that the templates of other licenses match better: more words, or as many to a greater share.

    Two spans are of one place where more than half of the shorter lies in the other. Phrases always stay.
    """
    def weight(span):
        return span[4] * (span[3] - span[2]), span[4]

    ranked = sorted((s for s in spans if s[1] is None), key=weight, reverse=True)
    kept: list[tuple] = []
    for span in ranked:
        beaten = any(
            other[0] != span[0] and weight(other) > weight(span)
            and 2 * (min(other[3], span[3]) - max(other[2], span[2])) > min(other[3] - other[2], span[3] - span[2])
            for other in kept)
        if not beaten:
            kept.append(span)
    return [s for s in spans if s[1] is not None] + kept


def ascending(cells: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of cells that ascends in both numbers."""
    cells = sorted(cells, key=lambda c: (c[0], -c[1]))
    tails, places, before = [], [], []
    for i, (_, tpos) in enumerate(cells):
        at = bisect_left(tails, tpos)
        tails[at:at + 1] = [tpos]
        places[at:at + 1] = [i]
        before.append(places[at - 1] if at else None)
    out, i = [], places[-1] if places else None
    while i is not None:
        out.append(cells[i])
        i = before[i]
    return out[::-1]


def license_spans(docs: DataFrame, phrases: Mapping[str, tuple] = PHRASES,
                  templates: Mapping[str, tuple] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_words, copies`` with what was found: ``label, whole, start, end, covered``.

    ``whole`` names the phrase that stands there word by word and is null for a merged span. Each text gives one more
    row without a label, which alone holds ``n_words`` and ``copies``, the number of rows with that id and text.
    """
    spark = docs.sparkSession
    ship(spark)
    known = _listed(phrases, templates)
    places = [(gram, number, tpos) for number, (*_, grams) in enumerate(known) for tpos, gram in enumerate(grams)]
    places.append((_COUNT_GRAM, _COUNT, 0))
    table = spark.createDataFrame(places, "gram long, template long, tpos long")
    votes = (
        _rolled(docs, id_col, text_col).join(F.broadcast(table), "gram")
        .withColumn("diagonal", F.col("pos") - F.col("tpos"))
        .groupBy("doc_id", "text_hash", "part", "template", "diagonal")
        .agg(F.collect_set("pos").alias("at"), F.count("*").alias("n"))
        .groupBy("doc_id", "text_hash", "part")
        .agg(F.collect_list(F.struct("template", "diagonal", "at", "n")).alias("votes")))
    schema = StructType([votes.schema["doc_id"], votes.schema["text_hash"], StructField("n_words", LongType()),
                         StructField("copies", LongType()), *SPANS.fields])
    arrow = to_arrow_schema(schema)
    facts = [(label, whole, words, len(grams)) for label, whole, words, grams in known]
    names = [text for group in (phrases, templates) for texts in group.values() for text in texts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, part in enumerate(batch.column("part").to_pylist()):
                found = defaultdict(list)
                for vote in batch.column("votes")[i].as_py():
                    found[vote["template"]].append(vote)
                for count in found.pop(_COUNT, ()):
                    rows.append((count["diagonal"], count["n"], None, None, None, None, None))
                    at.append(i)
                spans = []
                for template, cast in found.items():
                    label, whole, words, grams = facts[template]
                    if whole:
                        spans += [(label, names[template], v["diagonal"], v["diagonal"] + words, 1.0)
                                  for v in cast if len(v["at"]) == grams]
                    else:
                        spans += [(label, None, *span) for span in
                                  merged([(v["diagonal"], v["at"]) for v in cast], words)]
                own = [(None, None, *span) for span in strongest(spans) if span[2] // STRIDE == part]
                rows += own
                at += [i] * len(own)
            if rows:
                taken = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(taken), batch.column(1).take(taken),
                     *[pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), list(arrow)[2:], strict=True)]],
                    schema=arrow)

    return votes.select("doc_id", "text_hash", "part", "votes").mapInArrow(run, schema)


def license_scan(docs: DataFrame, **options) -> DataFrame:
    """A row for each row of ``docs``: what ``license_spans`` found, counted.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` follow the phrases, ``labels`` also the merged spans;
    ``score`` is the largest share of a template that was found, 1 for a phrase, 0 without any.
    """
    base = F.col("whole").isNotNull()

    def listed(label):
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    found = license_spans(docs, **options).groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.max("copies").alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"), listed("label").alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"))
    once = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return once.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
