import os
import re
from collections import Counter

import llm_helpers as given
import pytest

from docledger.llm.quality import drop_low_quality, limits, quality



def plain(text):
    """The base counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


ODD = [None, "", " \n\t", "a", "x\nx\nx \n\n\n", "é ü #*$%&|<> 日本", "a b c a b c a b", "w " * 3000]


def test_counts(spark):
    rows = given.small() + [(10_000 + i, t) for i, t in enumerate(ODD)]
    got = given.by_id(quality(given.clashing(given.documents(spark, rows))))
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text), i
        assert r.kept == (r.reason is None) and not (r.base_failed and r.kept)


def test_bands(spark):
    prose = " ".join(t for _, t in given.small() if t[:1].isalpha() and "!!" not in t and " | " not in t)[:6000]
    hexes = " ".join(os.urandom(9).hex() for _ in range(400))
    binary = " ".join("".join(chr(33 + b % 90) for b in os.urandom(30)) for _ in range(300))
    repeated = " ".join(f"{'same words again and again here ' * 4}{i}" for i in range(80))
    got = given.by_id(quality(given.documents(
        spark, [(1, prose), (2, binary), (3, repeated), (4, hexes), (None, prose)])))
    assert got[1].kept and got[None].kept and not got[2].kept and not got[3].kept
    assert got[2].reason == "incompressible"
    low, high = zip(*[limits(n) for n in (0, 300, 600, 5000, 10**6)], strict=True)
    assert list(low) == sorted(low, reverse=True) and list(high) == sorted(high, reverse=True)


@pytest.mark.parametrize("label, least, most", [(1, 0.97, 1.0), (0, 0.0, 0.75)])
def test_against_labels(spark, label, least, most):
    """Good labelled texts long enough to judge stay; many bad ones go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where(f"quality = {label}")
    rows = quality(docs.join(labels.select("doc_id"), "doc_id")).where("n_words >= 50").collect()
    assert least <= sum(r.kept for r in rows) / len(rows) <= most


def test_filter_keeps_columns(spark):
    docs = given.clashing(given.documents(spark, given.small(60) + [(500, None), (None, given.small(1)[0][1])]))
    kept = drop_low_quality(docs)
    assert kept.schema == docs.schema
    verdicts = quality(docs).where("kept")
    assert kept.count() == verdicts.count()
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in verdicts.collect())
    assert drop_low_quality(docs.limit(0)).count() == 0


def test_chunks_cover_the_whole_text():
    """A short rest is part of the last chunk: junk there counts."""
    import random

    from docledger.llm.quality import CHUNK, LEAST_CHUNK, Rules
    from docledger.llm.text import word_hashes

    rng, rules, seen = random.Random(4), Rules(), []
    rules.ratio = lambda raw: seen.append(raw) or 0.5
    for size in (0, 1, LEAST_CHUNK - 1, LEAST_CHUNK, CHUNK, CHUNK + 1, CHUNK + LEAST_CHUNK - 1, CHUNK + LEAST_CHUNK, 5 * CHUNK + 77):
        raw = bytes(rng.randrange(97, 123) for _ in range(size))
        seen.clear()
        rules.judge(1, raw, word_hashes([raw])[0])
        assert seen[0] == raw
        assert b"".join(seen[1:]) == (raw if size >= LEAST_CHUNK else b"")
        assert all(LEAST_CHUNK <= len(chunk) < CHUNK + LEAST_CHUNK for chunk in seen[1:])
