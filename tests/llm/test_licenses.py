"""Diagonal voting against plain searches of whole texts."""

import random

from llm_helpers import SMALL, clashing, documents, small

from docledger.llm import licenses as li
from docledger.llm.queries import QUERIES


def plain(text):
    """Places of the phrases, by looking at every word."""
    words = li.word_list(text or "")
    found = []
    for label, phrases in li.PHRASES.items():
        for phrase in phrases:
            wanted = phrase.encode().split()
            found += [(i, label) for i in range(len(words)) if words[i:i + len(wanted)] == wanted]
    return (len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None),
            ",".join(sorted({label for _, label in found})))


def base(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
                   for r in df.collect()), key=repr)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_given_table(spark):
    got = QUERIES["op11_license_scan"](spark, SMALL)
    assert base(got) == sorted(((i, *plain(t)) for i, t in small()), key=repr)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "..."), (4, "Under the MIT-license, under the mit license"), (4, "cc BY nc"), (4, "cc BY nc"),
            (None, "x apache license, version 2"), (5, "cc by nc by nc cc by"), (6, "cc by")]
    docs = clashing(documents(spark, rows)).withColumnRenamed("v", "gram_")
    assert base(li.license_scan(docs)) == sorted(((i, *plain(t)) for i, t in rows), key=repr)
    assert li.license_scan(documents(spark, [(1, "a")]).limit(0)).collect() == []


def test_score_and_labels(spark):
    notice = li.TEMPLATES["bsd"][0]
    words = notice.split()
    shortened = " ".join(words[:10] + ["indeed"] + words[10:20] + words[22:])
    half = " ".join(words[:len(words) // 3])
    shuffled = " ".join(random.Random(1).sample(words, len(words)))
    rows = [(1, f"a b c {notice} d e"), (2, f"a b {shortened}"), (3, half), (4, shuffled),
            (5, "This work is licensed under the gnu general public license, version 3."), (6, notice + " " + "filler " * 50 + notice)]
    got = {r.doc_id: (r.base_labels, r.labels, r.score) for r in li.license_scan(documents(spark, rows)).collect()}
    assert got[1] == ("", "bsd", 1.0)
    assert got[2][1] == "bsd" and 0.8 < got[2][2] < 1
    assert got[3] == ("", "", 0.0) and got[4] == ("", "", 0.0)
    assert got[5] == ("", "gpl-3", 1.0)
    spans = li.license_spans(documents(spark, rows)).where("doc_id = 6 AND label = 'bsd'").collect()
    n = len(li.word_list(notice))
    assert sorted((r.start, r.end) for r in spans) == [(0, n), (n + 50, 2 * n + 50)]


def test_spans_against_longest_common_subsequence():
    """No verified span claims more of a template than the texts have in common, and good copies lose little."""
    rng = random.Random(3)
    template = [f"w{i}" for i in range(60)]
    for _ in range(60):
        text = list(template)
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(text))
            if rng.random() < 0.5:
                text[at:at] = [f"x{rng.random()}"] * rng.randrange(1, 4)
            else:
                del text[at:at + rng.randrange(1, 3)]
        text = ["y"] * rng.randrange(5) + text + ["z"] * 3
        diagonals = {}
        for t in range(len(template) - 2):
            for p in range(len(text) - 2):
                if template[t:t + 3] == text[p:p + 3]:
                    diagonals.setdefault(p - t, []).append(p)
        best = max((share for _, _, share in li.merged(list(diagonals.items()), 60)), default=0)
        common = lcs(template, text) / 60
        assert best <= common + 1e-9
        assert best >= common - 0.35


def test_ascending():
    assert li.ascending([]) == []
    assert li.ascending([(1, 5), (2, 1), (3, 2), (3, 3), (4, 0), (5, 3)]) == [(2, 1), (3, 2), (5, 3)]


def test_long_text(spark):
    """More words than a part: places at and across the borders of parts are found once."""
    n = 2 * li.STRIDE + 5000
    words = ["w"] * n
    for at in (0, li.STRIDE - 2, li.STRIDE + li.OVERLAP - 3, 2 * li.STRIDE, n - 4):
        words[at:at + 4] = ["under", "the", "mit", "license"]
    bsd = li.word_list(li.TEMPLATES["bsd"][0])
    words[2 * li.STRIDE - 10:2 * li.STRIDE - 10 + len(bsd)] = [w.decode() for w in bsd]
    text = " ".join(words)
    docs = documents(spark, [(1, text), (2, "cc by nc")])
    assert base(li.license_scan(docs)) == sorted([(1, *plain(text)), (2, *plain("cc by nc"))], key=repr)
    spans = li.license_spans(docs).where("label = 'bsd'").collect()
    assert [(s.start, s.end) for s in spans] == [(2 * li.STRIDE - 10, 2 * li.STRIDE - 10 + len(bsd))]


def test_parameters(spark):
    import pytest

    docs = documents(spark, [(1, "one two three four five")])
    got = li.license_scan(docs, phrases={"p": ("two three four",)}, templates={}).first()
    assert (got.n_base, got.first_word, got.labels) == (1, 1, "p")
    with pytest.raises(ValueError):
        li.license_scan(docs, phrases={"p": ("two",)}, templates={})
