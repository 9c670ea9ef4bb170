import os
import re
from collections import Counter
from pathlib import Path

import llm_helpers as given
import numpy as np
import pyarrow as pa

from docledger.llm import text
from docledger.llm.text import map_documents, shingle_set, windows, word_hashes


def test_words_of_all_texts():
    texts = [t for _, t in given.small()] + ["", " \t\n\x0b\x0c\r", "É\x85b \xa0x", "a", "ABC abc"]
    h, bounds = word_hashes([t.encode() for t in texts])
    assert np.diff(bounds).tolist() == [len(given.words(t)) for t in texts]
    flat = [w for t in texts for w in given.words(t)]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_case_can_be_kept():
    h, _ = word_hashes([b"Ab ab"], lower=False)
    assert h[0] != h[1]


def test_long_texts_are_cut_at_blanks(monkeypatch):
    texts = ["one two  three\n" * 40, "x" * 500 + " y", "", "z"]
    whole = word_hashes([t.encode() for t in texts], tails=True)
    monkeypatch.setattr(text, "BLOCK", 64)
    cut = word_hashes([t.encode() for t in texts], tails=True)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_words_of_any_bytes():
    """Only the six blanks part words, the last two bytes are those of the word, a word hashes alike wherever it stands."""
    data = bytes(range(256)) + b"\t\x00 " + bytes(range(255, -1, -1)) + b" ab ab\x0c\x0bb"
    h, bounds = word_hashes([data, b"", data], lower=False, tails=True)
    parts = data.split() * 2
    assert bounds.tolist() == [0, len(parts) // 2, len(parts) // 2, len(parts)]
    assert h[:, 1].tolist() == [int.from_bytes(w[-2:], "big") for w in parts]
    assert len(set(zip(parts, h[:, 0].tolist(), strict=True))) == len(set(parts)) == len(set(h[:, 0].tolist()))


def test_windows_follow_the_words():
    h, _ = word_hashes([b"a b c a b c d"])
    three = windows(h, 3)
    assert three[0] == three[3] and len(three) == 5 and len(set(three.tolist())) == 4
    assert len(shingle_set(h[:0])) == 0 and len(shingle_set(h[:2])) == 1 and len(shingle_set(h)) == 3


def test_rows_keep_their_ids(spark):
    docs = given.clashing(given.documents(spark, [(1, "a b"), (None, None), (1, "a b"), (2, "")]))
    out = map_documents(docs, "doc_id bigint, size int", lambda d: ((i, len(t)) for i, t in d))
    assert Counter(map(tuple, out.collect())) == Counter([(1, 3), (1, 3), (None, 0), (2, 0)])


def test_id_types_stay(spark):
    docs = spark.createDataFrame([("x", "a")], "doc_id string, text string")
    assert map_documents(docs, "doc_id bigint, size int", lambda d: ((i, len(t)) for i, t in d)).collect() == [("x", 1)]


def test_workers_hand_back_what_a_task_used(spark):
    """A Python worker that has held many megabytes is small again for the task after."""
    def anonymous():
        return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024

    def little(documents):
        yield from ((os.getpid(), anonymous()) for _ in documents)

    def much(documents):
        for _ in documents:
            held = [pa.array(["x" * 2000] * 10_000) for _ in range(6)]
            rows = [column.to_pylist() for column in held]
            yield os.getpid(), anonymous()
            del held, rows

    docs = given.documents(spark, [(1, "a")], 1)
    schema = "pid bigint, megabytes bigint"
    pid, most = map_documents(docs, schema, much).collect()[0]
    after = next(n for worker, n in (map_documents(docs, schema, little).collect()[0] for _ in range(50)) if worker == pid)
    assert after < most - 170, (after, most)
