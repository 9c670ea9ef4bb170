import random
from collections import defaultdict

import llm_helpers as given
import pytest

from docledger.llm.packing import LENGTHS, Packer, bins, cost, pack
from docledger.llm.queries import QUERIES, model_path


@pytest.mark.parametrize("seed", range(4))
def test_bins_are_whole_and_tight(seed):
    rng = random.Random(seed)
    sizes = [min(LENGTHS[-1], int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(2000)]
    packed = Packer().pack(sizes)
    assert sorted(i for _, members in packed for i in members) == list(range(len(sizes)))
    for length, members in packed:
        used = sum(sizes[i] for i in members)
        assert used <= length and all(used > shorter for shorter in LENGTHS if shorter < length)
    # Better than any one length alone, and than no packing.
    price = sum(cost(length) for length, _ in packed)
    alone = sum(cost(min(x for x in LENGTHS if x >= s)) for s in sizes)
    one = sum(cost(length) for length, _ in Packer((LENGTHS[-1],)).pack(sizes))
    assert price < 0.8 * alone and price <= one
    assert sum(sizes) / sum(length for length, _ in packed) > 0.95


def brute(sizes, lengths):
    """The least cost of all ways to put the pieces into bins."""
    best = [float("inf")]

    def place(i, used):
        if i == len(sizes):
            best[0] = min(best[0], sum(cost(min(x for x in lengths if x >= u)) for u in used))
            return
        for b in range(len(used)):
            if used[b] + sizes[i] <= lengths[-1]:
                place(i + 1, used[:b] + [used[b] + sizes[i]] + used[b + 1:])
        place(i + 1, [*used, sizes[i]])

    place(0, [])
    return best[0]


def test_near_the_optimum():
    rng = random.Random(5)
    lengths = (8, 16, 32)
    total = optimum = 0
    for _ in range(40):
        sizes = [rng.randint(1, 20) for _ in range(7)]
        total += sum(cost(length) for length, _ in Packer(lengths).pack(sizes))
        optimum += brute(sizes, lengths)
    assert optimum <= total <= 1.12 * optimum


def test_best_fit_takes_the_tightest_room():
    packed = Packer((10,)).pack([6, 7, 3])
    assert sorted(sorted(members) for _, members in packed) == [[0], [1, 2]]


def test_tables(spark):
    rows = given.small(80) + [(7000, None), (7001, ""), (None, "a b"), (None, "a b"), (7002, "w " * 20_000)]
    docs = given.clashing(given.documents(spark, rows))
    packed = pack(docs, block_rows=16)
    got = packed.collect()
    of, inside = defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append((r.piece, r.start, r.n_tokens))
        inside[r.bin_id].append((r.bin_offset, r.n_tokens, r.bin_length, r.bin_used))
    for i, text in rows:
        if i is None:
            continue
        at = 0
        for n, (piece, start, size) in enumerate(sorted(of[i])):
            assert (piece, start) == (n, at)
            at += size
        assert at == len((text or "").encode().split()) + 1
    assert sorted(of[None]) == [(0, 0, 3), (0, 0, 3)]
    for members in inside.values():
        at = 0
        for offset, size, length, used in sorted(members):
            assert offset == at and length in LENGTHS
            at += size
        assert at == used <= length
    assert {r.bin_id: len(r.pieces) for r in bins(packed).collect()} == {b: len(m) for b, m in inside.items()}
    assert pack(docs.limit(0)).count() == 0


def test_query_packs_exact_tokens(spark, tmp_path):
    """Texts without blanks too: their pieces cover all tokens of the model and the end, none is too long."""
    import sentencepiece

    rows = given.small(40) + [(7000, None), (7001, ""), (7002, "日本語の文章です。" * 3000), (7003, "q8Zx/" * 20_000)]
    given.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    encoder = sentencepiece.SentencePieceProcessor(model_file=model_path())
    of = defaultdict(list)
    for r in QUERIES["op5_best_fit_packing"](spark, str(tmp_path)).collect():
        of[r.doc_id].append((r.piece, r.start, r.n_tokens))
        assert r.n_tokens <= r.bin_used <= r.bin_length
    assert set(of) == {i for i, _ in rows}
    for i, text in rows:
        at = 0
        for n, (piece, start, size) in enumerate(sorted(of[i])):
            assert (piece, start) == (n, at)
            at += size
        assert at == len(encoder.encode(text or "")) + 1
    assert len(of[7002]) > 1 and len(of[7003]) > 1


@pytest.mark.parametrize("group", [1 << 18, 1, 50])
def test_counted_keeps_the_order(monkeypatch, group):
    from docledger.llm import packing

    class Many:
        def many(self, texts):
            assert len(texts) <= 500
            return [len(text) for text in texts]

    monkeypatch.setattr(packing, "GROUP", group)
    rows = [(None if i % 7 == 0 else i, b"x" * (i % 13)) for i in range(1203)]
    expected = [(i, len(raw)) for i, raw in rows]
    assert list(packing.counted(iter(rows), Many())) == list(packing.counted(iter(rows), len)) == expected
    assert list(packing.counted(iter([]), Many())) == []
