import llm_helpers as given
import public_tokenizers
import pytest
import sentencepiece

from docledger.llm.tokens import Counter, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "a ", "  a  b ", "<s> </s> <unk>", "\x00\n\t", "日本語テキスト", "🙂" * 50, "▁▁ a", "\n\n\n\n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("chunk, overlap", [(60, 2), (200, 16), (1000, 64)])
def test_splicing_is_exact(library, chunk, overlap):
    with open(PATH, "rb") as file:
        counter = Counter(file.read(), chunk, overlap)
    texts = [t for _, t in given.small(60)] + ["a" * 900, "ab " * 400, " " * 900, "日本 語" * 300, "x\n\n" * 300,
                                              "é" * 700 + " b" * 200, "thethethe" * 100]
    widened = 0
    for text in texts:
        total, _, more = counter.spliced(text)
        widened += more
        assert total == len(library.encode(text)), text[:40]
    if overlap == 2:
        assert widened


def test_counts(spark, library):
    rows = given.small(40) + [(1000 + i, t) for i, t in enumerate(ODD)] + [(7000, None), (None, "a b"), (None, "a b")]
    docs = given.clashing(given.documents(spark, rows))
    got = sorted(map(tuple, count_tokens(docs, PATH, 500, 32).select("doc_id", "n_bytes", "n_tokens").collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows), key=str)


def test_empty_table(spark):
    assert count_tokens(given.documents(spark, [(1, "a")]).limit(0), PATH).count() == 0


@pytest.mark.parametrize("kept", [1 << 19, 50])
def test_segments_are_exact_and_encoded_once(library, kept):
    import random

    from docledger.llm.lattice import pieces
    from docledger.llm.tokens import Segments

    with open(PATH, "rb") as file:
        counter = Counter(file.read())
    assert Segments.suit(counter)
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "▁", "a", "the", "é", "日本", "🙂", "\t", "\x00", "<0x0A>", "http://", "x" * 30, "."]
    texts = [t for _, t in given.small(60)] + ODD + [
        "".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(2000)]
    sent = []

    class Encoder:
        def encode(self, texts, **more):
            sent.extend(map(len, texts))
            return library.encode(texts, **more)

    segments = Segments(counter, pieces(PATH), kept)
    segments.encoder = Encoder()
    expected = [len(library.encode(t)) for t in texts]
    assert segments.many([t.encode() for t in texts]).tolist() == expected
    assert [int(segments.many([t.encode()])[0]) for t in texts[:200]] == expected[:200]
    if kept > 50:
        first = sum(sent)
        assert segments.many([t.encode() for t in texts]).tolist() == expected and sum(sent) == first


def test_tokens_of_some_texts_at_a_time(spark, library):
    """Long texts are spliced, in their place among the others; without segments counts are the same."""
    from docledger.llm.tokens import TokensAndEnd

    texts = [t for _, t in given.small(20)] + ODD + ["日本語の文章です。" * 200, "", "q8Zx/" * 400, "ab cd\n" * 300]
    counter = TokensAndEnd(given.documents(spark, [(1, "a")]), PATH, 1000)
    raws, expected = [t.encode() for t in texts], [len(library.encode(t)) + 1 for t in texts]
    assert counter.many(raws) == expected == [counter(raw) for raw in raws]
    assert counter.segments is not None and counter.many([]) == []
    counter.segments = None
    assert counter.many(raws) == expected
