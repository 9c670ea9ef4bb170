"""Exact token counts of whole texts, huge ones by overlapping chunks that are spliced.

A text is encoded by the library itself. One longer than ``chunk_chars`` is encoded in chunks that
overlap; each chunk is encoded with offsets, and two neighbours are spliced at a position inside
their overlap where both have a token boundary and which is proven stable: no piece of the
vocabulary holds the two characters around it next to each other, so no merge can ever cross it and
both sides are encoded independently. Where the overlap has no such position it is doubled, at
worst until the chunk reaches the end of the text, which is then the plain encoding.

By the same rule texts may be cut wherever no piece holds the two characters, so that a segment which
occurs again is encoded once (``Segments``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from docledger.llm.lattice import Cutter, Pieces, pieces
from docledger.llm.text import map_documents

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, n_chunks int, n_widened int"


class Counter:
    """Token counts by one sentencepiece model."""

    def __init__(self, model: bytes, chunk_chars: int = 32_768, overlap_chars: int = 256):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chunk, self.overlap = chunk_chars, overlap_chars
        pieces = (self.encoder.id_to_piece(i) for i in range(self.encoder.get_piece_size()))
        self.joined = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}

    def plain(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.encoder.encode(texts, num_threads=1, return_type="numpy")]

    def _boundaries(self, text: str) -> tuple[int, dict[int, int]]:
        """All tokens, and the tokens before each token boundary by its offset in characters."""
        offsets = self.encoder.encode(text, return_type="offset_mapping")["offsets"]
        return len(offsets), {end: n + 1 for n, (_, end) in enumerate(offsets)}

    def _stable(self, text: str, at: int) -> bool:
        return text[at - 1:at + 1].replace(" ", "▁") not in self.joined

    def spliced(self, text: str) -> tuple[int, int, int]:
        """Tokens, chunks and how often an overlap had to be widened."""
        total, chunks, widened, start, taken, overlap = 0, 0, 0, 0, 0, self.overlap
        # The chunk from ``start`` counts from its token ``taken`` on.
        end = min(len(text), self.chunk + overlap)
        tokens, here = self._boundaries(text[:end])
        chunks += 1
        while end < len(text):
            after = max(end - overlap, start + 1)
            after_end = min(len(text), after + self.chunk + overlap)
            n, there = self._boundaries(text[after:after_end])
            chunks += 1
            cut = next((at for at in range(after + 1, end)
                        if at - start in here and at - after in there and self._stable(text, at)
                        and here[at - start] >= taken), None)
            if cut is None:
                overlap *= 2
                widened += 1
                end = min(len(text), end + overlap)
                tokens, here = self._boundaries(text[start:end])
                continue
            total += here[cut - start] - taken
            start, taken, end, tokens, here = after, there[cut - after], after_end, n, there
            overlap = self.overlap
        return total + tokens - taken, chunks, widened


class Segments:
    """Token counts of texts by those of their segments, of which about ``kept`` are remembered.

    A hash of 64 bits is taken for the segment, as in the lattice; 16 bytes are held for each.
    """

    def __init__(self, counter: Counter, table: Pieces, kept: int = 1 << 19):
        self.encoder, self.cutter, self.kept = counter.encoder, Cutter(table), kept
        self.line_end = counter.encoder.piece_to_id("<0x0A>")
        self.hashes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def suit(counter: Counter) -> bool:
        """Whether the model takes texts as they are, unknown characters byte by byte, line ends alone, and
        joins no blank to what stands before it."""
        encoder, probe = counter.encoder, " \n  ﬁｅ\t "
        line_end = encoder.piece_to_id("<0x0A>")
        return (encoder.is_byte(line_end) and encoder.encode("\n")[1:] == [line_end]
                and encoder.normalize(probe) == ("▁" + probe).replace(" ", "▁")
                and not any("\n" in pair or (pair[1] == "▁" != pair[0]) for pair in counter.joined))

    def _encoded(self, segments: list[str]) -> np.ndarray:
        counts = np.ones(len(segments), np.int64)
        others = [i for i, segment in enumerate(segments) if segment != "\n"]
        if others:
            # A line's end, which is one token, stands before each.
            text = "".join("\n" + segments[i] for i in others)
            ids = self.encoder.encode([text], num_threads=1, return_type="numpy")[0]
            counts[others] = np.diff(np.append(np.flatnonzero(ids == self.line_end), len(ids))) - 1
        return counts

    def many(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        for owner, h, joined, starts, ends in self.cutter(texts):
            order = np.argsort(h)
            h = h[order]
            begins = np.concatenate(([True], h[1:] != h[:-1]))
            found, first = h[begins], order[begins]
            at = np.searchsorted(self.hashes, found)
            new = np.ones(len(found), bool)
            inside = at < len(self.hashes)
            new[inside] = self.hashes[at[inside]] != found[inside]
            counts = np.zeros(len(found), np.int64)
            counts[~new] = self.counts[at[~new]]
            first = first[new]
            counts[new] = self._encoded([joined[a:b] for a, b in zip(
                starts[first].tolist(), ends[first].tolist(), strict=True)])
            self.hashes = np.insert(self.hashes, at[new], found[new])
            self.counts = np.insert(self.counts, at[new], counts[new])
            if len(self.hashes) > self.kept:
                self.hashes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            np.add.at(total, owner[order], counts[np.cumsum(begins) - 1])
        return total


class TokensAndEnd:
    """Exact tokens of texts, and one end for each; the counter is built once by each task that uses it.

    Texts are counted by their segments where the model suits. Chunks are long, as a text that is spliced
    costs about twice as much for each character.
    """

    def __init__(self, docs: DataFrame, model_path: str, chunk_chars: int = 262_144):
        with open(model_path, "rb") as file:
            self.model = docs.sparkSession.sparkContext.broadcast((file.read(), pieces(model_path)))
        self.chunk_chars, self.counter, self.segments = chunk_chars, None, None

    def __call__(self, raw: bytes) -> int:
        return self.many([raw])[0]

    def many(self, raws: list[bytes]) -> list[int]:
        if self.counter is None:
            model, table = self.model.value
            self.counter = Counter(model, self.chunk_chars)
            self.segments = Segments(self.counter, table) if Segments.suit(self.counter) else None
        long = {i: self.counter.spliced(text)[0] for i, raw in enumerate(raws)
                if len(raw) > self.chunk_chars and len(text := raw.decode()) > self.chunk_chars}
        short = [b"" if i in long else raw for i, raw in enumerate(raws)]
        counts = (self.segments.many(short).tolist() if self.segments
                  else self.counter.plain([raw.decode() for raw in short]))
        return [long.get(i, n) + 1 for i, n in enumerate(counts)]


def count_tokens(
    docs: DataFrame, model_path: str, chunk_chars: int = 32_768, overlap_chars: int = 256,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, n_chunks, n_widened``, one row for each row of ``docs``.

    Only the two named columns are read. A null or empty text has 0 tokens; a null id stays null;
    repeated rows are counted each by itself; an empty table gives an empty result. ``model_path``
    is read on the driver and sent along (the vocabulary is of fixed size). No shuffle.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def each(documents):
        counter = Counter(model.value, chunk_chars, overlap_chars)
        waiting, size = [], 0
        for doc_id, raw in documents:
            text = raw.decode()
            if len(text) > chunk_chars:
                yield (doc_id, len(raw), *counter.spliced(text))
                continue
            waiting.append((doc_id, len(raw), text))
            size += len(text)
            if size > 500_000:
                yield from flush(counter, waiting)
                waiting, size = [], 0
        yield from flush(counter, waiting)

    def flush(counter, waiting):
        counts = counter.plain([text for _, _, text in waiting]) if waiting else []
        for (doc_id, size, _), n in zip(waiting, counts, strict=True):
            yield doc_id, size, n, 1, 0

    return map_documents(docs, SCHEMA, each, id_col, text_col)
