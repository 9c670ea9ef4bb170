"""Best-fit packing of token sequences into bins of several permitted lengths.

Texts become pieces of at most the largest length, a piece at a time is put into the open bin that
it fills best, and where none has room a new bin is opened. Its length is chosen among all
permitted ones: for each, the pieces still waiting are tried out on it, and the one with the least
cost for each token held is opened. At last each bin shrinks to the shortest permitted length that
holds its contents.

Packing runs inside the tasks that read the texts, over blocks of ``block_rows`` rows, so nothing
is shuffled, no group can grow hot and memory is bounded. Bins never span blocks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.text import map_documents

LENGTHS = (512, 1024, 2048, 4096, 8192)
BLOCK_ROWS = 20_000
GROUP = 1 << 18  # bytes of texts counted at a time
SCHEMA = ("doc_id bigint, piece int, start bigint, n_tokens int, bin_id bigint, bin_offset int, "
          "bin_length int, bin_used int")


def cost(length: int) -> float:
    """Of running one sequence: linear layers, and attention that grows with the square."""
    return length * (1 + length / 32_768)


def words_and_end(raw: bytes) -> int:
    """A count without any model: words, and one end."""
    return len(raw.split()) + 1


class Packer:
    """Packs pieces, each a length; results are bins of piece numbers."""

    def __init__(self, lengths: tuple[int, ...] = LENGTHS, price: Callable[[int], float] = cost):
        self.lengths, self.price = tuple(sorted(set(lengths))), price

    def _opened(self, first: int, waiting: dict[int, int], present: int) -> int:
        """The permitted length that costs least for each token it would hold."""
        best = None
        for length in self.lengths[bisect_left(self.lengths, first):]:
            room, used, taken = length - first, first, defaultdict(int)
            bits = present & ((1 << (room + 1)) - 1)
            while room and bits:
                size = bits.bit_length() - 1
                n = min(waiting[size] - taken[size], room // size)
                if n > 0:
                    taken[size] += n
                    room -= n * size
                    used += n * size
                bits &= (1 << min(size, room + 1)) - 1
            held = self.lengths[bisect_left(self.lengths, used)]
            rate = self.price(held) / used
            if best is None or rate < best[0]:
                best = rate, length
        return best[1]

    def pack(self, sizes: list[int]) -> list[tuple[int, list[int]]]:
        """Bins as (length, pieces in the order they were put in)."""
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
        waiting: dict[int, int] = defaultdict(int)
        for size in sizes:
            waiting[size] += 1
        present = sum(1 << size for size in waiting)
        free: dict[int, list[int]] = defaultdict(list)  # open bins by the room they have
        rooms, bins = 0, []
        for i in order:
            size = sizes[i]
            waiting[size] -= 1
            if not waiting[size]:
                present &= ~(1 << size)
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                number = free[room].pop()
                if not free[room]:
                    rooms &= ~(1 << room)
            else:
                room, number = self._opened(size, waiting, present), len(bins)
                bins.append([])
            bins[number].append(i)
            if room > size:
                free[room - size].append(number)
                rooms |= 1 << (room - size)
        out = []
        for pieces in bins:
            used = sum(sizes[i] for i in pieces)
            out.append((self.lengths[bisect_left(self.lengths, used)], pieces))
        return out


def counted(documents: Iterator[tuple], count: Callable[[bytes], int]) -> Iterator[tuple]:
    """Id and count of each text in turn; a ``count`` that takes ``many`` texts gets some at a time."""
    many = getattr(count, "many", lambda texts: map(count, texts))
    ids, texts, size = [], [], 0
    for doc_id, raw in documents:
        ids.append(doc_id)
        texts.append(raw)
        size += len(raw)
        if size > GROUP or len(ids) == 500:
            yield from zip(ids, many(texts), strict=True)
            ids, texts, size = [], [], 0
    yield from zip(ids, many(texts), strict=True)


def pack(
    docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, count: Callable[[bytes], int] = words_and_end,
    price: Callable[[int], float] = cost, block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row for each piece of each text: where it starts, its bin and its place there.

    Columns: ``doc_id, piece, start, n_tokens, bin_id, bin_offset, bin_length, bin_used``. A null or
    empty text is its end alone; a text with a count of 0 has no piece; a null id stays null;
    repeated rows are packed each by itself; an empty table gives an empty result; other columns
    are not read. Ids of bins hold task, block and number.
    """
    longest = max(lengths)

    def each(documents):
        packer, block, pieces = Packer(lengths, price), 0, []
        task = TaskContext.get().partitionId()
        for rows, (doc_id, total) in enumerate(counted(documents, count), 1):
            pieces += [(doc_id, n, start, min(longest, total - start))
                       for n, start in enumerate(range(0, total, longest))]
            if rows % block_rows == 0 or len(pieces) >= 2 * block_rows:
                yield from placed(packer, pieces, task, block)
                block, pieces = block + 1, []
        yield from placed(packer, pieces, task, block)

    def placed(packer, pieces, task, block) -> Iterator[tuple]:
        for number, (length, members) in enumerate(packer.pack([p[3] for p in pieces])):
            used, offset = sum(pieces[i][3] for i in members), 0
            for i in members:
                yield (*pieces[i], task << 40 | block << 20 | number, offset, length, used)
                offset += pieces[i][3]

    return map_documents(docs, SCHEMA, each, id_col, text_col, batch_rows=10_000)


def bins(packed: DataFrame) -> DataFrame:
    """One row for each bin: its pieces in order. A bin holds at most its length in pieces."""
    return packed.groupBy("bin_id", "bin_length", "bin_used").agg(
        F.sort_array(F.collect_list(F.struct("bin_offset", "doc_id", "piece", "start", "n_tokens")))
        .alias("pieces"))
