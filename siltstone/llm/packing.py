"""Packing into token sequences by Karmarkar-Karp multiway differencing.

Every input partition packs its own documents in one pass, without a shuffle. Whole
capacities of a document become sequences of their own; what is left is cut into parts
of at most ``part`` tokens. The parts of ``group`` documents are split over k windows,
k being the fewest that could hold them: each part is a partial partition, and the two
partitions with the widest spread merge, largest sums against smallest, until one is
left. While its fullest window exceeds the capacity, k rises (in proportion to the excess, by
one at least) and the merge repeats.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siltstone.llm.pieces import BLOCK_BYTES, PieceEncoder
from siltstone.llm.words import blocks, gives_back

_COLUMNS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window, 0 to k - 1, of each size, with near-equal sums."""
    parent = list(range(len(sizes)))
    heap: list[tuple] = []
    for item, size in enumerate(sizes.tolist()):
        sums, slots = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[-1], slots[-1] = size, item
        heap.append((-size, item, sums, slots))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, sums, slots = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        others = others[::-1]
        sums = sums + other[::-1]
        both = np.flatnonzero((slots >= 0) & (others >= 0))
        joined = np.where(slots >= 0, slots, others)
        for at in both.tolist():
            number = len(parent)
            parent.append(number)
            parent[slots[at]] = parent[others[at]] = number
            joined[at] = number
        order = np.argsort(sums, kind="stable")
        sums, joined = sums[order], joined[order]
        # Equal shares of all windows don't matter to later merges.
        heapq.heappush(heap, (int(sums[0] - sums[-1]), turn, sums - sums[0], joined))
        turn += 1
    roots = heap[0][3].tolist()
    window = {root: at for at, root in enumerate(roots) if root >= 0}
    place = [0] * len(parent)
    for node in range(len(parent) - 1, -1, -1):
        place[node] = window[node] if parent[node] == node else place[parent[node]]
    return np.array(place[: len(sizes)], np.int64)


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size (none above the capacity), no window's sum above it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        place = difference(sizes, k)
        fullest = int(np.bincount(place, weights=sizes).max())
        if fullest <= capacity:
            return place
        k = max(k + 1, k * fullest // capacity)


class _Packer:
    """The parts of a partition's documents, until there are enough to pack."""

    def __init__(self, capacity: int, part: int, group: int, with_ids: bool):
        self.capacity, self.part, self.group, self.with_ids = capacity, part, group, with_ids
        self.next = TaskContext.get().partitionId() << 32
        self.rows: list[list] = []
        self.ids: list[bytes] = []
        self.documents = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.capacity
        marks = [*range(0, whole, self.capacity), *range(whole, total, self.part)]
        for start, stop in zip(marks, [*marks[1:], total], strict=True):
            crc = zlib.crc32(ids[start:stop])
            self.rows.append([doc_id, start, stop - start, crc, total, start < whole])
            if self.with_ids:
                self.ids.append(ids[start:stop].tobytes())
        self.documents += 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        full = np.array([row[5] for row in self.rows])
        sizes = np.array([row[2] for row in self.rows], np.int64)
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        sequence[full] = self.next + np.arange(full.sum())
        self.next += int(full.sum())
        rest = np.flatnonzero(~full)
        if len(rest):
            place = windows_of(sizes[rest], self.capacity)
            used, place = np.unique(place, return_inverse=True)
            sequence[rest] = self.next + place
            self.next += len(used)
            by = np.argsort(place, kind="stable")
            ends = np.cumsum(sizes[rest][by])
            first = np.concatenate([[True], place[by][1:] != place[by][:-1]])
            begins = ends - sizes[rest][by]
            offset[rest[by]] = begins - np.repeat(begins[first], np.bincount(place))
        columns = list(zip(*self.rows, strict=True))[:5]
        arrays = [pa.array(x, pa.int64()) for x in columns] + [pa.array(sequence), pa.array(offset)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if self.with_ids:
            arrays.append(pa.array(self.ids, pa.binary()))
            names.append("ids")
        self.rows, self.ids, self.documents = [], [], 0
        yield pa.RecordBatch.from_arrays(arrays, names)


def pack(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 1, part: int = 512, group: int = 512,
    with_ids: bool = False,
) -> DataFrame:
    """Every token of every row of ``docs`` (doc_id long, text string), each in one piece.

    A row's tokens are its text's ids by the file ``tokenizer`` of the tokenizers library,
    then ``end_id``; a null or empty text has ``end_id`` alone. Returns, per piece, doc_id,
    start, length, ids_crc32, doc_tokens, sequence_id and offset, and ``ids`` (32-bit,
    little-endian) if asked for. A repeated row is a document of its own; a null doc_id
    stays null; other columns are ignored; an empty table gives no rows. Sequence numbers
    hold the input partition's in their upper half. ``group`` documents are packed
    together (padding falls with it), and as many more as one block of texts has.
    """

    @gives_back
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer)
        packer = _Packer(capacity, part, group, with_ids)
        last = np.array([end_id], np.uint32)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, b, raw, ends in blocks(batch.column(1), BLOCK_BYTES):
                ids, bounds = encoder.encode(raw, ends)
                for row in range(a, b):
                    packer.add(doc_ids[row], np.concatenate([ids[bounds[row - a] : bounds[row - a + 1]], last]))
                    if packer.documents >= group:
                        yield from packer.flush()
        yield from packer.flush()

    return docs.select("doc_id", "text").mapInArrow(run, _COLUMNS + (", ids binary" if with_ids else ""))
