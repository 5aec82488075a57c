"""Token ids in wavelet matrices: one compressed file image per shard of documents.

A shard holds whole documents in ascending doc_id order. Plane by plane, from the
highest bit of an id to the lowest, it stores that bit of every token and then moves the
tokens with bit 0 before those with bit 1. A plane is cut into blocks that are compressed
apart. The file has the set bits before every block, and each block those before every
``STEP`` bits of its own. So any token is read, counted or found by one rank or select
per plane, and each of these opens one block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.pieces import worker_encoder
from siltstone.llm.scratch import Scratch
from siltstone.llm.words import blocks

MAGIC = b"SLTWM2\0\0"
_HEAD = struct.Struct("<8sQQI")
_PLANE = struct.Struct("<QI")
#: Bits of a block, and bits between two stored counts within it.
BLOCK, STEP = 1 << 16, 512
#: Bytes of text encoded at once: of a longer block fewer pieces are distinct. A batch has no more.
TEXT_BYTES = 1 << 23


def _block_images(ones: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """A plane's blocks, and the set bits before each: a block has those before every step of its own, then its bits."""
    steps = -(-len(ones) // STEP)
    bits = np.zeros(steps * (STEP // 8), np.uint8)
    packed = np.packbits(ones, bitorder="little")
    bits[: len(packed)] = packed
    counts = np.bitwise_count(bits.view(np.uint64)).reshape(steps, STEP // 64).sum(axis=1, dtype=np.int64)
    before = np.cumsum(counts) - counts
    first = np.arange(0, steps, BLOCK // STEP)
    own = (before - np.repeat(before[first], np.diff(np.append(first, steps)))).astype("<u2")
    edges = [*first.tolist(), steps]
    images = [
        own[x:y].tobytes() + bits[x * (STEP // 8) : y * (STEP // 8)].tobytes()
        for x, y in zip(edges[:-1], edges[1:], strict=True)
    ]
    return images, before[first]


def encode_shard(doc_ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray, bits: int) -> bytes:
    """The file image: head, table of documents, then for each plane its zeros, block table and blocks.

    An id that ``bits`` cannot hold is an error.
    """
    import zstandard

    if len(tokens) and int(tokens.max()) >> bits:
        raise ValueError(f"token id {int(tokens.max())} does not fit into {bits} bits")
    squeeze = zstandard.ZstdCompressor(level=1).compress
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([0 if x is None else x for x in doc_ids], np.int64)
    table = squeeze(known.tobytes() + numbers.tobytes() + lengths.astype(np.uint64).tobytes())
    parts = [_HEAD.pack(MAGIC, len(tokens), len(doc_ids), bits), struct.pack("<Q", len(table)), table]
    values = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        ones = (values & values.dtype.type(1 << level)).astype(bool)
        images, before = _block_images(ones)
        blocks_ = list(map(squeeze, images))
        high = values.take(np.flatnonzero(ones))
        low = values.take(np.flatnonzero(~ones))
        parts.append(_PLANE.pack(len(low), len(blocks_)))
        parts.append(before.astype("<u8").tobytes())
        parts.append(np.array(list(map(len, blocks_)), "<u4").tobytes())
        parts += blocks_
        values = np.concatenate([low, high])
    return b"".join(parts)


class WaveletShard:
    """Reads a file image: all tokens, or one token's places, without decoding the rest.

    ``opened`` holds the (plane, block) pairs that look-ups have decompressed so far.
    """

    def __init__(self, image: bytes | memoryview):
        import zstandard

        self._open = zstandard.ZstdDecompressor().decompress
        view = memoryview(image)
        magic, self.size, documents, self.bits = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        at = _HEAD.size
        (length,) = struct.unpack_from("<Q", view, at)
        table = self._open(view[at + 8 : at + 8 + length])
        at += 8 + length
        known = np.frombuffer(table, np.uint8, documents)
        numbers = np.frombuffer(table, np.int64, documents, documents)
        self.doc_ids = [int(x) if ok else None for x, ok in zip(numbers, known, strict=True)]
        lengths = np.frombuffer(table, np.uint64, documents, 9 * documents).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.zeros, self._before, self._blocks = [], [], []
        for _ in range(self.bits):
            zeros, count = _PLANE.unpack_from(view, at)
            at += _PLANE.size
            self.zeros.append(zeros)
            self._before.append(np.frombuffer(view, "<u8", count, at).astype(np.int64))
            sizes = np.frombuffer(view, "<u4", count, at + 8 * count)
            ends = at + 12 * count + np.cumsum(sizes, dtype=np.int64)
            self._blocks.append([view[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)])
            at += 12 * count + int(sizes.sum())
        self.opened: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _block(self, plane: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's stored counts and its bits as 64-bit words."""
        if (plane, number) not in self.opened:
            image = self._open(self._blocks[plane][number])
            steps = len(image) // (2 + STEP // 8)
            self.opened[plane, number] = np.frombuffer(image, "<u2", steps), np.frombuffer(image, "<u8", offset=2 * steps)
        return self.opened[plane, number]

    def _bits(self, plane: int) -> np.ndarray:
        """All bits of a plane; nothing of it is kept open."""
        parts = []
        for block in self._blocks[plane]:
            image = self._open(block)
            steps = len(image) // (2 + STEP // 8)
            parts.append(np.frombuffer(image, np.uint8, offset=2 * steps))
        packed = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        return np.unpackbits(packed, count=self.size, bitorder="little").view(bool)

    def _rank(self, plane: int, at: int) -> int:
        """Set bits among the first ``at`` of a plane."""
        if at >= self.size:
            return self.size - self.zeros[plane]
        counts, words = self._block(plane, at // BLOCK)
        inside = at % BLOCK
        step, word = inside // STEP, inside // 64
        count = int(self._before[plane][at // BLOCK]) + int(counts[step])
        count += int(np.bitwise_count(words[step * (STEP // 64) : word]).sum())
        return count + (int(words[word]) & ((1 << at % 64) - 1)).bit_count() if at % 64 else count

    def _select(self, plane: int, bit: int, nth: int) -> int:
        """The place of the nth (from 0) bit of this value in a plane."""
        ones = self._before[plane]
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, nth, side="right")) - 1
        nth -= int(before[block])
        counts, words = self._block(plane, block)
        ones = counts.astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * STEP - ones
        step = int(np.searchsorted(before, nth, side="right")) - 1
        part = words[step * (STEP // 64) : (step + 1) * (STEP // 64)]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little")
        return block * BLOCK + step * STEP + int(np.flatnonzero(bits == bit)[nth - int(before[step])])

    def access(self, at: int) -> int:
        """The token at a place."""
        token = 0
        for plane in range(self.bits):
            one = self._rank(plane, at + 1) - self._rank(plane, at)
            token = token << 1 | one
            ones = self._rank(plane, at)
            at = self.zeros[plane] + ones if one else at - ones
        return token

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        """Where the token's copies among the first ``stop`` tokens lie below the last plane."""
        low, high = 0, stop
        for plane in range(self.bits):
            ones = self._rank(plane, low), self._rank(plane, high)
            if token >> (self.bits - 1 - plane) & 1:
                low, high = self.zeros[plane] + ones[0], self.zeros[plane] + ones[1]
            else:
                low, high = low - ones[0], high - ones[1]
        return low, high

    def count(self, token: int, stop: int | None = None) -> int:
        """Copies of a token among the first ``stop`` tokens, or among all."""
        if token >> self.bits:
            return 0
        low, high = self._range(token, self.size if stop is None else stop)
        return high - low

    def occurrence(self, token: int, nth: int) -> int:
        """The place of a token's nth copy, from 0."""
        if not 0 <= nth < self.count(token):
            raise IndexError(nth)
        at = self._range(token, 0)[0] + nth
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """All tokens in their order: planes are undone from the last to the first."""
        values = np.zeros(self.size, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in range(self.bits - 1, -1, -1):
            ones = self._bits(plane)
            before = np.empty_like(values)
            before[np.flatnonzero(~ones)] = values[: self.zeros[plane]]
            before[np.flatnonzero(ones)] = values[self.zeros[plane] :] | values.dtype.type(1 << (self.bits - 1 - plane))
            values = before
        return values


def write_shards(
    docs: DataFrame, tokenizer: str, scratch: Scratch, *, end_id: int = 2, bits: int = 16, shard_tokens: int = 1 << 19
) -> DataFrame:
    """Writes all rows' tokens in ascending doc_id order; (part, shard, tokens, image) of each shard, as read back.

    Rows are range-partitioned by doc_id, null first, rows of one doc_id in input order.
    A shard ends with the document that takes it past ``shard_tokens`` tokens. Images
    are the binary column of a Parquet table: only Spark's writers reach every store.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(tokenizer), TaskContext.get().partitionId()
        doc_ids, held, lengths, total, shard = [], [], [], 0, 0
        end = np.array([end_id], np.uint32)

        def image() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            data = encode_shard(doc_ids, np.array(lengths), tokens, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(tokens)], pa.int64()),
                 pa.array([data], pa.binary())],
                ["part", "shard", "tokens", "image"],
            )

        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for a, b, raw, ends in blocks(batch.column(1), TEXT_BYTES):
                ids, bounds = encoder.encode(raw, ends)
                for row in range(b - a):
                    held += (ids[bounds[row] : bounds[row + 1]], end)
                    lengths.append(int(bounds[row + 1] - bounds[row]) + 1)
                    doc_ids.append(numbers[a + row])
                    total += lengths[-1]
                    if total >= shard_tokens:
                        yield image()
                        doc_ids, held, lengths, total, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield image()

    ordered = (
        docs.select("doc_id", "text", F.monotonically_increasing_id().alias("arrival"))
        .repartitionByRange("doc_id", "arrival")
        .sortWithinPartitions("doc_id", "arrival")
        .select("doc_id", "text")
    )
    shards = ordered.mapInArrow(run, "part int, shard int, tokens long, image binary")
    return scratch.keep(shards, "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards' images."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = WaveletShard(batch.column(2)[row].as_buffer())
                tokens, starts = shard.tokens().astype(np.uint32), shard.starts
                crcs = [zlib.crc32(tokens[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                count = len(shard.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[row].as_py()] * count, pa.int32()),
                        pa.array([batch.column(1)[row].as_py()] * count, pa.int32()),
                        pa.array(shard.doc_ids, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "shard", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    rows = shards.select("part", "shard", "image").mapInArrow(
        run, "part int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long"
    )
    sizes = shards.select("part", "shard", "tokens")
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    all_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(all_before), F.lit(0)).alias("part_start"))
    own_before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part", "shard", F.coalesce(F.sum("tokens").over(own_before), F.lit(0)).alias("shard_start")
    ).join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("base"))
    return rows.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def id_bits(tokenizer: str, end_id: int) -> int:
    """The bits that hold every id of a vocabulary file and the end id."""
    from tokenizers import Tokenizer

    return max(max(Tokenizer.from_file(tokenizer).get_vocab().values()), end_id, 1).bit_length()


def token_index(docs: DataFrame, tokenizer: str, *, end_id: int = 2, bits: int | None = None) -> DataFrame:
    """Writes every row of ``docs`` (doc_id long, text string) to wavelet shards and reads it back from them.

    Returns doc_id, start, n_tokens, ids_crc32. A null or empty text is its end id alone;
    repeated rows are written again; other columns are ignored; an empty table gives no
    rows. ``bits`` is the width of an id, by default what the vocabulary needs; an id beyond
    it is an error.
    """
    bits = bits or id_bits(tokenizer, end_id)
    scratch = Scratch(docs.sparkSession)
    return read_shards(write_shards(docs, tokenizer, scratch, end_id=end_id, bits=bits))
