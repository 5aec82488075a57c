"""Tokens of two vocabularies aligned by the bytes they cover.

A is a byte-level BPE file, B a piece vocabulary that puts a space before each text; A
gets that space too, so that both cover the same bytes. Where an A and a B token end at
the same byte there is a link, and a cut: the tokens between two cuts are a group.

Lockstep merging finds the links. One vector holds a pointer into the A tokens and one
into the B tokens for every lane of a block; each step compares the ends that all lanes
point at, emits the lanes where they agree as links, and moves the pointer whose token
ends first (both, at a link). Lanes that are through are compacted away. A lane is a
document, or, so that a long document does not hold up the others, a run of it of about
``LANE_BYTES`` from one place to the next where both vocabularies are sure to cut: a lone
space between visible characters.

How often two ids are linked in the whole corpus takes one pass over the texts. A task numbers
the id pairs that it meets; a document keeps the numbers of its pairs, and each pack of
some ``PACK_BYTES`` of text has a dictionary of its pairs with their counts in it. Counts
are summed over the dictionaries, looked up once for each of their entries, and brought
to the documents pack by pack: a pair costs a row for each pack, not for each document.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.pieces import CACHE_PIECES, PieceEncoder, cuts
from siltstone.llm.scratch import Scratch
from siltstone.llm.words import blocks, give_back

LANE_BYTES = 1 << 10
SEGMENT_BYTES = 1 << 20
PACK_BYTES = 32 << 20
PACK_PAIRS = 1 << 20
_SPACE = 0x20
_NONE = np.zeros(0, np.int64)


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The byte-level tokenizer for which special strings in texts are plain text, and its tokens' bytes."""
    from tokenizers import Tokenizer

    from siltstone.llm.pieces import _alphabet

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    to_byte = {chr(character): byte for byte, character in _alphabet().items()}
    words = tokenizer.get_vocab()
    spelled = [b""] * (max(words.values()) + 1)
    for word, number in words.items():
        # Added tokens, which no text gives, may hold characters beyond the alphabet.
        if all(x in to_byte for x in word):
            spelled[number] = bytes(to_byte[x] for x in word)
    return tokenizer, spelled


@functools.lru_cache(maxsize=1)
def _processor(path: str):
    """The piece vocabulary, its tokens' bytes, the id of a lone space, and whether words can be encoded apart."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled, apart = [], True
    for number in range(processor.GetPieceSize()):
        piece = processor.IdToPiece(number)
        if processor.IsByte(number):
            spelled.append(bytes([int(piece[3:-1], 16)]))
        elif processor.IsControl(number) or processor.IsUnknown(number):
            spelled.append(b"")
        else:
            spelled.append(piece.replace("▁", " ").encode())
            # No merge may reach over the border of a visible character and a space.
            apart = apart and "▁" not in piece.lstrip("▁")
    return processor, spelled, processor.PieceToId("▁"), apart


def _match(pieces: list[str], ids: np.ndarray, sizes: np.ndarray, spelled: list[bytes]) -> np.ndarray:
    """Whether each piece is what its tokens spell."""
    words = list(map(spelled.__getitem__, ids.tolist()))
    ends = np.cumsum(sizes).tolist()
    begins = [0, *ends[:-1]]
    return np.array(
        [b"".join(words[a:b]) == x.encode() for x, a, b in zip(pieces, begins, ends, strict=True)], bool
    )


class _Left(PieceEncoder):
    """Ids of vocabulary A, with a check of every distinct piece."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer, self.spelled = _tokenizer(path)

    def _forget(self) -> None:
        super()._forget()
        self.good = np.zeros(0, bool)

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        super()._add(pieces, ids, sizes)
        self.good = np.concatenate([self.good, _match(pieces, ids, sizes, self.spelled)])


class _Right:
    """Ids of vocabulary B by distinct pieces: a run of spaces and what follows up to the next space.

    ``number`` and ``row_pieces`` are the last block's pieces and each row's offset among
    them, ``good`` says of every known piece whether its tokens spell it.
    """

    def __init__(self, path: str):
        self.processor, self.spelled, self.space, self.apart = _processor(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)
        self.good = np.zeros(0, bool)

    def _learn(self, new: list[str]) -> None:
        # Every piece begins with a space, and the processor puts one before what it gets.
        coded = self.processor.encode([x[1:] for x in new], num_threads=1)
        coded = [ids if len(x) > 1 else [self.space] for x, ids in zip(new, coded, strict=True)]
        sizes = np.array(list(map(len, coded)), np.int64)
        flat = np.array([y for x in coded for y in x], np.uint32)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.flat = np.concatenate([self.flat, flat])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.good = np.concatenate([self.good, _match(new, flat, sizes, self.spelled)])

    def encode(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, end to end, and each row's offset among them; a row begins with a space or is empty."""
        begin = np.zeros(len(raw), bool)
        if self.apart:
            space = raw == _SPACE
            begin[0:1] = space[0:1]
            begin[1:] = space[1:] & ~space[:-1]
        begin[ends[:-1][ends[1:] > ends[:-1]]] = True
        starts = np.flatnonzero(begin)
        self.row_pieces = np.searchsorted(starts, ends)
        if not len(starts):
            self.number = starts
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        data = pa.py_buffer(np.ascontiguousarray(raw))
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), data).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > CACHE_PIECES:
            self._forget()
        new = [x for x in distinct if x not in self.known]
        if new:
            self._learn(new)
        place = coded.indices.to_numpy(zero_copy_only=False)
        self.number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[place]
        begins = self.bounds[self.number]
        lengths = self.bounds[self.number + 1] - begins
        after = np.cumsum(lengths)
        ids = self.flat[np.repeat(begins - (after - lengths), lengths) + np.arange(after[-1])]
        return ids, np.concatenate([[0], after])[self.row_pieces]


def lockstep(
    a_ends: np.ndarray, b_ends: np.ndarray, a_lanes: np.ndarray, b_lanes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The links, in order: A and B tokens whose ends agree.

    Lane i has the A tokens ``a_lanes[i]:a_lanes[i + 1]`` and the B tokens likewise, none
    empty; both cover the same bytes.
    """
    a, b, stop = a_lanes[:-1].copy(), b_lanes[:-1].copy(), a_lanes[1:]
    live = a < stop
    a, b, stop = a[live], b[live], stop[live]
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(a):
        x, y = a_ends[a], b_ends[b]
        same = x == y
        left.append(a[same])
        right.append(b[same])
        a = a + (x <= y)
        b = b + (y <= x)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    left, right = np.concatenate(left), np.concatenate(right)
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


class Aligned:
    """A block of texts, each with its space before it: tokens of both vocabularies and their links.

    ``a`` and ``b`` are ids end to end, ``a_first`` and ``b_first`` each row's offset;
    ``left`` and ``right`` are the linked tokens, ``first`` each row's offset among
    the links. A row whose tokens do not spell it has none of all these.
    """

    def __init__(self, raw: np.ndarray, ends: np.ndarray, coders: Coders):
        left, right = coders.left, coders.right
        self.a, self.a_first = left.encode(raw, ends)
        good = _all(left.good[left.number], left.row_pieces)
        self.b, self.b_first = right.encode(raw, ends)
        good &= _all(right.good[right.number], right.row_pieces)
        if not good.all():
            sizes = np.diff(ends)
            raw = raw[np.repeat(good, sizes)]
            ends = np.concatenate([[0], np.cumsum(sizes * good)])
            self.a, self.a_first = left.encode(raw, ends)
            self.b, self.b_first = right.encode(raw, ends)
        self.good = good
        a_ends, b_ends = np.cumsum(coders.a_bytes[self.a]), np.cumsum(coders.b_bytes[self.b])
        lanes = _lanes(raw, ends, right.apart)
        a_lanes = np.append(np.searchsorted(a_ends, lanes, side="right"), len(self.a))
        b_lanes = np.append(np.searchsorted(b_ends, lanes, side="right"), len(self.b))
        self.left, self.right = lockstep(a_ends, b_ends, a_lanes, b_lanes)
        self.first = np.searchsorted(self.left, self.a_first)

    def codes(self) -> np.ndarray:
        """The linked ids, A above B in 64 bits."""
        return self.a[self.left].astype(np.uint64) << np.uint64(32) | self.b[self.right].astype(np.uint64)

    def written(self, coders: Coders) -> list[str]:
        """Each row's groups: ``a1,a2|b1;a3|b2,b3;``."""
        a_group = np.searchsorted(self.left, np.arange(len(self.a)))
        b_group = np.searchsorted(self.right, np.arange(len(self.b)))
        links = np.arange(len(self.left) + 1)
        a_before, b_before = np.searchsorted(a_group, links), np.searchsorted(b_group, links)
        out = np.empty(len(self.a) + len(self.b), object)
        names = coders.a_names[self.a]
        names[self.left] = coders.a_last[self.a[self.left]]
        out[np.arange(len(self.a)) + b_before[a_group]] = names
        names = coders.b_names[self.b]
        names[self.right] = coders.b_last[self.b[self.right]]
        out[np.arange(len(self.b)) + a_before[b_group + 1]] = names
        edges = (self.a_first + self.b_first).tolist()
        return ["".join(out[x:y]) for x, y in zip(edges[:-1], edges[1:], strict=True)]


class Coders:
    """Both encoders of a worker, the lengths of their tokens and the decimal names of their ids."""

    def __init__(self, a_path: str, b_path: str):
        self.left, self.right = _Left(a_path), _Right(b_path)
        self.a_bytes = np.array(list(map(len, self.left.spelled)), np.int64)
        self.b_bytes = np.array(list(map(len, self.right.spelled)), np.int64)
        self.a_names, self.a_last = _names(len(self.a_bytes), ",", "|")
        self.b_names, self.b_last = _names(len(self.b_bytes), ",", ";")


def _names(count: int, *marks: str) -> list[np.ndarray]:
    return [np.array([f"{i}{mark}" for i in range(count)], object) for mark in marks]


@functools.lru_cache(maxsize=1)
def _coders(a_path: str, b_path: str) -> Coders:
    return Coders(a_path, b_path)


def _all(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(~flags)])
    return sums[first[1:]] == sums[first[:-1]]


def _lanes(raw: np.ndarray, ends: np.ndarray, apart: bool) -> np.ndarray:
    """Offsets at which lanes begin: every row, and in long ones places where both vocabularies cut."""
    rows = ends[:-1][ends[1:] > ends[:-1]]
    if not apart:
        return rows
    safe = cuts(raw, ends)
    safe = safe[raw[safe] == _SPACE]
    new = np.ones(len(safe), bool)
    new[1:] = safe[1:] // LANE_BYTES != safe[:-1] // LANE_BYTES
    return np.union1d(rows, safe[new])


def _spaced(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The texts with a space before each; null and empty ones stay without."""
    import pyarrow.compute as pc

    column = column.cast(pa.large_string()).fill_null("")
    nothing, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    spaced = pc.binary_join_element_wise(nothing, column, space)
    return pc.if_else(pc.equal(pc.binary_length(column), 0), nothing, spaced)


def _segments(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in runs of about ``SEGMENT_BYTES`` that both vocabularies encode apart."""
    start, size = 0, SEGMENT_BYTES
    while len(raw) - start > size:
        part = raw[start : start + size]
        safe = cuts(part, np.array([0, len(part)]))
        safe = safe[part[safe] == _SPACE]
        if len(safe) and safe[-1]:
            yield part[: safe[-1]]
            start, size = start + int(safe[-1]), SEGMENT_BYTES
        else:
            size *= 2
    yield raw[start:]


class _Pack:
    """Numbers the id pairs of a run of documents."""

    def __init__(self):
        self.codes = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.size = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The numbers of ``codes``, new ones after the known; counts are added up."""
        distinct, place = np.unique(codes, return_inverse=True)
        fresh = np.setdiff1d(distinct, self.codes, assume_unique=True)
        total, at = len(self.codes), np.searchsorted(self.codes, fresh)
        self.codes = np.insert(self.codes, at, fresh)
        self.numbers = np.insert(self.numbers, at, np.arange(total, total + len(fresh)))
        numbers = self.numbers[np.searchsorted(self.codes, distinct)]
        self.counts = np.concatenate([self.counts, np.zeros(len(fresh), np.int64)])
        self.counts[numbers] += np.bincount(place, counts, len(distinct)).astype(np.int64)
        return numbers[place]


def _squeezed(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct numbers and their counts, small."""
    order = np.argsort(numbers)
    both = np.concatenate([np.diff(numbers[order], prepend=0), counts[order]]).astype("<u4")
    return zlib.compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unsqueezed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_MADE = T.StructType([
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("groups_sha256", T.StringType()),
])
_INNER = T.StructType([
    T.StructField("pack", T.LongType()), T.StructField("pairs", T.BinaryType()), T.StructField("number", T.LongType()),
    T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType()),
])


class _Measured:
    """A block's rows: tokens, links and digests, and their distinct id pairs, end to end."""

    def __init__(self, n_a, n_b, links, digests, codes, counts, first, size):
        self.n_a, self.n_b, self.links, self.digests = n_a, n_b, links, digests
        self.codes, self.counts, self.first, self.size = codes, counts, first, size


def _measured(texts: pa.Array, coders: Coders) -> Iterator[_Measured]:
    for _, _, raw, ends in blocks(_spaced(texts), SEGMENT_BYTES):
        if len(raw) > 2 * SEGMENT_BYTES:
            yield _long_row(raw, coders)
            continue
        block = Aligned(raw, ends, coders)
        digests = [hashlib.sha256(x[:-1].encode()).hexdigest() if x else "" for x in block.written(coders)]
        links = np.diff(block.first)
        owner, codes = np.repeat(np.arange(len(links)), links), block.codes()
        order = np.lexsort((codes, owner))
        owner, codes = owner[order], codes[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(codes)))
        first = np.searchsorted(owner[at], np.arange(len(links) + 1))
        yield _Measured(
            np.diff(block.a_first), np.diff(block.b_first), links, digests, codes[at], counts, first, len(raw)
        )


def _long_row(raw: np.ndarray, coders: Coders) -> _Measured:
    """As a block of one row, segment by segment: any length."""
    n_a = n_b = links = 0
    digest, last = hashlib.sha256(), ""
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for part in _segments(raw):
        block = Aligned(part, np.array([0, len(part)]), coders)
        if not block.good.all():
            none = np.zeros(1, np.int64)
            return _Measured(none, none, none, [""], codes[:0], counts[:0], np.zeros(2, np.int64), len(raw))
        n_a, n_b, links = n_a + len(block.a), n_b + len(block.b), links + len(block.left)
        digest.update(last.encode())
        last = block.written(coders)[0]
        here, times = np.unique(block.codes(), return_counts=True)
        codes, at = np.unique(np.concatenate([codes, here]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, times]), len(codes)).astype(np.int64)
    digest.update(last[:-1].encode())
    row = [np.array([x]) for x in (n_a, n_b, links)]
    return _Measured(*row, [digest.hexdigest()], codes, counts, np.array([0, len(codes)]), len(raw))


def _counted(docs: DataFrame, a_path: str, b_path: str, keep: Sequence[str], text: str) -> tuple[DataFrame, list[str]]:
    """Rows of documents (``number`` is null) and of the packs' dictionaries; and the names of the kept columns here."""
    names = [f"_keep_{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(f"`{x}`").alias(n) for x, n in zip(keep, names, strict=True)], F.col(f"`{text}`").cast("string").alias("_text")
    )
    kept = T.StructType(rows.schema.fields[:-1])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept] + _INNER.fields + _MADE.fields)
    width = len(names)

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(a_path, b_path)
        task = TaskContext.get().partitionId() << 24
        pack, size, target = _Pack(), 0, None

        def dictionary() -> pa.RecordBatch:
            order = np.argsort(pack.numbers)
            codes = pack.codes[order]
            columns = [pa.nulls(len(codes), f.type) for f in target]
            columns[width] = pa.array(np.full(len(codes), task), pa.int64())
            columns[width + 2] = pa.array(np.arange(len(codes)), pa.int64())
            columns[width + 3] = pa.array((codes >> np.uint64(32)).astype(np.int32))
            columns[width + 4] = pa.array((codes & np.uint64(0xFFFFFFFF)).astype(np.int32))
            columns[width + 5] = pa.array(pack.counts, pa.int64())
            return pa.RecordBatch.from_arrays(columns, schema=target)

        for batch in batches:
            if target is None:
                fields = [pa.field(n, batch.schema.types[i]) for i, n in enumerate(names)]
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                fields += [pa.field(f.name, k) for f, k in zip(_INNER, kinds, strict=True)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                target = pa.schema(fields + [pa.field(f.name, k) for f, k in zip(_MADE, kinds, strict=True)])
            row = 0
            for part in _measured(batch.column(width), coders):
                count = len(part.digests)
                numbers = pack.add(part.codes, part.counts)
                pairs = [
                    _squeezed(numbers[x:y], part.counts[x:y]) if x < y else None
                    for x, y in zip(part.first[:-1].tolist(), part.first[1:].tolist(), strict=True)
                ]
                columns = [batch.column(i).slice(row, count) for i in range(width)]
                columns += [pa.array(np.full(count, task), pa.int64()), pa.array(pairs, pa.binary())]
                columns += [pa.nulls(count, target.field(width + i).type) for i in range(2, 6)]
                columns += [pa.array(x, pa.int64()) for x in (part.n_a, part.n_b, part.links, part.links)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(part.digests, pa.string())], schema=target)
                row, size = row + count, size + part.size
                if size > PACK_BYTES or len(pack.codes) > PACK_PAIRS:
                    yield dictionary()
                    pack, size, task = _Pack(), 0, task + 1
        if len(pack.codes):
            yield dictionary()
        give_back()

    return rows.mapInArrow(align, schema), names


def pair_counts(dictionaries: DataFrame) -> DataFrame:
    """How often ids ``a`` and ``b`` are linked in the corpus, and whether no other ``a`` is linked to ``b`` more often."""
    counts = dictionaries.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # At most one row for each id of vocabulary B.
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(
    docs: DataFrame, a_path: str, b_path: str, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Per row: the columns ``keep``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose id pair is its B id's most frequent one in the
    corpus, ties included, ``count_sum`` adds up all links' corpus counts, and the digest
    is that of the groups as ``a1,a2|b1;a3|b2,b3``. A null or empty text, or one that
    either vocabulary does not spell byte for byte (it may hold the piece vocabulary's
    own space mark), has zeros and an empty digest and adds nothing to the counts.
    Repeated rows are counted each; nulls in ``keep`` stay; an empty table gives an empty
    one. Columns not in ``keep`` play no part, whatever their names; ``keep`` may hold
    none of the new columns' names. Texts are read whole; one of many megabytes goes
    through in segments.
    """
    made = [*_MADE.names[:4], "n_best", "count_sum", _MADE.names[4]]
    clash = sorted(set(keep) & set(made))
    if clash:
        raise ValueError(f"columns {clash} are both kept and made")
    scratch = Scratch(docs.sparkSession)
    counted, names = _counted(docs, a_path, b_path, keep, text)
    counted = scratch.keep(counted, "counted")
    dictionaries = counted.filter("number IS NOT NULL").select("pack", "number", "a", "b", "n")
    pairs = scratch.keep(pair_counts(dictionaries), "pairs")
    looked_up = dictionaries.join(pairs, ["a", "b"]).select(F.col("pack").alias("of_pack"), "number", "count", "best")
    rows = counted.filter("number IS NULL").select(*names, "pack", "pairs", *_MADE.names)
    sums = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    kept = [f for f in rows.schema if f.name in names]
    schema = T.StructType([*kept, *_MADE.fields, *sums])

    def add_up(documents: pa.Table, entries: pa.Table) -> pa.Table:
        number = entries.column("number").to_numpy()
        count, best = np.zeros(len(number), np.int64), np.zeros(len(number), bool)
        count[number] = entries.column("count").to_numpy()
        best[number] = entries.column("best").to_numpy()
        n_best, total = [], []
        for blob in documents.column("pairs").to_pylist():
            numbers, times = _unsqueezed(blob) if blob else (_NONE, _NONE)
            n_best.append(int(times[best[numbers]].sum()))
            total.append(int((times * count[numbers]).sum()))
        out = documents.drop_columns(["pack", "pairs"])
        out = out.append_column("n_best", pa.array(n_best, pa.int64()))
        return out.append_column("count_sum", pa.array(total, pa.int64()))

    done = rows.groupBy("pack").cogroup(looked_up.groupBy("of_pack")).applyInArrow(add_up, schema)
    renamed = [F.col(n).alias(x) for n, x in zip(names, keep, strict=True)]
    return done.select(*renamed, *made)


def token_links(docs: DataFrame, a_path: str, b_path: str, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Per row: ``keep`` and the arrays a_ids, b_ids and links (a, b: places in them of tokens that end together).

    Edge cases as in ``alignment``; here a row's arrays hold the whole text's tokens.
    """
    new = "a_ids array<int>, b_ids array<int>, links array<struct<a:int,b:int>>"
    clash = sorted(set(keep) & {"a_ids", "b_ids", "links"})
    if clash:
        raise ValueError(f"columns {clash} are both kept and made")
    names = [f"_keep_{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(f"`{x}`").alias(n) for x, n in zip(keep, names, strict=True)], F.col(f"`{text}`").cast("string").alias("_text")
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]] + T.StructType.fromDDL(new).fields)
    link = pa.struct([("a", pa.int32()), ("b", pa.int32())])

    def lists(values: np.ndarray | pa.Array, first: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(a_path, b_path)
        for batch in batches:
            for start, stop, raw, ends in blocks(_spaced(batch.column(len(names))), SEGMENT_BYTES):
                block = Aligned(raw, ends, coders)
                owner = np.repeat(np.arange(stop - start), np.diff(block.first))
                places = [block.left - block.a_first[owner], block.right - block.b_first[owner]]
                pairs = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in places], fields=list(link))
                columns = [batch.column(i).slice(start, stop - start) for i in range(len(names))]
                columns += [
                    lists(pa.array(block.a.astype(np.int32)), block.a_first),
                    lists(pa.array(block.b.astype(np.int32)), block.b_first), lists(pairs, block.first),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "a_ids", "b_ids", "links"])
        give_back()

    done = rows.mapInArrow(align, schema)
    return done.select(*[F.col(n).alias(x) for n, x in zip(names, keep, strict=True)], "a_ids", "b_ids", "links")
