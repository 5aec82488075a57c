"""Token ids of whole text columns, by the tokenizers library on distinct pieces of text.

Byte-level BPE never merges across its pre-token borders. A single space or line break
between two visible characters begins a pre-token, and so do the marks of ``_MARKS``
after an ASCII letter; a text may thus be cut there and its pieces encoded apart. Natural
text repeats its pieces, so each block is encoded as a dictionary of distinct ones.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
CACHE_PIECES = 200_000
WORDS = 200

def _alphabet() -> dict[int, int]:
    """Byte to character, as byte-level BPE writes bytes: visible ones as they are, others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in visible]
    return {x: x for x in visible} | {x: 0x100 + i for i, x in enumerate(others)}


#: A line break is kept while lines are still to be told apart.
_ALPHABET = _alphabet() | {0x0A: 0x0A}
_SPACE = chr(_ALPHABET[0x20])

#: A piece with no blank but one before it.
_PLAIN = re.compile(r" ?[^\s\x1c-\x1f]+").fullmatch

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: First bytes of the characters among which other white space is found.
_MAYBE = np.zeros(256, dtype=bool)
_MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(x) for x in ",.;:!?)"]] = True


def cuts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Offsets at which pieces begin: every row's start and each safe place within."""
    size = len(raw)
    begin = np.zeros(size + 1, dtype=bool)
    begin[ends] = True
    row_start = begin.copy()
    at = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
    at = at[(at > 2) & (at < size - 1)]
    before, after = raw[at - 1], raw[at + 1]
    # White space beyond ASCII ends in C2 xx or in E1, E2 or E3 and two bytes more.
    other = (before >= 0x80) & ((raw[at - 2] == 0xC2) | _MAYBE[raw[at - 3]])
    lone = ~(_BLANK[before] | other | _BLANK[after] | _MAYBE[after] | row_start[at] | row_start[at + 1])
    at = at[lone]
    begin[at] = True
    begin[at[raw[at] == 0x0A] + 1] = True
    at = np.flatnonzero(_MARKS[raw])
    at = at[at > 0]
    begin[at[_LETTER[raw[at - 1]]]] = True
    begin[size] = False
    return np.flatnonzero(begin)


@functools.lru_cache(maxsize=1)
def _loaded(path: str) -> tuple:
    """A file's tokenizer, its bare model, the ids of a line break and its tokens' lengths; once per worker."""
    # A Spark task has one core; threads beyond it only hold memory.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    model = Tokenizer(tokenizer.model)
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    end = np.array(tokenizer.encode("\n", add_special_tokens=False).ids, np.uint32)
    words = tokenizer.get_vocab()
    lengths = np.zeros(max(words.values()) + 1, np.int64)
    for word, number in words.items():
        lengths[number] = len(word)
    return tokenizer, model, end, lengths


class PieceEncoder:
    """Encodes rows with one byte-level BPE file; special strings in texts as that file says.

    Encoded pieces are remembered: their ids lie end to end in ``flat``, and ``known``
    has each piece's number; ``number`` and ``row_pieces`` are the last block's pieces and
    each row's offset among them. Past ``most`` times ``CACHE_PIECES`` pieces all are forgotten.
    """

    def __init__(self, path: str, most: int = 1):
        self.most = most
        self.tokenizer, self.model, self.end, self.lengths = _loaded(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.bounds = np.zeros(1, np.int64)

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.flat = np.concatenate([self.flat, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])

    def _learn(self, new: list[str]) -> None:
        """Encodes distinct pieces, many in a call; the length of ids or a line break shows where each ends."""
        letters, foreign, others = [], [], []
        for x in new:
            if (x[1:] if x[0] == " " else x).isalpha():
                (letters if x.isascii() else foreign).append(x)
            else:
                others.append(x)
        for letters in filter(None, (letters, foreign)):
            # One pre-token each: the model alone, on the alphabet that it has for bytes.
            joined = "\n".join(letters)
            if joined.isascii():  # nothing but blanks is written otherwise
                lines = joined.replace(" ", _SPACE).split("\n")
            else:
                lines = joined.encode().decode("latin-1").translate(_ALPHABET).split("\n")
            texts = [" ".join(lines[i : i + WORDS]) for i in range(0, len(lines), WORDS)]
            coded = self.model.encode_batch_fast(texts, add_special_tokens=False)
            flat = np.concatenate([np.array(x.ids, np.uint32) for x in coded])
            spelled, wanted = np.cumsum(self.lengths[flat]), np.cumsum(list(map(len, lines)))
            self._add(letters, flat, np.diff(np.searchsorted(spelled, wanted), prepend=-1))
        odd, plain = [], []
        for x in others:
            (plain if _PLAIN(x) else odd).append(x)
        if plain:
            texts = ["\n".join(plain[i : i + WORDS]) for i in range(0, len(plain), WORDS)]
            parts = []
            for coding in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                parts += (np.array(coding.ids, np.uint32), self.end)
            flat = np.concatenate(parts)
            breaks = np.flatnonzero(flat == self.end[0])
            self._add(plain, flat[flat != self.end[0]], np.diff(breaks, prepend=-1) - 1)
        if odd:
            ids = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
            self._add(odd, np.concatenate(ids), np.array([len(x) for x in ids]))

    def encode(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """uint32 ids of all rows, end to end, and each row's offset among them."""
        starts = cuts(raw, ends)
        if not len(starts):
            self.number, self.row_pieces = starts, np.zeros(len(ends), np.int64)
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        data = pa.py_buffer(np.ascontiguousarray(raw))
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), data).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = coded.indices.to_numpy(zero_copy_only=False)
        if len(self.known) > self.most * CACHE_PIECES:
            self._forget()
        numbers = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown.tolist()]
            self._learn(new)
            numbers[unknown] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        number = numbers[place]
        self.number, self.row_pieces = number, np.searchsorted(starts, ends)
        begins = self.bounds[number]
        lengths = self.bounds[number + 1] - begins
        after = np.cumsum(lengths)
        ids = self.flat[np.repeat(begins - (after - lengths), lengths) + np.arange(after[-1])]
        return ids, np.concatenate([[0], after])[self.row_pieces]


@functools.lru_cache(maxsize=1)
def worker_encoder(path: str) -> PieceEncoder:
    """A file's encoder, kept by the Python worker: its later tasks find the pieces of earlier ones.

    It remembers more of them than one that lasts for a task: some 200 bytes a piece.
    """
    return PieceEncoder(path, most=3)
