"""The wavelet file: look-ups open the blocks they touch, and ids that do not fit are refused."""

import numpy as np
import pytest

from siltstone.llm import pieces, wavelet
from siltstone.llm.queries import tokenizer_path

BPE = "byte_bpe_50k.json"


@pytest.mark.parametrize("size", [0, 1, 511, 512, 65_536, 65_537, 300_000])
@pytest.mark.parametrize("bits", [3, 17])
def test_look_ups_equal_plain_arrays(size, bits):
    rng = np.random.default_rng(size)
    tokens = rng.integers(0, 1 << bits, size).astype(np.uint32)
    tokens[size // 3 : size // 2] = 5
    shard = wavelet.WaveletShard(wavelet.encode_shard([1], np.array([size]), tokens, bits))
    assert (shard.tokens() == tokens).all() and shard.opened == {}
    for at in sorted({0, size // 2, size - 1, *rng.integers(0, max(size, 1), 20).tolist()}):
        if 0 <= at < size:
            token = int(tokens[at])
            places = np.flatnonzero(tokens == token)
            assert shard.access(at) == token
            assert shard.count(token) == len(places) and shard.count(token, at) == (places < at).sum()
            nth = int((places < at).sum())
            assert shard.occurrence(token, nth) == at
    assert shard.count(1 << bits) == 0


def test_a_look_up_opens_one_or_two_blocks_of_a_plane():
    tokens = np.random.default_rng(1).integers(0, 50_000, 1 << 20).astype(np.uint32)
    image = wavelet.encode_shard([1], np.array([len(tokens)]), tokens, 16)
    shard = wavelet.WaveletShard(image)
    assert shard.access(777_777) == tokens[777_777]
    assert len(shard.opened) <= 2 * 16 and len(shard.opened) < 16 * (len(tokens) // wavelet.BLOCK) / 4
    shard = wavelet.WaveletShard(image)
    shard.count(int(tokens[5]))
    assert len(shard.opened) <= 2 * 16


def test_ids_that_do_not_fit_are_an_error(spark):
    with pytest.raises(ValueError, match="70000 does not fit into 16 bits"):
        wavelet.encode_shard([1], np.array([2]), np.array([70_000, 5], np.uint32), 16)
    assert wavelet.id_bits(tokenizer_path(BPE), 2) == 16 and wavelet.id_bits(tokenizer_path(BPE), 70_000) == 17


def test_a_workers_next_task_finds_the_pieces_of_the_last(monkeypatch):
    learned = []
    learn = pieces.PieceEncoder._learn
    monkeypatch.setattr(pieces.PieceEncoder, "_learn", lambda self, new: (learned.extend(new), learn(self, new))[1])
    path = tokenizer_path(BPE)
    pieces.worker_encoder.cache_clear()
    texts = ["So wéit, so   gut.\nfin", " ", "", "ein\t\tWort zu viel, 12 x 4! </s>", "a" * 40 + " weit"]
    raws = [x.encode() for x in texts]
    raw, ends = np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)])
    whole = [x.ids for x in pieces._loaded(path)[0].encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        ids, bounds = pieces.worker_encoder(path).encode(raw, ends)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == whole
    assert len(learned) == len(set(learned)) > 0
    monkeypatch.setattr(pieces, "CACHE_PIECES", 0)
    again = pieces.worker_encoder(path).encode(raw, ends)
    assert (again[0] == ids).all() and len(learned) == 2 * len(set(learned))
    pieces.worker_encoder.cache_clear()


def test_a_worker_remembers_more_pieces_than_a_task(monkeypatch):
    """The pieces of a block are still known two blocks later; letters of all scripts keep their ids."""
    texts = [
        " ".join(f"w{''.join(chr(97 + (i // 26**k) % 26) for k in range(3))}{tail}" for i in range(500))
        for tail in ("a", "é", "д")
    ]
    learned = []
    learn = pieces.PieceEncoder._learn
    monkeypatch.setattr(pieces.PieceEncoder, "_learn", lambda self, new: (learned.extend(new), learn(self, new))[1])
    monkeypatch.setattr(pieces, "CACHE_PIECES", 600)
    pieces.worker_encoder.cache_clear()
    path = tokenizer_path(BPE)
    encoder = pieces.worker_encoder(path)
    for text in (*texts, texts[0]):
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.encode(raw, np.array([0, len(raw)]))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(learned) == len(set(learned)) == 1500
    pieces.worker_encoder.cache_clear()
