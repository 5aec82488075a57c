"""Alignment of two vocabularies against a plain one-token-at-a-time version on whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from siltstone.llm import alignment as al
from siltstone.llm.pieces import _alphabet
from siltstone.llm.queries import QUERIES, tokenizer_path
from siltstone.llm.scratch import ship

TABLES = "/root/testdata/sf0.001"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TEXTS = [
    None, "", " ", "  ", "a", " a  b ", "\n", "tab\there", "one two three", "é ß <|endoftext|> 日本　語  x", "x▁y z",
    "</s><s>[INST] <unk> <0x41>", "𝔘𝔫𝔦 🙂🙂 é", "word " * 3000, "nospace" * 3000, "日本語" * 500, "a b c\r\nd",
    "trailing   ", "...!!! (ok), 'tis; 1234567890", "one two three", "don't we'll I'VE", "\x00\x01 ctrl", "ﬁ ﬀ Å",
]


def _coders():
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(tokenizer_path(A))
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))


def _tokens(text, left, right):
    """Ids and end offsets of both vocabularies, or nothing if they do not spell the text."""
    if not text:
        return None
    to_byte = {chr(c): b for b, c in _alphabet().items()}
    a = left.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(to_byte[x] for x in left.id_to_token(i)) for i in a]
    b = right.encode(text)
    b_bytes = [
        bytes([int(right.IdToPiece(i)[3:-1], 16)]) if right.IsByte(i) else right.IdToPiece(i).replace("▁", " ").encode()
        for i in b
    ]
    wanted = (" " + text).encode()
    if b"".join(a_bytes) != wanted or b"".join(b_bytes) != wanted:
        return None
    return a, np.cumsum(list(map(len, a_bytes))).tolist(), b, np.cumsum(list(map(len, b_bytes))).tolist()


def _brute(rows):
    left, right = _coders()
    counts, documents = Counter(), []
    for doc, text in rows:
        tokens = _tokens(text, left, right)
        if tokens is None:
            documents.append((doc, 0, 0, 0, [], ""))
            continue
        a, a_ends, b, b_ends = tokens
        cuts = sorted(set(a_ends) & set(b_ends))
        by_end_a, by_end_b = dict(zip(a_ends, a)), dict(zip(b_ends, b))
        links = [(by_end_a[c], by_end_b[c]) for c in cuts]
        counts.update(links)
        groups, i, j = [], 0, 0
        for cut in cuts:
            x, y = i, j
            while i < len(a) and a_ends[i] <= cut:
                i += 1
            while j < len(b) and b_ends[j] <= cut:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        documents.append((doc, len(a), len(b), len(groups), links, digest))
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return Counter(
        (d, n, m, g, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for d, n, m, g, links, digest in documents
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _found(frame):
    return Counter(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def test_query_equals_brute_force_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    assert _found(QUERIES["op12_alignment"](spark, TABLES)) == _brute(rows)


@pytest.mark.parametrize("small", [False, True])
def test_odd_texts_equal_brute_force(spark, small, monkeypatch):
    ship(spark)
    rows = [(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(1 if small else 3)
    assert _found(al.alignment(frame, tokenizer_path(A), tokenizer_path(B))) == _brute(rows)


def test_long_rows_segments_and_packs():
    left, right = tokenizer_path(A), tokenizer_path(B)
    coders = al.Coders(left, right)
    text = " " + "The quick brown fox, naïve café: 12 tokens\n" * 60_000
    raw = np.frombuffer(text.encode(), np.uint8)
    assert sum(len(x) for x in al._segments(raw)) == len(raw) and len(list(al._segments(raw))) > 2
    row = al._long_row(raw, coders)
    whole = al.Aligned(raw, np.array([0, len(raw)]), coders)
    assert row.n_a[0] == len(whole.a) and row.links[0] == len(whole.left)
    assert row.digests[0] == hashlib.sha256(whole.written(coders)[0][:-1].encode()).hexdigest()
    assert row.counts.sum() == len(whole.left)
    bad = np.concatenate([raw, np.frombuffer(" a▁b".encode(), np.uint8)])
    assert al._long_row(bad, coders).digests == [""]
    pack = al._Pack()
    first = pack.add(np.array([7, 3, 7], np.uint64), np.array([1, 2, 4]))
    second = pack.add(np.array([5, 3], np.uint64), np.array([1, 1]))
    assert first.tolist() == [1, 0, 1] and second.tolist() == [2, 0] and pack.counts.tolist() == [3, 5, 1]


def test_squeezed_pairs_come_back():
    numbers, counts = np.array([9, 2, 70_000]), np.array([1, 300, 2])
    back = al._unsqueezed(al._squeezed(numbers, counts))
    assert back[0].tolist() == [2, 9, 70_000] and back[1].tolist() == [300, 1, 2]


def test_lockstep_emits_every_common_end():
    a, b = np.array([1, 3, 4, 9, 2, 5]), np.array([3, 9, 1, 2, 3, 5])
    left, right = al.lockstep(a, b, np.array([0, 4, 6]), np.array([0, 2, 6]))
    assert list(zip(left.tolist(), right.tolist())) == [(1, 0), (3, 1), (4, 3), (5, 5)]


def test_edges_and_links(spark):
    ship(spark)
    paths = tokenizer_path(A), tokenizer_path(B)
    schema = "doc_id long, text string, pack string, _text string, number string"
    assert al.alignment(spark.createDataFrame([], schema), *paths).collect() == []
    rows = [(1, "one two", "p", "q", "r"), (1, "one two", "p", "q", "r"), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    found = al.alignment(frame, *paths, keep=["pack", "number", "doc_id"])
    assert found.columns[:3] == ["pack", "number", "doc_id"]
    assert sorted((r.pack or "", r.n_links, r.count_sum) for r in found.collect()) == [("", 0, 0), ("p", 2, 4), ("p", 2, 4)]
    with pytest.raises(ValueError):
        al.alignment(frame.withColumnRenamed("pack", "n_a"), *paths, keep=["n_a"])
    links = al.token_links(frame, *paths, keep=["doc_id"]).collect()
    left, right = _coders()
    wanted = _tokens("one two", left, right)
    row = next(r for r in links if r.doc_id == 1)
    assert (row.a_ids, row.b_ids) == (wanted[0], wanted[2])
    assert [(wanted[1][x.a], wanted[3][x.b]) for x in row.links] == [(c, c) for c in sorted(set(wanted[1]) & set(wanted[3]))]
    assert next(r for r in links if r.doc_id is None).links == []
