"""The stages of the pipeline and the operators without SQL against plain Python, row by row."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm import fertility, mixture, quality_votes, toxicity
from siltstone.llm.pieces import cuts
from siltstone.llm.queries import QUERIES, tokenizer_path
from siltstone.llm.scratch import Scratch, ship
from siltstone.llm.words import blocks
from tests.llm.test_queries import _brute_components

TABLES = "/root/testdata/sf0.001"
BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORD = re.compile(r"[^\x20\x09-\x0d]+").findall
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def inputs(spark):
    """Each stage's input as a table, and its output."""
    ship(spark)
    scratch, docs, out = Scratch(spark), spark.read.parquet(f"{TABLES}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = scratch.keep(stage(spark, docs, TABLES), name)
        out[name] = docs, made
        docs = made
    return out


def _rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def _base(text):
    words = WORD(text)
    lines = [x for x in text.split("\n") if WORD(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered |= set(range(i, i + 5))
    symbols = sum(text.count(x) for x in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def _measures(text, tokenizer, processor):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    counts, n = Counter(ids), len(ids)
    entropy = 1.0
    if n > 1:
        entropy = (math.log2(n) - sum(c * math.log2(c) for c in counts.values()) / n) / math.log2(n)
    # A row that others precede in its block: the first one's first piece may reach over an early blank.
    raw = np.frombuffer(b"row\n" + text.encode(), np.uint8)
    starts = [x for x in cuts(raw, np.array([0, 4, len(raw)])).tolist() if x >= 4] + [len(raw)]
    parts = [raw[a:b].tobytes().decode() for a, b in zip(starts[:-1], starts[1:])]
    coded = [x for part in processor.encode(parts) for x in part]
    return len(text) / max(n, 1), sum(map(processor.IsByte, coded)) / max(len(coded), 1), entropy


def _verdicts(texts, langs):
    """base counts, measures and kept of each row."""
    import sentencepiece

    tokenizer = Tokenizer.from_file(tokenizer_path(BPE))
    processor = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    base = [_base(t or "") for t in texts]
    found = [_measures(t or "", tokenizer, processor) for t in texts]
    limits = {}
    for lang in set(langs):
        own = [m for m, b, x in zip(found, base, langs) if x == lang and b[0]]
        for i, name in enumerate(fertility.MEASURES):
            values = sorted(m[i] for m in own)
            if values:
                low, mid, high = (values[max(0, math.ceil(p * len(values)) - 1)] for p in (0.25, 0.5, 0.75))
                below, above, least = fertility.LEAST[name]
                limits[lang, i] = (
                    mid - max((mid - low) * 6.0, mid * below, least), mid + max((high - mid) * 6.0, mid * above, least)
                )
    kept = []
    for b, m, lang in zip(base, found, langs):
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        inside = all((lang, i) in limits and limits[lang, i][0] <= m[i] <= limits[lang, i][1] for i in range(3))
        kept.append(not failed and inside)
    return base, found, kept


def test_fertility_equals_plain_python(spark):
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").collect()
    base, found, kept = _verdicts([r.text for r in rows], [r.lang for r in rows])
    out = {r.doc_id: r for r in QUERIES["op2_fertility"](spark, TABLES).collect()}
    assert len(out) == len(rows) == len({r.doc_id for r in rows})
    for row, b, m, k in zip(rows, base, found, kept):
        one = out[row.doc_id]
        assert (one.n_words, one.word_chars, one.n_symbols, one.n_dup_lines, one.n_repeat_words) == b
        assert np.allclose((one.chars_per_token, one.entropy), (m[0], m[2]), rtol=1e-12, atol=1e-12)
        # One token more or less in the first row of a block.
        assert abs(one.byte_share - m[1]) <= m[1] / max(b[0], 1) + 1e-12
        assert one.kept == k, row.doc_id


def test_toxicity_stage_drops_what_the_model_rejects(spark, inputs):
    docs, kept = inputs["toxicity"]
    model = toxicity.fit(docs, spark.read.parquet(f"{TABLES}/labels.parquet"))
    wanted = Counter()
    for row in docs.collect():
        scores = [model.scores(raw, ends) for _, _, raw, ends in blocks(pa.array([row.text], pa.string()))]
        if scores[0][0] < 0.5:
            wanted[tuple(row)] += 1
    assert _rows(kept) == wanted and 0 < sum(wanted.values()) < docs.count()


def test_quality_stage_keeps_what_the_rules_keep(inputs):
    docs, kept = inputs["quality_rules"]
    rows = docs.collect()
    _, _, good = _verdicts([r.text for r in rows], [r.lang for r in rows])
    assert _rows(kept) == Counter(tuple(r) for r, k in zip(rows, good) if k)


def test_join_stage_keeps_one_row_of_each_component(inputs):
    docs, kept = inputs["ngram_join"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    firsts = {component for doc, size, component in _brute_components(rows).elements() if size}
    empty = {doc for doc, size, _ in _brute_components(rows).elements() if not size}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(firsts | empty)
    assert _rows(kept) <= _rows(docs)


def test_mixing_stage_takes_the_words_of_the_mix(inputs, tmp_path):
    docs, mixed = inputs["mixing"]
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents")
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
        names = [d[0] for d in connection.sql(mixture.MIXTURE_SQL).description]
        wanted = {r[names.index("doc_id")]: r[names.index("taken")] for r in connection.sql(mixture.MIXTURE_SQL).fetchall()}
    taken = defaultdict(int)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in mixed.collect():
        words = WORD(row.text)
        taken[row.doc_id] += len(words)
        assert words == WORD(texts[row.doc_id])[: len(words)]
    assert dict(taken) == {x: n for x, n in wanted.items() if n}


def test_packing_stage_holds_every_token_once(inputs):
    docs, packed = inputs["packing"]
    tokenizer = Tokenizer.from_file(tokenizer_path(BPE))
    wanted = Counter(
        (r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in docs.collect()
    )
    rows = packed.collect()
    sequences, tokens = defaultdict(list), Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        tokens[r.doc_id, r.doc_tokens] += r.length
    assert tokens == Counter({k: k[1] * n for k, n in wanted.items()})
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


EDGES = [(1, None, "en", "x"), (2, "", None, "x"), (3, "word " * 40_000, "en", "x"), (3, "word " * 40_000, "en", "x"),
         (None, "a few words", "fr", None)]


def test_classifiers_on_edge_rows_and_without_labels(spark):
    ship(spark)
    docs = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for found, neutral in ((quality_votes.quality_votes(docs, none), 0.5), (toxicity.toxicity(docs, none), None)):
        rows = found.collect()
        assert Counter(r.doc_id for r in rows) == Counter(x[0] for x in EDGES)
        assert all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
        assert neutral is None or {r.score for r in rows} == {neutral}
    empty = docs.limit(0)
    labels = spark.createDataFrame([(1, 1, 1), (None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    assert quality_votes.quality_votes(empty, labels).count() == 0 == toxicity.toxicity(empty, labels).count()
    for found in (quality_votes.quality_votes(docs, labels), toxicity.toxicity(docs, labels)):
        same = {r.score for r in found.collect() if r.doc_id == 3}
        assert len(same) == 1


def test_stages_on_edge_rows(spark):
    ship(spark)
    rows = [(*r[:3], None, 0) for r in EDGES]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, TABLES)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() <= 10 * len(rows)
