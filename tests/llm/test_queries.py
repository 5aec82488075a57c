"""The corpus queries against their SQL, exact round trips, brute force and held-out labels."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from siltstone.llm import adaptive_scan, chat_windows, fertility, html_text, mixture, ngram_join, packing, toxicity, wavelet
from siltstone.llm.queries import ORACLES, QUERIES, tokenizer_path
from siltstone.llm.scratch import Scratch, ship
from siltstone.llm.words import blocks
from tests import oracle

TABLES = "/root/testdata/sf0.001"
BPE = "byte_bpe_50k.json"
DOCS = "doc_id long, text string, lang string, source string, size string, score string"
ODD = [
    (1, None, "en", "a", None, None), (2, "", None, None, "x", "y"), (3, " \n\t ", "en", "b", "x", "y"),
    (4, "one two", "en", "a", "x", "y"), (5, "one two", None, None, "x", "y"), (5, "one two", None, None, "x", "y"),
    (None, "a b c d e f g h i j", "fr", "b", "x", "y"), (7, "word " * 30_000, "fr", "b", "x", "y"),
    (8, "A b C d e F g h i j", "fr", None, "x", "y"), (9, "é ß <|endoftext|> 日本　語  x", "de", "c", "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    with oracle.connect(TABLES) as connected:
        assert oracle.compare(spark, connected, QUERIES[name], ORACLES[name], TABLES) == []


def _brute_components(rows):
    sets = [
        {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").encode().lower().split()) else set()
        for _, t in rows
    ]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        low[top(i)].append(doc)
    lows = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return Counter((d, len(s), d if not s else lows[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_components_are_those_of_brute_force(spark, odd):
    rng = random.Random(4)
    base = [rng.choice("abcdefghijk") + rng.choice("xyz") for _ in range(60)]
    rows = [(r[0], r[1]) for r in ODD]
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(60)] = rng.choice(["new", "old", f"w{rng.randint(0, 9)}"])
        rows.append((100 + i, " ".join(words[: rng.randint(40, 60)])))
    found = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == _brute_components(rows)


def test_one_row_of_each_component_stays(spark):
    base = [f"w{i}" for i in range(40)]
    near, other, third = [*base[:39], "new"], [f"x{i}" for i in range(30)], [f"y{i}" for i in range(30)]
    text, near, other, third = (" ".join(x) for x in (base, near, other, third))
    rows = [
        (3, text, "en"), (2, near, "en"), (2, near, "en"), (2, near, "fr"), (None, text, "en"), (None, text, None), (9, text.upper(), "en"),
        (9, other, "en"),  # its doc_id has a copy of 2 too
        (None, third, "de"), (None, third, "de"), (None, third + " z", None),
        (4, None, "en"), (4, None, "en"), (5, " ", None), (None, "", None), (6, "alone", "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = ngram_join.one_of_each(docs)
    assert found.columns == docs.columns
    kept = Counter(map(tuple, found.collect()))
    assert kept <= Counter(rows)
    assert sum(kept[r] for r in {(2, near, "en"), (2, near, "fr")}) == 1
    assert sum(kept[r] for r in {(None, third, "de"), (None, third + " z", None)}) == 1
    groups = {text, near, text.upper(), third, third + " z"}
    assert Counter(r for r in kept.elements() if r[1] not in groups) == Counter(r for r in rows if r[1] not in groups)
    assert sum(kept.values()) == 8
    assert ngram_join.one_of_each(docs.where("doc_id = 6 or doc_id = 4")).count() == 3


def test_packing_and_index_hold_all_ids(spark, odd):
    tokenizer = Tokenizer.from_file(tokenizer_path(BPE))
    ids = [(r[0], np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids, np.uint32)) for r in ODD]
    pieces = packing.pack(odd, tokenizer_path(BPE), with_ids=True).collect()
    windows, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        docs[p["doc_id"]].append(p)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for doc_id, one in ids:
        if doc_id != 5:
            whole = b"".join(p["ids"] for p in sorted(docs[doc_id], key=lambda p: p["start"]))
            assert whole == np.append(one, np.uint32(1)).astype("<u4").tobytes()
    read = wavelet.token_index(odd, tokenizer_path(BPE)).collect()
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in read) == Counter(
        (d, zlib.crc32(np.append(x, np.uint32(2)))) for d, x in ids
    )
    at = 0
    for r in sorted(read, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_wavelet_shard_answers():
    tokens = np.random.default_rng(0).zipf(1.3, 5000) % 50_257
    shard = wavelet.WaveletShard(wavelet.encode_shard([1, None], np.array([10, 4990]), tokens.astype(np.uint32), 16))
    assert (shard.tokens() == tokens).all() and shard.doc_ids == [1, None]
    for at in (0, 511, 512, 4999):
        assert shard.access(at) == tokens[at]
    for token in (1, 7, 60_000, 70_000):
        places = np.flatnonzero(tokens == token)
        assert shard.count(token) == len(places) and shard.count(token, 100) == (places < 100).sum()
        if len(places):
            assert shard.occurrence(token, len(places) // 2) == places[len(places) // 2]
        else:
            with pytest.raises(IndexError):
                shard.occurrence(token, 0)


def test_chat_windows_keep_budget_and_come_back(spark):
    rng = random.Random(1)
    marks = ["<|im_end|>\n", "\\", "[INST]", "</s>", "\n", "word ", "é"]
    rows = [(c, t, "system" if t == 0 and c % 2 else "user" if t % 2 else "assistant",
             "".join(rng.choice(marks) for _ in range(rng.randint(0, 200)))) for c in range(6) for t in range(40)]
    rows += [(None, None, None, None), (7, 0, "a\\\n<|b", "x"), (7, 0, "a\\\n<|b", "x"), (8, 0, "system", "alone")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat_windows.chat_windows(turns)
    assert windows.where("tokens > 1024").count() == 0 and windows.where("repeated > 0").count() > 0
    back = chat_windows.read_windows(windows).orderBy("conv_id", "window").collect()
    said = Counter((r["conv_id"], t["role"], t["text"]) for r in back for t in r["turns"])
    assert said == Counter((c, r or "", t or "") for c, _, r, t in rows)
    loss = "".join(r["loss"] for r in back if r["conv_id"] == 0)
    assert loss == "".join(t for c, _, r, t in rows if c == 0 and r == "assistant")


def test_mix_meets_budgets(odd):
    rows = mixture.mixture(odd, ["doc_id", "source"]).collect()
    goals = {r["source"]: r["target"] for r in rows}
    for source, target in goals.items():
        assert sum(r["taken"] for r in rows if r["source"] == source) == int(target)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    mixed = mixture.mixed_documents(odd)
    assert mixed.columns == odd.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].encode().split())
    assert all(words[s] == int(t) for s, t in goals.items())


def test_fertility_base_counts(odd):
    found = fertility.fertility_rules(odd, tokenizer_path(BPE), tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(found) == len(ODD)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_words"] == 0 and by_id[1]["base_failed"] and not by_id[1]["kept"]
    assert by_id[7]["n_repeat_words"] == 30_000 and by_id[7]["base_failed"]
    assert by_id[8]["n_words"] == 10 and by_id[8]["word_chars"] == 10 and not by_id[8]["base_failed"]
    assert by_id[9]["n_symbols"] == 4


def test_html_text_takes_the_article_alone():
    page = (
        "<html><head><title>T</title></head><body class='has-sidebar'><nav><a href=/>Home</a></nav>"
        "<div id=content><h1>The &amp; title</h1><p>First <b>long</b> paragraph of the text, with more words than others."
        "<p>Second&nbsp;one,\n also with quite a few words in it, as texts have.</p><p>No.</p></div>"
        "<div class='comments'><p>A comment that is long, too, and that nobody wants to see in here.</p></div>"
        "<footer>&copy; all</footer><script>var x='<p>no</p>'</script>"
    )
    assert html_text.main_text(page) == (
        "The & title\n\nFirst long paragraph of the text, with more words than others.\n\n"
        "Second one, also with quite a few words in it, as texts have.\n\nNo."
    )
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<div" * 999) == ""
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"


LONG = "a sentence of the article that has quite a few words in it, as texts have"


@pytest.mark.parametrize("tag", [
    '<p title="hidden treasure">', '<p data-id="menu">', '<p data-hidden="1">', '<p data-x=\'a class="menu" b\'>',
    '<p class="overflow-hidden">', '<p class="article-header">', '<p style="--display: none-such">', '<p class="header">',
])
def test_html_text_cuts_by_exact_names_only(tag):
    page = f"<body><div id=content><p>First {LONG}.</p>{tag}Second {LONG}.</p><p>Third {LONG}.</p></div></body>"
    assert html_text.main_text(page) == f"First {LONG}.\n\nSecond {LONG}.\n\nThird {LONG}."


def test_html_text_keeps_links_headings_and_rows_of_the_core():
    page = (
        f'<body><div class="overflow-hidden"><div class="article-header"><h1>Title</h1></div><p>First {LONG}, '
        f'<a href="/the-hidden-cost.html">a link</a> <a href="/x?id=menu">too</a>.</p><table><tr class="header"><th>Head</th></tr>'
        f'<tr><td>Cell {LONG}</td></tr></table></div></body>'
    )
    assert html_text.main_text(page) == f"Title\n\nFirst {LONG}, a link too.\n\nHead\n\nCell {LONG}"


@pytest.mark.parametrize("tag", [
    "<div hidden>", "<div HIDDEN=''>", "<div class='header'>", "<div class='Big notice'>", "<div id=search>", "<div role=alert>",
    "<div class='comments-list'>", "<div aria-hidden=true>", "<div style='color:red; display : none !important'>",
])
def test_html_text_cuts_what_is_marked_beside_the_core(tag):
    page = f"<body>{tag}<p>Beside, {LONG}.</p></div><div id=content><p>First {LONG}.</p><p>Second {LONG}.</p></div></body>"
    assert html_text.main_text(page) == f"First {LONG}.\n\nSecond {LONG}."


def test_html_text_needs_no_end_of_head_and_takes_loose_texts():
    text = f"First {LONG}.\n\nSecond {LONG}."
    for head in ("<head><title>T</title><meta charset=x>", "<head><style>p{}</style><noscript><img></noscript>\n", "<head>"):
        assert html_text.main_text(f"<html>{head}<p>First {LONG}.<p>Second {LONG}.") == text
        assert html_text.main_text(f"<html>{head}Only {LONG}.") == f"Only {LONG}."
    for loose in (f"Loose <i>and</i> {LONG}.", f"Loose<br>and {LONG}."):
        page = f"<body>{loose}<div><p>First {LONG}.</p><p>Second {LONG}.</p><p>{LONG}</p></div><p>End {LONG}</p></body>"
        assert html_text.main_text(page).startswith(f"Loose and {LONG}.\n\nFirst")
    assert html_text.main_text(f"<body><div class=header><p>All {LONG}</p></div></body>") == f"All {LONG}"


def test_neighbours_are_found(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 16)) + rng.normal(size=(6, 16))[rng.integers(6, size=600)] * 3
    vectors[100:300] = vectors[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(1000, None, "x"), (1020, [0.0] * 16, "x"), (1040, [float("nan")] * 16, "x"), (None, [1.0] * 16, "x"), rows[40]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = defaultdict(dict)
    for r in adaptive_scan.nearest_neighbours(frame).collect():
        found[r["query_id"]][r["rank"]] = r["vec_id"]
    assert sorted(found) == list(range(0, 600, 20))
    right = 0
    for query, near in found.items():
        scores = (vectors * vectors[query]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != query][:20]
        assert len(near) == 20
        right += len(set(order) & set(near.values()))
    assert right >= 0.9 * 20 * len(found)


def test_classifiers_on_held_out_rows(spark):
    for name, label in (("op3_quality_votes", "quality"), ("op6_toxicity", "toxic")):
        directory = "/root/testdata/sf0.01"
        labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{directory}/labels.parquet").collect()}
        rows = [r for r in QUERIES[name](spark, directory).collect()]
        assert all(0 <= r["score"] <= 1 for r in rows)
        held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
        right = sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held)
        assert right >= (0.95 if label == "quality" else 0.6), (name, right)


def _toxicity_model(blank=" ", bad=("vile", "scum", "idiot"), good=("river", "garden", "music", "window", "paper", "bread")):
    """A model of texts of 24 words, of which a toxic one has six bad ones."""
    rng = random.Random(3)
    rows = []
    for at in range(120):
        words = [rng.choice(good) for _ in range(24)]
        if at % 2:
            words[9:15] = [rng.choice(bad) for _ in range(6)]
        rows.append((blank.join(words), at % 2))
    return toxicity.train([x for x, _ in rows], [y for _, y in rows])


def _toxicity_scores(model, texts):
    column = pa.array(texts, pa.string())
    return np.concatenate([model.scores(raw, ends) for _, _, raw, ends in blocks(column)])


def test_toxicity_of_a_text_does_not_depend_on_marks_in_others():
    buckets, bounds = toxicity.subwords([b"a\x02\x02b", b"bb", b"cc"])
    for at, piece in ((1, b"bb"), (2, b"cc")):
        assert (buckets[bounds[at] : bounds[at + 1]] == toxicity.subwords([piece])[0]).all()
    model = _toxicity_model()
    toxic, clean = "river vile scum idiot vile scum idiot garden", "river garden music window paper bread river"
    alone = [_toxicity_scores(model, [x])[0] for x in (toxic, clean)]
    assert alone[0] > 0.5 > alone[1]
    for odd in ("\x02", "an \x02\x02 odd\x02 page", "\x03\x02\x03"):
        assert np.allclose(_toxicity_scores(model, [odd, toxic, clean])[1:], alone)


@pytest.mark.parametrize("blank", ["\t", "  ", "\r\n", "\u3000", "\u00a0 "])
def test_toxic_passage_shows_whatever_the_white_space(blank):
    model = _toxicity_model()
    clean = ["river", "garden", "music", "window", "paper", "bread"] * 500
    toxic = [*clean[:1500], *["vile", "scum", "idiot"] * 3, *clean[1500:]]
    scores = _toxicity_scores(model, [blank.join(toxic), blank.join(clean), blank * 9])
    assert scores[0] > 0.5 > scores[1] and (scores == _toxicity_scores(model, [" ".join(toxic), " ".join(clean), ""])).all()


def test_toxic_passage_shows_in_a_text_without_white_space():
    good, bad = ("河流经过花园", "音乐从窗外来", "面包放在纸上", "孩子们读书"), ("恶毒的蠢货", "卑鄙的败类")
    model = _toxicity_model("", bad, good)
    rng = random.Random(5)
    clean = [rng.choice(good) for _ in range(3000)]
    toxic = [*clean[:1500], *(rng.choice(bad) for _ in range(8)), *clean[1500:]]
    scores = _toxicity_scores(model, ["".join(toxic), "".join(clean)])
    assert scores[0] > 0.5 > scores[1]


def test_toxicity_pieces_are_short_and_whole():
    texts = ["", "  a,b \u3000x" + "y" * 99, "\u2003 \u00a0", "é" * 50 + "日本語" * 20 + " \U0001f600" * 2, None, "\x1fz"]
    for _, _, raw, ends in blocks(pa.array(texts, pa.string())):
        pieces, place, first = toxicity._distinct(raw, ends)
        for row, text in enumerate(texts):
            own = [pieces[p].decode() for p in place[first[row] : first[row + 1]]]
            assert "".join(own) == "".join((text or "").split()) and all(0 < len(x) <= 24 for x in own)
            assert all(sum(4 if c > "\u07ff" else 1 for c in x) <= 24 + 3 for x in own)


def test_empty_tables_give_no_rows(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert ngram_join.ngram_components(empty).count() == 0
    assert packing.pack(empty, tokenizer_path(BPE)).count() == 0
    assert wavelet.token_index(empty, tokenizer_path(BPE)).count() == 0
    assert mixture.mixture(empty, ["doc_id"]).count() == 0
    assert fertility.fertility_rules(empty, tokenizer_path(BPE), tokenizer_path("piece_bpe_32k.model")).count() == 0
    assert toxicity.toxicity(empty, none).count() == 0
    assert adaptive_scan.nearest_neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert chat_windows.chat_windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs, scratch = spark.read.parquet(f"{TABLES}/documents.parquet"), Scratch(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, TABLES), name)
        assert docs.count() > 0
        if name != "packing":
            assert docs.columns == columns
    assert QUERIES and docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
