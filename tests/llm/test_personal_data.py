"""Personal data: the base against plain regular expressions, the added kinds by example."""

import hashlib
import random
import re
import time

import pytest

from siltstone.llm import personal_data as pii
from siltstone.llm.queries import QUERIES
from siltstone.llm.scratch import ship

TABLES = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        doubled = [int(x) * (2 if i % 2 else 1) for i, x in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(sum(divmod(x, 10)) for x in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _base(text):
    found = [
        (m.start(), place, m.end())
        for place, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if _passes(kind, m.group())
    ]
    return [(list(PATTERNS)[k], s, e) for s, k, e in sorted(found)]


def _digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def _random_texts(count):
    rng = random.Random(11)
    parts = ["@", "+", ".", "-", " ", "  ", "(", ")", "a", "B", "é", "日", "1", "25", "255", "256", "4111111111111111",
             "4111 1111 1111 1111", "+1 (555) 010-9999", "10.0.0.1", "x.y@z.com", "\n", "_", "%", ":", "\x0b", "0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def _rows(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def test_base_equals_regular_expressions(spark):
    ship(spark)
    texts = [*_random_texts(4000), None, "", "1." * 500, "a@" * 300 + "b.c", "9" * 5000]
    rows = {r.doc_id: r for r in _rows(spark, texts)}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        base, row = _base(text), rows[i]
        assert row.base_sha256 == _digest(base), text
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(x[0] == k for x in base) for k in PATTERNS
        ), text
        listed = [tuple(x.split(":")) for x in row.spans.split(",") if x]
        assert [(k, int(s), int(e)) for k, s, e in listed if k in PATTERNS] == base


def test_query_equals_regular_expressions_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    rows = QUERIES["op11_personal_data"](spark, TABLES).collect()
    assert len(rows) == len(texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    assert all(r.base_sha256 == _digest(_base(texts[r.doc_id])) for r in rows)


@pytest.mark.parametrize("text, kind, wanted", [
    ("write to jörg.müller@bücher.example, please", "mail", "jörg.müller@bücher.example"),
    ("“josé@casa.example”", "mail", "josé@casa.example"),
    ('ask "jo doe"@mail.example now', "mail", '"jo doe"@mail.example'),
    ("jane.roe [at] example [dot] org", "mail", "jane.roe [at] example [dot] org"),
    ("host 2001:DB8::8a2e:370:7334.", "ip6", "2001:DB8::8a2e:370:7334"),
    ("IBAN DE89 3704 0044 0532 0130 00 with thanks", "iban", "DE89 3704 0044 0532 0130 00"),
    ("pay gb29nwbk60161331926819, soon", "iban", "gb29nwbk60161331926819"),
    ("Account no. 1234-5678-90!", "account", "1234-5678-90"),
    ("SSN: 078-05-1120", "account", "078-05-1120"),
    ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "secret", "04dbebab91ab85687d33eeaaf9ac699e1188f962"),
    ("see ftp://anna:pa55!word@files.example/x", "login", "anna:pa55!word"),
])
def test_added_kinds(spark, text, kind, wanted):
    text = f"é {text}"
    row = _rows(spark, [text])[0]
    listed = [x.split(":") for x in row.spans.split(",") if x]
    assert [text[int(s) : int(e)] for k, s, e in listed if k == kind] == [wanted]


@pytest.mark.parametrize("text", [
    "at 12:30:45 we met", "a::b is code", "IBAN DE89 3704 0044 0532 0130 01", "your account is closed", "tokens of love",
    "password: please choose one", "http://example.org/a:b@c", "me @ home", "1.2.3 and 300.1.1.1", "+12 345",
])
def test_ordinary_text_stays_clean(spark, text):
    assert _rows(spark, [text])[0].spans == ""


def test_added_spans_within_others_are_not_listed(spark):
    row = _rows(spark, ["account 4111 1111 1111 1111"])[0]
    assert row.spans == "card:8:27"


def test_edges(spark):
    ship(spark)
    empty = spark.createDataFrame([], "doc_id long, text string, spans string")
    assert pii.personal_data(empty).collect() == []
    long = "x" * 3_000_000 + " a@b.example " + "é" * 500_000 + " 10.1.2.3"
    rows = [(None, long, "s"), (1, "a@b.example", None), (1, "a@b.example", None), (2, None, "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = pii.personal_spans(frame, keep=["doc_id", "spans"], into="found").collect()
    assert sorted((r.doc_id is None, len(r.found)) for r in found) == [(False, 0), (False, 1), (False, 1), (True, 2)]
    first = next(r for r in found if r.doc_id is None)
    assert [long[x.start : x.end] for x in first.found] == ["a@b.example", "10.1.2.3"]
    with pytest.raises(ValueError):
        pii.personal_spans(frame, keep=["spans"])
    clean = pii.redacted(frame)
    assert clean.columns == frame.columns
    texts = [r.text for r in clean.collect()]
    assert texts.count("[EMAIL]") == 2 and texts.count(None) == 1
    assert any(t and t.endswith("é [IP]") for t in texts)


@pytest.mark.parametrize("part", ["9", "9.", "a@", "+1 ", ":", "a:", "[at]x", "token ", "account 1", "@é.", "http://a:b", "de89 "])
def test_time_grows_with_the_text(part):
    start = time.perf_counter()
    pii.spans(part * (2_000_000 // len(part)))
    assert time.perf_counter() - start < 20
