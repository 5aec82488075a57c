"""Pages: time in proportion to their size, and the edges of ``extracted``."""

import time

import pytest

from siltstone.llm import html_text
from siltstone.llm.scratch import ship

LONG = "words of an article that goes on for a while, with commas, and ends at last"


@pytest.mark.parametrize("part", ["<div>", "<p>", "<b>", "<table><tr><td>", "<ul><li>", "<span class=a>", "</p>", "<a href=x>t", "<div></b>"])
def test_time_grows_with_the_page(part):
    page = part * (1_000_000 // len(part))
    start = time.perf_counter()
    html_text.main_text(page + f"<p>{LONG}")
    assert time.perf_counter() - start < 20


def test_nested_and_unclosed_elements():
    assert html_text.main_text("<div>" * 5000 + f"<p>{LONG}<p>second {LONG}") == f"{LONG}\n\nsecond {LONG}"
    assert html_text.main_text(f"<table><tr><td><b>{LONG}</table></b><p>{LONG}") == f"{LONG}\n\n{LONG}"
    assert html_text.main_text(f"<ul><li>{LONG}<ul><li>inner {LONG}</ul><li>third {LONG}</ul>").count("\n\n") == 2


def test_extracted_edges(spark):
    ship(spark)
    page = f"<html><body><nav>Menu</nav><article><p>{LONG}</p></article></body></html>"
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, None), (None, "v", "", "y"), (3, "w", "<nav>only menus</nav>", "z"),
            (4, "l", f"<p>{LONG}" * 20_000, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in html_text.extracted(frame).collect()), key=repr)
    long = "\n\n".join([LONG] * 20_000)
    assert found == sorted([
        (1, "u", LONG, len(LONG)), (1, "u", LONG, len(LONG)), (2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0),
        (4, "l", long, len(long)),
    ], key=repr)
    assert html_text.extracted(spark.createDataFrame([], frame.schema)).collect() == []
