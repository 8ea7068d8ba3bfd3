"""Main text: awkward markup, and work in proportion to the page."""

import time

import pytest

from tideline.llm import html


def texts(page, **kw):
    return [b.text for b in html.blocks(page, **kw)]


def test_attributes_named_like_the_training_mark(spark):
    pages = [f"<html><body><nav><a href=/>Home</a></nav><article><h1>A title {i}</h1><table><tr><td data-label=\"Unit price\">Five and a half euros, they said.</td><td data-label='x'>More of it here.</td><td data-label>z z</td></tr></table><p>Some words of the text number {i}, and more.</p></article></body></html>" for i in range(30)]
    df = spark.createDataFrame([(i, "u", p, "x", 1) for i, p in enumerate([*pages, pages[0], None, ""])], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r["__tl_text"] for r in html.extract(df, html.train(df)).collect()}
    assert len(got) == 33 and got[30] == got[0] and got[31] == got[32] == ""
    assert "Five and a half euros, they said." in got[0] and "Home" not in got[0]


@pytest.mark.parametrize("page", ["<a " * 333_000, "<div>x" * 170_000, "<a \"" * 250_000, "<a '>" * 200_000, "<" * 1_000_000, "<!" * 500_000, "<!--" * 250_000,
                                  "<div>" * 100_000 + "</p>" * 125_000, "".join(f"<div class='c{'abcdefghij'[i % 10] * (i % 97)}'>x" for i in range(12_000)), "<svg/>" * 160_000, "<svg>" * 200_000, "&" * 1_000_000, "<x" + " class=y" * 120_000 + ">t"])
def test_a_broken_page_of_a_megabyte_takes_seconds(page):
    known = html.Known(frozenset(["div", "p"]), frozenset(["aaa", "y"]))
    began = time.process_time()
    html.blocks(page, known)
    html.blocks(page, keep=150)
    assert time.process_time() - began < 6  # both ways


def test_awkward_markup():
    assert texts("a < b <c>d</c> 5<6 <3") == ["a < b", "d", "5<6 <3"]
    assert texts("<p title=\"a > b\">x</p><p title='it's'>y</p>") == ["x", "y"]
    assert texts('<p title="never closed>x</p><p>y') == ["x", "y"]
    assert texts("<p>x<!-- no end <p>y") == ["x"]
    assert texts("<p>x<script>if (a<b) </p></script>y") == ["x y"] or texts("<p>x<script>if (a<b) </p></script>y") == ["x", "y"]
    assert texts("<!DOCTYPE html><?xml version='1'?><p>x") == ["x"]
    assert texts("<p>no end of tag <a href=") == ["no end of tag <a href="]
    assert texts("") == texts(None) == []
    own = html.blocks("<main><div class='c1 menu' id=D><p>x</p></div><p hidden>y</p></main><p data-label=\"main\">z</p>")
    assert [(b.leaf, sorted(b.tags), sorted(b.names), b.hidden, b.mark, b.inside) for b in own] == [
        ("p", ["div", "main", "p"], ["c", "d", "menu"], False, None, False),
        ("p", ["main", "p"], [], True, None, True),
        ("p", ["p"], [], False, None, False),
    ]
    assert [b.mark for b in html.blocks("<div data-label=\"main\"><p>z", marks=True)] == ["main"]


def test_known_tags_and_names_are_all_that_is_kept():
    page = "<main class=body><div class='c menu'><em>x</em><ul><li class=c>y"
    full, part = html.blocks(page), html.blocks(page, html.Known(frozenset(["div", "li"]), frozenset(["c"])))
    assert [b.text for b in full] == [b.text for b in part] and [b.inside for b in full] == [b.inside for b in part]
    assert [(sorted(b.tags), sorted(b.names)) for b in part] == [(["div"], ["c"]), (["div", "li"], ["c"])]
