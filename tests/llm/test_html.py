"""Reading of pages: no text is lost behind broken markup, and time grows with the page."""

from __future__ import annotations

import time

import pytest
from transitlake.llm.html_text import Page


def texts(source):
    return [t for t in Page(source).text if t]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        # Letters that change their length in lower case, before an element whose end is looked for.
        ("İ" * 12 + "<script>x = 1</script><p>kept one two three.</p>", ["İ" * 12, "kept one two three."]),
        ("<SCRIPT>a</Script >b<style>c", ["b"]),
        # Elements without text that nobody closed end before the next block.
        ("<p>a</p><button>click <p>kept</p><div>also</div>", ["a", "kept", "also"]),
        ("<p>a</p><select><option>1<p>kept</p><select><option>2</select><p>b</p>", ["a", "kept", "b"]),
        ("<svg><path d='M0'><h2>kept</h2>", ["kept"]),
        ("<math><mi>x<section>kept</section>", ["kept"]),
        ("<b>x<title>forgotten <p>kept</p>", ["xforgotten", "kept"]),
        # Closed ones keep their blocks.
        ("<button><div>label</div></button><p>b</p>", ["b"]),
        ("<svg><svg></svg><foreignObject><div>no</div></foreignObject></svg><p>b</p>", ["b"]),
        ("<p>x <!-- never > closed <p>hidden</p>", ["x"]),
        ("x <!-- never", ["x"]),
        ("a < b <p>c</p> d < e", ["a < b", "c", "d < e"]),
        ("", []),
    ],
)
def test_broken_markup(source, expected):
    assert [" ".join(t.split()) for t in texts(source)] == expected


@pytest.mark.parametrize(
    "piece", ["<x ", "<x '", "<div>", "<title>", "<button>", "<button><p>", "<!", "<!--", "<li><ul>", '<a href="x', "</p><div>", "<td><dl>", "&amp;<"]
)
def test_a_large_page_takes_no_longer_than_its_size(piece):
    source = "<p>begin</p>" + piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    Page(source)
    assert time.perf_counter() - start < 5
