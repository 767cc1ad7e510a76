"""Markup that used to swallow text, and broken pages of a megabyte."""

import time

import pytest

from flagstone.llm.html import _tokens, main_text, page_lines

PAGE = "<html><body><article><p>One first paragraph here.</p>%s<p>Second paragraph, after it.</p></article></body></html>"
WHOLE = "One first paragraph here.\n\nSecond paragraph, after it."


@pytest.mark.parametrize(
    "markup",
    [
        '<svg class="i"/>',
        "<math/>",
        "<video-player>",
        "<video-player></video-player>",
        "<select-box>",
        "<canvas-x>",
        "<title-x>",
        "<svg><title>no</title></svg>",
        '<script>if (a<b) x="</p>";</script>',
        "<iframe src=x>",
        "<object data=x>",
        '<a title="a > b"></a>',
        "<!-- no -->",
        "<![CDATA[ no ]]>",
        "<textarea>no</textarea>",
        "<select><option>no</select>",
        "<SCRIPT >no</Script >",
        "<br/>",
        "</svg>",
    ],
)
def test_no_text_is_lost(markup):
    assert main_text(PAGE % markup) == WHOLE


def test_unclosed_script_takes_the_rest():
    assert main_text(PAGE % "<script>x") == "One first paragraph here."
    assert main_text(PAGE % "<!-- x") == "One first paragraph here."
    assert main_text(PAGE % '<p class="x>y') == WHOLE.replace("\n\n", "\n\ny\n\n")


def test_tokens_cover_tags_in_order():
    page = 'a<b c="d>e">f</b><!--g--><svg/>h<style>i</style>j<k'
    assert [(page[a:b], close, tag) for a, b, close, tag, _ in _tokens(page)] == [
        ('<b c="d>e">', False, "b"), ("</b>", True, "b"), ("<!--g-->", False, ""), ("<svg/>", False, ""), ("<style>i</style>", False, "")
    ]


@pytest.mark.parametrize(
    "unit",
    ['<a "', '<a b="', "<!", "<", "<a ", "<a b='>", "</x>", "<!--", "<script ", "<div class=ad>", "<svg>", '<a b="x>', "&lt;", "<p>x", "</script ", "<a b='\""],
)
def test_time_grows_with_the_page(unit):
    def seconds(n):
        start = time.process_time()
        page_lines(unit * (n // len(unit)))
        return time.process_time() - start

    # a quadratic scan of a megabyte takes minutes
    assert seconds(1 << 20) < 20


def test_deep_nesting():
    start = time.process_time()
    page_lines("<div class=ad>" * 35_000 + "</x>" * 100_000 + "</nav>" * 50_000)
    assert time.process_time() - start < 20
