"""Extraction against a plain reading of the given pages, and on layouts they do not have."""

import html
import re
import time

import pytest

from orderloom.llm import html_paths
from orderloom.llm.html_paths import main_text
from orderloom.llm.queries import QUERIES

PROSE = "The river rose in the night, and by the morning the lower fields were under water. Nobody had slept."
MORE = "It went back slowly; the grass was grey with silt, and the fences leaned. Work began again at noon."
LAST = "By the end of the week the road was open, and the school, too, had dried out enough to be used."
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News of the day</a></li><li><a href=/c>About us</a></li></ul>"


def plain_article(page):
    """The article of the given pages: blocks between tags, which they write in one way only."""
    if not page or "<article>" not in page:
        return ""
    body = page.split("<article>", 1)[1].split("</article>")[0]
    parts = re.split(r"</?(?:p|h1)>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in parts]
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_equals_a_plain_reading(spark, sf):
    folder = f"/root/testdata/{sf}"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op13_html_paths"](spark, folder).collect()
    assert len(rows) == len(pages)
    for row in rows:
        page = pages[row["page_id"]]
        assert (row["url"], row["text"]) == (page["url"], plain_article(page["html"]))
        assert row["n_chars"] == len(row["text"])


LAYOUTS = {
    "divs with classes": (
        f"<body><div class='site-header'><a href=/>The Paper</a></div><div id=nav>{MENU}</div>"
        f"<div class=content><h1>Flood</h1><p>{PROSE}</p><p>Short.</p><p>{MORE}</p></div>"
        f"<div class='left-sidebar'><p>{LAST}</p></div><div class='comments'><p>{LAST}</p><p>{LAST}</p><p>{LAST}</p>"
        "</div><div id=footer>All rights reserved.</div></body>",
        f"Flood\n{PROSE}\nShort.\n{MORE}",
    ),
    "nothing named": (
        f"<body><div>{MENU}</div><div><h2>Flood</h2><p>{PROSE}</p><ul><li>one thing</li><li>another</li></ul>"
        f"<p>{MORE}</p></div><div>{MENU}</div></body>",
        f"Flood\n{PROSE}\none thing\nanother\n{MORE}",
    ),
    "no container": (
        f"<body><div><a href=/>Home</a> | <a href=/x>News</a></div><h1>Flood</h1><p>{PROSE}<p>{MORE}<p>{LAST}"
        "<div><a href=/i>Imprint</a> <a href=/p>Privacy</a></div></body>",
        f"Flood\n{PROSE}\n{MORE}\n{LAST}",
    ),
    "table layout": (
        f"<table><tr><td>{MENU}</td><td><h1>Flood</h1><p>{PROSE}</p><p>{MORE}</p></td></tr></table>",
        f"Flood\n{PROSE}\n{MORE}",
    ),
    "page in a form": (
        f"<form action=/><header><b>Paper</b></header><main><h1>Flood</h1><p>{PROSE}</p></main></form>",
        f"Flood\n{PROSE}",
    ),
    "forms, notices and adverts within": (
        f"<article><header><h1>Flood</h1></header><div class='cookie-notice'>We use cookies. Really, we do.</div><p>{PROSE}"
        f"</p><div class=ad>{LAST}</div><form><label>Your mail</label><input><button>Send it</button></form><p>{MORE}"
        f"</p><div class='share-buttons'>Share this!</div><footer>Filed under: rivers</footer></article>",
        f"Flood\n{PROSE}\n{MORE}",
    ),
    "comments as articles and as a section": (
        f"<main><article><h1>Flood</h1><p>{PROSE}</p><article><p>{MORE}</p><p>{MORE}</p></article></article>"
        f"<section><h2>3 Comments</h2><article><p>{LAST}</p><p>{LAST}</p><p>{LAST}</p><p>{LAST}</p></article></section></main>",
        f"Flood\n{PROSE}",
    ),
    "comments after a heading": (
        f"<div class=post><h1>Flood</h1><p>{PROSE}</p><p>{MORE}</p><h3>Comments</h3><p>{LAST}</p></div>",
        f"Flood\n{PROSE}\n{MORE}",
    ),
    "hidden and never text": (
        f"<article><p hidden>no</p><p style='display: none'>no</p><noscript><p>no</p></noscript><svg><text>no</text></svg>"
        f"<template><p>no</p></template><script>if (a < b) {{ '<p>no' }}</script><p>{PROSE}</p></article>",
        PROSE,
    ),
    "layout names do not exclude": (
        f"<body class='has-sidebar menu-open'><div class='with-sidebar'><article><p>{PROSE}</p></article></div></body>",
        PROSE,
    ),
    "references, white space and breaks": (
        "<article><p>A &lt;b&gt; &amp;amp; &eacute;&#233;&#xE9; &am &amp&nbsp;x\n\n y<br>z</p><pre>a\n  b</pre></article>",
        "A <b> &amp; ééé &am & x y z\na b",
    ),
    "comments in markup, odd case, unclosed tags": (
        f"<BODY><!-- <p>no</p> --><ARTICLE><H1>Flood</h1><p><b>{PROSE}<br><p>{MORE}</b><i>!</ARTICLE><FOOTER>no",
        f"Flood\n{PROSE}\n{MORE}!",
    ),
    "cut off in a tag": (f"<article><p>{PROSE}</p><p>{MORE}</p><a hre", f"{PROSE}\n{MORE}"),
    "cut off in a comment": (f"<article><p>{PROSE}</p><!-- <p>{MORE}</p>", PROSE),
    "cut off in a script": (f"<article><p>{PROSE}</p><script>var x = '<p>';", PROSE),
    "text that is no markup": ("a < b and 3 <4, </ >then", "a < b and 3 <4, then"),
    "head without an end": (f"<html><head><title>no</title><body><p>{PROSE}</p>", PROSE),
    "a teaser list beside the article": (
        f"<main><article><h1>Flood</h1><p>{PROSE}</p><p>{MORE}</p></article><article><h2>Other</h2><p>{LAST}</p></article></main>",
        f"Flood\n{PROSE}\n{MORE}",
    ),
}


@pytest.mark.parametrize("name", list(LAYOUTS))
def test_layouts(name):
    page, text = LAYOUTS[name]
    assert main_text(page) == text


def test_a_very_short_article_is_kept_beside_a_long_advert():
    page = f"<nav>{MENU}</nav><div class=ad>{PROSE} {MORE}</div><article><p>Of.</p></article><footer>{LAST}</footer>"
    assert main_text(page) == "Of."


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [
        (1, "u", None, "x", "y"),
        (None, None, "", "x", "y"),
        (2, "u", "<nav>only</nav>", "x", "y"),
        (3, "u", "<p>one</p>", "x", "y"),
        (3, "u", "<p>one</p>", "x", "y"),
    ]
    found = html_paths.extract(spark.createDataFrame(rows, schema))
    values = sorted((tuple(r) for r in found.collect()), key=repr)
    assert values == [(1, "u", "", 0), (2, "u", "", 0), (3, "u", "one", 3), (3, "u", "one", 3), (None, None, "", 0)]
    assert html_paths.extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize(
    "part",
    ["<div>", "<b>", "<p>word ", "<!--", "<a href=\"", "</div>", "<script>", "<", "<p class='", "&amp;", "<li><div>"],
)
def test_time_grows_with_the_length_only(part):
    started = time.time()
    main_text(part * 20_000)
    short = time.time() - started
    started = time.time()
    main_text(part * 80_000)
    assert time.time() - started < 10 * short + 1


def test_values_are_summed_per_path():
    page = html_paths.read_page("<div class=x><p>Ab, c.</p><p>de</p></div><div><p><a href=/>fg</a></p></div>")
    values = html_paths._path_values(page, page.blocks)
    # Two blocks of 8 characters and two marks on the first path; the other is all links.
    assert values.tolist() == [4.0 * 2.0, 4.0 * 2.0, 0.0]
