"""Pages of makes that the table does not hold, exact marginals, and pages that are hard to parse."""

import itertools
import random
import time

import pytest

from sluice.llm import html_extract
from sluice.llm.common import table

LONG = "This paragraph says something about the topic at hand, and it goes on for quite a while before it ends. " * 2
TEXT = LONG.strip()


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.train(table(spark, "/root/testdata/sf0.001", "pages"))


PAGES = {
    "no landmark": (f'<html><body><div class="post-body"><h1>Title</h1><p>{LONG}</p><p>Short.</p></div><div class="footer">c</div></body></html>', f"Title\n{TEXT}\nShort."),
    "plain body": (f"<body><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>", f"Title\n{TEXT}\n{TEXT}"),
    "short plain body": ("<body><h1>Title</h1><p>One.</p><p>Two two.</p></body>", "Title\nOne.\nTwo two."),
    "table layout": (f"<table><tr><td><a href=a>one</a> <a href=b>two</a></td><td><h1>Title</h1><p>{LONG}</p></td></tr><tr><td>Copyright</td></tr></table>", f"Title\n{TEXT}"),
    "menu in the body": (f"<body><ul><li><a href=x>a</a></li><li><a href=y>b</a></li></ul><h1>Title</h1><p>{LONG}</p><form><p>{LONG}</p></form></body>", f"Title\n{TEXT}"),
    "quote in an unquoted value": (f'<article><p>{LONG}<a href=foo"bar>link</a> tail</p></article>', f"{TEXT} link tail"),
    "notice and comments": (f'<body><div class="cookie-notice"><p>{LONG}</p></div><article><h1>T</h1><p>{LONG}</p></article><section id="comments"><p>{LONG}</p></section></body>', f"T\n{TEXT}"),
    "tag of its own": (f"<body><x-story><p>{LONG}</p><p>More.</p></x-story></body>", f"{TEXT}\nMore."),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_makes_of_pages(model, name):
    source, want = PAGES[name]
    assert html_extract.main_text(source, model) == want


def test_marginals_are_exact(model):
    """Against the sum over all states of all nodes of small trees."""
    rng = random.Random(2)
    for _ in range(12):
        source = "".join(rng.choice(["<div class=post>", "<p>", "<nav>", "</div>", "text ", LONG, "<a>x</a>", "<li>"]) for _ in range(6))
        tree = html_extract.Tree(source)
        kinds, n = tree.kinds(), len(tree.tag)
        if n > 9:
            continue

        def potential(i, up, down):
            rows = model["edge"].get(kinds[i]) or model["edge"].get(kinds[i].split("~")[0]) or html_extract._UNKNOWN
            known = [model["word"][b] for b in map(html_extract.bucket, tree.words[i]) if b in model["word"]]
            import math

            return rows[up][down] * math.exp(sum(k[up][down] for k in known))

        total, content = 0.0, [0.0] * n
        for states in itertools.product(html_extract.STATES, repeat=n - 1):
            states = (html_extract.FRAME, *states)
            weight = 1.0
            for i in range(1, n):
                weight *= potential(i, states[tree.parent[i]], states[i])
            total += weight
            for i in range(n):
                content[i] += weight * (states[i] == html_extract.CONTENT)
        got = html_extract.marginals(tree, model)
        assert got == pytest.approx([c / total for c in content], abs=1e-9)


@pytest.mark.parametrize("source", ["<b>" * 20_000 + "</i>" * 20_000, "<div><article>" * 5000, "<p><button>" + "<div>" * 10_000, "<li>" * 20_000, "<a href='" * 5000, "<a b=" * 20_000, "<p " + "x=y " * 50_000])
def test_parsing_takes_time_in_proportion(model, source):
    began = time.process_time()
    html_extract.main_text(source, model)
    html_extract._labels(html_extract.Tree(source))
    assert time.process_time() - began < 5


def test_every_word_counts_whatever_its_length(spark):
    """Words that share a prefix are apart, and rare ones still mark their kind."""
    rare = "x" * 150
    page = f'<html><body><article><p>{LONG}</p><div class="{rare}a menu"><p>{LONG}</p></div></article></body></html>'
    pages = spark.createDataFrame([(i, "u", page) for i in range(3)], "page_id long, url string, html string")
    model = html_extract.train(pages)
    assert html_extract.bucket(rare + "a") in model["word"] and html_extract.bucket(rare + "b") not in model["word"]
    assert all(len(k) <= 6 or not k.startswith("w") for k in model["word"])


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extracted(empty).collect() == []
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, "v", "\x00<\x01"), (2, "w", "<p>a&amp;amp;b")], "page_id long, url string, html string")
    odd = odd.selectExpr("*", "1 AS id", "'x' AS text", "2 AS n_chars", "3 AS kind")
    rows = html_extract.extracted(odd).collect()
    assert len(rows) == 4 and all(r.n_chars == len(r.text) for r in rows)
    assert [r.text for r in rows if r.url == "w"] == ["a&amp;b"]
