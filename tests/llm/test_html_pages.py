"""Pages that broke the extraction once: few blocks, deep nesting, comments written as articles."""

import time
import tracemalloc

import numpy as np
import pytest

from clusterlens.llm import html_extract as h

WEIGHTS = np.array([0.3, 1.0, -3, 0.5, 1, 0.5, -1, 0.5, 0, -1.0])
LONG = " ".join(["The river ran slowly past the old stone houses, and nobody said a word."] * 6)


@pytest.mark.parametrize("n", range(6))
def test_pages_of_few_blocks(spark, n):
    page = "".join(f"<p>{LONG} {k}</p>" for k in range(n))
    assert len(h.features_of(h.blocks_of(page))) == n
    assert h.extract_text(page, WEIGHTS) == "\n\n".join(f"{LONG} {k}" for k in range(n))
    pages = spark.createDataFrame([(1, page), (2, "<h1>Title</h1><p>Only paragraph.</p>"), (3, None), (4, "")], "page_id long, html string")
    assert h.train(pages).shape == (h.FEATURES,)
    assert pages.select(h.main_text(pages["html"], WEIGHTS).alias("t")).count() == 4


@pytest.mark.parametrize("page", ["<div>text ", "<div>", "<div>text <h2>h</h2>", "<b><div>x</p>"])
def test_deep_nesting_takes_linear_memory(page):
    used = []
    for n in (2_000, 20_000):
        tracemalloc.start()
        h.extract_text(page * n, WEIGHTS)
        used.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert used[1] < 25 * used[0]
    began = time.time()
    h.extract_text(page * 100_000, WEIGHTS)
    assert time.time() - began < 60


def test_distances_in_the_tree():
    found = h.blocks_of("<div><p>a</p><p>b</p><section><ul><li>c</li></ul></section></div><div>d</div>e")
    tree = found[0].tree
    assert [b.text for b in found] == list("abcde")
    assert [tree.distance(x.element, y.element) for x, y in zip(found, found[1:], strict=False)] == [2, 4, 5, 1]
    assert tree.distance(found[0].element, found[0].element) == 0


@pytest.mark.parametrize(
    "comments",
    [
        '<article class="comment"><p>{c}</p></article>', '<section id="comments"><article><p>{c}</p></article></section>', '<div class="comments-area"><ol><li class="x"><article id="c1"><p>{c}</p></article></li></ol></div>',
        '<ol class="comment-list"><li><p>{c}</p></li></ol>', "<div id='disqus_thread'><p>{c}</p></div>", '<div class="replies"><article class="reply"><h2>Re</h2><p>{c}</p></article></div>',
    ],
)
@pytest.mark.parametrize("inside", [True, False])
def test_reader_comments_are_left_out(comments, inside):
    said = " ".join(["I agree with all of this, and I would like to add some thoughts."] * 40)  # more text than the article
    part = "".join(comments.format(c=f"{said} {k}") for k in range(3))
    if not inside and comments.startswith("<article"):
        part = f"<section id='comments'>{part}</section>"
    page = f"<article class='post comments-open'><h1>Title</h1><p>{LONG}</p>{part if inside else ''}</article>{'' if inside else part}"
    assert h.extract_text(page, WEIGHTS) == f"Title\n\n{LONG}"


@pytest.mark.parametrize("name", ["post has-comments", "with-comments", "comments-open", "no-comments"])
def test_names_that_only_mention_comments_keep_the_text(name):
    assert h.extract_text(f'<article class="{name}"><p>{LONG}</p></article>', WEIGHTS) == LONG
    assert h.extract_text(f'<article><div class="{name}"><p>{LONG}</p></div></article>', WEIGHTS) == LONG
    assert h.extract_text(f'<main class="comments"><p>{LONG}</p></main>', WEIGHTS) == LONG
