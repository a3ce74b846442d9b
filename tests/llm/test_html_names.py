"""Class and id names that mix boilerplate words with others do not drop articles."""

import pytest

from roadpulse.llm import html_text

P = (
    "<h1>Council agrees on bridge</h1><p>The council agreed on Tuesday to widen the old bridge, which carries most of the traffic.</p>"
    "<p>Work begins in spring and takes two years, the mayor said.</p>"
)
TEXT = [
    "Council agrees on bridge", "The council agreed on Tuesday to widen the old bridge, which carries most of the traffic.",
    "Work begins in spring and takes two years, the mayor said.",
]
BOX = '<div class="elementor-widget-container">'


@pytest.mark.parametrize("html,lines", [
    (f"<main>{BOX}{P}</div></main>", TEXT),
    (f"<main>{BOX}<h1>{TEXT[0]}</h1></div>{BOX}<p>{TEXT[1]}</p></div>{BOX}<p>{TEXT[2]}</p></div></main>", TEXT),
    (f'<div class="wrapper sticky-header">{P}<footer>Imprint</footer></div>', TEXT),
    (f'<article><div class="post-content share-enabled">{P}</div></article>', TEXT),
    (f'<div class="body-text login-required">{P}</div>', TEXT),
    (f'<div id="app" class="ad-free">{P}</div>', TEXT),
    (f'<article>{P}</article><div class="user-comments"><p>Anna: {TEXT[2]}</p></div><div class="site-header">Daily news</div>', TEXT),
    (f'<article>{P}</article><section class="comment-list">{f"<p>Ben: {TEXT[1]}</p>" * 9}</section>', TEXT),
    (f'<article>{P}<div class="article-share">Share this story with your friends</div></article>', TEXT),
    ("<article><p>The sum <math><mi>n</mi><mo>+</mo><mn>1</mn><annotation>n+1</annotation></math> of both is odd.</p></article>", ["The sum n+1 of both is odd."]),
])
def test_mixed_names(spark, html, lines):
    if not hasattr(test_mixed_names, "tree"):
        test_mixed_names.tree = html_text.train_tree(spark)
    pages = spark.createDataFrame([(1, "u", f"<html><body>{html}</body></html>")], "page_id long, url string, html string")
    assert html_text.extract(pages, model=test_mixed_names.tree).first().text.split("\n") == lines
