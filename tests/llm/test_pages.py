"""Page extraction: attributes, marker words, stray quotes, long pages, odd tables."""

import time

import pytest
from pyspark.sql import functions as F

from voltmart.llm import html

ARTICLE = "It is the first of the articles that we have on this, and there is more of it to be read by all who are in the mood for it."
KEPT = [
    '<p title="it is hidden here">{}</p>', '<p data-note=" class=comments ">{}</p>', "<p data-x='a hidden b'>{}</p>",
    '<div class="market-share"><p>{}</p></div>', '<section id="search-for-meaning"><p>{}</p></section>',
    '<section id="related-work"><p>{}</p></section>', '<p title=abc"def>{}</p>', "<p it's>{}</p>", '<p class = "lead" id=x>{}</p>',
    '<p class="content social-science">{}</p>',
]
DROPPED = [
    '<div class="related-posts"><p>{}</p></div>', '<div class="main sidebar"><p>{}</p></div>', "<div class=comments>{}</div>",
    '<div id="comment-list"><p>{}</p></div>', '<div class="cookie-banner"><p>{}</p></div>', '<p hidden>{}</p>',
    '<p aria-hidden="true">{}</p>', '<p style="display: none">{}</p>', '<div role="navigation">{}</div>', '<div CLASS="Site-Header">{}</div>',
    '<div class="share-buttons">{}</div>',
]


@pytest.mark.parametrize("page", KEPT)
def test_names_inside_values_and_longer_words_mark_nothing(page):
    other = "There is also this which we have not said before, and it is as long as that which is to be read with it in the end."
    assert html.main_text(f"<article>{page.format(other)}<p>{ARTICLE}</p></article>") == f"{other}\n{ARTICLE}"


@pytest.mark.parametrize("page", DROPPED)
def test_marked_parts_go(page):
    assert html.main_text(f"<body><div><p>{ARTICLE}</p></div>{page.format('Read this, as it is the best of all that we have to say on it now.')}") == ARTICLE


def test_only_text_in_an_element_with_a_harmless_attribute():
    assert html.main_text(f'<body><div data-title="a hidden b">{ARTICLE}</div>') == ARTICLE


def test_an_open_quote_ends_at_the_next_one_as_in_browsers():
    assert html.main_text(f'<p>{ARTICLE}</p><p title="abc>lost</p><p class="x">{ARTICLE}</p>') == f"{ARTICLE}\n{ARTICLE}"
    assert html.main_text(f'<p>{ARTICLE}</p><p title="abc>lost') == ARTICLE


def test_other_languages_keep_their_sentences():
    text = "Сегодня в столице открылась выставка современного искусства, на которой представлены работы художников из двадцати стран мира и всех её областей."
    page = f"<body><nav><a href=x>Дом</a></nav><div><p>{text}</p><p>{text}</p></div><footer>{text}</footer></body>"
    assert html.main_text(page) == f"{text}\n{text}"


def test_time_grows_with_the_page():
    started = time.process_time()
    assert html.main_text("<div>x" * 100_000 + f"<p>{ARTICLE}") .endswith(ARTICLE)
    html.main_text("</b>" * 100_000)
    html.main_text("<p " + "a=' " * 100_000)
    html.main_text('<p title="' * 100_000)
    assert time.process_time() - started < 20


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    page = f"<article><p>{ARTICLE}</p></article>"
    rows = [(1, "u", page, "x", 7), (1, "u", page, "x", 7), (None, None, page, None, None), (2, "u", None, "", 0),
            (3, "u", "", "", 0), (4, "v", f"<article>{f'<p>{ARTICLE}</p>' * 20_000}</article>", "", 0)]
    found = html.extract(spark.createDataFrame(rows, schema).repartition(3))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in found.collect()), key=repr)
    long = "\n".join([ARTICLE] * 20_000)
    n = len(ARTICLE)
    assert got == sorted(
        [(1, "u", ARTICLE, n)] * 2 + [(None, None, ARTICLE, n), (2, "u", "", 0), (3, "u", "", 0), (4, "v", long, len(long))], key=repr
    )
    assert html.extract(spark.createDataFrame([], schema)).count() == 0
    assert html.extract(found.withColumn("html", F.lit(None))).filter("n_chars > 0").count() == 0
