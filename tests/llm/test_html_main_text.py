"""Main text that its page marks badly."""

import html
import random
import re
import time

import pytest

from strandloom.llm import html_text
from strandloom.llm.html_text import main_text

TEXT = ("It is the story of a man who was in the house and had to go. " * 5).strip()
LONG = f"<p>{TEXT}</p><p>{TEXT}</p>"
SAID = "That was the best of all the stories that I have read in this year and more."


@pytest.mark.parametrize("comments", [f'<ol class="comment-list"><li><article><p>{SAID}</p></article></ol>', f'<article class="comment"><p>{SAID}</p></article>', f'<article class="card"><a href=x>{SAID}</a></article>'])
def test_articles_beside_the_text(comments):
    assert main_text(f"<body><div>{LONG}</div>{comments}</body>") == f"{TEXT} {TEXT}"


def test_unmarked_article_does_not_hide_the_text():
    assert f"{TEXT} {TEXT}" in main_text(f"<body><div>{LONG}</div><article><p>{SAID}</p></article></body>")


@pytest.mark.parametrize("name", ["content with-sidebar", "site has-header", "promotion-study"])
def test_a_token_does_not_condemn_the_page(name):
    assert main_text(f'<body><div class="{name}">{LONG}</div></body>') == f"{TEXT} {TEXT}"


def test_sections_of_an_article():
    page = f'<article><h2 id="search-methods">Search methods</h2>{LONG}<section id="related-work"><p>Others did that before.</p></section><figure><img src=x><figcaption>What it was.</figcaption></figure><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>'
    assert main_text(page) == f"Search methods {TEXT} {TEXT} Others did that before. What it was. So x=2 holds."


@pytest.mark.parametrize("name", ["cookie-notice", "site-footer", "comment-list", "sidebar-left", "newsletter-hint"])
def test_small_or_named_parts_stay_out(name):
    assert main_text(f'<body><div>{LONG}</div><div class="{name}"><p>{SAID}</p></div></body>') == f"{TEXT} {TEXT}"


def test_parts_of_an_article_stay():
    assert main_text(f'<article>{LONG}<div class="legal">Rules of the house.</div><div class="social-history"><p>How it was.</p></div></article>') == f"{TEXT} {TEXT} Rules of the house. How it was."
    assert main_text(f'<article>{LONG}<div class="related"><a href=x>One more</a> <a href=y>Another</a></div></article>') == f"{TEXT} {TEXT}"


def test_links_around_blocks_and_unclosed_parts():
    assert main_text(f"<body><div>{LONG}</div><a href=x><div>{TEXT}</div></a></body>") == f"{TEXT} {TEXT}"
    assert main_text(f"<body><div><p><a href=x>open<p>{TEXT}</p>{LONG}</div></body>") == f"{TEXT} {TEXT} {TEXT}"
    assert main_text(f"<body><p><svg><p>{TEXT}</p></body>") == TEXT


def _by_loops(blocks):
    """The two passes over (text, link characters), written out: which blocks of a plain page are good."""
    labels = []
    for text, links in blocks:
        words = [w for w in re.findall(r"[^\W\d_]+", text.lower())]
        stop = sum(w in html_text.STOP_WORDS for w in words) / max(len(words), 1)
        if links / len(text) > 0.3:
            labels.append("bad")
        elif len(text) < 70:
            labels.append("bad" if links else "short")
        elif stop >= 0.3:
            labels.append("good" if len(text) >= 200 else "near")
        else:
            labels.append("near" if stop >= 0.2 else "bad")
    out = []
    for i, x in enumerate(labels):
        left = next((j for j in range(i - 1, -1, -1) if labels[j] in ("good", "bad")), None)
        right = next((j for j in range(i + 1, len(labels)) if labels[j] in ("good", "bad")), None)
        sides = [j for j in (left, right) if j is not None]
        if x in ("good", "bad"):
            out.append(x == "good")
        elif not sides:
            out.append(x == "near")
        elif len({labels[j] for j in sides}) == 1:
            out.append(labels[sides[0]] == "good")
        elif x == "near":
            out.append(True)
        else:
            good, bad = (left, right) if labels[left] == "good" else (right, left)
            out.append(abs(good - i) <= abs(bad - i))
    return out


def test_blocks_against_loops():
    r = random.Random(8)
    for _ in range(300):
        found, page = [], "<body>"
        for _ in range(r.randint(1, 25)):
            text = " ".join(r.choice(["the", "of", "and", "planet", "carbon", "window", "garden"]) for _ in range(r.choice([1, 3, 8, 14, 20, 45, 60])))
            cut = r.choice([0, 0, 0, 1, len(text) // 2, len(text)])
            head = text[:cut].strip()
            page += f"<p><a href=x>{text[:cut]}</a>{text[cut:]}</p>" if cut else f"<p>{text}</p>"
            found.append((text, len(head)))
        want = " ".join(t for (t, _), ok in zip(found, _by_loops(found)) if ok)
        assert main_text(page + "</body>") == want


@pytest.mark.parametrize("attrs", ['title="the hidden cost of war"', "data-title='a hidden gem'", 'class="hidden-gems"', "data-hidden=no"])
def test_a_word_in_a_value_hides_nothing(attrs):
    assert main_text(f"<article><div {attrs}><p>{TEXT}</p></div></article>") == TEXT


@pytest.mark.parametrize("attrs", ["hidden", "HIDDEN", 'Hidden=""', "id=x hidden", 'hidden="until-found"', 'ARIA-HIDDEN="True"'])
def test_hidden_parts(attrs):
    assert main_text(f"<body><div>{LONG}</div><div {attrs}><p>{SAID * 4}</p></div></body>") == f"{TEXT} {TEXT}"


RUSSIAN = "Однажды вечером старый мастер вернулся домой и долго рассказывал детям о море, о кораблях и о далёких городах, где он когда-то жил и работал. " * 2
JAPANESE = "昔々あるところにおじいさんとおばあさんが住んでいました。おじいさんは山へ柴刈りに、おばあさんは川へ洗濯に行きました。" * 4
POLISH = "Dawno temu stary rybak mieszkał nad brzegiem jeziora, codziennie wypływał łodzią przed świtem, wracał wieczorem zmęczony, opowiadając wnukom przygody. " * 2


@pytest.mark.parametrize("text", [RUSSIAN, JAPANESE, POLISH])
def test_languages_without_a_list(text):
    menu = "".join(f"<li><a href=/{i}>{text[:20]}</a></li>" for i in range(8))
    page = f"<body><ul>{menu}</ul><div><p>{text}</p><p>{text}</p></div><div class=footer>{text}</div></body>"
    assert main_text(page) == f"{text.strip()} {text.strip()}"
    assert main_text(f"<body><div>{LONG}<p>{text}</p></div></body>").startswith(f"{TEXT} {TEXT}")


def test_a_paragraph_in_another_script_stays():
    assert main_text(f"<body><div>{LONG}<p>{RUSSIAN}</p>{LONG}</div></body>") == f"{TEXT} {TEXT} {RUSSIAN.strip()} {TEXT} {TEXT}"


@pytest.mark.parametrize("page", ["<div>" * 40_000 + "</p></b></li>" * 40_000, "<article>" * 60_000, "<div class=x-ad-y>a" * 40_000, "<p>" * 60_000 + "</div>" * 60_000, "<table><tr><td>" * 30_000])
def test_hostile_pages_take_linear_time(page):
    began = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - began < 10


def test_labelled_pages(spark, sf):
    """Pages of the table in one form: the article's own text is known from the page by hand-written cuts."""
    checked = 0
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        if not r.html or r.html.count("<article>") != 1 or "<div" in r.html.split("<article>")[1].split("</article>")[0]:
            continue
        inner = r.html.split("<article>")[1].split("</article>")[0]
        if re.search(r"<(?!/?(?:p|b|i|em|strong|h1|h2|h3|br|ul|ol|li)\b)", inner):
            continue
        flat = re.sub(r"</?(?:b|i|em|strong)>", "", inner)
        parts = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"</?(?:p|h1|h2|h3|ul|ol|li)>", re.sub(r"<br>", " ", flat))]
        assert main_text(r.html) == " ".join(x for x in parts if x), r.page_id
        checked += 1
    assert checked >= 10
