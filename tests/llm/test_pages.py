"""Pages put together from known parts, read back, and compared with a plain reader that knows which parts are the article."""

import random
import time
from html.parser import HTMLParser

import pytest

from monthclose.llm import htmltext

WORDS = "river stone window garden letter market harbour winter bridge candle mirror orchard".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + rng.choice([".", ", and so on.", "; that was all!"])


class Plain(HTMLParser):
    """One line for each element that carries the mark data-told."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.told, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        if dict(attrs).get("data-told"):
            self.told.append("")
            self.depth = 1
        elif self.depth and tag not in ("br",):
            self.depth += 1

    def handle_endtag(self, tag):
        self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.depth:
            self.told[-1] += data


def told(page):
    reader = Plain()
    reader.feed(page)
    return "\n".join(" ".join(t.split()) for t in reader.told)


def made(rng, wrapper, boundary):
    """A page whose article's blocks are marked, with boilerplate around it and in it."""
    body = [f"<h1 data-told=1>{sentence(rng, 5)}</h1>"]
    for _ in range(rng.randint(4, 9)):
        text = sentence(rng, rng.randint(18, 60))
        words = text.split()
        k = rng.randrange(len(words))
        words[k] = rng.choice(["<b>%s</b>", "<a href='/x?a=1&b=2'>%s</a>", "%s &amp;", "<em title=\"a > b\">%s</em>", "%s\n\t"]) % words[k]
        body.append(f"<p data-told=1>{' '.join(words)}</p>")
    inside = ["<script>var a = '<p>no</p>';</script>", "<!-- <p>no</p> -->", "<style>p{}</style>"]
    for part in rng.sample(inside, 2):
        body.insert(rng.randrange(len(body)), part)
    links = "".join(f"<li><a href='/{k}'>{rng.choice(WORDS)}</a></li>" for k in range(rng.randint(4, 9)))
    around = [f"<nav><ul>{links}</ul></nav>", f"<div class='cookie-notice'><p>{sentence(rng, 8)}</p></div>",
              f"<aside><p>{sentence(rng, 9)}</p></aside>", f"<div id=sidebar><ul>{links}</ul></div>",
              f"<form><label>Mail</label><input name=m><p>{sentence(rng, 4)}</p></form>", f"<div class=ad>{sentence(rng, 6)}</div>"]
    after = [f"<section id=comments><p>{sentence(rng, 9)}</p><p>{sentence(rng, 7)}</p></section>", "<footer>&copy; all</footer>"]
    start, end = boundary
    opened, closed = wrapper
    before = "".join(rng.sample(around, rng.randint(0, 3)))
    return (f"<html><head><title>t</title></head><body>{opened}<header>Site</header>{before}{start}{''.join(body)}{end}"
            f"{''.join(rng.sample(around, 2))}{''.join(after)}{closed}</body></html>")


WRAPPERS = [("", ""), ("<form id=aspnetForm method=post>", "</form>"), ("<div class='search-page has-header'>", "</div>"),
            ("<div id=app style='display:none'>", "</div>")]
BOUNDARIES = [("<article>", "</article>"), ("<main class=related><article>", "</article></main>"), ("<div>", "</div>"),
              ("<div class='post alert-free'>", "</div>")]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("boundary", BOUNDARIES)
def test_generated_pages(wrapper, boundary):
    if "display" in wrapper[0] and "<article>" not in boundary[0]:
        pytest.skip("hidden, and nothing says that an article is in it")
    rng = random.Random(repr((wrapper, boundary)))
    for _ in range(60):
        page = made(rng, wrapper, boundary)
        assert htmltext.main_text(page) == told(page)


def said(n=4):
    return [f"Sentence number {k}, with several words in it, and an end." for k in range(n)]


PROSE = "".join(f"<p>{s}</p>" for s in said())


def test_wrappers_and_what_stays_out():
    whole = "\n".join(said())
    comments = f"<article><p>{'I liked this, really. ' * 30}</p></article>"
    for page in (f"<form id=f><nav><a>x</a></nav><article>{PROSE}</article><select><option>o</option></select></form>", f"<form>{PROSE}</form>",
                 f"<article>{PROSE}<div class=comments>{comments}</div></article>", f"<nav><ul><li>x<article>{PROSE}</article>",
                 f"<article>{PROSE}</article><div class=comments>{comments}</div>", f"<header><article>{PROSE}</article></header>",
                 f"<div class='post comments-open'><article>{PROSE}</article></div>", f"<dialog open><main>{PROSE}</main></dialog>"):
        assert htmltext.main_text(page) == whole, page
    assert htmltext.main_text("<nav>menu</nav><footer>foot</footer>") == ""
    assert htmltext.main_text(f"<article><section class=legal>{PROSE}</section><p>End.</p></article>") == whole + "\nEnd."


def test_paragraphs_that_are_links_and_words_in_sentences():
    whole = "\n".join(said())
    assert htmltext.main_text(f"<article>{PROSE}<blockquote><p><a href=x>A link, whole.</a></p></blockquote></article>") == (
        whole + "\nA link, whole.")
    assert htmltext.main_text(f"<article><p>A <span class=legal>legal</span> word.</p>{PROSE}</article>") == "A legal word.\n" + whole


def test_lenient_attributes():
    for start in ('<p class="a>', "<p title=it's>", "<p title='it's>", '<p class="x"id="y">', "<p data-x='<b>k</b>'>", '<p a="b > c">', "<p =>"):
        assert htmltext.main_text(f'<article>{start}One, two.</p><p class="b">Three "four" five.</p></article>') == (
            'One, two.\nThree "four" five.'), start
    assert htmltext.main_text(f"<svg/>{PROSE}") == "\n".join(said())
    assert htmltext.main_text(f"<object>{PROSE}") == "\n".join(said())


def test_time_grows_with_the_page():
    n = 20000
    start = time.time()
    for page in ("<script " * n, "<div>" * n + "x", "<div class=menu>" * n + "x", '<p a="x' * n, "<p a='\">" * n, "<div>" * n + "</b>x" * n,
                 "<div>" * n + "<li>x</li>" * n, "<object>x" * n, "<" * n, "<!--" * n, "<p " + "=" * n, "<p>x</p>" * n):
        htmltext.main_text(page)
    assert time.time() - start < 60  # one quadratic reader among them took minutes


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmltext.extract(empty, ["page_id", "url"]).collect() == []
