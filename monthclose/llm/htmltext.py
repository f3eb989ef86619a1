"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each with the path of block elements from the root to it. All blocks of one path belong
together: per path the length of the text outside links and the punctuation are divided by the number of blocks. The two ratios are
smoothed over the sequence of blocks, fused, and compared with a threshold that the page itself gives. If article and main elements
hold most of that text, the paths in them are measured against each other and the others left out. A paragraph inside them counts
whole, links or not.

Some elements are in doubt: by their name (menus, footers, asides), because they are hidden, or by a word of their class, id or role
(comments, notices and so on), forms too. They are left out with all they hold, but not if they wrap most of the text of article and
main elements (all of it, where the word is one for comments). Forms and elements in doubt by a word also stay if they hold most of
the page's text, and no article or main stands outside of them, or they lie in it themselves; and if nothing else is left.

Tags are read leniently: a quote opens a value only after an equals sign, and a value whose closing quote stands in the middle of a
word has none. Reading takes time in proportion to the page.

Defined results: NULL or empty html gives an empty text. Unclosed elements end with their parent, a paragraph ends where the next
block begins, unfinished tags at the end of the page are ignored; a script, style, frame or text field that does not end takes the
rest of the page. Equal pages give equal texts.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from monthclose.llm.common import small_batches

#: Weight of punctuation against text length, and the share of the page's mean that a path must reach.
PUNCTUATION_WEIGHT, SHARE = 0.4, 0.12
#: The share of the page's text outside links that counts as most of it.
MOST = 0.5

# Element names by what they mean for the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre section summary table tbody td tfoot "
    "th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = frozenset("head title noscript select button option label legend textarea".split())
BESIDE = frozenset("nav aside footer menu dialog".split())
FORMS = frozenset("form fieldset".split())
# Elements whose contents are no markup of the page; the first four end nowhere if they are not closed.
RAW_TEXT = frozenset("script style iframe textarea".split())
RAW = RAW_TEXT | frozenset("template svg object canvas select".split())
CLOSES_PARAGRAPH = BLOCKS - {"body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open one of the same family.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
# Words of classes, ids and roles that name what is no article.
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer header masthead topbar comment comments reply replies respond disqus "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup login form search "
    "share sharing social related recommended widget toolbar pagination pager skip complementary contentinfo "
    "dialog legal copyright tagcloud tags meta byline hidden".split())
COMMENTS = frozenset("comment comments reply replies respond disqus".split())

_TOKEN = re.compile(
    r"[^<]+"
    r"|<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>=]++|=\s*+(?:\"[^\"]*+\"(?=[\s/>]|\Z)|'[^']*+'(?=[\s/>]|\Z))?+)*+)(>?)"
    r"|<", re.S)
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
_LABEL = re.compile(r"\b(class|id|role|aria-hidden|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HAS_LABEL = re.compile(r"class|id|role|hidden|style", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


#: Why an element is in doubt: a word, a form, a word for comments, its name or because it is hidden. NEVER is text of no kind.
WORD, FORM, COMMENT, ASIDE, NEVER = 1, 2, 3, 4, 5


def _doubt(name: str, attributes: str) -> int:
    """What speaks against an element, 0 if nothing does."""
    if name in NOT_TEXT:
        return NEVER
    kind = ASIDE if name in BESIDE else FORM if name in FORMS else 0
    if kind == ASIDE or not _HAS_LABEL.search(attributes) or name in ("html", "body"):
        return kind
    for key, *values in _LABEL.findall(attributes):
        value, key = "".join(values), key.lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return ASIDE
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return ASIDE
        else:
            said = NOT_ARTICLE & set(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
            if said:
                kind = max(kind, COMMENT if said & COMMENTS else WORD)
    return kind


class Block(NamedTuple):
    """A stretch of text: the numbers of its path and of the innermost element in doubt around it (0: none), the length outside links,
    whether it is inside an article or main element and the number of the innermost element in doubt around that one, and whether
    it is no text for good."""

    path: int
    text: str
    plain: int
    inside: bool
    base: int
    doubt: int
    never: bool


class Doubt(NamedTuple):
    """An element in doubt: the number of the next one around it, why, whether it lies in an article or main element, and whether it is
    a main element itself."""

    above: int
    kind: int
    inside: bool
    main: bool


class Page:
    """The blocks of a page in order, its elements in doubt, and its paths as (number of the parent path, name). Number 0 is the root."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        self.doubts = [Doubt(0, 0, False, False)]
        self.paths: list[tuple[int, str]] = [(0, "")]
        self._numbers: dict[tuple[int, str], int] = {}
        self._stack: list[tuple[str, Block]] = [("", Block(0, "", 0, False, 0, 0, False))]
        self._open: Counter[str] = Counter()
        self._parts: list[str] = []
        self._outside: list[str] = []
        self._read(page)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            whole = len(self._outside) == len(self._parts)
            plain = len(text) if whole else len(" ".join(html.unescape("".join(self._outside)).split()))
            self._parts.clear()
            self._outside.clear()
            if text:
                name, place = self._stack[-1]
                self.blocks.append(place._replace(text=text, plain=len(text) if place.inside and name == "p" else plain))

    def _close(self, names: frozenset | set, until: frozenset | set = frozenset()) -> None:
        """Close the innermost element of ``names``, if none of ``until`` is open inside it. What is looked at is closed, mostly."""
        if not any(self._open[name] for name in names):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] in names:
                self._flush()
                self._open.subtract(name for name, _ in self._stack[k:])
                del self._stack[k:]
                return
            if self._stack[k][0] in until:
                return

    def _enter(self, name: str, kind: int) -> None:
        _, around = self._stack[-1]
        path = self._numbers.setdefault((around.path, name), len(self.paths))
        if path == len(self.paths):
            self.paths.append((around.path, name))
        # A header inside the article holds its title; one outside is a page header.
        kind = ASIDE if name == "header" and not around.inside and kind < ASIDE else kind
        article = name in ("article", "main")
        doubt = around.doubt
        if 0 < kind < NEVER:
            self.doubts.append(Doubt(doubt, kind, around.inside, name == "main"))
            doubt = len(self.doubts) - 1
        self._open[name] += 1
        self._stack.append((name, Block(
            path, "", 0, around.inside or article, (around.doubt if kind else doubt) if article else around.base, doubt,
            around.never or kind == NEVER)))

    def _read(self, page: str) -> None:
        at, in_link, endless = 0, False, set()
        while at < len(page):
            token = _TOKEN.match(page, at)
            at = token.end()
            slash, name, attributes, finished = token.groups()
            if not name:
                if not token[0].startswith(("<!", "<?")):
                    self._parts.append(token[0])
                    if not in_link:
                        self._outside.append(token[0])
                continue
            name = name.lower()
            if name in RAW and not slash:
                if finished and not (name == "svg" and attributes.endswith("/")) and name not in endless:
                    end = _END[name].search(page, at)
                    if end or name in RAW_TEXT:
                        at = end.end() if end else len(page)
                    else:
                        endless.add(name)
                continue
            if name == "a" or slash and name in BLOCKS:  # a link that is not closed ends with its block
                in_link = not slash
            if name == "br" or name not in BLOCKS and name in VOID:
                self._parts.append(" " if name == "br" else "")
                self._outside.append(self._parts[-1])
            elif slash:
                if name in BLOCKS or self._open[name]:
                    self._flush()
                    self._close({name}, frozenset() if name in BLOCKS else BLOCKS)
            else:
                kind = _doubt(name, attributes)
                own, around = self._stack[-1]
                if name not in BLOCKS and around.inside and (own == "p" or own in HEADINGS) and kind in (WORD, COMMENT):
                    kind = 0  # words of a sentence
                if not (kind or name in BLOCKS or name in SIBLINGS):
                    continue
                self._flush()
                if name in CLOSES_PARAGRAPH:
                    self._close({"p"}, BLOCKS - {"p"})
                if name in HEADINGS:
                    self._close(HEADINGS, BLOCKS - HEADINGS)
                if name in SIBLINGS:
                    self._close(SIBLINGS[name], frozenset({"ul", "ol", "dl", "table", "select", "menu"}))
                if name not in VOID:
                    self._enter(name, kind)
        self._flush()

    def _upwards(self, amounts: list[float]) -> list[float]:
        """What each element in doubt holds, with those inside it; an element's number is higher than that of one around it."""
        for k in range(len(amounts) - 1, 0, -1):
            amounts[self.doubts[k].above] += amounts[k]
        return amounts

    def _any_around(self, marks: list[bool]) -> list[bool]:
        """For each element in doubt, whether it or one around it is marked."""
        found = [False] * len(marks)
        for k in range(1, len(marks)):
            found[k] = marks[k] or found[self.doubts[k].above]
        return found

    def allowed(self) -> np.ndarray:
        """Block by block, whether nothing speaks against it but ratios."""
        none = [0.0] * len(self.doubts)
        size, wrapped, mains = none[:], none[:], [float(d.main) for d in self.doubts]
        in_articles = 0.0
        for block in self.blocks:
            length = 0 if block.never else block.plain
            size[block.doubt] += length
            if block.inside:
                in_articles += length
                wrapped[block.base] += length
        size, wrapped, mains = self._upwards(size), self._upwards(wrapped), self._upwards(mains)
        most = MOST * size[0]
        # A page has one main element, whatever its class says.
        wraps = [mains[k] > 0 or wrapped[k] > 0 and wrapped[k] >= (1 if d.kind == COMMENT else MOST) * in_articles
                 for k, d in enumerate(self.doubts)]
        beside_wraps = self._any_around([not w for w in wraps])
        marked = any(b.inside and b.plain and not b.never and not beside_wraps[b.doubt] for b in self.blocks)
        by_name = self._any_around([d.kind == ASIDE and not wraps[k] for k, d in enumerate(self.doubts)])
        by_word = self._any_around([
            0 < d.kind < ASIDE and not wraps[k] and (size[k] <= most or marked and (not d.inside or d.kind == COMMENT))
            for k, d in enumerate(self.doubts)])
        stays = [not (b.never or by_name[b.doubt]) for b in self.blocks]
        able = np.array([ok and not by_word[b.doubt] for ok, b in zip(stays, self.blocks, strict=True)], bool)
        return able if able.any() else np.array(stays, bool)


def main_text(html_text: str | None) -> str:
    """The chosen blocks of a page, one a line."""
    page = Page(html_text or "")
    found, able = page.blocks, page.allowed()
    if not able.any():
        return ""
    lengths = np.array([0 if b.never else b.plain for b in found], float)
    here = able & np.array([b.inside for b in found], bool)
    if here.any() and lengths[here].sum() >= MOST * lengths[able].sum():
        able = here
    groups: dict[int, list[int]] = {}
    for k, block in enumerate(found):
        if able[k]:
            groups.setdefault(block.path, []).append(k)
    text, marks = np.zeros(len(found)), np.zeros(len(found))
    for rows in groups.values():
        text[rows] = sum(found[k].plain for k in rows) / len(rows)
        marks[rows] = sum(len(_PUNCTUATION.findall(found[k].text)) for k in rows) / len(rows)
    ratios = []
    for values in (text, marks):
        padded = np.pad(np.log1p(values), 1, mode="edge")
        smooth = 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]
        ratios.append(smooth / max(smooth[able].mean(), 1e-9))
    fused = (1 - PUNCTUATION_WEIGHT) * ratios[0] + PUNCTUATION_WEIGHT * ratios[1]
    # The decision is one per path, so that a short paragraph goes with the long ones of its path. A heading with a kept path
    # beside it needs no threshold.
    keep = {path for path, rows in groups.items()
            if text[rows[0]] > 0 and float(np.mean(fused[rows])) >= SHARE + 0.5 * float(fused[able].mean())} or set(groups)
    parents = {page.paths[path][0] for path in keep}
    return "\n".join(
        block.text for k, block in enumerate(found)
        if able[k] and (block.path in keep or page.paths[block.path][1] in HEADINGS and page.paths[block.path][0] in parents))


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep`` with ``text`` and ``n_chars`` (code points) of every page."""
    small_batches(pages.sparkSession)
    schema = pages.select(*keep).schema.simpleString()[7:-1] + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*keep, html_col).mapInArrow(run, schema)
