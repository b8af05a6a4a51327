"""Main text of web pages by two-pass block rules.

Pass 1 gives each block of text a class from its length, link density and stop-word density, with the
page's own structure as evidence (menus, footers, forms and the like are decided as bad; blocks of an
article element lean to good). Pass 2 settles short and nearly good blocks by their nearest decided
neighbours. A page is parsed by a small scanner that never fails on broken markup.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, table

#: Fixed values of the block rules.
SHORT, LONG = 70, 200
LINK_DENSITY, STOP_LOW, STOP_HIGH = 0.3, 0.2, 0.3
#: Stop-word density of a page below which its language is taken to be none of the lists'.
FOREIGN = 0.05

#: Frequent words of four languages.
STOP_WORDS = frozenset(
    "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know "
    "der die das und ist nicht mit ein eine sich auch auf für dem den des von zu im als aus bei nach wird sind war oder wie wenn noch nur über "
    "le la les de des et un une est que qui dans pour pas sur au aux avec ce il elle sont plus par ne se mais ou son ses "
    "el los las del y en es por con para una no su se lo como más pero sus al este ya".split()
)

RAW = {"script", "style", "textarea", "template", "noscript", "svg", "annotation", "annotation-xml", "iframe", "object", "canvas", "select", "xmp"}
BAD = {"head", "title", "nav", "footer", "aside", "form", "menu", "button", "dialog", "audio", "video", "label", "fieldset", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "keygen"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr", "ruby", "rt", "rp"} | {
    "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "mover", "munder", "munderover", "mtable", "mtr", "mtd", "mstyle", "mspace", "mpadded", "mphantom", "semantics"
}
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar", "form"}
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs header footer masthead topbar "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments commentlist reply replies disqus respond "
    "related recommended recommendations trending pagination pager widget toolbar search skip form disclaimer legal hidden".split()
)

#: Of these, words that an article can also have for its own parts: there they condemn link-heavy parts only.
SOFT_NAMES = frozenset("legal disclaimer related recommended recommendations social share sharing trending hidden".split())
#: Elements without text of the page that need not be closed: an unclosed one ends at its own tag.
OPEN_ENDED = {"svg", "select", "object", "iframe", "canvas", "noscript", "template", "annotation", "annotation-xml"}

#: Words of a class or id that only say where, how or in which order a part stands: before and behind the name.
BEFORE = frozenset("site page main primary secondary global top bottom left right inner outer post user reader".split())
BEHIND = frozenset("list item items area box wrapper wrap container section block panel inner outer links slot unit bar left right top bottom group thread body content text".split())
#: What a class says of the parts of its element, not of the element.
STATES = frozenset("has with no without".split())
CARDS = frozenset("teaser teasers card cards preview tile snippet".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
GOOD, BY_TAG, BY_NAME, WEAK = range(4)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*|[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")


class Weak:
    """An element with a bad word in a longer name, and the innermost such element around it."""

    __slots__ = ("around", "text", "links", "heavy", "small")

    def __init__(self, around: "Weak | None"):
        self.around, self.text, self.links, self.heavy, self.small = around, 0, 0, False, False


class Block:
    __slots__ = ("parts", "links", "bad", "article", "region", "label", "weak")

    def __init__(self, bad, article, region, weak=None):
        self.parts, self.links, self.bad, self.article, self.region, self.label, self.weak = [], 0, bad, article, region, "", weak

    @property
    def text(self) -> str:
        return _SPACE.sub(" ", html_lib.unescape("".join(self.parts))).strip()


def _name(value: str, bad: frozenset) -> int:
    """BY_NAME if a whole class or id name says bad, WEAK if only a part of one does."""
    found = GOOD
    for name in value.split():
        parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
        if not bad.intersection(parts) or parts[0] in STATES:
            continue
        i, j = 0, len(parts)
        while i < j and parts[i] in BEFORE:
            i += 1
        while i < j and (parts[j - 1] in BEHIND or parts[j - 1].isdigit()):
            j -= 1
        if i < j and bad.issuperset(parts[i:j]):
            return BY_NAME
        found = WEAK
    return found


def _judged(tag: str, attrs: str, article: bool) -> int:
    """What an element's tag and attributes say of all its text."""
    if tag in BAD or (tag == "header" and not article):
        return BY_TAG
    if not attrs or tag in ("html", "body", "main") or tag in INLINE:
        return GOOD
    found = GOOD
    for name, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        name = name.lower()
        if name == "hidden":
            return BY_NAME
        if name == "role" and value in BAD_ROLES or name == "aria-hidden" and value == "true":
            return BY_NAME
        if name in ("class", "id"):
            kind = _name(value, BAD_NAMES - SOFT_NAMES if article else BAD_NAMES)
            if kind == BY_NAME:
                return kind
            if article and _name(value, SOFT_NAMES):
                found = WEAK
            if kind == WEAK and tag not in HEADINGS or tag == "article" and _name(value, CARDS):
                found = WEAK
        if name == "style" and "display:none" in value.replace(" ", ""):
            return BY_NAME
    return found


def blocks(page: str) -> tuple[list[Block], list[Weak]]:
    """Blocks of text in page order, with what their surroundings say of them, and all weak elements, outer ones first.

    A closing tag without an open element is passed over, so the scan takes time in proportion to the page.
    """
    stack: list[tuple[str, int, bool, Weak | None]] = []  # tag, why bad, inside an article, weakly bad element around
    opened: Counter[str] = Counter()  # elements of the stack by tag
    found: list[Block] = []
    weaks: list[Weak] = []
    now: Block | None = None
    at, links, region = 0, -1, 0  # links: open elements around an open link, else -1

    def close() -> str:
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    def add(text: str) -> None:
        nonlocal now
        bad, article, weak = stack[-1][1:] if stack else (GOOD, False, None)
        if now is None:
            now = Block(bad != GOOD, article, region, weak)
            found.append(now)
        now.parts.append(text)
        if links >= 0:
            now.links += len(text.strip())

    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            add(text)
        if not m:
            break
        at, tag = m.end(), (m.group(2) or "").lower()
        if not tag:
            if m.group().startswith("<![CDATA["):
                add(html_lib.escape(m.group()[9:].removesuffix("]]>")))
            continue
        closing = bool(m.group(1))
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else at if tag in OPEN_ENDED else len(page)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                add(" ")
            continue
        if tag == "a":
            links = -1 if closing else max(len(stack), 1)
        if tag in INLINE:
            continue  # no element of the stack; markup inside a block
        now = None
        if closing:
            while opened[tag] and close() != tag:
                pass
            if len(stack) < links:  # an unclosed link ends with the element that it stands in
                links = -1
        else:
            for group in ({"p"}, {"li"}, {"td", "th"}, {"tr"}, {"dt", "dd"}, {"option"}):
                if tag in group or (group == {"p"} and tag not in INLINE):
                    while stack and stack[-1][0] in group:
                        close()
            if len(stack) < links:
                links = -1
            bad, article, weak = stack[-1][1:] if stack else (GOOD, False, None)
            if tag in ("article", "main") or tag == "body":  # ends whatever was left open before
                if tag == "body" or not article and not opened["aside"]:
                    if tag != "article" or bad == BY_TAG:  # an article in a list of comments is a comment
                        bad, weak = GOOD, weak if tag == "article" else None
                article = tag != "body"
            own = _judged(tag, m.group(3) or "", article)
            if own == WEAK:
                weak = Weak(weak)
                weaks.append(weak)
            opened[tag] += 1
            stack.append((tag, max(bad, own if own != WEAK else GOOD), article, weak))
        if tag in BAD or tag in ("article", "main", "header", "section", "div"):
            region += 1
    return found, weaks


def _condemn(kept: list[tuple[Block, str]], weaks: list[Weak]) -> None:
    """Elements with a bad word in a longer name are bad if link-heavy or, outside articles, small."""
    for b, t in kept:
        if b.weak:
            b.weak.text += len(t)
            b.weak.links += b.links
    for w in reversed(weaks):  # inner ones first
        if w.around:
            w.around.text += w.text
            w.around.links += w.links
    for w in weaks:
        w.heavy = w.links > LINK_DENSITY * w.text or w.around is not None and w.around.heavy
        w.small = w.text < LONG or w.around is not None and w.around.small
    for b, _ in kept:
        b.bad = b.bad or b.weak is not None and (b.weak.heavy or b.weak.small and not b.article)


def _unlisted(text: str) -> bool:
    """Whether most letters are of no script that the stop words are written in."""
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c > "\u024f" for c in letters) > len(letters)


def _stops(kept: list[tuple[Block, str]]) -> list[float]:
    """Stop-word density of the blocks that it decides, else 0.

    Words of other languages hit the lists hardly anywhere. There the density says nothing and counts as high,
    so that length and link density decide: for blocks in another script, and for pages whose running text has a density
    below ``FOREIGN``.
    """
    out, hits, words = [], 0, 0
    for b, t in kept:
        if b.bad or b.links > LINK_DENSITY * len(t) or len(t) < SHORT:
            out.append(0.0)
            continue
        ws = _WORD.findall(t.lower())
        stop = sum(w in STOP_WORDS for w in ws)
        if _unlisted(t):
            out.append(1.0)
        else:
            hits, words = hits + stop, words + len(ws)
            out.append(stop / max(len(ws), 1))
    return out if hits >= FOREIGN * words else [1.0] * len(out)


def _nearest(marks: list[bool]) -> tuple[list, list]:
    """For each place the nearest mark before it and behind it, or None."""
    before, behind, last = [], [], None
    for i, mark in enumerate(marks):
        before.append(last)
        last = i if mark else last
    last = None
    for i in range(len(marks) - 1, -1, -1):
        behind.append(last)
        last = i if marks[i] else last
    return before, behind[::-1]


def _label(kept: list[tuple[Block, str]]) -> None:
    """Both passes."""
    for (b, t), stop in zip(kept, _stops(kept)):
        density = b.links / max(len(t), 1)
        if b.bad:
            b.label = "bad"
        elif density > LINK_DENSITY:
            b.label = "bad"
        elif len(t) < SHORT:
            b.label = "short" if b.links == 0 or b.article else "bad"
        else:
            if b.article:  # an article's lists, tables and code have few stop words
                b.label = "good" if stop >= STOP_LOW else "near"
            else:
                b.label = ("good" if len(t) >= LONG else "near") if stop >= STOP_HIGH else "near" if stop >= STOP_LOW else "bad"
    has_article = any(b.article for b, _ in kept)
    labels = [b.label for b, _ in kept]
    # Nearest decided blocks before and behind each block, of all and of the articles' own running text.
    settled = [x in ("good", "bad") for x in labels]
    own = [s and b.article and not b.bad for s, (b, _) in zip(settled, kept)]
    around = {True: _nearest(own), False: _nearest(settled)}
    for i, (b, _) in enumerate(kept):
        if settled[i]:
            continue
        # Inside an article only its own running text is a neighbour; menus, forms and the like say nothing.
        left, right = (side[i] for side in around[b.article])
        sides = [(abs(j - i), labels[j]) for j in (left, right) if j is not None]
        if not sides:
            b.label = "good" if b.article or labels[i] == "near" and not has_article else "bad"
        elif len({x for _, x in sides}) == 1:
            b.label = sides[0][1]
        elif labels[i] == "near" or b.article:
            b.label = "good"
        else:
            b.label = min(sides, key=lambda s: (s[0], s[1] != "good"))[1]


def classify(found: list[Block], weaks: list[Weak] = ()) -> list[Block]:
    """The blocks with text, their label 'good' or 'bad'.

    A page whose articles hold most of its good text has its main text there. Articles that do not, such as
    comments and teasers, count as any other text.
    """
    kept = [(b, b.text) for b in found]
    kept = [(b, t) for b, t in kept if t]
    _condemn(kept, weaks)
    _label(kept)
    if any(b.article for b, _ in kept):
        inside = sum(len(t) for b, t in kept if b.label == "good" and b.article)
        outside = sum(len(t) for b, t in kept if b.label == "good" and not b.article)
        if inside > outside:
            for b, _ in kept:
                if not b.article:
                    b.label = "bad"
        else:
            for b, _ in kept:
                b.article = False
            _label(kept)
    return [b for b, _ in kept]


def main_text(page: str | None) -> str:
    """The page's main text: good blocks in page order, joined by one space; empty if none."""
    return " ".join(b.text for b in classify(*blocks(page or "")) if b.label == "good")


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def extract_text(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` with ``text``, the main text of each page, and ``n_chars``, its code points (long).

    Null, empty and white pages, and pages without main text, give the empty text; very long ones are read whole, in
    time in proportion to their length. Every row is kept, repeated ones too; an empty table stays empty. Columns of ``df`` with a result
    column's name are kept with an underscore in front.
    """
    for name in ("text", "n_chars"):
        if clash := [c for c in df.columns if c.lower() == name and c != html]:
            df = df.withColumnRenamed(clash[0], free_name(df, name))
    return df.withColumn("text", _main_text(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
