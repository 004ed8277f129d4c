"""Main text of web pages: flat text blocks, described by words and link density of themselves and their neighbours,
classified by a decision tree that is trained on a small labelled table."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadlake.llm import common

RAW = r"<(script|style|title|textarea|iframe|noscript)(?=[\s/>])"
CONTAINERS = "svg select object canvas audio video template annotation".split()
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|" + RAW + r".*?(?:</\1\s*>|\Z)"
    # quotes count only after an equals sign; one that is never closed counts as any character
    r"|<(/?)([a-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-z](?P<broken>)",
    re.I | re.S,
)
#: The same after a tag whose quotes run on to the end of the page: there a tag ends with its first ">".
LENIENT = re.compile(r"<!--.*?(?:-->|\Z)|" + RAW + r".*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z(?P<broken>)", re.I | re.S)
ENDS = {x: re.compile(rf"</{x}\s*>", re.I) for x in CONTAINERS}


def tokens(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of the markup of a page, from left to right; no tag for what is no element. Each
    part of the page is looked at a fixed number of times: what an unclosed element would be searched for is remembered."""
    pattern, at, ends = TOKEN, 0, dict.fromkeys(CONTAINERS, -1)
    while m := pattern.search(source, at):
        if m["broken"] is not None and pattern is TOKEN:
            pattern, at = LENIENT, m.start()
            continue
        end, tag = m.end(), (m[3] or "").lower()
        if tag in ends and not m[2] and not m[4].endswith("/"):
            if -1 < ends[tag] < end or ends[tag] == -1:
                ends[tag] = close.end() if (close := ENDS[tag].search(source, end)) else len(source) + 1
            if ends[tag] <= len(source):  # with all that it holds
                end, tag = ends[tag], ""
        yield m.start(), end, m[2] or "", tag, m[4] or ""
        at = end


INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr ruby rt rp"
    " math semantics mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace mpadded mphantom".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open tag of these ends an open one of the same group.
ALONE = {"p": "p", "li": "li", "dt": "d", "dd": "d", "tr": "tr", "td": "t", "th": "t", "option": "option", **{f"h{k}": "h" for k in range(1, 7)}}
#: What text lies in: 2 headings, 1 paragraphs, list items and cells, 0 anything else.
KINDS = {**dict.fromkeys("p li dt dd blockquote pre td th caption figcaption summary".split(), 1), **{f"h{k}": 2 for k in range(1, 7)}}
SIDE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side rail nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar"
    " footer cookie cookies consent gdpr notice notices alert popup modal overlay comment comments commentlist reply replies respond discussion disqus share sharing social related recommended recommendations"
    " opinions feedback newsletter subscribe subscription signup login search pagination pager copyright legal widget toolbar skip cookiebar cookieconsent cookiebanner adsbygoogle adslot adbox".split()
)
#: Words that may stand beside those in a class or id; any other says that the name is about something else.
PLAIN_WORDS = frozenset(
    "left right top bottom upper lower inner outer first last main primary secondary global site page web box bar list item items block section area zone region container wrapper wrap content body text link links button buttons"
    " icon icons panel group row col column unit slot place holder placeholder form field input label title heading thread user post posts article articles story stories entry media small large mobile desktop fixed sticky"
    " reader readers visitor visitors user users community latest recent more all new your our the and for of in to by on with policy law info message messages count form respond ol ul div id class".split()
)
#: Words without a letter or digit, such as bars between links.
SIGNS = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "kind", "side", "place", "density", "run", "share"]


def named_side(names: str) -> bool:
    """Whether a class or id is made of side words and plain ones; the header of a post is none."""
    for name in names.split():
        parts = [x.lower() for x in WORD.findall(name)]
        side = {x for x in parts if x in SIDE_WORDS}
        if side and all(x in SIDE_WORDS or x in PLAIN_WORDS or x.isdigit() or len(x) < 3 for x in parts):
            if side != {"header"} or not {"post", "entry", "article", "story"} & set(parts):
                return True
    return False


def is_side(tag: str, attributes: str, inside: bool = False) -> bool:
    """Whether an element is marked as something else than article text, by its tag, role, class or id, or is hidden.
    ``inside``: within an article, whose header holds its headline."""
    if tag in SIDE_TAGS:
        return not (inside and tag == "header")
    if not attributes or attributes.isspace() or tag in ("html", "body", "main"):
        return False
    found = {name.lower(): value.strip("\"'") for name, value in ATTRIBUTE.findall(attributes)}
    style = found.get("style", "").replace(" ", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return True
    names = f"{found.get('class', '')} {found.get('id', '')}"
    if tag == "article":
        return bool({"comment", "comments", "reply"} & {x.lower() for x in WORD.findall(names)})
    return found.get("role", "").lower() in SIDE_ROLES or named_side(names)


@dataclass
class Element:
    """An element between blocks: its place in the page's list of elements is above that of what it lies in."""

    tag: str
    parent: int
    side: bool
    article: bool
    muted: bool = False


@dataclass
class Block:
    """A run of text between block tags; ``inside``: the element that it lies in."""

    text: str
    words: int
    links: float
    kind: int
    inside: int


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, False, False)])


def blocks_of(source: str) -> Page:
    """Cuts a page, whole or broken off, into its text blocks in order. White space is one space, references decoded.
    Inline elements that are marked as something else or hidden are left out of the block around them."""
    page, stack, parts = Page(), [0], []
    linked, in_link, at, muted, articles = 0, False, 0, 0, 0
    elements, open_ = page.elements, Counter()

    def take(piece: str) -> None:
        nonlocal linked
        if not muted:
            parts.append(piece)
            if in_link:
                linked += len(piece.split()) - len(SIGNS.findall(piece))

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            n, within = len(text.split()), next(e for e in reversed(stack) if elements[e].tag not in INLINE)
            spoken = n - len(SIGNS.findall(text))
            page.blocks.append(Block(text, n, min(1.0, linked / spoken) if spoken else 0.0, KINDS.get(elements[within].tag, 0), within))
        parts.clear()
        linked = 0

    def push(tag: str, side: bool, article: bool, mute: bool) -> None:
        nonlocal muted, articles
        elements.append(Element(tag, stack[-1], side, article, mute))
        stack.append(len(elements) - 1)
        open_[tag] += 1
        muted, articles = muted + mute, articles + article

    def pop(k: int) -> None:
        nonlocal muted, articles
        for e in stack[k:]:
            muted, articles = muted - elements[e].muted, articles - elements[e].article
            open_[elements[e].tag] -= 1
        del stack[k:]

    def last(tag: str) -> int | None:
        """The place of the innermost open ``tag``; what lies above it is closed with it."""
        return None if not open_[tag] else next((k for k in range(len(stack) - 1, 0, -1) if elements[stack[k]].tag == tag), None)

    for start, end, slash, tag, attributes in tokens(source):
        if start > at:
            take(source[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            take(" ")
        elif tag in INLINE:
            if tag == "a":
                in_link = not slash
            if slash:
                if muted and (k := last(tag)) is not None:
                    pop(k)
            elif tag not in VOID and not attributes.endswith("/"):
                # within what is left out, inline elements are counted, so that its end is found
                mute = bool(attributes) and is_side(tag, attributes)
                if muted or mute:
                    push(tag, mute, False, mute)
        elif slash:
            flush()
            if (k := last(tag)) is not None:
                pop(k)
            in_link = False
        else:
            flush()
            in_link = False
            while elements[stack[-1]].tag in INLINE and tag in ALONE:
                pop(len(stack) - 1)  # what is left out ends with its paragraph
            top, group = elements[stack[-1]].tag, ALONE.get(tag)
            if (group and ALONE.get(top) == group) or top == "p":
                pop(len(stack) - 1)
            if tag not in VOID and not attributes.endswith("/"):
                side = is_side(tag, attributes, articles > 0)
                push(tag, side, not side and (tag in ("article", "main") or "role" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes) is not None), False)
    if at < len(source):
        take(source[at:])
    flush()
    return page


def features(page: Page) -> np.ndarray:
    """FEATURES of every block. density: words to a line of 80 characters. run: words outside links of the block and of those
    next to it, as far as they hold more text than links. share: of the page's words. side: within an element that is marked as something else, unless the mark lies around an
    article, or is a form around over half of the page's words. place: 1 within the innermost article or main element
    that holds at least half of the page's words outside links and marks, -1 outside of it, 0 on a page without one."""
    if not page.blocks:
        return np.zeros((0, len(FEATURES)))
    own = np.array([(b.words, b.links) for b in page.blocks], float)
    inside = [b.inside for b in page.blocks]
    parents = [e.parent for e in page.elements]

    def held(amount: np.ndarray) -> np.ndarray:
        out = np.bincount(inside, amount, len(parents))
        for k in range(len(parents) - 1, 0, -1):
            out[parents[k]] += out[k]
        return out

    around, words = [e.article for e in page.elements], held(own[:, 0])
    for k in range(len(parents) - 1, 0, -1):
        around[parents[k]] |= around[k]
    side = [False] * len(parents)
    for k, e in enumerate(page.elements[1:], 1):
        side[k] = side[e.parent] or (e.side and not around[k] and not (e.tag == "form" and 2 * words[k] > words[0]))
    prose = held(own[:, 0] * (1 - own[:, 1]) * ~np.array(side)[inside])
    article = max((k for k, e in enumerate(page.elements) if e.article and 2 * prose[k] >= prose[0] > 0), default=0)
    place = [0] * len(parents)
    for k in range(len(parents)) if article else ():
        place[k] = 1 if k == article or (k and place[parents[k]] == 1) else -1
    edge = np.zeros((1, 2))
    before, after = np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge])
    marked, placed = np.array(side)[inside], np.array(place)[inside]
    text, prose = own[:, 0] * (1 - own[:, 1]), own[:, 1] < 0.5
    density = own[:, 0] / np.ceil(np.array([len(b.text) for b in page.blocks]) / 80)
    run = text + runs(text, prose) + runs(text[::-1], prose[::-1])[::-1]
    return np.column_stack([own, before, after, [b.kind for b in page.blocks], marked, placed, density, run, own[:, 0] / own[:, 0].sum()])


def runs(text: np.ndarray, prose: np.ndarray) -> np.ndarray:
    """For each block the words of the prose that ends just before it."""
    out, words = np.zeros(len(text)), 0.0
    for k in range(1, len(text)):
        words = words + text[k - 1] if prose[k - 1] else 0.0
        out[k] = words
    return out


#: The labelled table: pages of many layouts, one a line. {n} stands for about n words of article text, {-n} for n words of
#: anything else. Each page is filled in several times, with other words and lengths.
LABELLED = """
<header><a href=/>{-1}</a></header><nav><ul><li><a href=a>{-1}</a><li><a href=b>{-2}</a></ul></nav><article><h1>{9}</h1><p>{60}</p><p>{35}</p><p>{6}</p></article><nav><a href=h>{-2}</a></nav><footer>{-9}</footer>
<nav><a href=a>{-1}</a> <a href=b>{-1}</a></nav><div class=ad>{-8}</div><article><h1>{11}</h1><p><b>{12}</b> {90}<br><p>{120}</p><p>{75}</p></article><footer>{-3} {-12}</footer>
<article><h1>{8}</h1><p>{40}</p><h2>{3}</h2><p><a href=q>{7}</a></p><p>{30}</p><p>{8}</p></article><nav><ul><li><a href=h>{-2}</a></ul></nav>
<article><h1>{7}</h1><p>{80}</p></article><aside class=related><ul><li><a href=o>{-5}</a></li><li><a href=o>{-6}</a></li></ul></aside><footer>{-6}</footer>
<main><h1>{6}</h1><p>{100}</p><p>{80}</p></main><nav><a href=h>{-1}</a><a href=g>{-2}</a></nav>
<article><h1>{8}</h1><div>{25}</div><div>{20}</div><div>{28}</div></article><footer>{-5}</footer>
<article><h1>{9}</h1><div>{4}</div><div>{12}</div><div>{3}</div><div>{45}</div><div>{16}</div></article><div>{-4}</div>
<article><h2><a href=t>{6}</a></h2><p>{70}</p><p>{20}</p></article><aside><a href=u>{-4}</a></aside>
<article><h2><a href=t>{5}</a></h2><div>{40}</div><div>{30}</div></article><section class=comments><h3>{-1}</h3><p>{-30}</p></section>
<div class=post><h1>{7}</h1><p>{55}</p><p>{48}</p></div><div class="reader-opinions"><h2>{-2}</h2><p>{-70}</p><p>{-30}</p></div>
<main><article><h1>{7}</h1><p>{44}</p><p>{36}</p></article><section class=comments><h2>{-1}</h2><p>{-40}</p><p>{-60}</p><p>{-8}</p></section></main>
<main><article><h1>{8}</h1><p>{30}</p><ul><li>{2}</li><li>{3}</li><li>{4}</li></ul><p>{28} <a href=x>{5}</a></p></article></main><aside><h3>{-2}</h3><p>{-22}</p></aside>
<article><h1>{6}</h1><p>{80}</p><p><a href=r>{6}</a></p><p>{52}</p></article><div>{-18}</div>
<article><h1>{6}</h1><table><tr><td>{1}</td><td>{2}</td></tr><tr><td>{3}</td><td>{1}</td></tr></table><p>{40}</p><pre>{20}</pre><blockquote>{18}</blockquote></article>
<div class=cookie-banner>{-14}</div><h1>{8}</h1><p>{33}</p><p>{41}</p><div id=comments><p>{-25}</p><p>{-55}</p><p>{-9}</p></div>
<ul class=menu><li><a href=a>{-1}</a><li><a href=b>{-2}</a></ul><div><div>{90}</div><div>{60}</div><div>{45}</div></div><div id=footer>{-8}</div>
<ul><li><a href=a>{-1}</a></li><li><a href=b>{-1}</a></li><li><a href=c>{-2}</a></li></ul><h1>{9}</h1><p>{60}</p><p>{85}</p><p>{3}</p><p>{40}</p><div>{-14}</div>
<ul><li><a href=a>{-1}</a></li><li><a href=b>{-2}</a></li></ul><h1>{7}</h1><p>{25}</p><p>{1}</p><p>{12}</p><p>{30}</p><div>{-10}</div>
<div><a href=a>{-1}</a> <a href=b>{-2}</a></div><div>{-6}</div><h1>{7}</h1><p>{40}</p><p>{1}</p><p>{30}</p><h3>{-2}</h3><p><a href=r>{-5}</a></p><p><a href=r>{-5}</a></p><div>{-8}</div>
<div><a href=a>{-1}</a> <a href=b>{-1}</a></div><div>{-1}</div><div>{-1}</div><h1>{8}</h1><p>{50}</p><p>{30}</p><div>{-2}</div><div>{-2}</div><div>{-1}</div>
<div>{-1}</div><ul><li><a href=a>{-1}</a><li><a href=b>{-1}</a></ul><h1>{5}</h1><p>{90}</p><div>{-2}</div><p>{70}</p><div>{-1}</div><div>{-12}</div>
<div>{-1}</div><h1>{9}</h1><div>{60}</div><div>{80}</div><div>{40}</div><div>{-2}</div><div>{-2}</div>
<div>{-2}</div><div><h1>{7}</h1><div>{30}</div><div>{22}</div><div>{45}</div></div><div>{-1}</div>
<div><a href=a>{-2}</a></div><div>{55}<br><br>{40}<br><br>{35}</div><div>{-9}</div>
<div><a href=a>{-2}</a><a href=b>{-1}</a></div><h2>{6}</h2><p>{45}</p><p>{62}</p><h2>{-2}</h2><ul><li><a href=r>{-8}</a></li><li><a href=r>{-7}</a></li></ul><div>{-10}</div>
<div class=page><div class=top><a href=a>{-2}</a></div><div class=text><h1>{8}</h1><p>{30} <a href=x>{3}</a> {25}</p><ul><li>{6}</li><li>{8}</li><li>{5}</li></ul><p>{30}</p></div><div>{-6}</div></div>
<form id=all><div><input></div><h1>{5}</h1><p>{60}</p><p>{72}</p><p>{48}</p></form><div>{-3}</div>
<h1>{4}</h1><p>{22}</p><p>{18}</p><p>{27}</p>
<h1>{7}</h1><p>{5}</p><p>{4}</p><p>{6}</p>
<p>{18}</p>
<p>{2}</p>
<p>{70}</p><p>{50}</p>
<div>{2}</div>
<div>{9}</div>
<div>{60}</div>
{40}
<ul><li>{3}</li><li>{2}</li><li>{4}</li><li>{6}</li></ul>
<ul><li><a href=a>{-6}</a></li><li><a href=b>{-7}</a></li><li><a href=c>{-5}</a></li></ul>
<div><a href=a>{-3}</a></div><div><a href=b>{-2}</a></div><div>{-12}</div>
<div role=navigation><a href=a>{-1}</a></div><div role=main><h1>{8}</h1><p>{50}</p><div>{24}</div><p>{9}</p></div><div role=contentinfo>{-7}</div>
<section><article><h1>{7}</h1><p>{64}</p></article><article class=comment><p>{-40}</p></article><article class=comment><p>{-15}</p></article></section>
<main><article><h1>{9}</h1><p>{75}</p><p>{60}</p></article><article class=teaser><h2><a href=o>{-5}</a></h2></article></main><footer><ul><li><a href=f>{-1}</a></ul></footer>
<article><header><h1>{8}</h1></header><p>{35}</p><figure><figcaption>{7}</figcaption></figure><p>{50}</p><div class=share>{-2}</div><div class=newsletter>{-15}</div></article><div>{-30}</div>
<article><h1>{8}</h1><p>{20}</p><p>{5}</p></article><div class=related><p>{-20}</p></div><div>{-25}</div><div>{-40}</div>
<div><h1>{6}</h1><div>{-2}</div><div>{35}</div><div>{50}</div><div><a href=p>{-1}</a> <a href=n>{-1}</a></div></div><div>{-3}</div><div>{-11}</div>
<h1>{8}</h1><div>{-3}</div><p>{60}</p><p>{45}</p><h2>{3}</h2><p>{50}</p><h2>{2}</h2><p>{38}</p><div>{-6}</div>
<table><tr><td><a href=a>{-1}</a></td><td><a href=b>{-1}</a></td></tr></table><table><tr><td><h1>{6}</h1><p>{50}</p><p>{66}</p></td></tr></table><div>{-5}</div>
<article><h1>{8}</h1><p>{30}</p><ol><li>{15}</li><li>{22}</li></ol><h3>{4}</h3><dl><dt>{1}</dt><dd>{9}</dd></dl><p>{12} <a href=x>{12}</a></p></article><aside>{-28}</aside>
<article><p>{45}</p><h2>{2}</h2><ul><li><a href=s>{-6}</a></li><li><a href=s>{-5}</a></li></ul></article><footer>{-4}</footer>
<h1>{7}</h1><p>{60}</p><p>{40}</p><div><a href=n>{-2}</a></div>
<h1>{7}</h1><p>{60}</p><p>{6}</p><ul><li><a href=n>{-3}</a></li><li><a href=n>{-3}</a></li></ul>
<div><p>{45}</p><p>{30}</p><p>{9}</p></div><div><a href=n>{-2}</a> <a href=n>{-2}</a></div>
<p>{50}</p><p>{12}</p><p><a href=r>{-6}</a></p><p><a href=r>{-5}</a></p>
<div>{60}</div><div>{45}</div><div>{30}</div><div><a href=n>{-3}</a></div>
<h1>{5}</h1><div>{40}</div><p>{22}</p><nav><a href=n>{-2}</a></nav>
<article><h1>{7}</h1><p>{60}</p></article><p>{-18}</p><h3>{-3}</h3><p>{-40}</p>
<p>{-7}</p><article><h1>{9}</h1><p>{30}</p><p>{30}</p></article><ul><li>{-4}</li><li>{-6}</li></ul>
<h3>{-2}</h3><p>{-25}</p><main><h1>{6}</h1><p>{70}</p><p>{2}</p><div>{35}</div></main><p>{-9}</p>
<article><h2><a href=t>{2}</a></h2><p>{70}</p></article><footer>{-5}</footer>
<article><h1><a href=t>{3}</a></h1><div>{50}</div><div>{12}</div></article><div><a href=o>{-3}</a></div>
<article><h2><a href=t>{9}</a></h2><p>{30}</p><h3><a href=t>{1}</a></h3><p>{40}</p></article>
<h2><a href=t>{-4}</a></h2><p>{-12}</p><article><h1>{6}</h1><p>{80}</p></article><h2><a href=t>{-4}</a></h2><p>{-14}</p>
<nav><a href=x>{-1}</a></nav><article><h1>{2}</h1><p>{2}</p></article><footer>{-9}</footer>
<ul><li><a href=x>{-2}</a></ul><article><h1>{3}</h1><p>{8}</p><div>{2}</div></article><div><a href=x>{-2}</a></div>
<div><a href=x>{-2}</a></div><article><h1>{1}</h1><div>{3}</div><p>{1}</p></article><nav><a href=x>{-2}</a></nav>
<article><h1>{7}</h1><p>{60}</p><p>{1}</p></article><nav><a href=x>{-2}</a></nav>
<main><h1>{7}</h1><p>{60}</p><p>{50}</p><p>{2}</p><div>{1}</div></main><ul><li><a href=x>{-3}</a></ul>
<article><h1>{7}</h1><div>{20}</div><div>{60}</div><h2>{2}</h2><div>{2}</div></article><nav><a href=x>{-2}</a></nav>
<div><a href=a>{-1}</a></div><div>{-6}</div><h1>{2}</h1><p>{40}</p><p>{1}</p><p>{30}</p><h3>{-2}</h3><p><a href=r>{-5}</a></p><p><a href=r>{-5}</a></p><div>{-7}</div>
<h1>{5}</h1><p>{70}</p><p>{20}</p><h4>{-3}</h4><ul><li><a href=r>{-6}</a></li><li><a href=r>{-4}</a></li></ul>
<div><a href=a>{-1}</a> | <a href=b>{-2}</a></div><h2>{3}</h2><p>{40}</p><p>{2}</p><p>{40}</p><div><a href=c>{-2}</a></div>
"""
SYLLABLES = "ra lo min ter a sel on du vi pe scha gen tor li u ba nes tu".split()


def filled(layout: str, seed: int) -> str:
    """A page of a layout: article words begin with k, others with d. Lengths vary by up to half, short ones do not; some pages
    end with their article, and in some its paragraphs are more."""
    rng = random.Random(f"{seed}-{layout}")
    if rng.random() < 0.35:
        layout = re.match(r"(?s).*\{\d+\}(?:</\w+>)*|", layout)[0] or layout
    layout = re.sub(r"<(p|div)>\{[2-9]\d\}</\1>", lambda m: m[0] * rng.choice((1, 1, 1, 2, 5)), layout)
    word = lambda first: first + "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 5)))

    def words(m: re.Match) -> str:
        n = int(m[1])
        count = max(1, round(abs(n) * rng.uniform(0.6, 1.6))) if abs(n) > 3 else abs(n)
        return " ".join(word("d" if n < 0 else "k") for _ in range(count))

    return re.sub(r"\{(-?\d+)\}", words, layout)


def labelled(table: str = LABELLED, copies: range = range(12)) -> np.ndarray:
    """FEATURES and the label of every block of the pages of ``table``, each filled in for every number of ``copies``."""
    rows = []
    for layout in filter(None, table.splitlines()):
        for copy in copies:
            page = blocks_of(filled(layout, copy))
            labels = [2 * sum(w.startswith("k") for w in b.text.split()) >= b.words for b in page.blocks]
            rows.append(np.column_stack([features(page), labels]))
    return np.concatenate(rows)


@dataclass
class Tree:
    """A binary decision tree: x[feature] > cut goes right; a leaf has feature -1 and its class."""

    feature: int
    cut: float = 0.0
    left: Tree | None = None
    right: Tree | None = None
    label: int = 0

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.label)
        side = x[:, self.feature] > self.cut
        out = np.empty(len(x), int)
        out[side], out[~side] = self.right.predict(x[side]), self.left.predict(x[~side])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 9, least: int = 8) -> Tree:
    """The split of least Gini impurity, the first of equals, down to pure leaves, ``depth`` or leaves of ``least`` blocks."""

    def gini(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return 2 * ones * (n - ones) / n

    own = Tree(-1, label=int(2 * y.sum() >= len(y)))
    if depth == 0 or y.min() == y.max():
        return own
    best = (gini(np.array([len(y)]), np.array([y.sum()]))[0] - 1e-9, -1, 0.0)
    for k in range(x.shape[1]):
        order = np.argsort(x[:, k], kind="stable")
        values, ones = x[order, k], np.cumsum(y[order])[:-1]
        left = np.arange(1, len(y))
        cuts = (values[1:] > values[:-1]) & (left >= least) & (len(y) - left >= least)
        if cuts.any():
            got = np.where(cuts, gini(left, ones) + gini(len(y) - left, y.sum() - ones), np.inf)
            if got.min() < best[0]:
                best = (got.min(), k, float(values[got.argmin()] + values[got.argmin() + 1]) / 2)
    if best[1] < 0:
        return own
    side = x[:, best[1]] > best[2]
    return Tree(best[1], best[2], grow(x[~side], y[~side], depth - 1, least), grow(x[side], y[side], depth - 1, least), own.label)


def pruned(tree: Tree, x: np.ndarray, y: np.ndarray) -> Tree:
    """``tree`` with every branch a leaf that is right as often without its splits on held-out blocks."""
    if tree.feature < 0:
        return tree
    side = x[:, tree.feature] > tree.cut
    kept = Tree(tree.feature, tree.cut, pruned(tree.left, x[~side], y[~side]), pruned(tree.right, x[side], y[side]), tree.label)
    return Tree(-1, label=tree.label) if (y == tree.label).sum() >= (kept.predict(x) == y).sum() else kept


@cache
def train(table: str = LABELLED) -> Tree:
    """Grown on twelve fillings of the labelled pages, pruned on eight others."""
    rows, held = labelled(table), labelled(table, range(12, 20))
    return pruned(grow(rows[:, :-1], rows[:, -1]), held[:, :-1], held[:, -1])


def main_texts(sources: list[str | None], tree: Tree) -> list[str]:
    pages = [blocks_of(x) if x else Page() for x in sources]
    keep = iter((tree.predict(np.concatenate([np.zeros((0, len(FEATURES))), *map(features, pages)])) == 1).tolist())
    return ["\n\n".join([b.text for b in page.blocks if next(keep)]) for page in pages]


def extract(pages: DataFrame, table: str = LABELLED) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages`` (page_id, url, html).

    The tree is trained on the driver from ``table``, whose size is fixed; pages are worked on where they are read, so
    nothing is shuffled. Null or empty html, and pages without article text, give an empty text. Whole pages are
    read, whatever their length. Null ids and urls stay null, repeated rows are extracted each, an empty table gives no
    rows. Columns other than page_id, url and html are not read.
    """
    tree = train(table)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = main_texts(batch.column(2).to_pylist(), tree)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    own = pages.select(pages["page_id"].cast("long"), pages["url"].cast("string"), pages["html"].cast("string"))
    return common.map_columns(own, one, "page_id long, url string, text string, n_chars long", rows=256)
