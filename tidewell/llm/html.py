"""Main text of web pages by two passes of rules over blocks (Pomikálek, "Removing Boilerplate and Duplicate Content", 2011)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = frozenset(
    """
    the of and to in that is was for it with as be on by at he his but are this have not from which or had you they an were
    der die das und ist nicht ein eine zu den von mit sich des auf für dem im auch als an werden aus hat dass sie nach bei um
    le la les de des et en un une du est que qui dans pour pas sur par au avec il ne se plus ce mais son ou
    el los las y por con no una su al lo como más pero sus del se
    il che non di per è sono gli alla con della nel
    o os um uma não com para mais
    het een van niet ik je dat zijn op te
    """.split()
)
#: Elements that end a block, elements whose content is no text, and elements that hold no article text.
BLOCK = frozenset(
    """p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main nav header footer
    aside form fieldset blockquote pre figure figcaption hr address body html center details summary legend menu dialog""".split()
)
RAW = "script|style|noscript|iframe|title|textarea"
HIDDEN = "template|object|svg|math|select|button|canvas|audio|video"
HIDDEN_NAMES = frozenset(HIDDEN.split("|"))
BOILER = frozenset("nav footer aside menu dialog".split())
#: Elements that a reader fills in.
CONTROLS = frozenset("input select textarea button".split())
#: Elements that hold the page or its article, whatever their class or id says of its layout.
WHOLE = frozenset("html body main article".split())
#: Words of class, id and role names that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
MARKS = frozenset(
    """ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs
    sidebar footer masthead topbar cookie cookies consent gdpr notice notices alert comment comments reply replies respond disqus share sharing social
    related recommended newsletter subscribe subscription signup login search pagination pager popup modal overlay widget complementary contentinfo
    """.split()
)
#: Class names that mark an article as a whole, and words that make a name tell a state instead of a kind (`has-comments`, `comments-open`).
ARTICLE_NAMES = frozenset("article content entry hentry main post story".split())
STATES = frozenset("has with no not is show hide open closed enabled disabled visible hidden on off".split())
#: Shortest block that decides for itself, in characters; long blocks; link density; stop-word densities.
SHORT, LONG, LINKS, STOP_LOW, STOP_HIGH = 70, 200, 0.2, 0.15, 0.3

#: Quotes count as such only after an equals sign; nothing is tried twice, so that pages of broken tags take linear time.
_ATTRIBUTES = r"(?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
#: A comment or raw element that is not closed goes to the page's end.
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>]){_ATTRIBUTES}(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))|<(/?)([a-z][a-z0-9]*)(?![\w:-])({_ATTRIBUTES})>|</?[a-z][\w:-]*{_ATTRIBUTES}>|<[!?/][^>]*>",
    re.S | re.I,
)
_HIDDEN_END = re.compile(rf"</({HIDDEN})\s*>", re.I)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[^\W\d_]+")
#: What ends a sentence, in any script that has such signs.
_SENTENCE = re.compile(r"[.!?…](?=[\s\"'”»)\]]|$)|[。！？؟।]")
_HEADING = re.compile(r"h[1-6]")


@dataclass(slots=True)
class Block:
    text: str
    links: float  # share of the text in links
    inside: bool  # in an article or main element
    bad: bool  # in boilerplate by its containers' elements or names
    heading: bool
    form: int | None  # the innermost form around it


def marked(attributes: str, inside: bool) -> bool:
    """Whether more of the names in class, id and role speak for boilerplate than for an article; names of states do not count."""
    weight = 0
    for m in _NAME.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = set(re.split(r"[_\-]+", name))
            if words & MARKS or not inside and "header" in words:
                weight += not words & STATES
            elif name in ARTICLE_NAMES:
                weight -= 1
    return weight > 0


def blocks(page: str) -> tuple[list[Block], Counter, set[int]]:
    """Each non-empty block in page order, the number of controls of each form, and the forms that hold a whole article."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool, int | None]] = []  # open containers: name, in boilerplate, in an article, form
    open_now: Counter[str] = Counter()
    controls: Counter[int | None] = Counter()
    wrappers: set[int] = set()
    ends: dict[str, list[int]] = {}
    for m in _HIDDEN_END.finditer(page):
        ends.setdefault(m[1].lower(), []).append(m.end())
    text: list[str] = []
    linked: list[str] = []
    link, at, mark, heading, forms = 0, 0, False, False, 0

    def flush() -> None:
        nonlocal mark, heading
        whole = " ".join(unescape("".join(text)).split())
        if whole:
            part = len(" ".join(unescape("".join(linked)).split()))
            _, bad, inside, form = stack[-1] if stack else ("", False, False, None)
            found.append(Block(whole, part / len(whole), inside, mark or bad, heading, form))
        text.clear(), linked.clear()
        mark = heading = False

    for m in _TAG.finditer(page):
        if m.start() < at:  # in a hidden element
            continue
        if at < m.start():
            text.append(page[at : m.start()])
            if link:
                linked.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or m[1] or "").lower()
        form = stack[-1][3] if stack else None
        if name in CONTROLS and not m[2] and not (name == "input" and re.search(r"type\s*=\s*[\"']?hidden", m[4], re.I)):
            controls[form] += 1
        if name in HIDDEN_NAMES and not m[2] and not m[4].endswith("/"):
            # to its end; if there is none it is its tag alone
            later = ends.get(name, [])
            k = bisect_left(later, at)
            at = later[k] if k < len(later) else at
        elif name in ("br", "img", "wbr", "input"):
            text.append(" " * (name != "wbr"))
        elif name == "a":
            link = not m[2]
        elif name in BLOCK:
            flush()
            if m[2]:
                if open_now[name]:
                    while True:
                        last = stack.pop()[0]
                        open_now[last] -= 1
                        if last == name:
                            break
            elif name not in ("p", "hr", "li", "dt", "dd", "td", "th", "tr") and not _HEADING.fullmatch(name):
                _, bad, inside, form = stack[-1] if stack else ("", False, False, None)
                if name == "form":
                    form, forms = forms, forms + 1
                if name in ("article", "main") and form is not None:
                    wrappers.add(form)
                bad = bad or name in BOILER or name == "header" and not inside or name not in WHOLE and marked(m[4], inside)
                stack.append((name, bad, inside or name in ("article", "main"), form))
                open_now[name] += 1
            else:
                mark = marked(m[4], True)
                heading = bool(_HEADING.fullmatch(name))
                if name == "h1" and form is not None:
                    wrappers.add(form)
    if at < len(page):
        text.append(page[at:])
        if link:
            linked.append(page[at:])
    flush()
    return found, controls, wrappers


def density(t: str) -> float:
    words = _WORD.findall(t.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def main_text(page: str) -> str:
    """The blocks of the article, joined by two newlines.

    First pass: containers of boilerplate are out, and so is a form with controls, unless it wraps an article, a page's
    heading or a long block of running text. Where article and main elements hold most of the running text, all that
    lies outside them is out; else they are containers like others. Of the rest, a block full of links is bad. A block
    of stop words is good, if it is long enough to tell; outside articles a long one without any is good if it has
    sentences (in languages whose stop words are not listed), else bad. All others wait. Second pass: a waiting block
    takes the label of the nearest decided blocks before and after it. Outside an article it needs good ones on both
    sides, or on the one side where blocks are decided; a heading goes with what follows it; a line of copyright needs
    good ones on both sides. Inside an article a block goes only where all that are decided around it are bad. On a
    page without good blocks the waiting ones with a sentence are the text.
    """
    found, controls, wrappers = blocks(page)
    share = [density(b.text) for b in found]
    told = [bool(_SENTENCE.search(b.text)) for b in found]

    def running(i: int) -> bool:
        return found[i].links <= LINKS and (share[i] >= STOP_LOW or told[i])

    long_forms = {b.form for i, b in enumerate(found) if len(b.text) >= LONG and running(i) and not b.bad}
    for b in found:
        b.bad = b.bad or b.form is not None and controls[b.form] > 0 and b.form not in wrappers and b.form not in long_forms
    held = Counter()
    for i, b in enumerate(found):
        if not b.bad:
            held[b.inside] += len(b.text) * (running(i) and len(b.text) >= SHORT)
    article = held[True] >= held[False] and any(b.inside and not b.bad for b in found)
    labels: list[bool | None] = []
    out_of_play = []  # containers decide, and no neighbour inherits from them inside an article
    both = []  # needs good neighbours on both sides
    for i, b in enumerate(found):
        t, inside = b.text, b.inside and article
        out_of_play.append(article and (b.bad or not inside))
        both.append(not inside and t.lower().startswith(("©", "copyright ©", "copyright (c)")))
        if b.bad or article and not inside:
            labels.append(False)
        elif both[i]:
            labels.append(None)
        elif b.links > (0.5 if inside else LINKS):
            labels.append(None if inside and len(t) < SHORT else False)
        elif len(t) < SHORT:
            labels.append(None)
        elif inside:
            labels.append(True if share[i] >= STOP_LOW else None)
        elif len(t) < LONG:
            labels.append(True if share[i] >= STOP_HIGH else None)
        else:
            labels.append(share[i] >= STOP_LOW or told[i])
    if True not in labels:
        labels = [told[i] and not both[i] or None if x is None else x for i, x in enumerate(labels)]
    before: list[bool | None] = [None]
    for x, skip in zip(labels, out_of_play, strict=True):
        before.append(before[-1] if x is None or skip else x)
    out = []
    after = None
    for i in range(len(found) - 1, -1, -1):
        x = labels[i]
        if x is None:
            near = {y for y in (before[i], after) if y is not None}
            if both[i]:
                keep = before[i] is True and after is True
            elif found[i].inside and article:
                keep = near != {False}
            else:
                keep = near == {True} or found[i].heading and after is True
        else:
            keep = x
            after = after if out_of_play[i] else x
        if keep:
            out.append(found[i].text)
    return "\n\n".join(out[::-1])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """One row for each row of pages: page_id, url, text (see main_text), n_chars (its code points).

    Character references are decoded once, white space inside a block becomes one space, comments and the content of
    scripts, styles, forms' controls and the head are no text. A null or empty html, or a page of boilerplate, gives
    an empty text. Null page_id and url are kept, repeated rows are extracted each, markup that is cut off or not
    closed is read as far as it goes. Other columns are not read. An empty table gives an empty result.
    """
    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
