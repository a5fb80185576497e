"""A page as containers and text blocks, read in one pass over its tags."""

from __future__ import annotations

import functools
import html as entities
import re
from dataclasses import dataclass

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^<>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s\"'>][^\s>]*+)))?")
NUMBERS = re.compile(r"[0-9]+")
NAME_PARTS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title noscript iframe svg math object canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol option p pre section select summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("body main article section div td".split())
#: A start tag ends an open element of the second kind, not looking past an element of the third kind.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
NOT_CONTENT = frozenset("nav footer aside select dialog head menu".split())
#: Tags that are not content either, unless they hold most of the page's text.
FORMS = frozenset("form button label".split())
#: Parts of class and id names that mark what is not the article.
NOT_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted promotion related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
#: Those that are as common in names of subjects (a share price, a tasting menu): beside a word that is no part of a page
#: they mark only what consists of links.
SUBJECTS = frozenset(
    "banner banners login masthead menu modal nav navigation newsletter notice notices notification popup promo promoted promotion related respond "
    "search share sharing signup social sponsor sponsored subscribe widget widgets".split()
)
#: Words for parts of a page.
PAGE_PARTS = frozenset(
    "alert alerts area article articles bar block blocks body bottom box btn button buttons card cards center close col column container content deal deals "
    "desktop dropdown feed feeds fixed float form group head header holder icon icons inner item items js last layout left link links list lists main "
    "message messages mobile more offer offers outer overlay page pages panel post posts primary right row secondary section sections slot small sticky "
    "stories story sub submenu tab tabs text title toggle top trigger unit units up view wrap wrapper zone".split()
)
#: Those that may hold most of a page's text and are still not its article.
REPLIES = frozenset("comment comments consent cookie cookies disqus gdpr replies reply respond".split())
IF_LINKS = 3
#: After one of these a name says what the element has or lacks, not what it is.
NO_MARK = frozenset("has have with without no non not".split())
ATTRIBUTES = frozenset("class id role hidden aria-hidden style".split())
NOT_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())


@dataclass
class Element:
    tag: str
    path: str
    parent: int
    skipped: bool
    in_header: bool
    link: bool
    hard: bool = False
    mark: int = 0


@dataclass
class Block:
    text: str
    owner: int
    link_chars: int
    heading: bool


def _attributes(raw: str) -> dict[str, str]:
    """Attributes of a start tag that matter here, by whole names; the first of equal names counts."""
    found: dict[str, str] = {}
    if raw.strip():
        for name, *values in ATTRIBUTE.findall(raw):
            name = name.lower()
            if name in ATTRIBUTES and name not in found:
                found[name] = "".join(values).lower()
    return found


def _step(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes, without numbers, so that pages of one template agree."""
    classes = sorted({NUMBERS.sub("#", c) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def _skipped(tag: str, attributes: dict[str, str]) -> bool:
    if tag in NOT_CONTENT:
        return True
    if not attributes or tag in ("body", "html", "main"):
        return False
    if attributes.get("role") in NOT_CONTENT_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    return False


@functools.lru_cache(maxsize=10_000)
def _mark(names: str) -> int:
    """What class and id names mark: 0 nothing, 1 what is not the article, 2 replies or notices, ``IF_LINKS`` what is not the article if it is links."""
    found: set[str] = set()
    unsure = False
    for name in names.split():
        marks: set[str] = set()
        subject = False
        for part in NAME_PARTS.findall(name):
            if part in NO_MARK:
                break
            if part in NOT_CONTENT_NAMES:
                marks.add(part)
            elif part not in PAGE_PARTS:
                subject = True
        if subject and marks and marks <= SUBJECTS:
            unsure = True
        else:
            found |= marks
    return IF_LINKS if unsure and not found else 0 if not found else 1 if found.isdisjoint(REPLIES) else 2


def _subjects(elements: list[Element], lost: dict[int, int], linked: dict[int, int]) -> frozenset[int]:
    """Elements whose names are those of a subject rather than of a part of the page: what they hold is not mostly links."""
    plain, links = [0] * len(elements), [0] * len(elements)
    for k in range(len(elements) - 1, 0, -1):
        plain[k] += lost.get(k, 0)
        links[k] += linked.get(k, 0)
        if elements[k].skipped and not elements[k].hard:
            plain[elements[k].parent] += plain[k]
            links[elements[k].parent] += links[k]
    return frozenset(k for k, e in enumerate(elements) if e.mark == IF_LINKS and plain[k] > links[k])


def _wrappers(elements: list[Element], blocks: list[Block], lost: dict[int, int]) -> frozenset[int]:
    """Elements marked by their names that hold most of the page's unlinked text and are taken for wrappers of the article.

    One that holds a main heading or an article is; replies and notices often hold articles of their own. Without these
    an element is none if an article elsewhere has text, or if its names say replies or notices and other text is left.
    """
    held, heads, articles = [0] * len(elements), [False] * len(elements), [False] * len(elements)
    for k in range(len(elements) - 1, 0, -1):
        e = elements[k]
        held[k] += lost.get(k, 0)
        if e.skipped and not e.hard:
            heads[k] |= e.tag in ("h1", "main") and not e.mark
            up = e.parent
            held[up] += held[k]
            heads[up] |= heads[k]
            articles[up] |= articles[k] or e.tag == "article" and not e.mark
            articles[k] |= e.tag == "article"
    left = sum(len(b.text) - b.link_chars for b in blocks)
    half = (left + sum(lost.values())) / 2
    marked = [k for k, e in enumerate(elements) if e.mark and not e.hard and held[k] > half]
    if not marked:
        return frozenset()
    above, at = set(), marked[0]
    while at >= 0:
        above.add(at)
        at = elements[at].parent
    inside = [False] * len(elements)
    for k, e in enumerate(elements):
        inside[k] = k not in above and e.tag in ("article", "main") or e.parent >= 0 and inside[e.parent]
    elsewhere = any(inside[b.owner] for b in blocks)
    kept, before = set(), 0
    for k in marked:
        if kept:
            left += before - held[k]
        before = held[k]
        replies = elements[k].mark == 2
        if not (heads[k] or articles[k] and not replies or not left or not replies and not elsewhere):
            break
        kept.add(k)
    return frozenset(kept)


def parse(page: str) -> tuple[list[Element], list[Block]]:
    """Elements and blocks in page order. Element 0 stands for the whole page."""
    elements, blocks, lost, linked = _read(page, frozenset())
    if lost:
        kept = _subjects(elements, lost, linked)
        if kept:
            elements, blocks, lost, _ = _read(page, kept)
        if lost:
            wrappers = _wrappers(elements, blocks, lost)
            if wrappers:
                elements, blocks, _, _ = _read(page, kept | wrappers)
    return elements, blocks


def _read(page: str, kept: frozenset[int]) -> tuple[list[Element], list[Block], dict[int, int], dict[int, int]]:
    """Elements, blocks, and the unlinked and the linked characters of each element that is skipped for its names; ``kept`` ones are not."""
    elements = [Element("", "", -1, False, False, False)]
    open_: list[int] = [0]
    blocks: list[Block] = []
    lost: dict[int, int] = {}
    linked: dict[int, int] = {}
    parts: list[str] = []
    state = {"owner": 0, "link": 0, "heading": False}

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, state["owner"], state["link"], state["heading"]))
            parts.clear()
        state["link"] = 0

    def add(text: str) -> None:
        here = elements[open_[-1]]
        if text and not here.skipped:
            if not parts:
                state["owner"], state["heading"] = open_[-1], any(elements[k].tag in HEADINGS for k in open_[-4:])
            text = entities.unescape(text)
            parts.append(text)
            if here.link:
                state["link"] += len(text)
        elif text and not here.hard:
            size, sums = len(" ".join(text.split())), linked if here.link else lost
            if size:
                sums[open_[-1]] = sums.get(open_[-1], 0) + size

    def close(tags: set[str] | frozenset[str], stop: set[str]) -> None:
        for depth in range(len(open_) - 1, 0, -1):
            tag = elements[open_[depth]].tag
            if tag in tags:
                if any(elements[k].tag in BLOCKS for k in open_[depth:]):
                    flush()
                del open_[depth:]
                return
            if tag in stop:
                return

    at, end = 0, len(page)
    while at < end:
        match = TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        if match.group(2) is None:
            continue
        tag = match.group(2).lower()
        if match.group(1):
            if tag == "p" and not any(elements[k].tag == "p" for k in open_):
                flush()
            close({tag}, set())
            continue
        if tag in BLOCKS:
            flush()
            close({"p"}, {"td", "th", "table", "button", "article", "div", "section", "li", "body"} if tag != "p" else set())
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag == "br" or tag in ("td", "th"):
            add(" ")
        if tag in VOID:
            continue
        raw = match.group(3) or ""
        if tag in RAW:
            if not raw.endswith("/"):
                closing = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = closing.end() if closing else end
            continue
        if raw.endswith("/") and ":" in tag:
            continue
        parent, attributes = elements[open_[-1]], _attributes(raw)
        hard, mark = parent.hard or _skipped(tag, attributes), 0
        if not hard and len(elements) not in kept and tag not in ("body", "html", "main"):
            mark = _mark(f"{attributes.get('class', '')} {attributes.get('id', '')}") if attributes else 0
            if tag in FORMS or attributes.get("role") == "form":
                mark = mark if mark in (1, 2) else 1
        elements.append(
            Element(
                tag,
                f"{parent.path}>{_step(tag, attributes)}" if tag in CONTAINERS else parent.path,
                open_[-1],
                parent.skipped or hard or mark > 0,
                parent.in_header or tag == "header",
                parent.link or tag == "a",
                hard,
                mark,
            )
        )
        if elements[-1].skipped and not parent.skipped and tag not in BLOCKS and parts:
            add(" ")
        open_.append(len(elements) - 1)
    flush()
    return elements, blocks, lost, linked
