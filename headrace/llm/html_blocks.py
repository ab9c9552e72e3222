"""HTML pages as leaf blocks: each run of text between block tags, with the path of tags above it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Names from the HTML standard.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button canvas caption dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main "
    "menu nav noscript object ol option p pre search section select summary table tbody td template "
    "textarea tfoot th thead title tr ul video".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK_TAGS - {"button", "option", "title"}
LIKE_CLOSES = {
    "li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
HELD_BY = {"li": {"ul", "ol", "menu"}, "option": {"select"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
RAW = frozenset("script style title iframe".split())  # no markup inside, up to their own end tag
LEFT_OUT = frozenset("head svg object canvas video audio template".split())
FOREIGN = frozenset("svg math".split())
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta noscript noframes style script template title".split())
# Tags that end foreign elements which are still open.
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S | re.I,
)
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")  # a slash that is no part of a value
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]  # tag names, and parts of class, id and role names behind a dot
    linked: float  # share of the text inside links


def blocks(page: str) -> list[Block]:
    """Blocks with text in page order; scripts, styles, comments and ``LEFT_OUT`` elements have none.

    Scripts, styles, titles, frames and comments that are never closed last to the page's end, as in a
    browser. Other elements end with the element around them, foreign ones also at a tag that cannot
    stand in them, the head at the first tag or text of the body. A slash closes foreign and left out
    elements. A tag that the page's end cuts off is no text.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    run: list[str] = []
    path: tuple[str, ...] | None = None  # of the run, from its first text on
    linked = at = 0

    def close() -> None:
        nonlocal linked, path
        if path is not None:
            joined = "".join(run)
            text = " ".join((html.unescape(joined) if "&" in joined else joined).split())
            if text:
                found.append(Block(text, path, min(1.0, linked / len(text))))
        run.clear()
        linked, path = 0, None

    def read(piece: str) -> None:
        nonlocal path, linked
        if stack and stack[-1][0] == "head" and not piece.isspace():
            stack.pop()
        if any([tag in LEFT_OUT for tag, _ in stack]):
            return
        run.append(piece)
        if not piece.isspace():
            if path is None:
                path = tuple([n for _, names in stack for n in names])
            if any([tag == "a" for tag, _ in stack]):
                linked += len(piece)

    def pop_to(tags: set[str], stop: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    def foreign() -> str | None:
        """The open foreign element that the next tag would stand in."""
        for tag, _ in reversed(stack):
            if tag in FOREIGN:
                return tag
            if tag in INTEGRATION or tag in BLOCK_TAGS:
                return None
        return None

    while token := _TOKEN.search(page, at):
        if token.start() > at:
            read(page[at : token.start()])
        at = token.end()
        end, tag, rest, end2, tag2 = token.groups()
        tag = (tag or tag2 or "").lower()
        if not tag:
            continue
        end = end or end2
        outer = foreign()
        if outer and tag in BREAKS_OUT and (not end or tag in ("p", "br")):
            while outer:
                pop_to({outer}, set())
                outer = foreign()
        if not end and tag in RAW and not outer:
            close()
            closing = _RAW_ENDS[tag].search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if stack and stack[-1][0] == "head" and (tag in ("body", "html") if end else tag not in IN_HEAD):
            stack.pop()
        elif tag == "body" and not end:
            pop_to({"head"}, {"template"})
        if tag in BLOCK_TAGS or tag in LEFT_OUT:
            if run:
                close()
        elif tag == "br" and run:
            run.append(" ")
        if end:
            pop_to({tag}, {"template"} - {tag})
            continue
        if tag in CLOSES_P:
            pop_to({"p"}, {"article", "main", "section", "div", "body", "td", "li", "object", "template"})
        if tag in LIKE_CLOSES:
            pop_to(LIKE_CLOSES[tag], HELD_BY[tag])
        if (outer or tag in LEFT_OUT or tag in FOREIGN) and _CLOSED.search(rest or ""):
            continue
        if tag not in VOID_TAGS:
            names = [tag]
            if rest:
                for value in _NAMES.findall(rest):
                    names += ["." + part for part in _PARTS.findall(value.lower())]
            stack.append((tag, tuple(names)))
    if at < len(page):
        read(page[at:])
    close()
    return found
