"""Leaf blocks of HTML pages: runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Tags that do not break a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr"
    " annotation annotation-xml math merror mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
#: Tags without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
SILENT = frozenset("script style template noscript iframe object svg math canvas head title select option textarea button datalist annotation annotation-xml".split())
#: Silent elements whose text counts inside an article.
HEARD_IN_ARTICLE = frozenset("math object".split())
#: Elements whose content is raw: only their own end tag ends them.
RAW = frozenset("script style textarea title iframe noscript template".split())
#: What an opening tag closes without an end tag.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A paragraph ends where one of these opens.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An implied end does not reach over these.
BARRIER = frozenset("article aside body div footer form header main nav section table td th ul ol dl".split())

#: What may open inside a head; anything else ends it, as text does.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
SECTIONS = frozenset("article aside body footer form h1 h2 h3 h4 h5 h6 header main nav section".split())
#: Opening tags that HTML's rules for foreign content let end a drawing or formula.
_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
) | SECTIONS
#: Where HTML is at home again inside them.
FOREIGN_HTML = frozenset("foreignobject desc title annotation annotation-xml mi mo mn ms mtext".split())
_FLOW = ENDS_PARAGRAPH | SECTIONS | frozenset("dd dt li td th tr".split())
_CHOICE = (_FLOW - {"hr"}) | {"button", "input", "select", "textarea"}
#: Opening tags that a silent element without its end tag cannot contain.
ENDED_BY = {
    "svg": _FOREIGN, "math": _FOREIGN, "select": _CHOICE, "option": _CHOICE, "datalist": _CHOICE,
    "button": (_FLOW - {"div", "hr", "menu"}) | {"button"}, "canvas": SECTIONS, "object": SECTIONS,
}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(id|class|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    #: (tag, lower-case words of its id, class and role) from the root down
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int  #: characters inside links


def _names(attributes: str) -> tuple[str, ...]:
    found = []
    for m in ATTRIBUTE.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "")
        found += WORD.findall(value.lower())
    return tuple(found)


def leaf_blocks(page: str) -> list[Block]:
    """Blocks with text, in page order. Never fails: what is not a tag is text."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    quiet: list[bool] = []  # of each open element, whether it is a silent one
    last_end: dict[str, int] = {}
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = links = silent = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", "".join(pieces)).strip()
            if text:
                blocks.append(Block(text, tuple(e for e in stack if e[0] not in INLINE), min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop(count: int) -> None:
        nonlocal links, silent
        for tag, _ in stack[len(stack) - count :]:
            links -= tag == "a"
        silent -= sum(quiet[len(stack) - count :])
        del quiet[len(stack) - count :], stack[len(stack) - count :]

    def closed(tag: str) -> bool:
        """Whether an end tag follows somewhere."""
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in re.finditer(rf"</{re.escape(tag)}[\s/>]", page, re.I)), default=-1)
        return last_end[tag] >= at

    def end_silent(tag: str) -> None:
        """Ends the open silent elements that cannot contain an opening tag."""
        for k, (name, _) in enumerate(stack):
            if not quiet[k]:
                continue
            if name == "head":
                ended = tag not in IN_HEAD
            else:
                ended = tag in ENDED_BY.get(name, ()) and not (name in ("svg", "math") and any(e[0] in FOREIGN_HTML for e in stack[k + 1 :]))
            if ended:
                pop(len(stack) - k)
                return

    def say(raw: str) -> None:
        nonlocal linked
        if silent and stack[-1][0] == "head" and raw.strip():
            pop(1)
        if raw and not silent:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                linked += len(text.strip())

    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is None:
                if tag == "p":
                    flush()
                continue
            if any(e[0] not in INLINE for e in stack[depth:]):
                if tag in INLINE:
                    # An inline end does not close blocks that were opened inside it.
                    if tag == "a":
                        links -= 1
                    silent_end = quiet[depth]
                    del stack[depth], quiet[depth]
                    silent -= silent_end
                    continue
                flush()
            pop(len(stack) - depth)
            continue
        if silent:
            end_silent(tag)
        if tag == "br" or tag == "hr":
            pieces.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID:
            if tag not in INLINE:
                pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
            closes = CLOSES.get(tag)
            if tag in ENDS_PARAGRAPH:
                closes = (closes or set()) | {"p"}
            if closes:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in closes:
                        pop(len(stack) - k)
                        break
                    if stack[k][0] in BARRIER:
                        break
        if m[3].rstrip().endswith("/") and tag not in RAW:
            continue
        hushed = tag in SILENT and not (tag in HEARD_IN_ARTICLE and any(e[0] == "article" for e in stack))
        if tag in ("canvas", "object") and not closed(tag):
            hushed = False
        stack.append((tag, _names(m[3])))
        quiet.append(hushed)
        links += tag == "a"
        silent += hushed
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            pop(1)
            at = close.end() if close else end
    flush()
    return blocks
