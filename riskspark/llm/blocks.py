"""HTML pages as sequences of leaf blocks with their tag paths."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

# Attributes as the HTML standard reads them: quotes count only at the start of a value, an unquoted
# value ends at white space or '>', and a name may hold anything else. Nothing is tried twice.
_ATTRIBUTES = (r"(?:[^>\"']*+(?=>)|"  # no quotes at all
               r"(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++)?+)?+|=)*+)")
# A comment, a whole element of raw text that is not shown, or a tag.
_PIECE = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))"
    rf"|<(script|style|title|textarea)(?=[\s/>]){_ATTRIBUTES}(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|(\Z))|<[!?/][^>]*+(?:>|(\Z))", re.S | re.I)
# The same where some tag never ends: from there on, a tag ends at the next '>'.
_PLAIN_PIECE = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))|<(script|style|title|textarea)(?=[\s/>])[^>]*+(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.S | re.I)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+", re.I)
#: Elements below so many others are read as if they stood beside the last of those.
MOST_DEPTH = 100
# Elements that stand inside a line of text, and elements without content.
INLINE = frozenset("a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins "
                   "kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt "
                   "u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag closes an open element of its own group.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Elements whose content is not shown, and what may stand in a head.
HIDDEN = frozenset("noscript template svg math iframe object head select audio video canvas".split())
HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())


@dataclass
class Block:
    """The text of a leaf block, the names on its path, and what part of it is link text."""

    text: str
    path: tuple[str, ...]
    linked: float


def token_names(kind: str, token: str) -> tuple[str, ...]:
    """Names for one word of a class, id or role: the whole token, and its parts if it has several."""
    token = token.lower()
    words = _NAME.findall(token)
    return (f"{kind}:{token}", *([f"{kind}-part:{w}" for w in words] if words != [token] else []))


@lru_cache(maxsize=8192)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and names for its class, id and role.

    Those of ``html`` and ``body`` tell of the page, not of the text in it, and are left out.
    """
    out = [tag]
    if attributes and tag not in ("html", "body"):
        for kind, *values in _ATTRIBUTE.findall(attributes):
            for token in "".join(values).split():
                out += token_names(kind[0].lower(), token)
    return tuple(out)


def _pieces(page: str) -> list[re.Match]:
    """Comments, raw elements and tags in order; time is linear in the page."""
    found = []
    for piece in _PIECE.finditer(page):
        if piece[5] is not None or piece[6] is not None:  # never ends: its quotes are not meant so
            return found + list(_PLAIN_PIECE.finditer(page, piece.start(), page.rfind(">") + 1))
        found.append(piece)
    return found


def _tag(found: re.Match) -> tuple[str, bool]:
    """The name of a tag, empty for other pieces, and whether it opens an element with content."""
    tag = (found[3] or "").lower()
    return tag, bool(tag) and not found[2] and tag not in VOID and not found[4].endswith("/")


def _hidden_ends(pieces: list[re.Match]) -> dict[int, int]:
    """For the number of each hidden element's tag that is closed, the number of its closing tag.

    An element that is not closed before its parent is, is missing, and so is a head, which ends
    by other rules.
    """
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    open_: dict[str, int] = {}
    for i, found in enumerate(pieces):
        tag, opens = _tag(found)
        if opens:
            stack.append((tag, i))
            open_[tag] = open_.get(tag, 0) + 1
        elif tag and found[2] and open_.get(tag):
            while True:
                gone, at = stack.pop()
                open_[gone] -= 1
                if gone == tag:
                    break
            if tag in HIDDEN and tag != "head":
                ends[at] = i
    return ends


def split_blocks(page: str) -> list[Block]:
    """The blocks of a page in order: runs of text between block-level tags.

    Scripts, styles, comments, the head and control contents are no text. Character references
    are decoded, white space becomes one space, and blocks without text are left out. Inline
    tags do not end a block; a line break is white space. Unclosed elements are tolerated: a head
    ends at the first tag that cannot stand in it, and other elements that are not shown end with
    their parent. Only script, style, title and textarea may run to the end of the page. A tag that
    never ends for its quotes ends at the next ``>``.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    links: list[str] = []
    standing: Counter[str] = Counter()
    inside_link = 0
    #: Place in the stack of an unclosed element, or a head, that is not shown.
    hidden: int | None = None

    def cut(depth: int) -> None:
        nonlocal inside_link, hidden
        while len(stack) > depth:
            gone, _ = stack.pop()
            standing[gone] -= 1
            inside_link -= gone == "a"
        if hidden is not None and depth <= hidden:
            hidden = None

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            linked = " ".join(html.unescape("".join(links)).split())
            path = tuple(name for _, names in stack[:hidden] for name in names)
            blocks.append(Block(text, path, min(1.0, len(linked) / len(text))))
        pieces.clear()
        links.clear()

    def text(part: str) -> None:
        if part and hidden is None:
            pieces.append(part)
            if inside_link:
                links.append(part)

    found_all = _pieces(page)
    ends = _hidden_ends(found_all)
    at, skip_to = 0, -1
    for i, found in enumerate(found_all):
        if i <= skip_to:
            at = found.end()
            continue
        text(page[at:found.start()])
        at = found.end()
        tag, opens = _tag(found)
        if not tag:
            continue
        if i in ends:
            skip_to = ends[i]
            continue
        closing, inline = bool(found[2]), tag in INLINE
        if hidden is not None and not closing and tag not in HEAD:
            for depth, (open_, _) in enumerate(stack):
                if open_ == "head":
                    cut(depth)
                    break
        if opens and tag in HIDDEN:
            if len(stack) >= MOST_DEPTH:
                cut(MOST_DEPTH - 1)
            if hidden is None:
                hidden = len(stack)
            stack.append((tag, (tag,)))
            standing[tag] += 1
            continue
        if tag in ("br", "img", "wbr"):
            text(" ")
            continue
        if not inline and not (closing and tag in HIDDEN):
            flush()
        if tag in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1) if standing[tag] else ():
                if stack[depth][0] == tag:
                    cut(depth)
                    break
            continue
        closes = CLOSES.get(tag, ())
        for depth in range(len(stack) - 1, -1, -1):
            open_ = stack[depth][0]
            if open_ in closes:
                cut(depth)
                break
            if open_ not in INLINE and open_ not in ("p",) and open_ not in HIDDEN:
                break
        if not inline and stack and stack[-1][0] in INLINE and tag != "a":
            # A block inside an unclosed inline element: that element ends here.
            depth = len(stack)
            while depth and stack[depth - 1][0] in INLINE and stack[depth - 1][0] != "a":
                depth -= 1
            cut(depth)
        if opens:
            if len(stack) >= MOST_DEPTH:
                cut(MOST_DEPTH - 1)
            stack.append((tag, _names(tag, found[4])))
            standing[tag] += 1
            inside_link += tag == "a"
    text(page[at:])
    flush()
    return blocks
