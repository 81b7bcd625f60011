"""One page's markup as a flat list of tokens and elements; a small helper without Spark."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import xxhash

#: Fixed values of the HTML standard: elements without content, with raw text, that start a block, that end an open p.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody tfoot thead tr ul".split()
)
ENDS_P = BLOCKS - frozenset("body caption head html legend li dd dt option summary figcaption tbody tfoot thead tr".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LIMITS = frozenset("ul ol dl table div section article main body nav aside footer header form select".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?:/?[a-zA-Z])[^<>]*\Z", re.S
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Element(NamedTuple):
    tag: str
    names: str  # its class, id, role and hidden attributes, in order
    parent: int
    start: int  # of its tokens
    end: int
    digest: int  # of the whole subtree


def _names(attributes: str) -> str:
    if not attributes or attributes.isspace():
        return ""
    return " ".join(f"{k.lower()}={v.strip(chr(34) + chr(39)).lower()}" for k, v in _NAMES.findall(attributes))


def parse(page: str) -> tuple[list[str | int | None], list[Element]]:
    """Tokens and elements. A token is text, an element's number where it opens, or None where a block or line ends."""
    tokens: list[str | int | None] = []
    rows: list[list] = []
    sums: list = []
    stack: list[int] = []

    def close() -> None:
        i = stack.pop()
        if rows[i][0] in BLOCKS:
            tokens.append(None)
        rows[i][4] = len(tokens)
        rows[i][5] = sums[i].intdigest()
        sums[i] = None
        if stack:
            sums[stack[-1]].update(rows[i][5].to_bytes(8, "little"))

    def text(part: str) -> None:
        if part:
            part = html.unescape(part)
            tokens.append(part)
            if stack and not part.isspace():
                sums[stack[-1]].update(" ".join(part.split()).encode(errors="replace"))

    def close_open(tags: tuple[str, ...] | frozenset, limits: frozenset) -> None:
        for at in range(len(stack) - 1, -1, -1):
            tag = rows[stack[at]][0]
            if tag in tags:
                while len(stack) > at:
                    close()
                return
            if tag in limits:
                return

    at = 0
    while found := _TAG.search(page, at):
        text(page[at : found.start()])
        at = found.end()
        end, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        if end:
            if any(rows[i][0] == tag for i in stack):
                while rows[stack[-1]][0] != tag:
                    close()
                close()
            elif tag in ("p", "br"):
                tokens.append(" ")
            continue
        if tag in ENDS_P:
            close_open(("p",), _LIMITS)
        elif tag in _SAME:
            close_open(_SAME[tag], _LIMITS)
        names = _names(found[3])
        rows.append([tag, names, stack[-1] if stack else -1, len(tokens), 0, 0])
        sums.append(xxhash.xxh64(f"{tag}|{names}".encode(errors="replace")))
        stack.append(len(rows) - 1)
        if tag in BLOCKS:
            tokens.append(None)
        elif tag in ("br", "td", "th"):
            tokens.append(" ")
        tokens.append(len(rows) - 1)
        if tag in VOID or (found[3] or "").endswith("/"):
            close()
        elif tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>|\\Z", re.I).search(page, at)
            sums[stack[-1]].update(page[at : stop.start()].encode(errors="replace"))
            at = stop.end()
            close()
    text(page[at:])
    while stack:
        close()
    return tokens, [Element(*row) for row in rows]
