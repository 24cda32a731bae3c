"""Blocks of text of a web page, with the path of tags that leads to each."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Element names of HTML by the role they have here.
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead tr ul""".split()
)
#: Elements without an end tag.
VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements whose content is never text of the page; those of plain characters reach to the end of the page if unclosed.
PLAIN = frozenset("script style title textarea noscript iframe noembed noframes".split())
SKIPPED = PLAIN | frozenset("template svg select button object audio video canvas".split())
#: Start tags which end an open element of these names.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr",), "tbody": ("thead", "tbody"), "tfoot": ("tbody",),
}
#: Elements that no implied end reaches across.
WALLS = frozenset("article aside body div footer form header html li main nav ol section table td th ul".split())

#: A comment, a declaration, the name of a tag, or text; and the same where no more ``>`` comes.
SCAN_TAIL = re.compile(r"<!--.*|([^<]+|<)", re.DOTALL)
SCAN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|(<[!?])|<(/?)([a-zA-Z][^\s/>]*)|([^<]+|<)",
    re.DOTALL,
)
SPECIAL = re.compile("[>\"']")
TAGS = {name: re.compile(rf"<(/?){name}(?=[\s/>])", re.IGNORECASE) for name in SKIPPED - PLAIN}
ENDS_PLAIN = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in PLAIN}
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
PART = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    """A block of text.

    ``path`` has the distinct tags above it, outermost first, with their class, id and role
    names, however deep the block lies; ``inner`` is the innermost tag.
    """

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    links: int = 0
    rank: int = 0
    inner: str = ""


def names_of(attributes: str) -> tuple[str, ...]:
    """Words in the class, id and role of a tag, in lower case."""
    if "=" not in attributes:
        return ()
    found = (a or b or c for a, b, c in NAMES.findall(attributes))
    return tuple(word.lower() for value in found for word in PART.findall(value))


class TagEnds:
    """Where the tags of a page end, found forward, so that unclosed tags and quotes cost no second look.

    A tag ends at the first ``>`` outside quotes. What a scan without an end has passed has
    no end for a later scan either, and is remembered by the quotes it opened.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}
        self.hopeless: set[int] = set()
        self.since, self.special = 0, -1

    def _next(self, at: int) -> int:
        """The next ``>`` or quote from ``at`` on; -1 if no tag can end after it."""
        if at > self.last[">"]:
            return -1
        if not self.since <= at <= self.special:
            self.since, self.special = at, SPECIAL.search(self.html, at).start()
        return self.special

    def after(self, at: int) -> int:
        """The position after the tag whose attributes begin at ``at``, or -1 if it has no end."""
        opened = []
        while (at := self._next(at)) >= 0:
            mark = self.html[at]
            if mark == ">":
                return at + 1
            if at in self.hopeless:
                break
            opened.append(at)
            if at == self.last[mark]:
                break
            at = self.html.index(mark, at + 1) + 1
        self.hopeless.update(opened)
        return -1


def skips_of(html: str, name: str, ends: TagEnds) -> dict[int, int]:
    """Where the content of every closed element of that name begins, and where the element ends."""
    skips: dict[int, int] = {}
    begun: list[int] = []
    at = 0
    while tag := TAGS[name].search(html, at):
        at = ends.after(tag.end())
        if at < 0:
            at = tag.end()
        elif not tag[1]:
            if name != "svg" or html[at - 2] != "/":
                begun.append(at)
        elif begun:
            skips[begun.pop()] = at
    return skips


def blocks_of(html: str | None) -> list[Block]:
    """The blocks with text of a page in order; none for a null or empty page.

    Character references are decoded and white space, line breaks included, becomes one
    space. Comments and the elements of ``SKIPPED`` (scripts, styles, buttons, drawings
    and the like) hold no text, all others do, formulas and custom elements too. A
    self-closed drawing is empty; a skipped element that is never closed is skipped only
    if it is of plain characters. Unclosed and misplaced tags are put up with: an end tag
    closes the nearest open element of its name, and a start tag of a block closes an
    open paragraph. Nothing open is forgotten, however deep or unclosed.
    """
    stack: list[tuple[str, tuple[str, ...]]] = []
    # What is open, counted: paths of distinct tags cost the same at any depth, and blocks share them.
    above: dict[tuple[str, tuple[str, ...]], int] = {}
    names: Counter[str] = Counter()
    path: tuple | None = ()
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked, path
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                if path is None:
                    path = tuple(above)
                blocks.append(Block(text, path, linked, len(blocks), stack[-1][0] if stack else ""))
            pieces.clear()
        linked = 0

    def enter(tag: str, attributes: str) -> None:
        nonlocal path
        item = (tag, names_of(attributes))
        stack.append(item)
        names[tag] += 1
        if item in above:
            above[item] += 1
        else:
            above[item], path = 1, None

    def leave(position: int, end: int) -> None:
        nonlocal path
        for item in stack[position:end]:
            names[item[0]] -= 1
            above[item] -= 1
            if not above[item]:
                del above[item]
                path = None
        del stack[position:end]

    def close(position: int) -> None:
        flush()
        leave(position, len(stack))

    html = html or ""
    skips: dict[str, dict[int, int]] = {}
    ends = TagEnds(html)
    anchored = at = 0
    while at < len(html):
        if at > ends.last[">"]:
            declared = name = None
            match = SCAN_TAIL.match(html, at)
            text = match[1]
        else:
            match = SCAN.match(html, at)
            declared, end, name, text = match.groups()
        at = match.end()
        if declared or name is not None:
            # Quotes in a declaration mean nothing; a tag without an end is text.
            stop = (html.find(">", at) + 1 or -1 if at <= ends.last[">"] else -1) if declared else ends.after(at)
            if stop < 0:
                name, text, at = None, "<", match.start() + 1
            else:
                attributes, at = "" if declared else html[at : stop - 1], stop
        if text is not None:
            pieces.append(text)
            if anchored:
                linked += len(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if name in SKIPPED and not end:
            pieces.append(" ")
            if name in PLAIN:
                ended = ENDS_PLAIN[name].search(html, at)
                # Whatever stands in an end tag, its first > ends it.
                stop = html.find(">", ended.end()) if ended else -1
                at = stop + 1 if stop >= 0 else len(html)
                continue
            if name not in skips:
                skips[name] = skips_of(html, name, TagEnds(html))
            if at in skips[name]:
                at = skips[name][at]
                continue
        if name == "a":
            anchored = 0 if end else 1
        elif name == "br":
            pieces.append(" ")
        elif end:
            for position in range(len(stack) - 1, -1, -1) if names[name] else ():
                if stack[position][0] == name:
                    if name in BLOCK:
                        close(position)
                    else:
                        leave(position, position + 1)
                    break
        elif name in BLOCK:
            flush()
            targets = ENDS.get(name, ()) + (("p",) if name not in ("caption", "option") else ())
            for position in range(len(stack) - 1, -1, -1) if any(names[t] for t in targets) else ():
                if stack[position][0] in targets:
                    close(position)
                    break
                if stack[position][0] in WALLS:
                    break
            if name not in VOID:
                enter(name, attributes)
        elif name not in VOID and not attributes.endswith("/"):
            enter(name, attributes)
    flush()
    return blocks
