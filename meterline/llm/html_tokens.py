"""A page as tokens that know their place, and as blocks of visible text.

Tags and words are tokens. A token is told by the path of block elements around it (a hash of
their names, classes and ids), so that the same word in a menu and in an article are two tokens:
a word is a pair of path and word, a tag a hash of path and tag. End tags that pages leave out
(p, li, cells) are implied as browsers imply them.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from dataclasses import dataclass

import xxhash

#: Elements by their role in HTML.
BLOCK = frozenset(
    "address article aside blockquote body br button canvas caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav "
    "noscript ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead "
    "title tr ul video audio object".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
#: Elements that never hold main text.
ASIDE = frozenset(
    "aside audio button canvas dialog footer form head iframe menu nav noscript object script search select style svg "
    "template textarea title video".split()
)
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
MAIN_ROLES = frozenset("article main".split())
#: Words in a class or id that name what is not main text, and those that name readers' comments.
ASIDE_WORDS = frozenset(
    "ad ads adbox adslot adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related reply "
    "replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar "
    "widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
#: Elements closed by the start of another one, up to the elements that hold them.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
HOLDS_P = frozenset("button caption html object table td th".split())
CLOSES_P = BLOCK - frozenset("body br button canvas caption head html iframe noscript object optgroup option select tbody td template textarea tfoot th thead title tr video audio legend".split())

_WHOLE, _HALF = (1 << 64) - 1, 1 << 63
_PIECE = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|(?P<text>[^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOLD = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_LETTERS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass(slots=True)
class Block:
    """Visible text between two block tags; its numbers are first..last-1 of those taken."""

    text: str
    first: int
    last: int
    main: bool
    heading: bool
    words: int
    linked: int


@dataclass(slots=True, eq=False)
class _Open:
    """An open element; shared by all that are alike, so it is never changed."""

    name: str
    path: int
    end: int
    dropped: bool
    comment: bool
    main: bool
    heading: bool


def told(name: str, rest: str) -> tuple[str, bool, bool, bool]:
    """Of a start tag: its signature, and whether it is no main text, comments, or main text."""
    aside, main, comment = name in ASIDE, name in ("article", "main"), False
    if not rest or not _TOLD.search(rest):
        return name, aside, comment, main
    attributes = {}
    for key, value in _ATTRIBUTE.findall(rest):
        attributes.setdefault(key.lower(), references.unescape(value.strip("\"'")))
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    signature = re.sub(r"\d+", "#", " ".join([name, *named]))
    role = attributes.get("role", "").strip().lower()
    main |= role in MAIN_ROLES or attributes.get("itemprop", "").strip().lower() == "articlebody"
    aside |= role in ASIDE_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    aside |= "display:none" in attributes.get("style", "").replace(" ", "").lower()
    if name not in ("html", "body"):
        # "with-sidebar" tells of the page around, not of this element.
        of = [x for x in named if x.split("-")[0].lower() not in ("has", "is", "no", "with")]
        words = {w.lower() for x in of for w in _LETTERS.findall(x)}
        comment = bool(words & COMMENT_WORDS)
        aside |= comment or (not main and bool(words & ASIDE_WORDS))
    return signature, aside, comment, main


class Distinct:
    """Takes a page's tokens, each once."""

    def __init__(self):
        self.numbers: list[int] = []
        self.tags: set[int] = set()
        self.words: dict[int, set[str]] = defaultdict(set)

    def tag(self, token: int) -> None:
        self.tags.add(token)

    def text(self, path: int, words: list[str]) -> None:
        self.words[path].update(words)


class Known:
    """Takes the numbers of those tokens that are in a list, in the page's order."""

    def __init__(self, tokens: list[tuple[int, str | None]]):
        self.numbers: list[int] = []
        self._tags = {token: k for k, (token, word) in enumerate(tokens) if word is None}
        self._words: dict[int, dict[str, int]] = defaultdict(dict)
        for k, (path, word) in enumerate(tokens):
            if word is not None:
                self._words[path][word] = k

    def tag(self, token: int) -> None:
        k = self._tags.get(token)
        if k is not None:
            self.numbers.append(k)

    def text(self, path: int, words: list[str]) -> None:
        known = self._words.get(path)
        if known:
            self.numbers += [k for k in map(known.get, words) if k is not None]


def _hash(text: str, path: int) -> int:
    """64 bits with a sign, as Spark's longs."""
    return xxhash.xxh64_intdigest(text, path & _WHOLE) - _HALF


_ROOT = _Open("", 0, 0, False, False, False, False)
#: Of a start tag (or the name of one that tells no more) in an open element: its token and the
#: element it opens. Pages of a site repeat them; forgotten when there are ``MOST``, and tags of more
#: than ``LONG`` characters are not kept.
_STARTED: dict[tuple[str, _Open], tuple[int, _Open]] = {}
MOST, LONG = 1 << 16, 256


def _started(tag: str, name: str, rest: str, above: _Open) -> tuple[int, _Open]:
    """What ``_STARTED`` holds of a start tag inside ``above``, put there where it is missing."""
    plain = not rest or not _TOLD.search(rest)
    key = (name if plain else tag), above
    found = _STARTED.get(key)
    if found is None:
        signature, aside, comment, main = told(name, rest)
        path = _hash(signature, above.path) if name in BLOCK else above.path
        comment |= above.comment
        inside = main or above.main
        # A page's header is not main text; an article's own holds its headline.
        aside |= name == "header" and not inside
        # A main element inside a badly named wrapper counts; one among comments does not.
        dropped = aside or (above.dropped and not (main and not comment))
        heading = above.heading or name in ("h1", "h2")
        opened = _Open(name, path, _hash("/" + name, path), dropped, comment, inside, heading)
        if len(_STARTED) >= MOST:
            _STARTED.clear()
        found = _hash("<" + signature, above.path), opened
        if len(key[0]) <= LONG:
            _STARTED[key] = found
    return found


def read(page: str, taker: Distinct | Known) -> list[Block]:
    """Gives a page's tokens to ``taker``, and returns its blocks that may hold main text."""
    numbers, on_tag, on_text = taker.numbers, taker.tag, taker.text
    blocks: list[Block] = []
    parts: list[str] = []
    stack = [_ROOT]
    first = words_in = linked = 0
    links, paragraphs, in_main, heading = 0, 0, False, False
    at, n, match, started = 0, len(page), _PIECE.match, _STARTED.get

    def finish() -> None:
        nonlocal first, words_in, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, first, len(numbers), in_main, heading, words_in, linked))
            parts.clear()
        first, words_in, linked = len(numbers), 0, 0

    def close(i: int) -> None:
        nonlocal links, paragraphs
        for o in stack[i:]:
            if o.name == "a":
                links -= 1
            elif o.name == "p":
                paragraphs -= 1
        del stack[i:]

    while at < n:
        piece = match(page, at)
        at = piece.end()
        kind = piece.lastgroup
        if kind == "text":
            text = piece[0]
            top = stack[-1]
            if "&" in text:
                text = references.unescape(text)
            words = text.split()
            if not top.dropped:
                if not parts:
                    in_main, heading = top.main, top.heading
                parts.append(text)
                words_in += len(words)
                linked += len(words) if links else 0
            if words:
                on_text(top.path, words)
            continue
        if kind is None:
            continue  # a comment or a declaration
        slash, name, rest = piece.group("end", "name", "rest") if kind == "rest" else piece.group("end2", "name2", "rest2")
        name = name.lower()
        if slash:
            if name in BLOCK:
                if parts:
                    finish()
                first = len(numbers)
            top = stack[-1]
            if top.name == name:
                on_tag(top.end)
                stack.pop()
                links -= name == "a"
                paragraphs -= name == "p"
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    on_tag(stack[i].end)
                    close(i)
                    break
                if name not in BLOCK and stack[i].name in BLOCK:
                    break
            continue
        if name in BLOCK:
            if parts:
                finish()
            first = len(numbers)
            if paragraphs and name in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == "p":
                        close(i)
                        break
                    if stack[i].name in HOLDS_P:
                        break
            if name in CLOSED_BY:
                same, holders = CLOSED_BY[name]
                lowest = 0
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in same:
                        lowest = i
                    elif stack[i].name in holders:
                        break
                if lowest:
                    close(lowest)
        elif name == "a" and links:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "a":
                    close(i)
                    break
        above = stack[-1]
        tag = piece[0]
        token, opened = started((tag, above)) or _started(tag, name, rest, above)
        on_tag(token)
        if name in VOID:
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else n
            if name == "textarea" or end is None:
                continue
        stack.append(opened)
        paragraphs += name == "p"
        links += name == "a"
        first = len(numbers) if name in BLOCK else first
    finish()
    return blocks
