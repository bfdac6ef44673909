"""Leaf blocks of a web page, with the elements that enclose them."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

#: Elements of HTML by what they do to the text around them.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = "script|style|noscript|template|textarea|title|iframe"
#: Hidden up to their closing tags; without one, or closed in the tag, only the tag itself is skipped.
DRAWN = frozenset("object svg canvas audio video".split())
CLOSES_P = BLOCK - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend", "figcaption", "summary"}
#: An opening tag that ends an open element of the same group, up to the container named last.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
KEEPS = frozenset("article aside body div footer form header main nav section table td th".split())

#: A comment ends at --> or --!>, and at once in <!--> and <!--->.
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\Z))"
_TOKEN = re.compile(
    rf"{COMMENT}|<(?P<raw>{HIDDEN})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*+[^>]*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)[^>]*+>|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_DRAWN = re.compile(rf"""{COMMENT}|<(?P<close>/?)(?P<name>{"|".join(sorted(DRAWN))})(?=[\s/>])(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S | re.I)
_VALUE_END = re.compile(r"""=\s*+[^\s"'>]+\Z""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN_ATTRIBUTE = re.compile(r"""(?:\s|^)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Block:
    """A run of text that no block element interrupts."""

    text: str
    path: tuple[str, ...]  # names, classes and ids of the enclosing elements, outermost first
    linked: int  # characters inside links


@dataclass(slots=True)
class _Open:
    name: str
    words: tuple[str, ...]


@dataclass(slots=True)
class _Page:
    stack: list[_Open] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)  # where in the stack each name stands
    words: Counter[str] = field(default_factory=Counter)  # of all open elements

    def path(self) -> tuple[str, ...]:
        """All words; those of elements far out, beyond 500, once each."""
        near = tuple(w for e in self.stack[-500:] for w in e.words)
        return near if len(self.stack) <= 500 else (*self.words, *near)

    def flush(self) -> None:
        if self.pieces:
            text = clean("".join(self.pieces))
            if text:
                self.blocks.append(Block(text, self.path(), len(clean("".join(self.linked)))))
            self.pieces, self.linked = [], []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        if self.places.get("a"):
            self.linked.append(text)

    def open(self, name: str, rest: str) -> None:
        if name in BLOCK:
            self.flush()
        if name in CLOSES_P:
            self.end({"p"}, KEEPS)
        if name in SIBLINGS:
            self.end(*SIBLINGS[name])
        if name == "br" and self.pieces:
            self.add(" ")
        if name not in VOID and not rest.endswith("/") or name in BLOCK - VOID:
            words = [name]
            if rest:
                for key, a, b, c in _ATTRIBUTE.findall(rest):
                    words += [f"{'role' if key.lower() == 'role' else ''}.{w}" for w in _NAME.findall((a or b or c).lower())]
                if _HIDDEN_ATTRIBUTE.search(rest):
                    words.append(".hidden")
            self.places.setdefault(name, []).append(len(self.stack))
            self.words.update(words)
            self.stack.append(_Open(name, tuple(words)))

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        if self.places.get(name):
            barrier = KEEPS - {name} if name not in KEEPS and name not in ("html",) else frozenset()
            self.end({name}, barrier)

    def end(self, names: set[str], barrier: frozenset[str] | set[str]) -> None:
        """Closes the innermost open element of ``names``, unless a barrier lies inside it."""
        i = self.innermost(names)
        if i < 0 or i < self.innermost(barrier):
            return
        if self.pieces and any(e.name in BLOCK for e in self.stack[i:]):
            self.flush()
        for e in reversed(self.stack[i:]):
            self.places[e.name].pop()
            for w in e.words:
                self.words[w] -= 1
                if not self.words[w]:
                    del self.words[w]
        del self.stack[i:]

    def innermost(self, names: Iterable[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)


def clean(text: str) -> str:
    """Character references decoded, white space runs as one space, trimmed."""
    return _SPACE.sub(" ", html.unescape(text)).strip()


def drawn_spans(page: str) -> dict[int, int]:
    """Where each drawn element that has a closing tag starts and ends."""
    spans: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    for tag in _DRAWN.finditer(page):
        if not tag["name"]:
            continue
        waiting = open_at.setdefault(tag["name"].lower(), [])
        if not tag["close"]:
            if not tag["rest"].endswith("/") or _VALUE_END.search(tag["rest"]):
                waiting.append(tag.start())
        elif waiting:
            spans[waiting.pop()] = tag.end()
    return spans


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; a page without text has none."""
    found = _Page()
    drawn: dict[int, int] | None = None
    at = 0
    while token := _TOKEN.search(page, at):
        if token.start() > at:
            found.add(page[at : token.start()])
        at = token.end()
        name = token["name"] or token["name2"]
        if name:
            name = name.lower()
            if token["close"] or token["close2"]:
                found.close(name)
            elif name in DRAWN:
                if drawn is None:
                    drawn = drawn_spans(page)
                at = drawn.get(token.start(), at)
            else:
                found.open(name, token["rest"] or "")
    if at < len(page):
        found.add(page[at:])
    found.flush()
    return found.blocks
