"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Each block is main text or not.  Features come from its enclosing elements and its text;
weights of features and of label transitions are trained on labelled pages by the gradient
of their likelihood (forward-backward), and a page is decoded by Viterbi.
"""

from __future__ import annotations

import random
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.llm.common import few, texts
from lexigear.llm.html_blocks import Block, blocks

OTHER, MAIN = 0, 1
PAGES = 1_200  # labelled pages that the model is trained on
EPOCHS = 5
LEAST_PAGES = 3  # pages that a feature is on to get a weight
PATHS_HELD = 10_000  # scores of enclosing elements that a task keeps

# ---------------------------------------------------------------- features

#: Elements that say what their content is.
TELLING = frozenset("article aside details dialog fieldset figure footer form header main nav section table".split())


@lru_cache(maxsize=20_000)
def pieces(word: str) -> tuple[str, ...]:
    """A class or id in pieces, which names that training has not seen share with others:
    the whole, its beginnings, and its runs of three characters."""
    name = f"^{word[1:]}$"
    return (word, *(f"{name[:n]}*" for n in (4, 5, 7) if n < len(name) - 1), *(name[i : i + 3] for i in range(len(name) - 2)))


def elements(path: tuple[str, ...]) -> list[tuple[str, list[str]]]:
    """(tag, its classes, ids and roles) of each enclosing element, outermost first."""
    found: list[tuple[str, list[str]]] = []
    for w in path:
        if w[0] == "." or w.startswith("role."):
            found[-1][1].append(w)
        else:
            found.append((w, []))
    return found


@lru_cache(maxsize=2_000)
def path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    """What the enclosing elements say: each of their names anywhere around, and again those
    of the nearest two elements that are named or telling, since a form in an article is one
    thing and an article in a form another."""
    own = elements(path)
    found = ["bias", *{f"in {w}" for w in path if w[0] != "."}]
    for word in {w for w in path if w[0] == "."}:
        found += [f"in {p}" for p in pieces(word)]
    tags = [tag for tag, _ in own]
    found.append(f"leaf {tags[-1] if tags else ''}")
    found.append(f"pair {' '.join(tags[-2:])}")
    near = [(tag, words) for tag, words in reversed(own) if words or tag in TELLING][:2]
    for place, (tag, words) in enumerate(near):
        if tag in TELLING:
            found.append(f"near{place} {tag}")
        for word in words:
            found += [f"near{place} {p}" for p in pieces(word)]
    found.append(f"telling {' '.join([tag for tag in tags if tag in TELLING][-2:])}")
    return tuple(found)


def text_features(block: Block, first: bool, last: bool) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    found = [f"words {min(words.bit_length(), 8)}"]
    share = block.linked / len(text)
    found.append(f"links {0 if share == 0 else 1 if share < 0.34 else 2 if share < 0.8 else 3}")
    found.append(f"end {text[-1] if text[-1] in '.!?:…' else ''}")
    found.append(f"sentences {min(text.count('. ') + text.count('? ') + text.count('! '), 3)}")
    if "©" in text:
        found.append("mark")
    return found + ["first"] * first + ["last"] * last


def features(block: Block, first: bool, last: bool) -> list[str]:
    """Names of the features that a block has; a piece that several names share counts often."""
    return [*path_features(block.path), *text_features(block, first, last)]


def page_features(found: list[Block]) -> list[list[str]]:
    return [features(b, i == 0, i == len(found) - 1) for i, b in enumerate(found)]


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    """Scores by feature and label, of label pairs, and of labels at the start."""

    index: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray
    start: np.ndarray
    around: dict[tuple[str, ...], list[float]] = field(default_factory=dict, repr=False)  # scores of paths met lately

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        """(block, label) scores; features that training has not seen count nothing."""
        get = self.index.get
        return np.stack([self.weights[[i for i in map(get, row) if i is not None]].sum(axis=0) for row in rows])

    def page_emissions(self, found: list[Block]) -> list[list[float]]:
        """``emissions`` of a page's blocks, whose elements other blocks and pages share."""
        out = []
        for i, b in enumerate(found):
            around = self.around.get(b.path)
            if around is None:
                if len(self.around) >= PATHS_HELD:
                    self.around.clear()
                around = self.around[b.path] = self.emissions([path_features(b.path)])[0].tolist()
            x, y = around
            for name in text_features(b, i == 0, i == len(found) - 1):
                at = self.index.get(name)
                if at is not None:
                    x, y = x + self.weights[at, 0], y + self.weights[at, 1]
            out.append([float(x), float(y)])
        return out

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The most likely labels (Viterbi); ties go to OTHER."""
        return self.viterbi(self.emissions(rows).tolist()) if rows else []

    def viterbi(self, score: list[list[float]]) -> list[int]:
        if not score:
            return []
        (aa, ab), (ba, bb) = self.pairs.tolist()
        a, b = score[0][0] + self.start[0], score[0][1] + self.start[1]
        back = []
        for x, y in score[1:]:
            back.append((a + aa < b + ba, a + ab < b + bb))
            a, b = max(a + aa, b + ba) + x, max(a + ab, b + bb) + y
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(score: np.ndarray, pairs: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chances of labels and of label pairs, and the log of the sum over all labellings."""
    n = len(score)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = start + score[0]
    for t in range(1, n):
        ahead[t] = _log_sum(ahead[t - 1][:, None] + pairs, 0) + score[t]
    for t in range(n - 2, -1, -1):
        behind[t] = _log_sum(pairs + (score[t + 1] + behind[t + 1])[None, :], 1)
    total = float(_log_sum(ahead[-1], 0))
    single = np.exp(ahead + behind - total)
    double = np.exp(ahead[:-1, :, None] + pairs[None] + (score[1:] + behind[1:])[:, None, :] - total).sum(axis=0) if n > 1 else np.zeros((2, 2))
    return single, double, total


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Adaptive gradient steps on the likelihood of labelled pages, one page at a time."""
    on = Counter(name for rows, _ in pages for name in {name for row in rows for name in row})
    index = {name: i for i, name in enumerate(name for name, n in on.items() if n >= min(LEAST_PAGES, len(pages)))}
    model = Field(index, np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2))
    squares = [np.full(x.shape, 1e-6) for x in (model.weights, model.pairs, model.start)]
    order = random.Random(5)
    ids = [([[index[n] for n in row if n in index] for row in rows], np.array(labels)) for rows, labels in pages if rows]
    for _ in range(epochs):
        order.shuffle(ids)
        for rows, labels in ids:
            score = np.stack([model.weights[row].sum(axis=0) for row in rows])
            single, double, _ = marginals(score, model.pairs, model.start)
            truth = np.eye(2)[labels]
            flat = np.concatenate([np.array(row) for row in rows])
            each = np.repeat(single - truth, [len(row) for row in rows], axis=0)
            used, place = np.unique(flat, return_inverse=True)
            slope = np.zeros((len(used), 2))
            np.add.at(slope, place, each)
            slope += decay * model.weights[used]
            squares[0][used] += slope**2
            model.weights[used] -= rate * slope / np.sqrt(squares[0][used])
            seen = np.zeros((2, 2))
            for a, b in pairwise(labels):
                seen[a, b] += 1
            for x, g, s in ((model.pairs, double - seen, squares[1]), (model.start, single[0] - truth[0], squares[2])):
                s += g**2
                x -= rate * g / np.sqrt(s)
    return model


# ---------------------------------------------------------------- labelled pages


#: Stems of the names that pages give to their parts; ``Names`` makes names of them.
MAIN_NAMES = "content article entry post story maintext body main copy prose richtext markdown editorial document column blogpost news reading".split()
OTHER_NAMES = {
    "comments": "comment comments respond response reply replies discussion disqus thread talkback feedback review reviews guestbook opinion".split(),
    "adverts": "ad ads advert advertisement adsense adslot sponsor sponsored promo promotion banner commercial affiliate outbrain taboola".split(),
    "forms": "form newsletter subscribe signup login register search contact poll survey mailing optin".split(),
    "menus": "nav menu navbar navigation topnav breadcrumb breadcrumbs pager pagination tabs toolbar links sitemap".split(),
    "headers": "header masthead topbar logo branding sitetitle hero".split(),
    "footers": "footer colophon bottom copyright legal imprint credits".split(),
    "sidebars": "sidebar aside rail secondary widget widgets related recommended trending popular teaser latest".split(),
    "notices": "notice cookie cookies consent gdpr alert message modal popup overlay toast warning paywall announcement privacy".split(),
    "shares": "share social sharing follow tags meta rating print".split(),
}
BEFORE = ["", "", "", "", "site", "page", "block", "js", "c", "the", "my", "post", "article", "entry", "main", "content", "user", "wp"]
BEHIND = ["", "", "", "", "s", "list", "wrap", "wrapper", "box", "area", "section", "container", "inner", "item", "body", "content", "text", "title", "holder", "zone", "panel", "region", "group", "module", "top", "1", "2"]
PLAIN = ["container", "row", "wrapper", "inner", "clearfix", "col", "col-md-8", "mt-4", "grid", "box", "section", "wrap", "page", "site", "left", "right"]
ELEMENTS = {"comments": ["div", "div", "section", "ol", "ul"], "forms": ["div", "form", "form", "section"], "menus": ["nav", "div", "ul"], "headers": ["header", "div"], "footers": ["footer", "div"], "sidebars": ["aside", "div", "section"]}


class Names:
    """Class and id attributes made of stems; of all names that can be made, one in four is
    held out, and given only if ``held_out``."""

    def __init__(self, r: random.Random, held_out: bool):
        self.r, self.held_out = r, held_out

    def name(self, stem: str, own: bool = False) -> str:
        """A stem with something before or behind it; a main part's own has no other part's."""
        r = self.r
        for _ in range(50):
            joint = r.choice(("-", "-", "_", ""))
            before, behind = r.choice(BEFORE[:9] if own else BEFORE), r.choice(BEHIND)
            name = joint.join(x for x in (before, stem, behind) if x)
            if own and joint == "" and (before or behind):
                continue
            if (zlib.crc32(name.encode()) % 4 == 0) is self.held_out:
                return name
        return stem

    def noise(self) -> str:
        return self.r.choice((f"x{self.r.getrandbits(24):06x}", f"css-{self.r.getrandbits(20):x}", self.r.choice(PLAIN), self.r.choice(PLAIN)))

    def attribute(self, stem: str, own: bool = False) -> str:
        r = self.r
        if r.random() < 0.2:
            return f' id="{self.name(stem, own)}"'
        words = [self.name(stem, own)] + [self.noise() for _ in range(r.choice((0, 0, 1, 2)))]
        r.shuffle(words)
        return f' class="{" ".join(words)}"'


class Writer:
    """Writes pages of varied make-up whose blocks' labels are known.

    Words are random syllables, so that only elements, names and the shape of texts can be
    learnt.  Main text sits in an article, a main element or a division with a usual name;
    around it and in it stand the usual other parts, whose texts may be prose as well.
    """

    SYLLABLES = "ba re mi to lu sen dor ka vi na po el un ter as ion gel hu wi ost ur ma".split()

    def __init__(self, seed: int, held_out: bool = False) -> None:
        self.r = random.Random(seed)
        self.names = Names(self.r, held_out)
        self.out: list[str] = []
        self.labels: list[int] = []

    def word(self) -> str:
        return "".join(self.r.choices(self.SYLLABLES, k=self.r.randint(1, 4)))

    def sentence(self, most: int = 18) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(1, most))).capitalize() + self.r.choices(".?!", (8, 1, 1))[0]

    def prose(self, most: int = 8) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.randint(1, most)))
        odd = self.r.random()  # poor texts are texts as well
        if odd < 0.04:
            return text.upper()
        if odd < 0.12:
            return self.r.choice((" | ", "*** ", " » ", ", ")).join(text.split())
        return f"© {self.word()} {text}" if odd < 0.15 else text

    def put(self, markup: str, label: int) -> None:
        """Markup that holds exactly one block."""
        self.out.append(markup)
        self.labels.append(label)

    def paragraphs(self, label: int, most: int) -> None:
        for _ in range(self.r.randint(1, most)):
            self.put(self.r.choice(("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", f'<div class="{self.names.noise()}">{{}}</div>')).format(self.prose(10)), label)

    def opening(self) -> tuple[str, str, str]:
        """(kind, tag, attributes) of a part that is not main text."""
        kind = self.r.choice([*OTHER_NAMES, "comments", "adverts", "forms"])
        tag = self.r.choice(ELEMENTS.get(kind, ["div", "div", "section"]))
        bare = tag in ("nav", "form", "aside", "footer", "header") and self.r.random() < 0.5
        if kind == "notices" and self.r.random() < 0.15:
            return kind, tag, ' role="alert"'
        return kind, tag, "" if bare else self.names.attribute(self.r.choice(OTHER_NAMES[kind]))

    def other(self) -> None:
        """A part that is not main text, with items of the usual kinds in any of them."""
        kind, tag, attributes = self.opening()
        self.out.append(f"<{tag}{attributes}>")
        nested = self.r.random() < 0.25 and tag not in ("ul", "ol")
        if nested:
            self.out.append(f'<div class="{self.r.choice((self.names.noise(), self.r.choice(BEHIND[4:])))}">')
        if kind == "comments" and self.r.random() < 0.7:
            self.thread(tag)
        elif kind == "forms" and self.r.random() < 0.6:
            if self.r.random() < 0.5:
                self.paragraphs(OTHER, 2)
            self.put(f"<p><label>{self.word()} <input name='q'></label> <button>{self.word()}</button></p>", OTHER)
        elif tag in ("ul", "ol"):
            self.items()
        else:
            shape = self.r.choice(("list", "text", "text", "mixed", "prose"))
            if shape == "list":
                self.out.append("<ul>")
                self.items()
                self.out.append("</ul>")
            elif shape == "text":
                text = self.r.choice((self.prose(3), self.sentence(6), f"&copy; {self.word()} &middot; {self.sentence(8)}", self.prose(8)))
                self.put(text if self.r.random() < 0.6 else f"<p>{text}</p>", OTHER)
            elif shape == "prose":
                self.paragraphs(OTHER, 4)
            else:
                if self.r.random() < 0.6:
                    self.put(f"<h{(n := self.r.randint(2, 4))}>{self.sentence(4)}</h{n}>", OTHER)
                for _ in range(self.r.randint(1, 4)):
                    self.put(self.r.choice(("<p>{}</p>", "<div>{}</div>", '<div class="item">{}</div>', "<p><a href='#'>{}</a></p>")).format(self.r.choice((self.prose(6), self.sentence()))), OTHER)
        self.out.append("</div>" * nested + f"</{tag}>")

    def items(self) -> None:
        for _ in range(self.r.randint(1, 7)):
            link = f'<a href="/{self.word()}">{self.word()}</a>'
            self.put(f"<li>{link if self.r.random() < 0.9 else self.word()}</li>", OTHER)

    def thread(self, tag: str) -> None:
        """Comments of readers, prose in elements of their own."""
        if tag not in ("ul", "ol") and self.r.random() < 0.6:
            self.put(f"<h3>{self.r.randint(1, 99)} {self.sentence(3)}</h3>", OTHER)
        item = "li" if tag in ("ul", "ol") else "div"
        for _ in range(self.r.randint(1, 4)):
            stem = self.r.choice(OTHER_NAMES["comments"])
            self.out.append(f"<{item}{self.names.attribute(stem) if self.r.random() < 0.8 else ''}>")
            if self.r.random() < 0.6:
                self.put(f"<div class='{self.r.choice(('meta', 'author', 'byline', 'date'))}'>{self.word()} {self.word()}</div>", OTHER)
            inner = self.r.choice(("", f' class="{stem}-body"', f' class="{stem}-{self.r.choice(BEHIND[4:])}"', f' class="{self.r.choice(("body", "text", "content"))}"'))
            self.out.append(f"<div{inner}>")
            self.paragraphs(OTHER, 3)
            self.out.append(f"</div></{item}>")

    def body(self) -> None:
        r = self.r
        tag, attributes = r.choice((("article", ""), ("article", ""), ("main", ""), ("article", None), ("main", None), ("div", None), ("div", None), ("section", None)))
        if attributes is None:
            attributes = self.names.attribute(r.choice(MAIN_NAMES), own=True)
        self.out.append(f"<{tag}{attributes}>")
        inner = r.random() < 0.25
        if inner:
            self.out.append(f'<div class="{r.choice((self.names.noise(), self.names.name(r.choice(MAIN_NAMES), own=True)))}">')
        if r.random() < 0.8:
            title = f"<h1>{self.sentence(10)}</h1>"
            self.put(title if r.random() < 0.8 else f"<h1 class='{r.choice(('title', 'headline', 'entry-title', 'post-title'))}'>{self.sentence(10)}</h1>", MAIN)
        for _ in range(r.choice((1, 2, 4, 8, 14))):
            kind = r.random()
            if kind < 0.6:
                text = self.prose(10) if r.random() < 0.8 else self.sentence(3)
                self.put(r.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}<br></p>", f"<p class='{self.names.noise()}'>{{}}</p>", "<p>{} <a href='/x'>" + self.word() + "</a> " + self.word() + "</p>")).format(text), MAIN)
                if self.out[-1].startswith("<p>") and not self.out[-1].endswith("</p>"):
                    self.out.append("<p>")
            elif kind < 0.7:
                self.put(f"<h{(n := r.randint(2, 4))}>{self.sentence(6)}</h{n}>", MAIN)
            elif kind < 0.78:
                self.out.append(f"<{(t := r.choice(('ul', 'ol')))}>")
                for _ in range(r.randint(1, 5)):
                    self.put(f"<li>{self.sentence(12)}</li>", MAIN)
                self.out.append(f"</{t}>")
            elif kind < 0.84:
                self.put(r.choice(("<blockquote>{}</blockquote>", "<pre>{}</pre>", "<blockquote><p>{}</p></blockquote>", "<figure><figcaption>{}</figcaption></figure>", "<table><tr><td>{}</td></tr></table>", "<section><p>{}</p></section>")).format(self.prose(3)), MAIN)
            elif kind < 0.94:
                self.other()
            else:
                self.put(f"<p>{self.word()} <em>{self.word()}</em> {self.prose(4)}</p>", MAIN)
        self.out.append("</div>" * inner + f"</{tag}>")

    def page(self) -> tuple[str, list[int]]:
        r = self.r
        self.out.append(f"<!DOCTYPE html><html><head><title>{self.sentence()}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>")
        around = []
        if r.random() < 0.1:  # a form round the whole page
            around.append(r.choice(("<form>", '<form id="aspnetForm">', '<form id="form1" method="post">', f'<form id="{self.names.noise()}">')))
        if r.random() < 0.35:
            around.append(r.choice(('<div class="page">', '<div id="wrapper">', '<div class="container">', f'<div class="{self.names.noise()}">')))
        self.out += around
        for _ in range(r.randint(0, 4)):
            self.other()
        if r.random() < 0.96:
            self.body()
        for _ in range(r.randint(0, 4)):
            self.other()
        self.out += [f"</{a[1:].split()[0].rstrip('>')}>" for a in reversed(around)]
        self.out.append("</body></html>")
        return "".join(self.out), self.labels


def labelled(count: int = PAGES, seed: int = 1, held_out: bool = False) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of ``count`` written pages; ``held_out`` ones share no made name with
    others."""
    found = []
    for i in range(count):
        page, labels = Writer(seed * 1_000_003 + i, held_out).page()
        cut = blocks(page)
        if len(cut) != len(labels):
            raise ValueError("a written page was cut otherwise than it was labelled")
        found.append((cut, labels))
    return found


@cache
def default_field() -> Field:
    return train([(page_features(b), y) for b, y in labelled()])


# ---------------------------------------------------------------- the operator


def main_blocks(page: str, model: Field) -> list[str]:
    found = blocks(page)
    return [b.text for b, label in zip(found, model.viterbi(model.page_emissions(found))) if label == MAIN]


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): one row per page.

    Blocks of main text are joined by an empty line; a null or empty page gives the empty
    text.  The field is small (a few thousand weights) and goes with the tasks.
    """
    model = field or default_field()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            found = ["\n\n".join(main_blocks(h, model)) for h in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return narrow.mapInArrow(work, "page_id long, url string, text string, n_chars long")
