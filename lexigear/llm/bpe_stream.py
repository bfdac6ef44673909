"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a
state machine over bytes.

From the merge list follows how many further symbols can at most change a token
(``lookahead``).  The transducer keeps a window of symbols, and emits the tokens that end
that far before the end of what it has seen; so a word of any length takes constant memory.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexigear.llm.common import few, texts
from lexigear.llm.swap_packing import byte_alphabet

CACHED = 300_000  # entries of each memo of a task; a full one is emptied
CHUNK = 1 << 16  # characters of a text that are normalized and split at a time, more or less

#: White space, letters and numbers below U+0250 as the vocabulary file splits them.
WHITE = "\t-\r \x85\xa0"
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"


def lookahead(merges: list[tuple[str, str]], length: dict[str, int]) -> int:
    """Symbols beyond a token's end that must be known for the token to be certain.

    A token t is undone by a merge with what follows it, of lower rank than what t is
    needed for; that merge in turn needs its right part, and so on with ever lower ranks.
    Rules are taken by rank.  reach[t] is the furthest symbol beyond t that decides,
    under the rules so far, whether t stands: one that its formation depends on, or one of
    a merge that starts with t.
    """
    reach: dict[str, int] = {}
    for left, right in merges:
        whole = left + right
        after = reach.get(right, 0)
        formed = max(after, reach.get(left, 0) - length[right])
        reach[whole] = max(reach.get(whole, 0), formed)
        reach[left] = max(reach.get(left, 0), length[right] + after)
    return max(reach.values(), default=0)


NEVER = 1 << 30


class Vocabulary:
    """A byte-pair vocabulary file of the tokenizers library, with or without a suffix that
    marks the last symbol of a word."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in (self.vocab | self.special).items()}
        self.bytes_only = spec["decoder"] is not None
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.letters = byte_alphabet()
        symbols = [s for c in self.letters for s in (c, c + self.suffix)]
        length = dict.fromkeys(symbols, 1)
        for a, b in merges:
            length[a + b] = length[a] + length[b]
        # the last symbol of what was seen may still turn out to be the last of the word
        self.lookahead = lookahead(merges, length) + 1
        #: Rank of each pair of ids that merges, and the id it gives by rank.
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            self.rank.setdefault((self.vocab[a], self.vocab[b]), rank)
        self.merged = [self.vocab[a + b] for a, b in merges]
        self.size = {self.vocab[t]: n for t, n in length.items() if t in self.vocab}
        byte = {b: c for c, b in self.letters.items()}
        self.first = [self.vocab[byte[b]] for b in range(256)]
        self.last = [self.vocab[byte[b] + self.suffix] for b in range(256)]
        self.window = max(4 * self.lookahead, 64)
        self.decimal = [str(i) for i in range(max(self.text) + 1)]

    def merge(self, ids: list[int]) -> list[int]:
        """Merges pairs in a copy of ``ids``: always that of lowest rank, the first from the left."""
        ids, get = ids[:], self.rank.get
        ranks = [get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) != NEVER:
            i = ranks.index(rank)
            ids[i : i + 2] = [self.merged[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), NEVER)
        return ids


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Transducer from the bytes of one word to its ids, in any portions."""

    def __init__(self, vocab: Vocabulary, window: int | None = None) -> None:
        self.vocab = vocab
        self.window = window or vocab.window
        self.held: list[int] = []  # symbols that are not covered by an emitted token

    def feed(self, data: bytes) -> Iterator[int]:
        for at in range(0, len(data), self.window):
            self.held += [self.vocab.first[b] for b in data[at : at + self.window]]
            if len(self.held) > self.window:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        end = 0
        for token in self.vocab.merge(self.held):
            if end + self.vocab.size[token] > len(self.held) - self.vocab.lookahead:
                break
            end += self.vocab.size[token]
            yield token
        del self.held[:end]

    def finish(self) -> list[int]:
        """The ids of what is held, once the word has ended."""
        if self.vocab.suffix and self.held:
            self.held[-1] = self.vocab.last[self.vocab.first.index(self.held[-1])]
        held, self.held = self.held, []
        return self.vocab.merge(held)


def encode_word(vocab: Vocabulary, word: str | bytes) -> list[int]:
    """Ids of a whole word; one that the window holds needs no second look."""
    data = word.encode() if isinstance(word, str) else word
    if len(data) <= vocab.window:
        first = vocab.first
        ids = [first[b] for b in data]
        ids[-1] = vocab.last[data[-1]]
        return vocab.merge(ids)
    coder = Encoder(vocab)
    return [*coder.feed(data), *coder.finish()]


class Decoder:
    """State machine from ids to text.

    With a byte-level decoder in the vocabulary file, tokens are bytes, and the state is an
    incomplete character at their end.  Without one, tokens are written out with a space
    between, and the state is whether one has been written.
    """

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.begun = False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> Iterator[str]:
        for i in ids:
            token = self.vocab.text[i]
            if not self.vocab.bytes_only:
                yield " " + token if self.begun else token
                self.begun = True
            elif text := self.utf8.decode(token.encode() if token in self.vocab.special else bytes(map(self.vocab.letters.__getitem__, token))):
                yield text

    def finish(self) -> str:
        self.begun = False
        return self.utf8.decode(b"", True)


# ---------------------------------------------------------------- texts

_SPACES = re.compile(f"[{WHITE}]+")
_RARE = re.compile("[^\x00-ɏ]|İ")
_FAST = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^ {LETTERS}{NUMBERS}]+")
_CUT = re.compile("[ \n\t\r]")


def normalize(text: str) -> str:
    """White space runs as one space, lower case; for texts below U+0250, which compose
    nothing."""
    return _SPACES.sub(" ", text).lower()


def portions(text: str, size: int = CHUNK) -> Iterator[str]:
    """Cuts behind white space, where neither words nor composed characters go on; a word
    longer than ``size`` stays whole."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


class Coder:
    """Encodes texts and decodes their ids, with memos of bounded size."""

    def __init__(self, path: str) -> None:
        self.vocab = vocabulary(path)
        self.library = Tokenizer.from_file(path)  # its character tables split rarer letters
        self.special = re.compile("|".join(map(re.escape, self.vocab.special)))
        self.chunks: dict[str, tuple[str, str]] = {"": ("", "")}
        self.words: dict[str | bytes, list[int]] = {}
        self.decoder = Decoder(self.vocab)

    def word(self, word: str | bytes) -> list[int]:
        found = self.words.get(word)
        if found is None:
            found = encode_word(self.vocab, word)
            if len(word) <= 64:
                if len(self.words) >= CACHED:
                    self.words.clear()
                self.words[word] = found
        return found

    def chunk(self, chunk: str) -> tuple[str, str]:
        """Decimal ids and decoded text of normalized text without spaces, from the memo."""
        found = self.chunks.get(chunk)
        if found is None:
            found = self._coded([i for w in _FAST.findall(chunk) for i in self.word(w)])
            if len(chunk) <= 64:
                if len(self.chunks) >= CACHED:
                    self.chunks.clear()
                    self.chunks[""] = ("", "")
                self.chunks[chunk] = found
        return found

    def _coded(self, ids: list[int]) -> tuple[str, str]:
        decoded = "".join(self.decoder.feed(ids)) + self.decoder.finish()
        return " ".join(map(self.vocab.decimal.__getitem__, ids)), decoded

    def portion(self, text: str) -> tuple[str, str]:
        """Decimal ids and decoded text of a portion, each joined by one space."""
        if _RARE.search(text):
            words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return self._coded([i for w, _ in words for i in self.word(bytes(map(self.vocab.letters.__getitem__, w)))])
        found = [f for f in map(self.chunk, normalize(text).split(" ")) if f[0]]
        if not found:
            return "", ""
        ids, decoded = zip(*found)
        return " ".join(ids), " ".join(decoded)

    def code(self, text: str) -> Iterator[tuple[str, str]]:
        """(ids, decoded) of successive parts of a text, each joined by one space."""
        at = 0
        special = [(m.start(), m.end()) for m in self.special.finditer(text)] if self.vocab.special else []
        for start, end in [*special, (len(text), None)]:
            for portion in portions(text[at:start]):
                found = self.portion(portion)
                if found[0]:
                    yield found
            if end is not None:
                yield str(self.vocab.special[text[start:end]]), text[start:end]
                at = end

    def ids(self, text: str) -> list[int]:
        return [int(i) for part, _ in self.code(text) for i in part.split()]


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def code_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]): one row per row.

    Null text counts as empty: no ids, and the empty text back.  Digests are taken as the
    parts come, so that a long text's ids are held only where ``with_ids`` asks for them.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] * with_ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in few(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
                kept: list[tuple[str, str]] = []
                for ids, decoded in own.code(text):
                    ids_hash.update((" " + ids if n else ids).encode())
                    text_hash.update((" " + decoded if n else decoded).encode())
                    n += ids.count(" ") + 1
                    if with_ids:
                        kept.append((ids, decoded))
                row = (doc, n, ids_hash.hexdigest(), text_hash.hexdigest())
                rows.append((*row, [int(i) for p, _ in kept for i in p.split()], " ".join(d for _, d in kept)) if with_ids else row)
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r)) for r in rows], schema=arrow)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(work, schema)
