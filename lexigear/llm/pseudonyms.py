"""Format-preserving pseudonyms for personal data.

A value found in a text (card, phone, account, address, date, ...) is validated, turned
into its rank among all values of its format, moved by a keyed Feistel permutation of that
range, and written back in the same layout.  Equal values get equal pseudonyms in every
document, also when they are laid out differently; different values never share one.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable
from datetime import date
from functools import cache
from math import isqrt, prod
from string import ascii_lowercase, ascii_uppercase, digits

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10


def checked_key(key: bytes) -> bytes:
    """``key``, which must not be empty; blake2b takes 64 bytes at most."""
    if not key:
        raise ValueError("pseudonyms need a key")
    return key if len(key) <= 64 else hashlib.blake2b(key, digest_size=64).digest()


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """Image of ``value`` under a keyed permutation of range(size).

    A Feistel network over pairs (left, right) below the root of ``size``; values outside
    the range are moved on until they are inside.
    """
    side = isqrt(size - 1) + 1 if size > 1 else 1
    while True:
        left, right = divmod(value, side)
        for i in range(ROUNDS):
            digest = hashlib.blake2b(f"{tweak}:{size}:{i}:{right}".encode(), key=key, digest_size=32).digest()
            left, right = right, (left + int.from_bytes(digest, "big")) % side
        value = left * side + right
        if value < size:
            return value


def restore(value: int, size: int, key: bytes, tweak: str) -> int:
    """The value whose image is ``value``."""
    side = isqrt(size - 1) + 1 if size > 1 else 1
    while True:
        left, right = divmod(value, side)
        for i in reversed(range(ROUNDS)):
            digest = hashlib.blake2b(f"{tweak}:{size}:{i}:{left}".encode(), key=key, digest_size=32).digest()
            left, right = (right - int.from_bytes(digest, "big")) % side, left
        value = left * side + right
        if value < size:
            return value


Move = Callable[[int, int, str], int]  # value, size, tweak -> value


def refill(layout: str, figures: str) -> str:
    """``layout`` with its digits replaced in order."""
    it = iter(figures)
    return "".join(next(it) if c in digits else c for c in layout)


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in digits)


def luhn(figures: str) -> int:
    """The check digit that makes ``figures`` + it a valid card number."""
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(figures)))
    return -total % 10


def card(text: str, move: Move) -> str | None:
    n = only_digits(text)
    if not 13 <= len(n) <= 19 or n[0] not in "23456" or luhn(n[:-1]) != int(n[-1]):
        return None
    middle = move(int(n[1:-1]), 10 ** (len(n) - 2), f"card{n[0]}")
    moved = n[0] + str(middle).zfill(len(n) - 2)
    return refill(text, moved + str(luhn(moved)))


def phone(text: str, move: Move) -> str | None:
    n = only_digits(text)
    if not n:
        return None
    if text[0] == "+" and n[0] != "1":
        if not 8 <= len(n) <= 15:
            return None
        return refill(text, n[:2] + str(move(int(n[2:]), 10 ** (len(n) - 2), f"phone{n[:2]}")).zfill(len(n) - 2))
    lead, n = (n[:1], n[1:]) if len(n) == 11 and n[0] == "1" else ("", n)
    if len(n) != 10:
        return None
    if n[0] in "01" or n[3] in "01":
        # not in use by the numbering plan: only a leading + tells that it is meant as a number
        while text[0] == "+":
            n = str(move(int(n), 10**10, "phone1 unused")).zfill(10)
            if n[0] in "01" or n[3] in "01":
                return refill(text, lead + n)
        return None
    rank = ((int(n[:3]) - 200) * 800 + int(n[3:6]) - 200) * 10_000 + int(n[6:])
    rank, line = divmod(move(rank, 800 * 800 * 10_000, "phone1"), 10_000)
    area, exchange = divmod(rank, 800)
    return refill(text, f"{lead}{area + 200}{exchange + 200}{line:04d}")


def address(text: str, move: Move) -> str | None:
    """IPv4; 0.x and the ranges above 223 are no hosts and stay."""
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or not 1 <= parts[0] <= 223 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    rank = (parts[0] - 1) << 24 | parts[1] << 16 | parts[2] << 8 | parts[3]
    rank = move(rank, 223 << 24, "ip")
    return f"{(rank >> 24) + 1}.{rank >> 16 & 255}.{rank >> 8 & 255}.{rank & 255}"


def social(text: str, move: Move) -> str | None:
    area, group, serial = (int(p) for p in re.split("[- ]", text))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(move(rank, 898 * 99 * 9999, "ssn"), 9999)
    area, group = divmod(rank, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def mod97(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


#: The lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20,
}


def account(text: str, move: Move) -> tuple[str, int] | None:
    """IBAN: country and letters stay, digits move, the check digits follow.

    The candidate may have taken in what follows the number: its country tells where it
    ends, else the longest beginning that is valid.  Returned are the pseudonym and how
    many characters of the candidate it stands for.
    """
    places = [i for i, c in enumerate(text) if c != " "]
    country = text[:2]
    for length in [IBAN_LENGTHS[country]] if country in IBAN_LENGTHS else range(min(len(places), 34), 14, -1):
        if length > len(places):
            continue
        end = places[length - 1] + 1
        if end < len(text) and text[end] != " ":
            continue  # the number would end within a word
        plain = text[:end].replace(" ", "")
        check, rest = plain[2:4], plain[4:]
        n = only_digits(rest)
        if mod97(country, rest) != check or not n:
            continue
        rest = refill(rest, str(move(int(n), 10 ** len(n), f"iban{country}{re.sub('[0-9]', '0', rest)}")).zfill(len(n)))
        it = iter(country + mod97(country, rest) + rest)
        return "".join(c if c == " " else next(it) for c in text[:end]), end
    return None


FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
#: English month names.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def moved_day(y: int, m: int, d: int, move: Move) -> date | None:
    try:
        day = date(y, m, d).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    return date.fromordinal(FIRST_DAY + move(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))


def calendar(text: str, move: Move) -> str | None:
    """Dates from 1900 to 2099; day and month keep their order and padding.  Where both
    orders are valid, a day before its month is assumed, but for slashes the month first."""
    a, b, c = re.split("[-./]", text)
    if len(a) == 4:
        found, order = moved_day(int(a), int(b), int(c), move), "ymd"
    else:
        orders = ("mdy", "dmy") if "/" in text else ("dmy", "mdy")
        found, order = None, ""
        for order in orders:
            d, m = (int(a), int(b)) if order == "dmy" else (int(b), int(a))
            if found := moved_day(int(c), m, d, move):
                break
    if not found:
        return None
    mark = re.search("[-./]", text)[0]
    padded = all(len(p) > 1 for p in (a, b, c))
    parts = {"y": f"{found.year:04d}", "m": f"{found.month:02d}" if padded else str(found.month), "d": f"{found.day:02d}" if padded else str(found.day)}
    return mark.join(parts[p] for p in order)


def named_date(text: str, move: Move) -> str | None:
    """12 March 1980 and March 12, 1980, whole or three-letter names."""
    found = re.fullmatch(r"(?:(\d{1,2})( +))?([A-Za-z]+)(\.? +)(?:(\d{1,2})(,? +))?(\d{4})", text)
    name = found[3]
    month = next((i for i, m in enumerate(MONTHS, 1) if name.lower() in (m.lower(), m[:3].lower())), 0)
    if not month or (found[1] is None) == (found[5] is None):
        return None
    new = moved_day(int(found[7]), month, int(found[1] or found[5]), move)
    if not new:
        return None
    full = MONTHS[new.month - 1]
    word = full if len(name) > 3 or name.lower() == "may" else full[:3]
    word = word.upper() if name.isupper() else word.lower() if name.islower() else word
    if found[1]:
        return f"{new.day}{found[2]}{word}{found[4]}{new.year}"
    return f"{word}{found[4]}{new.day}{found[6]}{new.year}"


BLOCK_CHARS = 64  # the digest of a round covers both halves of such a block


def by_class(text: str, move: Move, tweak: str) -> str:
    """Permutes letters within their case and digits; blocks of 64 characters are one number
    in mixed radix each."""
    hexadecimal = len(text) >= 8 and re.fullmatch("[0-9a-f]+", text) is not None
    places = range(0, len(text), BLOCK_CHARS)
    return "".join(_block(text[at : at + BLOCK_CHARS], move, f"{tweak}{at}:" if at else tweak, hexadecimal) for at in places)


@cache
def alphabet(c: str) -> str:
    """The characters among which ``c`` moves: ASCII digits, letters of its case, or letters
    of the same kind in the same 256 places of Unicode; a mark stays."""
    for own in (digits, ascii_lowercase, ascii_uppercase):
        if c in own:
            return own
    kind = unicodedata.category(c)
    if kind[0] != "L" and kind != "Nd":
        return c
    first = ord(c) & ~0xFF
    return "".join(x for x in map(chr, range(first, first + 256)) if unicodedata.category(x) == kind and (first or not x.isascii()))


def _block(text: str, move: Move, tweak: str, hexadecimal: bool) -> str:
    sets = ["0123456789abcdef" if hexadecimal else alphabet(c) for c in text]
    value = 0
    for c, s in zip(text, sets):
        value = value * len(s) + s.index(c)
    shape = hashlib.blake2b("".join(s[0] for s in sets).encode(), digest_size=8).hexdigest()
    value = move(value, prod(len(s) for s in sets), f"{tweak}{shape}")
    out = []
    for s in reversed(sets):
        value, i = divmod(value, len(s))
        out.append(s[i])
    return "".join(reversed(out))


def mail(text: str, move: Move) -> str | None:
    """The local part moves; the domain stays."""
    local, _, domain = text.rpartition("@")
    return f"{by_class(local, move, 'mail')}@{domain}"


_SECRET = re.compile(r"""(.*?[:=]\s*["']?)([^\s"']+)""", re.S)
_TAIL = re.compile(r"""[^\w+/=]*\Z""")


def secret(text: str, move: Move) -> tuple[str, int] | None:
    """name=value: the value moves, up to a quote or white space; marks that end it, as those
    of a sentence do, are not part of it."""
    found = _SECRET.fullmatch(text)
    value = found[2][: _TAIL.search(found[2]).start()]
    if len(value) < LEAST_SECRET:
        return None
    return found[1] + by_class(value, move, "secret"), len(found[1]) + len(value)


def bare_key(text: str, move: Move) -> str | None:
    return text[:4] + by_class(text[4:], move, "key")


LEAST_SECRET = 6

#: Kind, how a candidate looks, and its validator: it gives the pseudonym, and where that may
#: be shorter than the candidate also the number of characters that it replaces.  The order
#: decides between overlapping kinds.
KINDS: list[tuple[str, str, Callable[[str, Move], str | tuple[str, int] | None]]] = [
    ("email", r"(?<![\w.%+\-])[\w.%+\-]++@(?:[\w\-]{1,63}\.)+[^\W\d_]{2,24}", mail),
    ("secret", r"""(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b["']?\s{0,3}[:=]\s{0,3}["']?)[^\s"']{6,}+""", secret),
    ("key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}+\b", bare_key),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,34}", account),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,5}(?:[ .\-]?\d{2,5}){1,4}(?![\w])", phone),
    ("date", r"(?<!\d)(?<!\d[.\-/])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d\-/]|\.\d)", calendar),
    ("date", r"\b(?i:\d{1,2} +(?:%s)\.? +\d{4}|(?:%s)\.? +\d{1,2},? +\d{4})\b" % ((names := "|".join(f"{m}|{m[:3]}" for m in MONTHS)), names), named_date),
    ("ssn", r"(?<!\d)(?<!\d-)\d{3}-\d{2}-\d{4}(?!\d|-\d)", social),
    ("card", r"(?<!\d)(?<!\d[.\-])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{4,5}|\d{13,19})(?!\d|-\d)", card),
    ("ip", r"(?<!\d)(?<!\d\.)\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)", address),
    ("phone", r"(?<![\w+\-])(?:1[ .\-])?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .\-])[2-9]\d{2}[ .\-]\d{4}(?![\w\-])", phone),
]
ANY = re.compile("|".join(f"(?P<k{i}>{pattern})" for i, (_, pattern, _) in enumerate(KINDS)))
HINT = re.compile(r"[0-9@=]")
_OTHER_DIGIT = re.compile(r"(?![0-9])\d")


def in_script(old: str, new: str) -> str:
    """``new`` with its digits in the script that ``old`` has at their places; where the
    layout has changed its length, in the first script other than ASCII."""
    if old.isascii():
        return new
    zeros = [ord(c) - unicodedata.decimal(c) if c.isdecimal() else 48 for c in old]
    if len(new) != len(old):
        zeros = [next((z for z in zeros if z != 48), 48)] * len(new)
    return "".join(chr(z + int(c)) if c in digits else c for c, z in zip(new, zeros))


def pseudonymize(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each in the new text.

    A candidate that no validator accepts stays as it is, and the search goes on behind
    its first character, so that a longer look-alike hides no value.  Decimal digits of any
    script count as digits, and stay in their script.
    """
    plain = text if text.isascii() else _OTHER_DIGIT.sub(lambda m: str(unicodedata.decimal(m[0])), text)
    if not HINT.search(plain):
        return text, []

    key = checked_key(key)

    def move(value: int, size: int, tweak: str) -> int:
        return permute(value, size, key, tweak)

    out: list[str] = []
    spans: list[tuple[int, int, str]] = []
    at = done = length = 0
    while found := ANY.search(plain, at):
        new = kind = None
        for i, (name, pattern, turn) in enumerate(KINDS):
            hit = found[0] if found.lastgroup == f"k{i}" else None
            if hit is None and (other := ALONE[i].match(plain, found.start())):
                hit = other[0]
            if hit is not None and (new := turn(hit, move)) is not None:
                new, used = new if isinstance(new, tuple) else (new, len(hit))
                kind, end = name, found.start() + used
                break
        if new is None:
            at = found.start() + 1
            continue
        new = in_script(text[found.start() : end], new)
        out += [text[done : found.start()], new]
        length += found.start() - done
        spans.append((length, length + len(new), kind))
        length += len(new)
        at = done = end
    out.append(text[done:])
    return "".join(out), spans


ALONE = [re.compile(pattern) for _, pattern, _ in KINDS]


def pseudonymized(column: Column | str, key: bytes) -> Column:
    """struct<text, spans>; a null text stays null, with no spans."""

    @F.arrow_udf("struct<text: string, spans: array<struct<start: int, end: int, kind: string>>>")
    def apply(column: pa.Array) -> pa.Array:
        rows = []
        for text in column.to_pylist():
            new, spans = (None, []) if text is None else pseudonymize(text, key)
            rows.append({"text": new, "spans": [{"start": a, "end": b, "kind": k} for a, b, k in spans]})
        return pa.array(rows, type=pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])))]))

    return apply(F.col(column) if isinstance(column, str) else column)


def pseudonymize_documents(docs: DataFrame, key: bytes, text_col: str = "text", spans: bool = False) -> DataFrame:
    """The same rows and columns with pseudonyms in ``text_col``; ``spans`` adds pii_spans.

    ``key`` decides the pseudonyms: whoever has it can undo them, so keep it secret.

    Only the text passes through Python, and each row is handled where it lies.
    """
    name = "done"
    while name in docs.columns:
        name += "_"
    done = docs.select("*", pseudonymized(docs[text_col].cast("string"), key).alias(name))
    kept = [F.col(f"{name}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*kept, *[F.col(f"{name}.spans").alias("pii_spans")] * spans)
