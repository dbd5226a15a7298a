"""Pseudonyms for personal data by format-preserving Feistel permutation.

A value that passes its kind's check is read as a number in mixed radix (a digit has ten values, a letter 26, an
address 2 ** 32, a day its place in the calendar), permuted with a key inside exactly that range, and written back in
the layout it had. Check digits are worked out anew, so a card stays a valid card and a date a valid date. A value
always has the same pseudonym, whatever its layout, so documents stay linked; the key holder can turn it back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import text_batches

ROUNDS = 10
KINDS = ("email", "iban", "address", "ssn", "date", "card", "phone", "secret")
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def permuted(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size): a Feistel network on the next even number of bits, walked along its cycle
    until it is inside the range."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low, octets = (1 << half) - 1, (half + 7) // 8
    mark = f"{tweak}/{size}".encode()

    def scramble(i: int, x: int) -> int:
        out, block = b"", 0
        while len(out) < octets:
            data = bytes([i, block & 0xFF]) + x.to_bytes(octets, "big") + mark
            out += hashlib.blake2b(data, key=key, digest_size=min(64, octets)).digest()
            block += 1
        return int.from_bytes(out[:octets], "big") & low

    while True:
        left, right = value >> half, value & low
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ scramble(i, left), left
            else:
                left, right = right, left ^ scramble(i, right)
        value = left << half | right
        if value < size:
            return value


def _alphabet(c: str) -> str:
    return next((a for a in (DIGITS, LOWER, UPPER) if c in a), c)


def _by_class(text: str, key: bytes, tweak: str, back: bool, alphabets: list[str] | None = None) -> str:
    """Each digit to a digit, each letter to one of its case, all together as one number; the rest stays."""
    alphabets = alphabets or [_alphabet(c) for c in text]
    number, size = 0, 1
    for c, a in zip(text, alphabets):
        number, size = number * len(a) + a.index(c), size * len(a)
    number, out = permuted(number, size, key, tweak, back), []
    for a in reversed(alphabets):
        number, place = divmod(number, len(a))
        out.append(a[place])
    return "".join(reversed(out))


def _filled(layout: str, digits: str) -> str:
    rest = iter(digits)
    return "".join(next(rest) if c in DIGITS else c for c in layout)


def _luhn(digits: str) -> int:
    """What the last digit adds up to with the others; 0 for a valid number."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10


def _email(text: str, key: bytes, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    name, _, top = domain.rpartition(".")
    return _by_class(f"{local}@{name}", key, "email", back) + "." + top


def _address(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    number = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "address", back)
    return ".".join(map(str, number.to_bytes(4, "big")))


def _card(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or _luhn(digits) or len(set(digits)) == 1:
        return None
    body = _by_class(digits[:-1], key, "card", back)
    return _filled(text, body + str(-_luhn(body + "0") % 10))


def _iban(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")

    def rest(value: str) -> int:
        return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97

    if not 15 <= len(plain) <= 34 or rest(plain) != 1:
        return None
    body = _by_class(plain[4:], key, "iban", back)
    new = f"{plain[:2]}{98 - rest(plain[:2] + '00' + body):02d}{body}"
    letters = iter(new)
    return "".join(c if c == " " else next(letters) for c in text)


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    number = permuted((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn", back)
    (number, serial), (place, group) = divmod(number, 9999), (0, 0)
    place, group = divmod(number, 99)
    area = place + 1 + (place + 1 >= 666)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(text: str, key: bytes, back: bool) -> str | None:
    """2001-12-31, 31.12.2001, 12/31/2001, or 31/12/2001 where the reading before is no day; the order of the parts
    stays, so a date of the last layout may afterwards be read like the one before and cannot be turned back."""
    parts = re.split(r"[-/.]", text)
    if len(parts[0]) == 4:
        orders = [(0, 1, 2)]
    else:
        orders = [(2, 1, 0)] if "." in text else [(2, 0, 1), (2, 1, 0)]
    for order in orders:
        try:
            day = date(*(int(parts[i]) for i in order))
        except ValueError:
            continue
        place = (day - FIRST_DAY).days
        if not 0 <= place < DAYS:
            return None
        new = FIRST_DAY + timedelta(permuted(place, DAYS, key, "date", back))
        written = dict(zip(order, (new.year, new.month, new.day)))
        mark = re.search(r"[-/.]", text).group()
        wide = all(len(p) >= 2 for p in parts)
        return mark.join(f"{written[i]:0{len(parts[i]) if wide else 1}d}" for i in range(3))
    return None


def _phone(text: str, key: bytes, back: bool) -> str | None:
    """The country code and the zero before an area code stay; first digits of area and exchange stay what a number may
    begin with."""
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    code = len(re.match(r"\+?(\d{0,3}?)(?=[ .(-])|\+?(\d)", text).group().lstrip("+")) if text.startswith("+") else 0
    body = digits[code:]
    first = "23456789"
    alphabets = [(first if c in first else "01") if i in (0, 3) and len(body) == 10 else DIGITS for i, c in enumerate(body)]
    if "/" in text:
        alphabets[0] = "0"
    return _filled(text, digits[:code] + _by_class(body, key, "phone", back, alphabets))


def _secret(text: str, key: bytes, back: bool) -> str | None:
    """Plain words are no secrets: there has to be a digit, or a capital behind a small letter."""
    if not re.search(r"\d|[a-z][^a-z]*[A-Z]", text):
        return None
    hexadecimal = all(c in "0123456789abcdef" for c in text)
    return _by_class(text, key, "secret", back, ["0123456789abcdef"] * len(text) if hexadecimal else None)


REPLACE: dict[str, Callable[[str, bytes, bool], str | None]] = {
    "email": _email, "iban": _iban, "address": _address, "ssn": _ssn, "date": _date, "card": _card, "phone": _phone, "secret": _secret,
}

# The length of an IBAN by country.
_IBAN_LENGTH = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

_EMAIL = re.compile(r"(?<![\w.%+-])(?P<email>[\w.%+-]+@[^\W_](?:[\w-]*[^\W_])?(?:\.[\w-]+)*\.[A-Za-z]{2,})(?![\w-])")
_NUMBERS = re.compile(
    r"(?<![\w.@-])(?:"
    r"(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])"
    r"|(?P<address>\d{1,3}(?:\.\d{1,3}){3})(?![\w-]|\.\d)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?P<date>\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?:(?=T\d\d:)|(?![\w-]|[./]\d))"
    r"|(?P<card>\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){5,12}|\(?\d{3}\)?[ .-]\d{3}[.-]\d{4}|0\d{2,4}/\d{5,8}(?!/))(?![\w-])"
    r")"
)
_SECRET = re.compile(
    r"(?<![A-Z0-9])AKIA(?P<akia>[A-Z0-9]{16})(?![A-Z0-9])"
    r"|\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[ ]{0,3}[=:][ ]{0,3}[\"']?(?P<secret>[A-Za-z0-9+/_-]{8,})",
    re.I,
)


def _iban_ends(text: str) -> list[str]:
    """What may be the IBAN at the start of a match: up to the country's length, then up to each space, longest first."""
    tokens = text.split(" ")
    parts = [" ".join(tokens[:n]) for n in range(len(tokens), 0, -1)]
    return sorted(parts, key=lambda part: len(part.replace(" ", "")) != _IBAN_LENGTH.get(text[:2]))


def pseudonymised(text: str, key: bytes, back: bool = False) -> tuple[str, list[int]]:
    """The text with every checked value replaced, and how many of each of KINDS; ``back`` undoes it."""
    counts = dict.fromkeys(KINDS, 0)

    def put(match: re.Match) -> str:
        whole, name = match.group(), match.lastgroup
        kind = "secret" if name == "akia" else name
        new = REPLACE[kind](match.group(name), key, back)
        if new is None:
            return whole
        counts[kind] += 1
        at = match.start(name) - match.start()
        return whole[:at] + new + whole[at + len(match.group(name)) :]

    def numbers(text: str) -> str:
        """After a failed check the search goes on behind the first character, so no value inside a match is passed over."""
        out, done, at = [], 0, 0
        while match := _NUMBERS.search(text, at):
            kind, value = match.lastgroup, match.group()
            for value in _iban_ends(value) if kind == "iban" else [value]:
                if (new := REPLACE[kind](value, key, back)) is not None:
                    counts[kind] += 1
                    out += [text[done : match.start()], new]
                    done = at = match.start() + len(value)
                    break
            else:
                at = match.start() + 1
        return "".join([*out, text[done:]])

    if "@" in text:
        text = _EMAIL.sub(put, text)
    if "=" in text or ":" in text or "AKIA" in text:
        text = _SECRET.sub(put, text)
    if _DIGITS.search(text):
        text = numbers(text)
    return text, list(counts.values())


_DIGITS = re.compile(r"\d[\d./() -]{5,}\d|[A-Z]{2}\d\d")


def _replaced(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for value in batch.column(1):
                text, found = (None, [0] * len(KINDS)) if not value.is_valid else pseudonymised(value.as_py(), key)
                texts.append(text)
                counts.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS)))],
                names=[batch.schema.names[0], "text", *(f"n_{k}" for k in KINDS)],
            )

    return run


def with_pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id") -> DataFrame:
    """(id, text, n_email, n_iban, ...): each whole text with its personal data replaced, and how many of each kind.

    ``key`` has 1 to 64 bytes. Values that fail their check (Luhn, mod 97, calendar, ranges) stay. Null texts stay
    null, empty ones empty. Rows are treated one by one, so repeats, ties and null ids do no harm. Other columns are
    ignored."""
    text_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col("text")).mapInArrow(
        _replaced(key), f"`{id_col}` {kind}, text string, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    )
