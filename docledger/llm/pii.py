"""Personal data replaced by keyed pseudonyms of the same format.

Validated numbers and dates are permuted within their format by an alternating Feistel network over
their digits (letters for mail addresses), so the same value under the same key becomes the same
pseudonym in every document, and no two values share one. What fails its validation is left alone.

| kind | taken | permuted |
|---|---|---|
| email | local part, host, top-level domain of letters | letters and digits of all but the last label |
| card | 13 to 19 digits with a valid check digit, first digit 2 to 6 | all but the first and the check digit, which is computed anew |
| iban | country, check digits valid modulo 97 | the digits after the check digits, which are computed anew |
| ssn | ddd-dd-dddd, area not 000, 666 or 9xx, no group of zeros | its nine digits, until valid again |
| phone | +, country code and 8 to 15 digits, or (ddd) ddd-dddd and ddd-ddd-dddd | the last ten digits, or all after the first two |
| ip | four numbers up to 255 | its 32 bits, until it has the same number of digits |
| date | an existing day 1900 to 2099 as y-m-d, d.m.y or d/m/y (m/d/y where only that exists) | the day number |
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.text import hand_back, map_documents
from docledger.session import ship

KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date")
ROUNDS = 10
SCHEMA = (
    "doc_id bigint, text string, spans array<struct<kind:string,start:int,end:int>>, "
    + ", ".join(f"n_{kind} int" for kind in KINDS) + ", n_replaced int")
FIRST_DAY = datetime.date(1900, 1, 1)
DAYS = (datetime.date(2100, 1, 1) - FIRST_DAY).days

_SEPARATED_PHONE = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
_FIND = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?"
    r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
    r"|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-]|\.[0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))"
    rf"|(?P<phone>(?<![0-9(+.-]){_SEPARATED_PHONE}(?![0-9-])"
    r"|(?<![0-9+])\+[1-9](?:[ .-]?\(?[0-9]+\)?)+(?![0-9]))"
    r"|(?P<card>(?<![0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))")


class Feistel:
    """A keyed permutation of vectors of small numbers, each below its own radix."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _draw(self, tweak: str, turn: int, value: int, modulus: int) -> int:
        size = (modulus.bit_length() + 7) // 8 + 8
        out = b""
        while len(out) < size:
            out += hashlib.blake2b(f"{tweak}|{turn}|{value}|{len(out)}".encode(), key=self.key).digest()
        return int.from_bytes(out[:size], "big") % modulus

    def pair(self, left: int, right: int, n_left: int, n_right: int, tweak: str) -> tuple[int, int]:
        for turn in range(ROUNDS):
            if turn % 2:
                left = (left + self._draw(tweak, turn, right, n_left)) % n_left
            else:
                right = (right + self._draw(tweak, turn, left, n_right)) % n_right
        return left, right

    def permute(self, values: list[int], radices: list[int], tweak: str) -> list[int]:
        half = len(values) // 2
        sides = []
        for part in (slice(0, half), slice(half, None)):
            number, size = 0, 1
            for v, r in zip(values[part], radices[part], strict=True):
                number, size = number * r + v, size * r
            sides.append((number, size))
        left, right = self.pair(sides[0][0], sides[1][0], sides[0][1], sides[1][1], tweak)
        out = []
        for number, part in ((right, radices[half:]), (left, radices[:half])):
            for r in reversed(part):
                number, v = divmod(number, r)
                out.append(v)
        return out[::-1]

    def digits(self, text: str, tweak: str) -> str:
        return "".join(map(str, self.permute([int(c) for c in text], [10] * len(text),
                                             f"{tweak}{len(text)}")))


def luhn(digits: str) -> int:
    """The sum that is divisible by 10 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, everything else as it was."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


def _only_digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _card(found: str, feistel: Feistel) -> str | None:
    digits = _only_digits(found)
    if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or luhn(digits) % 10 or len(set(digits)) == 1:
        return None
    body = digits[0] + feistel.digits(digits[1:-1], "card" + digits[0])
    return _refill(found, body + str(-luhn(body + "0") % 10))


def _iban_value(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def _iban(found: str, feistel: Feistel) -> str | None:
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_value(plain[4:] + plain[:4]) % 97 != 1:
        return None
    digits = _only_digits(plain[4:])
    body = _refill(plain[4:], feistel.digits(digits, "iban" + plain[:2])) if len(digits) > 1 else plain[4:]
    check = 98 - _iban_value(body + plain[:2] + "00") % 97
    rest = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(rest) for c in found)


def _valid_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(found: str, feistel: Feistel) -> str | None:
    digits = _only_digits(found)
    if not _valid_ssn(digits):
        return None
    digits = feistel.digits(digits, "ssn")
    while not _valid_ssn(digits):  # walking the cycle keeps it a permutation of the valid ones
        digits = feistel.digits(digits, "ssn")
    return _refill(found, digits)


def _phone(found: str, feistel: Feistel) -> str | None:
    digits = _only_digits(found)
    if not (8 <= len(digits) <= 15):
        return None
    national = len(digits) == 10 or len(digits) == 11 and digits[0] == "1"
    keep = len(digits) - 10 if national else 2
    return _refill(found, digits[:keep] + feistel.digits(digits[keep:], "phone" + ("1" if national else digits[:2])))


def _ip(found: str, feistel: Feistel) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
        return None
    lengths, numbers = [len(p) for p in parts], [int(p) for p in parts]
    # Numbers of one, two and three digits are permuted among themselves, which keeps the format.
    low, size = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 90, 3: 156}
    out = feistel.permute([n - low[k] for n, k in zip(numbers, lengths, strict=True)],
                          [size[k] for k in lengths], "ip" + "".join(map(str, lengths)))
    return ".".join(str(v + low[k]) for v, k in zip(out, lengths, strict=True))


def _day(y: str, m: str, d: str) -> int | None:
    try:
        number = (datetime.date(int(y), int(m), int(d)) - FIRST_DAY).days
    except ValueError:
        return None
    return number if 0 <= number < DAYS else None


def _date(found: str, feistel: Feistel) -> str | None:
    a, b, c = re.split(r"[-./]", found)
    order = "ymd" if "-" in found else "dmy"
    number = _day(a, b, c) if order == "ymd" else _day(c, b, a)
    if number is None and "/" in found:
        order, number = "mdy", _day(c, a, b)
    if number is None:
        return None
    # A network over 270 x 271 numbers, walked until it meets a day again.
    while True:
        left, right = feistel.pair(*divmod(number, 271), 270, 271, "date")
        number = left * 271 + right
        day = FIRST_DAY + datetime.timedelta(days=number) if number < DAYS else None
        if day and (order != "mdy" or day.day > 12):
            break
    parts = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
    separator = next(x for x in found if not x.isdigit())
    return separator.join(parts[x] for x in order)


def _email(found: str, feistel: Feistel) -> str | None:
    cut = found.rindex(".")
    body = found[:cut]
    at = [i for i, c in enumerate(body) if c.isalnum()]
    values = [int(body[i]) if body[i].isdigit() else ord(body[i].lower()) - 97 for i in at]
    shape = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in body)
    out = feistel.permute(values, [10 if body[i].isdigit() else 26 for i in at],
                          f"email{shape}{found[cut:].lower()}")
    text = list(body)
    for i, v in zip(at, out, strict=True):
        c = str(v) if body[i].isdigit() else chr(97 + v)
        text[i] = c.upper() if body[i].isupper() else c
    return "".join(text) + found[cut:]


#: Characters of an IBAN by its country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30}


def _shorter(kind: str, found: str) -> Iterator[str]:
    """Starts of a match that end where it might have ended, the longest first; IBANs of known length only."""
    if kind not in ("card", "iban"):
        return
    length = IBAN_LENGTHS.get(found[:2]) if kind == "iban" else None
    for end in range(len(found) - 1, 0, -1):
        if found[end - 1].isalnum() and not found[end].isalnum():
            size = sum(map(str.isalnum, found[:end]))
            if size < 13:
                return
            if length in (None, size):
                yield found[:end]


def _longer_inside(taken: str, found: str, feistel: Feistel) -> bool:
    """Whether a card of more digits begins behind a blank in ``taken``: a number went before it."""
    return any(len(_only_digits(other)) > len(_only_digits(taken)) and _card(other, feistel)
               for blank in re.finditer(" ", taken)
               for other in (found[blank.end():], *_shorter("card", found[blank.end():])))


_CHANGE = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "phone": _phone,
           "ip": _ip, "date": _date}


def pseudonymise(text: str, feistel: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind and place of what was replaced (offsets in the old text)."""
    if not re.search(r"[0-9@]", text):
        return text, []
    out, spans, done, at = [], [], 0, 0
    while found := _FIND.search(text, at):
        kind, taken = found.lastgroup, found[0]
        new = _CHANGE[kind](taken, feistel)
        if new is None:  # it may have taken a number or a word too many
            for taken in _shorter(kind, found[0]):
                if (new := _CHANGE[kind](taken, feistel)) is not None:
                    if kind == "card" and _longer_inside(taken, found[0], feistel):
                        new = None
                    break
        if new is None:
            # Another kind may begin inside what this one wrongly took, but not inside its first number.
            at = found.start() + max(1, len(re.match(r"[A-Za-z0-9]*", found[0])[0]))
            continue
        out += [text[done:found.start()], new]
        done = at = found.start() + len(taken)
        spans.append((kind, found.start(), at))
    return "".join(out) + text[done:], spans


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``doc_id, text, spans``, a count for each kind and ``n_replaced``, one row per row of ``docs``.

    A null text becomes an empty one without spans; a null id stays null; repeated rows get the same
    result; other columns are not read; an empty table gives an empty result. No shuffle.
    """
    def each(documents):
        feistel = Feistel(key)
        for doc_id, raw in documents:
            text, spans = pseudonymise(raw.decode(), feistel)
            kinds = [kind for kind, _, _ in spans]
            yield (doc_id, text, [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans],
                   *(kinds.count(k) for k in KINDS), len(spans))

    return map_documents(docs, SCHEMA, each, id_col, text_col, batch_rows=500)


def with_pseudonyms(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with its text replaced, all other columns as they were; a null text stays null."""
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def changed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        feistel = Feistel(key)
        for texts in batches:
            yield pa.array([None if t is None else pseudonymise(t, feistel)[0] for t in texts.to_pylist()], pa.string())
        hand_back()

    return docs.withColumn(text_col, changed(F.col(f"`{text_col}`")))
