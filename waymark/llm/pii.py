"""Format-preserving pseudonyms: validated numbers and dates are permuted within their format by a keyed Feistel network.

A value keeps its length, separators and validity (check digits, calendar, octets); the same value gives the same
pseudonym under one key, however it is written, so it stays linked across documents. Values outside a format's valid
set are walked through the permutation until they fall inside it, which keeps it one-to-one. One value of a format
can be its own pseudonym, as in any permutation.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Work, map_slices, pick

ROUNDS = 10
MEMO_VALUES = 200_000
KEY_OPTION = "spark.waymark.pseudonym.key"
FIRST_DAY, PAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal()
SCHEMA = "doc_id long, text string, n_replaced long, spans array<struct<kind:string,start:int,past:int>>"


class Feistel:
    """A keyed permutation of sequences of digits to a base, for any base and any length from 1."""

    def __init__(self, key: bytes) -> None:
        self.key = key[:64]

    def _round(self, kind: str, number: int, half: int, length: int, limit: int) -> int:
        text = f"{kind}|{length}|{number}|{half}".encode()
        # More bits than the limit has, so that the remainder is nearly even.
        wide = b"".join(
            hashlib.blake2b(text + bytes([part]), key=self.key).digest() for part in range(limit.bit_length() // 448 + 1)
        )
        return int.from_bytes(wide) % limit

    def permute(self, digits: Sequence[int], base: int, kind: str) -> list[int]:
        size = len(digits)
        left, right = size // 2, size - size // 2
        low, high = base ** left, base ** right
        value = 0
        for digit in digits:
            value = value * base + digit
        a, b = divmod(value, high)
        # a < low and b < high; each round changes one side by what the other gives, and so can be undone.
        for number in range(0, ROUNDS, 2):
            a = (a + self._round(kind, number, b, size, low)) % low
            b = (b + self._round(kind, number + 1, a, size, high)) % high
        value = a * high + b
        out = []
        for _ in digits:
            value, digit = divmod(value, base)
            out.append(digit)
        return out[::-1]

    def walk(self, digits: Sequence[int], base: int, kind: str, valid: Callable[[list[int]], bool]) -> list[int]:
        out = self.permute(digits, base, kind)
        while not valid(out):
            out = self.permute(out, base, kind)
        return out


def luhn(digits: Sequence[int]) -> int:
    """The check digit that follows these digits."""
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def iban_check(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def digits_of(text: str) -> list[int]:
    return [int(c) for c in text if c in "0123456789"]


def refill(pattern: str, digits: Sequence[int]) -> str:
    """`pattern` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(str(next(rest)) if c in "0123456789" else c for c in pattern)


def _card(written: str, feistel: Feistel) -> str | None:
    digits = digits_of(written)
    if len(set(digits)) < 2 or luhn(digits[:-1]) != digits[-1]:
        return None
    body = feistel.walk(digits[:-1], 10, "card", lambda d: d[0] != 0)
    return refill(written, [*body, luhn(body)])


# Lengths of account numbers by country, from the public registry.
IBAN_SIZES = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22,
    "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27,
    "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33,
    "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


# Lengths and first digits of the known issuers; they only decide which of several valid readings is taken.
ISSUERS = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2[2-7]\d{14}|3[47]\d{13}|3[0689]\d{12}|35\d{14}|6\d{15,18}")


def card_readings(run: str) -> list[tuple[int, int]]:
    """Parts of a run of digits that begin and end at a group's border and can be a card: those of known issuers first, long ones first."""
    groups = [m.span() for m in re.finditer("[0-9]+", run)]
    found = []
    for n, (start, _) in enumerate(groups):
        digits = ""
        for first, past in groups[n:]:
            digits += run[first:past]
            if len(digits) > 19:
                break
            if len(digits) >= 13:
                found.append((not ISSUERS.fullmatch(digits), -len(digits), start, past))
    return [(start, past) for _, _, start, past in sorted(found)]


def iban_readings(run: str) -> list[tuple[int, int]]:
    """The part of its country's length, then all parts that end with a group, long ones first; without blanks at the end."""
    ends = [m.end() for m in re.finditer("[A-Z0-9]+", run)][::-1]
    size = IBAN_SIZES.get(run[:2])
    if size is not None:
        ends = sorted((e for e in ends if e - run.count(" ", 0, e) == size), reverse=True) + ends[:1]
    return [(0, past) for past in ends]


READINGS: dict[str, Callable[[str], list[tuple[int, int]]]] = {"card": card_readings, "iban": iban_readings}


def _social(match: re.Match, feistel: Feistel) -> str | None:
    def valid(d: Sequence[int]) -> bool:
        area = 100 * d[0] + 10 * d[1] + d[2]
        return 0 < area < 900 and area != 666 and any(d[3:5]) and any(d[5:])

    digits = digits_of(match.group())
    return refill(match.group(), feistel.walk(digits, 10, "social", valid)) if valid(digits) else None


def _phone(match: re.Match, feistel: Feistel) -> str | None:
    """With a country code 7 to 15 digits in all, without one the ten of a North American number; the code stays."""
    if match["plus"]:
        code, rest = match["plus"], match["number"]
    else:
        code, rest = match["code"] or "", match["rest"]
    digits, country = digits_of(rest), "".join(map(str, digits_of(code))) or "1"
    if len(digits) != 10 if not code else not 7 <= len(digits) + len(country) <= 15:
        return None
    return code + refill(rest, feistel.permute(digits, 10, f"phone{country}"))


def _address(match: re.Match, feistel: Feistel) -> str | None:
    octets = [int(part) for part in match.group().split(".")]
    if any(o > 255 or len(part) > 1 and part[0] == "0" for o, part in zip(octets, match.group().split("."))):
        return None
    return str(ipaddress.IPv4Address(bytes(feistel.permute(octets, 256, "ipv4"))))


def _iban(written: str, feistel: Feistel) -> str | None:
    value = written.replace(" ", "")
    country, account = value[:2], value[4:]
    if not 11 <= len(account) <= 30 or iban_check(country, account) != value[2:4]:
        return None
    numbers = iter(feistel.permute(digits_of(account), 10, f"iban{country}"))
    names = [ord(c) - 65 for c in account if c.isalpha()]
    letters = iter(feistel.permute(names, 26, f"iban{country}") if names else [])
    fresh = "".join(str(next(numbers)) if c.isdigit() else chr(65 + next(letters)) for c in account)
    rest = iter(country + iban_check(country, fresh) + fresh)
    return "".join(c if c == " " else next(rest) for c in written)


def _date(match: re.Match, feistel: Feistel) -> str | None:
    """Year first, or day and month by value: where both readings are dates, the day comes first unless split by slashes."""
    parts = [match["a"], match["b"], match["c"]]
    numbers = [int(p) for p in parts]
    if len(parts[0]) == 4:
        orders = [(0, 1, 2)]
    elif len(parts[2]) == 4:
        orders = [(2, 0, 1), (2, 1, 0)] if match["sep"] == "/" else [(2, 1, 0), (2, 0, 1)]
    else:
        return None
    for order in orders:
        try:
            day = dt.date(*[numbers[i] for i in order]).toordinal()
        except ValueError:
            continue
        if FIRST_DAY <= day < PAST_DAY:
            break
    else:
        return None
    count = PAST_DAY - FIRST_DAY
    number = lambda d: int("".join(map(str, d)))
    out = feistel.walk([int(c) for c in f"{day - FIRST_DAY:05d}"], 10, "date", lambda d: number(d) < count)
    fresh = dt.date.fromordinal(FIRST_DAY + number(out))
    values = dict(zip(order, (fresh.year, fresh.month, fresh.day)))
    return match["sep"].join(str(values[i]).zfill(len(parts[i])) for i in range(3))


def _letters(text: str, feistel: Feistel, kind: str) -> str:
    """Digits, small and capital letters permuted among their own kind, everything else as it is."""
    out = list(text)
    for first, base in (("0", 10), ("a", 26), ("A", 26)):
        places = [i for i, c in enumerate(text) if ord(first) <= ord(c) < ord(first) + base]
        if places:
            fresh = feistel.permute([ord(text[i]) - ord(first) for i in places], base, kind)
            for place, digit in zip(places, fresh):
                out[place] = chr(ord(first) + digit)
    return "".join(out)


def _mail(match: re.Match, feistel: Feistel) -> str | None:
    """The local part is permuted; equal addresses in other capitals get equal pseudonyms."""
    return _letters(match["local"].lower(), feistel, "mail") + "@" + match["host"]


def _secret(match: re.Match, feistel: Feistel) -> str | None:
    value = match["value"]
    if re.fullmatch("[0-9a-f]+", value):
        fresh = "".join(f"{d:x}" for d in feistel.permute([int(c, 16) for c in value], 16, "secret"))
    else:
        fresh = _letters(value, feistel, "secret")
    return match.group()[:match.start("value") - match.start()] + fresh + match.group()[match.end("value") - match.start():]


BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _access_key(match: re.Match, feistel: Feistel) -> str | None:
    """The prefix that tells the kind of key stays."""
    value = match["value"]
    if match["head"].isupper():
        fresh = "".join(BASE_32[d] for d in feistel.permute([BASE_32.index(c) for c in value], 32, "access"))
    else:
        fresh = _letters(value, feistel, "access")
    return match["head"] + fresh


# Country codes of one and two digits; all others have three.
COUNTRIES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\\d{2}"

# In order of precedence where findings overlap.
KINDS: list[tuple[str, str, Callable[[Any, Feistel], str | None]]] = [
    ("secret", r"(?i:\b(?:[a-z_-]*(?:token|secret|password|passwd|api[_-]?key|access[_-]?key))\b[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
               r"(?P<value>[A-Za-z0-9_+/.\-]{12,})", _secret),
    ("access_key", r"(?<![A-Za-z0-9])(?:(?P<head>AKIA|ASIA)(?P<value>[A-Z2-7]{16})(?![A-Za-z0-9]))", _access_key),
    ("access_key", r"(?<![A-Za-z0-9])(?:(?P<head>gh[opsu]_|sk-)(?P<value>[A-Za-z0-9]{20,}))", _access_key),
    ("mail", r"(?<![\w.+-])(?P<local>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63})@(?P<host>[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})", _mail),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _address),
    ("date", r"(?<![\w./-])(?P<a>\d{4}|\d{1,2})(?P<sep>[-/.])(?P<b>\d{1,2})(?P=sep)(?P<c>\d{4}|\d{1,2})(?![\w/-]|\.\d)", _date),
    ("card", r"(?<![\w.-])\d(?:[ -]?\d){12,}(?![\w-])", _card),
    ("social", r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])", _social),
    # The second form is for country codes before one digit of area, pairs, or digits without separators.
    ("phone", r"(?<![\w.])(?:(?P<code>\+\d{1,3}[ .-]?)?(?P<rest>(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4})|"
              r"(?P<plus>\+(?:" + COUNTRIES + r")[ .-]?)(?P<number>\d{4,14}|(?:\(\d\) ?(?:\d{1,4}[ .-])?|\d[ .-])\d{3,4}[ .-]?\d{3,4}|"
              r"\(?\d{1,3}\)?(?:[ .-]\d{2}){3,5}))(?![\w-])", _phone),
]


class Pseudonyms:
    """Finds values in a text and puts their pseudonyms in place."""

    def __init__(self, key: bytes) -> None:
        self.feistel = Feistel(hashlib.sha256(key).digest())
        self.kinds = [(name, re.compile(pattern), make) for name, pattern, make in KINDS]
        self.known: dict[tuple[str, str], str | None] = {}

    def candidates(self, name: str, pattern: re.Pattern, text: str, found: list) -> Iterator[tuple[int, int, re.Match | str]]:
        """Start, end and what to make a pseudonym of; of cards and IBANs all readings of a run, going on behind the one that is found."""
        if name not in READINGS:
            yield from ((*match.span(), match) for match in pattern.finditer(text))
            return
        place = 0
        while match := pattern.search(text, place):
            first, before = match.start(), len(found)
            for start, past in READINGS[name](match.group()):
                yield first + start, first + past, match.group()[start:past]
            # All parts of a run of digits are tried; another IBAN may begin within what followed the last one.
            place = match.end() if name == "card" else max([first + 1, *(past for _, past, _, _ in found[before:])])

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, start and end of each value in the text as it was."""
        found: list[tuple[int, int, str, str]] = []
        taken = bytearray(len(text))
        digits = any(c in text for c in "0123456789")
        for name, pattern, make in self.kinds:
            # All other kinds are made of digits.
            if not (digits or name in ("mail", "secret", "access_key")) or name == "mail" and "@" not in text:
                continue
            for start, past, given in self.candidates(name, pattern, text, found):
                if taken.find(1, start, past) >= 0:
                    continue
                known = (name, text[start:past])
                if known not in self.known:
                    if len(self.known) >= MEMO_VALUES:
                        self.known.clear()
                    self.known[known] = make(given, self.feistel)
                if (fresh := self.known[known]) is not None:
                    found.append((start, past, name, fresh))
                    taken[start:past] = b"\1" * (past - start)
        found.sort()
        parts, last = [], 0
        for start, past, _, fresh in found:
            parts += [text[last:start], fresh]
            last = past
        return "".join([*parts, text[last:]]), [(name, start, past) for start, past, name, _ in found]


def pseudonymise(docs: DataFrame, key: str | None = None, id: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, n_replaced and spans (kind, start, past; code points of the original) of every row.

    The key comes from the argument or the option spark.waymark.pseudonym.key; without one a ValueError is raised, since anyone could undo
    pseudonyms of a key that stands in the source. Map-only. Missing texts stay missing,
    empty ones empty, both without spans; texts without a valid value are unchanged. Equal rows give equal rows. With `keep` the row as it was is a last column `_doc`.
    """
    secret = (key or docs.sparkSession.conf.get(KEY_OPTION, "")).encode()
    if not secret:
        raise ValueError(f"pseudonyms need a key: an argument or the option {KEY_OPTION}")

    def begin() -> Work:
        pseudonyms = Pseudonyms(secret)

        def work(ids: list, texts: list[bytes | None]) -> list:
            fresh = [(None, []) if t is None else pseudonyms.replace(t.decode()) for t in texts]
            spans = [[{"kind": k, "start": a, "past": b} for k, a, b in found] for _, found in fresh]
            return [ids, [t for t, _ in fresh], [len(s) for s in spans], spans]

        return work

    rows = pick(docs, keep, doc_id=id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_slices(rows, begin, SCHEMA, keep=text if keep else None)
