"""Format-preserving pseudonyms for personal numbers and dates.

What is found is checked first (Luhn and IBAN check digits, number plans, calendar) and then
permuted within its format by a keyed Feistel network: digits stay digits, separators stay where they are, check
digits are right again, a date stays a date. The permutation works on the value without
its separators and capitals, so a value gets the same pseudonym in every document and spelling, two values never share one,
and whoever has the key can undo it, spelling included. Dates whose day is above 12 are permuted among themselves, so that
the order of day and month that made them a date stays the only one that does.

Kinds: card, iban, ssn, phone, ip (IPv4), date, email (the letters and digits before the @) and hex (digests and tokens of
32, 40 or 64 hex digits). Where finds overlap, the kind named first in KINDS counts. A number that fails
its check is left alone. Numbers next to other digits or capitals are looked for between the separators: see ``spans``.
Where such a neighbour makes a longer valid number by chance, that one is replaced, and undoing a text can
take another end than was replaced; single values are always undone. Dates with names of months, two digits of the year or single
digits of day or month are not found. How long a number of a country other than +1 is isn't known:
digits after a blank count to it.

Nulls: a null text stays null, with no finds.
"""

from __future__ import annotations

import bisect
import calendar
import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridshard.llm.common import documents, map_texts

ROUNDS = 10
_SOME = re.compile(r"\d\D{0,4}\d|@|[0-9a-fA-F]{32}")


class Feistel:
    """A keyed permutation of 0 .. size - 1.

    The halves of a number, the quotient and rest by about the square root of size, are shifted in turn by a
    keyed hash of the other. A result beyond the size goes through again until it is within.
    """

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.b = isqrt(max(0, size - 1)) + 1
        self.a = -(-size // self.b)
        self.key = hashlib.blake2b(f"{kind}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def _shift(self, i: int, value: int) -> int:
        return int.from_bytes(hashlib.blake2b(b"%d:%d" % (i, value), key=self.key, digest_size=32).digest(), "big")

    def _pass(self, x: int, rounds: range, sign: int) -> int:
        left, right = divmod(x, self.b)
        for i in rounds:
            if i % 2:
                left = (left + sign * self._shift(i, right)) % self.a
            else:
                right = (right + sign * self._shift(i, left)) % self.b
        return left * self.b + right

    def __call__(self, x: int, undo: bool = False) -> int:
        rounds = range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS)
        x = self._pass(x, rounds, -1 if undo else 1)
        while x >= self.size:
            x = self._pass(x, rounds, -1 if undo else 1)
        return x


# Days before each month of 1900 to 2099, but for the first 12 of every month.
_LATE_DAYS = [0]
for _year in range(1900, 2100):
    for _month in range(1, 13):
        _LATE_DAYS.append(_LATE_DAYS[-1] + calendar.monthrange(_year, _month)[1] - 12)


def _date_number(day: datetime.date) -> tuple[str, int, int]:
    """The kind of a date, by its day, its number among those of the kind, and how many there are."""
    month = (day.year - 1900) * 12 + day.month - 1
    if day.day <= 12:
        return "date", month * 12 + day.day - 1, 12 * 2400
    return "late date", _LATE_DAYS[month] + day.day - 13, _LATE_DAYS[-1]


def _date_of(kind: str, number: int) -> datetime.date:
    if kind == "date":
        month, day = divmod(number, 12)
    else:
        month = bisect.bisect_right(_LATE_DAYS, number) - 1
        day = number - _LATE_DAYS[month] + 12
    return datetime.date(1900 + month // 12, month % 12 + 1, day + 1)


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` and it a valid number."""
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _spell(template: str, chars: str) -> str:
    """``chars`` in place of the letters and digits of ``template``."""
    rest = iter(chars)
    return "".join(next(rest) if c.isalnum() else c for c in template)


def _mixed_radix(values: list[int], sizes: list[int], permute: Callable[[int, int], int]) -> list[int]:
    """``values``, each below its size, permuted as one number."""
    number, total = 0, 1
    for v, s in zip(values, sizes, strict=True):
        number, total = number * s + v, total * s
    number = permute(number, total)
    out = []
    for s in reversed(sizes):
        number, v = divmod(number, s)
        out.append(v)
    return out[::-1]


class Pseudonyms:
    """Pseudonyms of single values; ``undo`` gives back the original."""

    def __init__(self, key: bytes, undo: bool = False):
        if not key:
            raise ValueError("pseudonyms need a key")
        self.key, self.undo = key, undo
        self._feistel = lru_cache(4096)(lambda kind, size: Feistel(key, kind, size))

    def _permute(self, kind: str) -> Callable[[int, int], int]:
        return lambda x, size: self._feistel(kind, size)(x, self.undo)

    def card(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        size = 10 ** (len(digits) - 1)
        body, made = digits[:-1], ""
        # Again if it is none of those that count as cards.
        while len(set(made)) < 2:
            body = f"{self._permute('card')(int(body), size):0{len(body)}d}"
            made = body + luhn_digit(body)
        return _spell(found, made)

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "")
        country, account = plain[:2], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_digits(country, account) != plain[2:4]:
            return None
        sizes = [10 if c.isdigit() else 26 for c in account]
        values = [int(c) if c.isdigit() else ord(c) - 65 for c in account]
        made = _mixed_radix(values, sizes, self._permute("iban" + country))
        account = "".join(str(v) if s == 10 else chr(65 + v) for v, s in zip(made, sizes, strict=True))
        return _spell(found, country + iban_digits(country, account) + account)

    def ssn(self, found: str) -> str | None:
        area, group, serial = map(int, found.split("-"))
        if area in (0, 666) or area > 899 or group == 0 or serial == 0:
            return None
        areas = [area - 1 - (area > 666), group - 1, serial - 1]
        a, g, s = _mixed_radix(areas, [898, 99, 9999], self._permute("ssn"))
        return f"{a + 1 + (a + 1 >= 666):03d}-{g + 1:02d}-{s + 1:04d}"

    def phone(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        international = found.startswith("+")
        if international and digits[0] == "1" and len(digits) != 11:
            return None
        country, rest = (digits[:-10], digits[-10:]) if len(digits) >= 10 else ("", digits)
        if (country == "1" or not country and not international) and len(rest) == 10:
            # Area and exchange of the North American plan begin with 2 to 9. Numbers that are written as
            # such but can't be stay so: they are permuted among themselves.
            if rest[0] not in "01" and rest[3] not in "01":
                values, sizes = [int(rest[:3]) - 200, int(rest[3:6]) - 200, int(rest[6:])], [800, 800, 10_000]
                a, b, c = _mixed_radix(values, sizes, self._permute("phone"))
                return _spell(found, f"{country}{a + 200:03d}{b + 200:03d}{c:04d}")
            if not international:
                return None
            while True:
                rest = f"{self._permute('phone-other')(int(rest), 10**10):010d}"
                if rest[0] in "01" or rest[3] in "01":
                    return _spell(found, country + rest)
        if not international or not 9 <= len(digits) <= 15:
            return None
        # The two digits after the + are taken for the country and stay.
        rest = digits[2:]
        return _spell(found, digits[:2] + f"{self._permute('phone' + digits[:2])(int(rest), 10 ** len(rest)):0{len(rest)}d}")

    def ip(self, found: str) -> str | None:
        parts = found.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        return ".".join(map(str, _mixed_radix(list(map(int, parts)), [256] * 4, self._permute("ip"))))

    def date(self, found: str) -> str | None:
        """Year first, or day and month in the only order that is a date; if both are, day first with dots and else month first."""
        mark = re.search(r"\D", found)[0]
        day_first, month_first = ("day", "month", "year"), ("month", "day", "year")
        orders = [("year", "month", "day")] if found[4] == mark else [day_first, month_first] if mark == "." else [month_first, day_first]
        numbers = list(map(int, found.split(mark)))
        for order in orders:
            fields = dict(zip(order, numbers, strict=True))
            if 1900 <= fields["year"] <= 2099 and 1 <= fields["month"] <= 12 and 1 <= fields["day"] <= calendar.monthrange(fields["year"], fields["month"])[1]:
                break
        else:
            return None
        kind, number, size = _date_number(datetime.date(**fields))
        made = _date_of(kind, self._permute(kind)(number, size))
        return mark.join(f"{getattr(made, n):0{4 if n == 'year' else 2}d}" for n in order)

    def email(self, found: str) -> str | None:
        name, _, domain = found.rpartition("@")
        sizes = [10 if c.isdigit() else 26 for c in name.lower() if c.isalnum()]
        values = [int(c) if c.isdigit() else ord(c) - 97 for c in name.lower() if c.isalnum()]
        shape = "".join("d" if s == 10 else "a" for s in sizes)
        made = _mixed_radix(values, sizes, self._permute(f"email:{domain.lower()}:{shape}"))
        spelt = _spell(name, "".join(str(v) if s == 10 else chr(97 + v) for v, s in zip(made, sizes, strict=True)))
        return "".join(new.upper() if old.isupper() else new for old, new in zip(name, spelt, strict=True)) + "@" + domain

    def hex(self, found: str) -> str | None:
        if found.isdigit() or found.isalpha():
            return None
        made = found
        while made is found or made.isdigit() or made.isalpha():
            made = f"{self._permute('hex')(int(made, 16), 16 ** len(found)):0{len(found)}x}"
        return made.upper() if found.isupper() else made


KINDS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])|(?<=[.+-])[A-Za-z0-9]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "hex": re.compile(r"(?<!\w)(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?!\w)"),
    "ip": re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"),
    "date": re.compile(r"(?<![\w./-])(?:\d{4}([./-])\d{2}\1\d{2}|\d{2}([./-])\d{2}\2\d{4})(?!(?!T\d\d)\w|[./-]\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?!\w|-\d)"),
    "phone": re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}(?!\w|[.-]\d)"),
}


# Digits in groups; numbers in the usual groups of the North American plan.
_DIGIT_GROUPS = re.compile(r"(?<![\w+-])\d+(?:[ -]\d+)*(?!\w)")
_PHONE_PART = re.compile(r"(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-]?)\d{3}[ .-]?\d{4}(?!\w|[.-]\d)")
_PHONE_PART_CHARS = len("+1 (555) 555-5555")


def _card_spans(text: str) -> Iterator[tuple[int, int]]:
    """Within a run of digits first single groups, then groups of four digits or more, of which the last may be shorter, the longest first."""
    for run in _DIGIT_GROUPS.finditer(text):
        if run.end() - run.start() < 13:
            continue
        groups = [(run.start() + m.start(), run.start() + m.end()) for m in re.finditer(r"\d+", run[0])]
        found = []
        for i, (start, _) in enumerate(groups):
            digits = 0
            for j in range(i, len(groups)):
                size = groups[j][1] - groups[j][0]
                digits += size
                if digits > 19:
                    break
                if digits >= 13:
                    found.append((j > i, -digits, start, groups[j][1]))
                if size < 4:
                    break
        yield from (f[2:] for f in sorted(found))


def spans(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Where a value of the kind can be, the likelier of two that overlap first.

    Besides the pattern's own matches these are parts of them between separators: cards as groups of a run of
    digits, IBANs and numbers with + without their last groups, IBANs with a later start, phone numbers in the usual groups.
    """
    if kind == "card":
        yield from _card_spans(text)
    for match in KINDS[kind].finditer(text):
        start, end = match.span()
        yield start, end
        if kind == "iban":
            for at in (start, *(start + m.end() for m in re.finditer(" ", match[0]))):
                part = KINDS[kind].match(text, at)
                if part:
                    yield part.span()
                    yield from ((at, at + m.start()) for m in reversed(list(re.finditer(" ", part[0]))))
        elif kind == "phone":
            if match[0][0] == "+":
                yield from ((start, start + m.start()) for m in reversed(list(re.finditer("[ .-]", match[0]))) if KINDS[kind].fullmatch(text, start, start + m.start()))
            # A part that begins before the end has no more characters after it than that, and the two that it must not be followed by.
            limit = end + _PHONE_PART_CHARS + 2
            part = _PHONE_PART.search(text, start, limit) if end - start > 10 else None
            while part and part.start() < end:
                yield part.span()
                part = _PHONE_PART.search(text, part.end(), limit)


def replaced(text: str, names: Pseudonyms, kinds: tuple[str, ...]) -> tuple[str, dict[str, int]]:
    """``text`` with pseudonyms, and how many of each kind."""
    if not _SOME.search(text):
        return text, {}
    # In order, and none overlaps another.
    taken: list[tuple[int, int, str]] = []
    counts: dict[str, int] = {}
    for kind in kinds:
        for start, end in spans(kind, text):
            place = bisect.bisect_left(taken, (end,))
            if place and start < taken[place - 1][1]:
                continue
            new = getattr(names, kind)(text[start:end])
            if new is not None:
                taken.insert(place, (start, end, new))
                counts[kind] = counts.get(kind, 0) + 1
    out, at = [], 0
    for start, end, new in taken:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), counts


def pseudonymised(docs: DataFrame, key: bytes, kinds: tuple[str, ...] = tuple(KINDS), undo: bool = False, names: tuple[str, str] = ("found", "n_found")) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, the number of finds by kind and their number.

    Columns of ``docs`` with the names of the last two give way.
    """
    drop = {n.lower() for n in names}
    keep = [c for c in docs.columns if c.lower() not in drop]
    kept = [c for c in keep if c.lower() != "text"]
    hidden = "pseudonymised_text"
    while hidden in docs.columns:
        hidden += "_"

    def make():
        values = Pseudonyms(key, undo)

        def compute(texts):
            made = [(None, {}) if t is None else replaced(t, values, kinds) for t in texts]
            return [t for t, _ in made], [list(c.items()) for _, c in made]

        return compute

    out = map_texts(docs, make, [(hidden, T.StringType()), (names[0], T.MapType(T.StringType(), T.IntegerType()))], kept)
    total = F.aggregate(F.map_values(names[0]), F.lit(0), lambda a, n: a + n)
    return out.select(*(F.col(hidden).alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in keep), names[0], total.alias(names[1]))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A public key: whoever uses the operator passes their own.
    found = pseudonymised(documents(spark, sf_dir).select("doc_id", "text"), b"example key")
    counts = [F.coalesce(F.col("found").getItem(k), F.lit(0)).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", "text", "n_found", *counts)
