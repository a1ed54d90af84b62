"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Every recognised value is validated, turned into a number within its format's domain,
permuted there under the key, and written back in the same layout: a card number
becomes another one with a right check digit, a date another date. The permutation
depends on key, kind and layout alone, so equal values stay equal across all documents,
and two different values of a layout never meet.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from datetime import date, timedelta
from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of 0 to size - 1, or its inverse.

    Alternating Feistel rounds over two numbers whose ranges multiply to ``size`` or a
    little more; a result outside is permuted again until it falls inside. Small domains
    may have values that fall on themselves.
    """
    if size <= 1:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def mix(round_: int, half: int) -> int:
        text = f"{kind}:{size}:{round_}:{half}".encode()
        return int.from_bytes(hmac.digest(key, text, "sha256"), "big")

    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    sign = -1 if back else 1
    while True:
        left, right = divmod(value, b)
        for r in order:
            if r % 2:
                right = (right + sign * mix(r, left)) % b
            else:
                left = (left + sign * mix(r, right)) % a
        value = left * b + right
        if value < size:
            return value


def luhn(digits: str) -> int:
    """Check sum of a digit string including its check digit, modulo 10."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _fill(layout: str, symbols: str) -> str:
    """``layout`` with its letters and digits replaced in turn."""
    rest = iter(symbols)
    return "".join(next(rest) if c.isalnum() else c for c in layout)


def _bare(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


class Pseudonyms:
    """Finds and replaces values under one key."""

    def __init__(self, key: bytes, back: bool = False):
        if not key:
            raise ValueError("a key is needed")
        self.key, self.back = key, back

    def _turn(self, value: int, size: int, kind: str) -> int:
        return permute(value, size, self.key, kind, self.back)

    def _symbols(self, text: str, kind: str) -> str:
        """Permutes digits among digits and ASCII letters among letters of their case, all together; the rest stays.

        A secret of lower-case hexadecimal digits alone stays one, and no other becomes one.
        """
        hexadecimal = kind == "secret" and not set(text) - set(HEXADECIMAL)
        sets = [HEXADECIMAL if hexadecimal else "0123456789" if c in "0123456789" else ALPHABET if c in ALPHABET else ALPHABET.upper() if c in ALPHABET.upper() else "" for c in text]
        value, size = 0, 1
        for c, chars in zip(text, sets, strict=True):
            if chars:
                value, size = value * len(chars) + chars.index(c), size * len(chars)
        kind_ = kind + ":" + "".join("-" if not s else s[0] for s in sets)
        while True:
            value, out = self._turn(value, size, kind_), []
            left = value
            for c, chars in zip(reversed(text), reversed(sets), strict=True):
                if chars:
                    left, at = divmod(left, len(chars))
                    c = chars[at]
                out.append(c)
            if kind != "secret" or hexadecimal or set(out) - set(HEXADECIMAL):
                return "".join(reversed(out))

    def card(self, text: str) -> str | None:
        digits = _bare(text)
        if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or luhn(digits) or len(set(re.findall(r"[ -]", text))) > 1:
            return None
        inner = self._turn(int(digits[1:-1]), 10 ** (len(digits) - 2), f"card{digits[0]}")
        body = f"{digits[0]}{inner:0{len(digits) - 2}d}"
        return _fill(text, body + str(-luhn(body + "0") % 10))

    def phone(self, text: str) -> str | None:
        digits = _bare(text)[-10:]
        if digits[0] in "01" or digits[3] in "01":
            return None
        value = ((int(digits[0]) - 2) * 100 + int(digits[1:3])) * 800 + (int(digits[3]) - 2) * 100 + int(digits[4:6])
        value = self._turn(value * 10_000 + int(digits[6:]), 800 * 800 * 10_000, "phone")
        value, line = divmod(value, 10_000)
        area, exchange = divmod(value, 800)
        head = _bare(text)[:-10]
        return _fill(text, f"{head}{area + 200:03d}{exchange + 200:03d}{line:04d}")

    def international(self, text: str) -> str | None:
        digits = _bare(text)
        if not 8 <= len(digits) <= 15:
            return None
        keep = 2
        return _fill(text, digits[:keep] + self._symbols(digits[keep:], "tel" + digits[:keep]))

    def address(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        value = self._turn(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ipv4")
        return ".".join(map(str, value.to_bytes(4, "big")))

    def social(self, text: str) -> str | None:
        area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self._turn(value, 898 * 99 * 9999, "ssn"), 9999)
        area, group = divmod(value, 99)
        return f"{area + 1 + (area + 1 >= 666):03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"

    def account(self, text: str) -> str | None:
        bare = _bare(text)

        def rest(country: str, body: str, check: str) -> int:
            return int("".join(str(int(c, 36)) for c in body + country + check)) % 97

        if not 15 <= len(bare) <= 34 or rest(bare[:2], bare[4:], bare[2:4]) != 1:
            return None
        body = self._symbols(bare[4:], "iban" + bare[:2])
        return _fill(text, f"{bare[:2]}{98 - rest(bare[:2], body, '00'):02d}{body}")

    def day(self, text: str) -> str | None:
        """A date of the same century and the same layout.

        A layout is the order of the numbers and their widths; month-first is what cannot
        be day-first. Days are permuted within the century until one can be written in
        the layout, so every layout keeps to itself and no two of its dates meet.
        """
        numbers = re.findall(r"\d+", text)
        first = len(numbers[0]) == 4
        year, month, day = (int(x) for x in (numbers if first else numbers[::-1]))
        flip = not first and month > 12 >= day
        if flip:
            month, day = day, month
        try:
            value = date(year, month, day)
        except ValueError:
            return None
        narrow_month, narrow_day = (len(numbers[i]) == 1 for i in ((1, 2) if first else (0, 1) if flip else (1, 0)))
        start = date(year // 100 * 100, 1, 1)
        size = (date(year // 100 * 100 + 99, 12, 31) - start).days + 1
        new = value
        while True:
            new = start + timedelta(self._turn((new - start).days, size, f"date{start.year}"))
            if not (narrow_month and new.month > 9 or narrow_day and new.day > 9 or flip and new.day <= 12):
                break
        written_month, written_day = f"{new.month:0{2 - narrow_month}d}", f"{new.day:0{2 - narrow_day}d}"
        year_, mark = f"{new.year}", re.sub(r"\d", "", text)[0]
        return mark.join([year_, written_month, written_day] if first else [written_month, written_day, year_] if flip else [written_day, written_month, year_])

    def email(self, text: str) -> str | None:
        name, _, host = text.rpartition("@")
        return f"{self._symbols(name, 'mail')}@{host}"

    def secret(self, text: str) -> str | None:
        """What follows the marker of a key, password or token."""
        m = re.match(r"""AKIA|[^=:]*[=:]\s*["']?""", text)
        return m[0] + self._symbols(text[m.end() :], "secret")

    def replace(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms, and the kinds of the values replaced in order."""
        if text is None or not HINT.search(text):
            return text, []
        kinds: list[str] = []
        out, at, look = [], 0, 0
        while m := FIND.search(text, look):
            new = getattr(self, m.lastgroup)(m[0])
            if new is None:  # something valid may begin inside
                look = m.start() + 1
                continue
            kinds.append(m.lastgroup)
            out += [text[at : m.start()], new]
            at = look = m.end()
        return "".join([*out, text[at:]]), kinds


ALPHABET = "abcdefghijklmnopqrstuvwxyz"
HEXADECIMAL = "0123456789abcdef"
HINT = re.compile(r"[0-9@=:]|AKIA")
# The layouts of values, in order of precedence where several begin at one place.
FIND = re.compile(
    r"""
      (?P<secret>(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])
        |(?<![A-Za-z])(?i:password|passwd|secret|api_key|apikey|token)\s*[=:]\s*["']?[A-Za-z0-9+/_-]{8,})
    | (?P<email>(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-]))
    | (?P<account>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    | (?P<phone>(?<![\w.])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-]))
    | (?P<day>(?<![\w./-])(?:(?:19|20)[0-9]{2}(?P<s1>[-/.])[0-9]{2}(?P=s1)[0-9]{2}|[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)(?:19|20)[0-9]{2})(?![\w/-]|[.][0-9]))
    | (?P<social>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
    | (?P<address>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|[.][0-9]))
    | (?P<card>(?<![\w.-])(?:[2-6][0-9]{12,18}|[2-6][0-9]{3}(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{1,7}|3[0-9]{3}(?P<s4>[ -])[0-9]{6}(?P=s4)[0-9]{5})(?![\w-]))
    | (?P<international>(?<![\w.])\+[1-9][0-9](?:[ .-]?\(?[0-9]{1,5}\)?){2,6}(?![\w-]))
    """,
    re.VERBOSE,
)


def pseudonymise(docs: DataFrame, key: bytes, keep: tuple[str, ...] = ("doc_id",), back: bool = False) -> DataFrame:
    """``keep`` columns of ``docs``, text with pseudonyms, and kinds: what was replaced, in order.

    Replaced are e-mail names, phone numbers, card numbers with a right check digit, IPv4
    addresses, social security numbers, IBANs with right check digits, calendar dates of
    1900 to 2099, access keys, passwords and tokens. What fails its check stays. A null
    text stays null; an empty one empty. ``back`` restores what the same key replaced.
    """
    own = hashlib.sha256(key).digest() if key else b""

    @F.pandas_udf("text string, kinds array<string>")
    def replaced(texts):
        import pandas as pd

        names = Pseudonyms(own, back)
        return pd.DataFrame([names.replace(t) for t in texts], columns=["text", "kinds"])

    Pseudonyms(own, back)
    out = docs.select(*[c for c in keep if c != "text"], replaced("text").alias("_new"))
    return out.select(*[c for c in keep if c != "text"], F.col("_new.text").alias("text"), F.col("_new.kinds").alias("kinds"))
