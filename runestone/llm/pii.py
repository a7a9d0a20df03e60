"""Format-preserving pseudonyms for personal data.

Values that pass the check of their kind (Luhn, mod 97, octets, calendar, numbering
plan) are put in place of other values of the same format: the digits, or letters and
digits, of a value form a number below the size of its format, which a keyed Feistel
network permutes. Equal values have equal pseudonyms in every document, also where they are
grouped or written differently, two values never share one, and nothing but the
key is needed to compute them: no table of values, no shuffle. ``restore`` is the inverse.

Kinds: e-mail addresses (the local part), IPv4 addresses, calendar dates, telephone
numbers, payment cards (stay Luhn-valid, with their first digit), social security numbers (stay valid),
IBANs (stay mod-97-valid), and access tokens
after ``token =`` and the like (hexadecimal ones stay so) or with the prefix AKIA.

Defined results: null stays null, empty stays empty. Digits that pass no check stay as
they are. Repeated rows get equal texts. An empty table gives an empty table. All other columns are kept;
a column ``n_pseudonyms`` of the input is replaced. A value that touches other letters or digits is no value.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from runestone.llm.common import column_of

ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY

# Characters of an IBAN by its country's code, as registered or in use.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "IR IS TR", 27: "BI CF CG CM DJ DZ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO EG GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> bytes:
    """Exactly the length that the country fixes, so that no word after it is taken in; else up to 34 characters."""
    exact = [
        f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, codes in IBAN_LENGTHS.items()
    ]
    other = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?P<iban>(?:{'|'.join([*exact, other])}))(?![0-9A-Za-z])".encode()


_EMAIL = rb"(?<![A-Za-z0-9._%+\x80-\xff-])(?P<email>[A-Za-z0-9._%+\x80-\xff-]+)@(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
# A time after a date, with its zone.
_TIME = rb"[Tt][0-9]{2}(?:(?::?[0-9]{2}){1,2}(?:[.,][0-9]+)?)?(?:[Zz]|[+-][0-9]{2}(?::?[0-9]{2})?)?(?![0-9A-Za-z])"
_NUMBERS = (
    rb"(?<![A-Za-z0-9.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9A-Za-z])"
    rb"|(?<![A-Za-z0-9./-])(?P<iso>[0-9]{4}-[0-9]{2}-[0-9]{2})(?:(?![-/.]?[0-9A-Za-z])|(?=" + _TIME + rb"))"
    rb"|(?<![A-Za-z0-9./-])(?P<day>[0-9]{1,2}(?P<sep>[./])[0-9]{1,2}(?P=sep)[0-9]{4})(?![-/.]?[0-9A-Za-z])"
    rb"|(?<![A-Za-z0-9])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![-]?[0-9A-Za-z])"
    rb"|(?<![A-Za-z0-9+])(?P<phone>(?:\+1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|(?:\+1[ .-]?)?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    rb"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4})(?![0-9A-Za-z]|\.[0-9])"
    rb"|" + _iban_pattern() +
    # In one piece, or in the groups that are printed on cards: never with the number after it.
    rb"|(?<![A-Za-z0-9])(?P<card>[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,7}"
    rb"|[0-9]{4}(?P<gap2>[ -])[0-9]{6}(?P=gap2)[0-9]{5})(?![0-9A-Za-z])"
)
_SECRET = (
    rb"(?i:(?<![A-Za-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?[ ]*[=:][ ]*[\"']?)"
    rb"(?P<secret>[A-Za-z0-9+/_-]{8,})|(?<![A-Za-z0-9])AKIA(?P<key>[0-9A-Z]{16})(?![0-9A-Za-z])"
)
_EMAILS, _DIGITS, _SECRETS = re.compile(_EMAIL), re.compile(_NUMBERS), re.compile(_SECRET)
# The separators inside a value are groups of their patterns too.
KINDS_OF_GROUPS = {"sep": "day", "gap": "card", "gap2": "card", "key": "secret"}
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_ANY_DIGIT = re.compile(rb"[0-9]{2}")


class Feistel:
    """Keyed permutations of 0..size-1 for any size."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, n: int, size: int, half: int, modulus: int) -> int:
        message = f"{kind}:{n}:{size}:{half}".encode()
        width = modulus.bit_length() // 8 + 9
        raw = b""
        while len(raw) < width:
            raw += hashlib.blake2b(message + bytes([len(raw) // 64]), key=self.key).digest()
        return int.from_bytes(raw[:width], "big") % modulus

    def _once(self, kind: str, value: int, size: int, back: bool) -> int:
        left = math.isqrt(size - 1) + 1
        right = -(-size // left)
        x, y = divmod(value, right)  # x < left, y < right
        for n in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if n % 2:
                y = (y + sign * self._round(kind, n, size, x, right)) % right
            else:
                x = (x + sign * self._round(kind, n, size, y, left)) % left
        return x * right + y

    def permute(self, kind: str, value: int, size: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """Walks on until the result is below ``size`` and valid, which keeps it a permutation of the valid values."""
        if size < 2:
            return value
        while True:
            value = self._once(kind, value, size, back)
            if value < size and (valid is None or valid(value)):
                return value


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def valid_ssn(value: int) -> bool:
    area, group, serial = value // 1_000_000, value // 10_000 % 100, value % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _refill(like: str, new: str, holds: Callable[[str], bool] = str.isdigit) -> str:
    """``like`` with its characters of a class replaced in turn by those of ``new``."""
    rest = iter(new)
    return "".join(next(rest) if holds(c) else c for c in like)


class Pseudonyms:
    """Replaces the values of a text; with ``back`` it restores them."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back

    def _number(self, kind: str, digits: str) -> str:
        return str(self.feistel.permute(f"{kind}{len(digits)}", int(digits), 10 ** len(digits), back=self.back)).zfill(len(digits))

    def _mixed(self, kind: str, text: str) -> str:
        """Letters stay letters of their case, digits stay digits."""
        sizes = [10 if "0" <= c <= "9" else 26 if "A" <= c <= "Z" or "a" <= c <= "z" else 1 for c in text]
        value = 0
        for c, size in zip(text, sizes, strict=True):
            value = value * size + (int(c) if size == 10 else ord(c.lower()) - 97 if size == 26 else 0)
        shape = "".join("d" if s == 10 else "A" if s == 26 and c.isupper() else "a" if s == 26 else c for c, s in zip(text, sizes, strict=True))
        value = self.feistel.permute(kind + shape, value, math.prod(sizes), back=self.back)
        out = []
        for c, size in zip(reversed(text), reversed(sizes), strict=True):
            value, n = divmod(value, size)
            out.append(c if size == 1 else str(n) if size == 10 else chr((65 if c.isupper() else 97) + n))
        return "".join(reversed(out))

    def email(self, x: str) -> str | None:
        return self._mixed("email", x) if any(c.isascii() and c.isalnum() for c in x) else None

    def secret(self, x: str) -> str | None:
        """Hexadecimal tokens stay hexadecimal; a plain word is no token."""
        if not any(c.isdigit() for c in x):
            return None
        if not _HEX.fullmatch(x):
            return self._mixed("secret", x)
        new = self.feistel.permute(f"hex{len(x)}", int(x, 16), 16 ** len(x), back=self.back)
        return f"{new:0{len(x)}{'X' if any(c.isupper() for c in x) else 'x'}}"

    def ip(self, x: str) -> str | None:
        octets = [int(o) for o in x.split(".")]
        if max(octets) > 255 or any(len(o) > 1 and o[0] == "0" for o in x.split(".")):
            return None
        new = self.feistel.permute("ip", int.from_bytes(bytes(octets), "big"), 1 << 32, back=self.back)
        return ".".join(map(str, new.to_bytes(4, "big")))

    def _date(self, year: int, month: int, day: int, kind: str = "date", valid: Callable[[datetime.date], bool] | None = None) -> datetime.date | None:
        try:
            at = datetime.date(year, month, day).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= at < DAYS:
            return None
        among = valid and (lambda n: valid(datetime.date.fromordinal(FIRST_DAY + n)))
        return datetime.date.fromordinal(FIRST_DAY + self.feistel.permute(kind, at, DAYS, among, self.back))

    def iso(self, x: str) -> str | None:
        new = self._date(*map(int, x.split("-")))
        return new and new.isoformat()

    def day(self, x: str) -> str | None:
        """Day first with dots; with slashes month first where that is a date. Written with two digits each.

        Other dates with slashes have a day over 12 first; they are permuted among themselves, those with a month of one digit too.
        """
        sep = "." if "." in x else "/"
        a, b, year = map(int, x.split(sep))
        if sep == "/" and a > 12:
            width = len(x.split(sep)[1])
            new = self._date(year, b, a, f"day first{width}", lambda d: d.day > 12 and (width == 2 or d.month < 10))
            return new and f"{new.day}/{new.month:0{width}d}/{new.year:04d}"
        if sep == "/":
            new = self._date(year, a, b)
            return new and f"{new.month:02d}/{new.day:02d}/{new.year:04d}"
        new = self._date(year, b, a)
        return new and f"{new.day:02d}.{new.month:02d}.{new.year:04d}"

    def ssn(self, x: str) -> str | None:
        value = int(x.replace("-", ""))
        if not valid_ssn(value):
            return None
        return _refill(x, f"{self.feistel.permute('ssn', value, 10**9, valid_ssn, self.back):09d}")

    def phone(self, x: str) -> str | None:
        """A country code, up to the first separator after a plus, stays."""
        code = re.match(r"\+[0-9]{1,3}(?=[ .(-])", x)
        head = code[0] if code else x[:2] if x[0] == "+" else ""
        digits = "".join(filter(str.isdigit, x[len(head):]))
        if not 7 <= len(digits) <= 14:
            return None
        return head + _refill(x[len(head):], self._number("phone", digits))

    def iban(self, x: str) -> str | None:
        plain = x.replace(" ", "")
        country, account = plain[:2], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, account) != plain[2:4]:
            return None
        new = self._mixed("iban" + country, account)
        return _refill(x, country + iban_check(country, new) + new, str.isalnum)

    def card(self, x: str) -> str | None:
        digits = "".join(filter(str.isdigit, x))
        if len(set(digits)) < 2 or str(luhn(digits[:-1])) != digits[-1]:
            return None
        new = digits[0] + self._number("card", digits[1:-1])
        return _refill(x, new + str(luhn(new)))

    def _one(self, kind: str, value: bytes) -> bytes | None:
        new = getattr(self, kind)(value.decode("utf-8", "surrogateescape"))
        return None if new is None else new.encode("utf-8", "surrogateescape")

    def text(self, text: bytes) -> tuple[bytes, int]:
        """The text with its values replaced, and how many there were."""
        count = 0

        def put(match: re.Match) -> bytes:
            nonlocal count
            kind = KINDS_OF_GROUPS.get(match.lastgroup, match.lastgroup)
            kept = "key" if match.lastgroup == "key" else kind
            value = match[kept]
            new = self._one(kind, value)
            if new is None:
                return match[0]
            count += 1
            start = match.start(kept) - match.start()
            return match[0][:start] + new + match[0][start + len(value):]

        # Longer contexts first, so that no part of a token or address is taken for a number.
        spans = []
        if b"=" in text or b":" in text or b"AKIA" in text:
            spans += [m for m in _SECRETS.finditer(text)]
        if b"@" in text:
            spans += [m for m in _EMAILS.finditer(text)]
        if _ANY_DIGIT.search(text):
            spans += [m for m in _DIGITS.finditer(text)]
        if not spans:
            return text, 0
        order = sorted(range(len(spans)), key=lambda i: (spans[i].start(), i))
        out, at = [], 0
        for i in order:
            if spans[i].start() >= at:
                out += [text[at:spans[i].start()], put(spans[i])]
                at = spans[i].end()
        return b"".join(out) + text[at:], count


def _replace(docs: DataFrame, key: bytes, back: bool) -> DataFrame:
    docs = docs.drop("n_pseudonyms")
    schema = StructType([*docs.schema.fields, StructField("n_pseudonyms", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key, back)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            results = [(None, 0) if t is None else pseudonyms.text(t) for t in column_of(batch, "text")]
            columns = batch.columns
            columns[at] = pa.array([t for t, _ in results], pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in results], pa.int64())], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_pseudonyms``."""
    return _replace(docs, key, False)


def restore(docs: DataFrame, key: bytes) -> DataFrame:
    """The inverse of ``pseudonymize`` under the same key."""
    return _replace(docs, key, True)
