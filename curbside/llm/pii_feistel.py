"""Personal data replaced by pseudonyms of the same format, by a keyed Feistel permutation.

Numbers and dates are found by pattern and validated (check digits, ranges,
calendar). A valid value is numbered within all values of its format, the number
is permuted by a Feistel network under a secret key, and the value of that
number takes its place. Equal values get equal pseudonyms in every document,
also when they are written with other separators; different values never share
one; the key's owner can turn pseudonyms back.

Formats: card numbers (Luhn digit kept valid), account numbers with two check
digits, social security numbers, phone numbers (country code kept), IPv4
addresses, dates of 1900 to 2099, mail addresses (letters and digits of name and
host; the last label stays), access keys and long hexadecimal secrets.

Defined results: a NULL text stays NULL with no values; a text without values is
returned as it is; repeated rows are each treated; an empty table gives an
empty result. Texts of any length are searched whole, and values of any length
replaced, in linear time: above ``SHORT`` letters a network adds to each place of
one half what a keyed stream over the other half gives.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b, shake_256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbside.llm.text import map_texts, small_batches

ROUNDS = 10
# Letters up to which a text is permuted as one number.
SHORT = 64

# What the formats look like.
MAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
)
NUMBER = re.compile(
    r"(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))"
    r"|(?P<iso>(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9]))"
    r"|(?P<day>(?<![0-9./-])[0-9]{1,2}(?P<sep>[./-])[0-9]{1,2}(?P=sep)[0-9]{4}(?![0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))"
    r"|(?P<card>(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,4}"
    r"(?:(?P=gap)[0-9]{1,3})?|[0-9]{4}(?P<amex>[ -])[0-9]{6}(?P=amex)[0-9]{5})(?![0-9]))"
    r"|(?P<phone>(?<![0-9A-Za-z+])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5})(?![0-9]))"
)
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
SECRET = re.compile(r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])")
FIRST_DAY, DAYS = date(1900, 1, 1), 73_049

DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()


class Feistel:
    """Keyed permutations of 0..n-1 for any n, one for each tweak."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, turn: int, half: int, side: int) -> int:
        width = (side.bit_length() + 7) // 8
        data = b"%d|%s|%d|%d|" % (turn, tweak.encode(), side, half)
        out = b""
        while len(out) < width + 8:  # 8 bytes more leave no noticeable bias
            out += blake2b(data + b"%d" % len(out), key=self.key).digest()
        return int.from_bytes(out[: width + 8]) % side

    def permute(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """Walks until the number is below ``size``; the square holding it is hardly larger."""
        if size < 2:
            return value
        side = isqrt(size - 1) + 1
        while True:
            left, right = divmod(value, side)
            for turn in range(ROUNDS):
                if back:
                    turn = ROUNDS - 1 - turn
                    left, right = (right - self._round(tweak, turn, left, side)) % side, left
                else:
                    left, right = right, (left + self._round(tweak, turn, right, side)) % side
            value = left * side + right
            if value < size:
                return value


    def permute_places(self, places: np.ndarray, sizes: np.ndarray, tweak: str, back: bool = False) -> np.ndarray:
        """A permutation of all lists with places below the given sizes, in time linear in their length."""
        places, middle = places.astype(np.int64), len(places) // 2
        halves = slice(0, middle), slice(middle, None)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            told, changed = halves if turn % 2 else halves[::-1]
            told_digest = blake2b(places[told].astype(np.uint8).tobytes(), key=self.key).digest()
            head = self.key + b"%d|%d|%s|" % (turn, len(places), tweak.encode())
            stream = shake_256(head + told_digest).digest(4 * len(places[changed]))
            shift = np.frombuffer(stream, "<u4").astype(np.int64)
            places[changed] = (places[changed] + (-shift if back else shift)) % sizes[changed]
        return places


def _mixed(text: str, alphabets: list[str], f: Callable[[int, int], int]) -> str:
    """Apply ``f(number, size)`` to a text read as a number whose places have these alphabets."""
    value, size = 0, 1
    for letter, alphabet in zip(text, alphabets):
        value = value * len(alphabet) + alphabet.index(letter)
        size *= len(alphabet)
    value, out = f(value, size), []
    for alphabet in reversed(alphabets):
        value, place = divmod(value, len(alphabet))
        out.append(alphabet[place])
    return "".join(reversed(out))


def _classes(text: str) -> list[str]:
    return [DIGITS if c in DIGITS else UPPER if c in UPPER else LOWER for c in text]


def _refill(shape: str, letters: str) -> str:
    """The letters and digits of ``shape`` replaced in order; separators stay."""
    fresh = iter(letters)
    return "".join(next(fresh) if c.isalnum() else c for c in shape)


def luhn_digit(payload: str) -> str:
    doubled = (int(c) * (2 - i % 2) for i, c in enumerate(reversed(payload)))
    return str(-sum(d // 10 + d % 10 for d in doubled) % 10)


def account_digits(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


class Pseudonyms:
    """Finds values in a text and replaces them; with ``back``, turns pseudonyms into values."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel = Feistel(key)
        self.back = back

    def _permute(self, tweak: str) -> Callable[[int, int], int]:
        return lambda value, size: self.feistel.permute(value, size, tweak, self.back)

    def _letters(self, text: str, tweak: str) -> str:
        classes = _classes(text)
        if len(text) <= SHORT:
            return _mixed(text, classes, self._permute(f"{tweak}:{len(text)}"))
        places = np.array([alphabet.index(c) for c, alphabet in zip(text, classes)])
        sizes = np.array([len(alphabet) for alphabet in classes])
        fresh = self.feistel.permute_places(places, sizes, tweak, self.back)
        return "".join([alphabet[i] for alphabet, i in zip(classes, fresh.tolist())])

    def mail(self, found: str) -> str:
        name, _, host = found.rpartition("@")
        head, dot, last = host.rpartition(".")
        bare = "".join(c for c in name + head if c.isalnum())
        fresh = _refill(f"{name}@{head}", self._letters(bare, "mail"))
        return fresh + dot + last

    def ip(self, found: str) -> str | None:
        parts = [int(p) for p in found.split(".")]
        if max(parts) > 255:
            return None
        value = self._permute("ip")(int.from_bytes(bytes(parts)), 1 << 32)
        return ".".join(map(str, value.to_bytes(4)))

    def _day(self, year: int, month: int, day: int) -> date | None:
        try:
            place = (date(year, month, day) - FIRST_DAY).days
        except ValueError:
            return None
        if not 0 <= place < DAYS:
            return None
        return FIRST_DAY + timedelta(days=self._permute("date")(place, DAYS))

    def iso(self, found: str) -> str | None:
        fresh = self._day(*map(int, found.split("-")))
        return fresh and fresh.isoformat()

    def day(self, found: str) -> str | None:
        """Month first with slashes where that is a date, else day first."""
        sep = next(c for c in found if not c.isdigit())
        a, b, year = found.split(sep)
        width = 2 if len(a) == len(b) == 2 else 1
        orders = [(a, b), (b, a)] if sep == "/" else [(b, a)]
        for month, day in orders:
            fresh = self._day(int(year), int(month), int(day))
            if fresh:
                parts = [fresh.month, fresh.day] if (month, day) == (a, b) and sep == "/" else [fresh.day, fresh.month]
                return sep.join(f"{p:0{width}d}" for p in parts) + f"{sep}{fresh.year}"
        return None

    def ssn(self, found: str) -> str | None:
        area, group, serial = (int(p) for p in found.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        place = area - 1 - (area > 666)
        value = self._permute("ssn")((place * 99 + group - 1) * 9_999 + serial - 1, 898 * 99 * 9_999)
        place, serial = divmod(value, 9_999)
        area, group = divmod(place, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def card(self, found: str) -> str | None:
        digits = "".join(c for c in found if c.isdigit())
        if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
            return None
        payload = digits[0] + self._letters(digits[1:-1], f"card:{digits[0]}")
        return _refill(found, payload + luhn_digit(payload))

    def phone(self, found: str) -> str | None:
        code = re.match(r"\+[0-9]{1,3}(?![0-9])|\+1|", found)[0]
        rest = found[len(code) :]
        digits = "".join(c for c in rest if c.isdigit())
        if not 7 <= len(digits) <= 15:
            return None
        return code + _refill(rest, self._letters(digits, f"phone{code}"))

    def account(self, found: str) -> str | None:
        bare = found.replace(" ", "")
        country, check, rest = bare[:2], bare[2:4], bare[4:]
        if account_digits(country, rest) != check:
            return None
        rest = self._letters(rest, f"account:{country}")
        return _refill(found, country + account_digits(country, rest) + rest)

    def secret(self, found: str) -> str:
        if found.startswith("AKIA"):
            rest = _mixed(found[4:], [DIGITS + UPPER] * 16, self._permute("key"))
            return "AKIA" + rest
        alphabet = DIGITS + ("ABCDEF" if found.isupper() else "abcdef")
        return _mixed(found, [alphabet] * len(found), self._permute(f"hex:{len(found)}"))

    def values(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, format, pseudonym) of every value, in order, without overlaps."""
        found = []
        if "@" in text:
            found += [(m.start(), m.end(), "mail", self.mail(m[0])) for m in MAIL.finditer(text)]
        for name, pattern in (("secret", SECRET), ("account", ACCOUNT)):
            for m in pattern.finditer(text):
                fresh = getattr(self, name)(m[0])
                if fresh is not None:
                    found.append((m.start(), m.end(), name, fresh))
        at = 0
        while m := NUMBER.search(text, at):
            kind = m.lastgroup if m.lastgroup not in ("sep", "gap", "amex") else None
            kind = kind or next(k for k in ("day", "card") if m[k])
            fresh = getattr(self, kind)(m[0])
            if fresh is None and kind == "card" and m[0].isdigit() is False:
                at = m.start() + 1
                continue
            at = m.end()
            if fresh is not None:
                found.append((m.start(), m.end(), kind, fresh))
        kept, end = [], 0
        order = {"mail": 0, "secret": 1, "account": 2}
        for value in sorted(found, key=lambda v: (v[0], order.get(v[2], 3))):
            if value[0] >= end:
                kept.append(value)
                end = value[1]
        return kept

    def replace(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms, and the formats of the values replaced."""
        if not text or not HINT.search(text):
            return text, []
        values = self.values(text)
        parts, at = [], 0
        for start, end, _, fresh in values:
            parts += [text[at:start], fresh]
            at = end
        return "".join(parts) + text[at:], [v[2] for v in values]


# Every value holds one of these or is a secret of letters alone.
HINT = re.compile(r"[0-9@]|AKIA|[a-fA-F]{32}")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with pseudonyms in their texts; columns as given."""

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in small_batches(batches, text):
            at = batch.schema.get_field_index(text)
            fresh = [names.replace(t)[0] for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(fresh, batch.column(at).type))

    return map_texts(docs, replaced, docs.schema)


def pseudonym_report(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_values, kinds, text), one per document, with pseudonyms in the text."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in small_batches(batches, "text"):
            fresh, kinds = zip(*map(names.replace, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(k) for k in kinds], pa.int64()),
                    pa.array([sorted(k) for k in kinds], pa.list_(pa.string())),
                    pa.array(fresh, pa.string()),
                ],
                names=["doc_id", "n_values", "kinds", "text"],
            )

    kind = whole.schema["doc_id"].dataType.simpleString()
    return map_texts(whole, replaced, f"doc_id {kind}, n_values long, kinds array<string>, text string")
