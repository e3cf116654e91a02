"""Format-preserving pseudonyms for personal data.

Values that pass their format's check (Luhn digit, calendar, octets, mod 97, …) are
permuted within the format by a keyed Feistel network over exactly the values the format
allows. Equal values get equal pseudonyms in every document, whatever separators they are
written with, and the key's owner can invert them.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import PREFIX

ROUNDS = 10
KEY_SETTING = "spark.tidemark.pii.key"
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY

# What a value looks like; of the alternatives at a place the first that passes its check counts.
_PATTERN = re.compile(
    r"""
      (?<![\w.+%-]) (?P<email> [\w.+%-]+ @ [A-Za-z0-9-]+ (?:\.[A-Za-z0-9-]+)* \.[A-Za-z]{2,} )
    | (?<!\w) (?P<iban> [A-Z]{2}[0-9]{2} (?:\ ?[A-Z0-9]{4}){2,7} (?:\ ?[A-Z0-9]{1,4})? ) (?!\w)
    | (?<!\w) (?P<token> [0-9a-f]{32,128} | [0-9A-F]{32,128} ) (?!\w)
    | (?<![\w.]) (?P<ip> [0-9]{1,3} (?:\.[0-9]{1,3}){3} ) (?!\w|\.[0-9])
    | (?<![\w./-]) (?P<date> [0-9]{4}-[0-9]{2}-[0-9]{2} | [0-9]{4}/[0-9]{2}/[0-9]{2}
        | [0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4} | [0-9]{1,2}/[0-9]{1,2}/[0-9]{4} ) (?![/-]?(?![Tt][0-9]{2})\w)
    | (?<![\w-]) (?P<ssn> [0-9]{3}-[0-9]{2}-[0-9]{4} ) (?![\w-])
    | (?<!\w) (?P<phone> \+1 [\ .-]? (?:\([0-9]{3}\)|[0-9]{3}) [\ .-]? [0-9]{3} [\ .-]? [0-9]{4}
        | \+[0-9]{1,3} [\ .-]? (?:\([0-9]{1,4}\)|[0-9]{1,4}) (?:[\ .-]?[0-9]{2,4}){2,4}
        | \([0-9]{3}\)\ ?[0-9]{3}[\ .-][0-9]{4} | [0-9]{3}-[0-9]{3}-[0-9]{4} | [0-9]{3}\.[0-9]{3}\.[0-9]{4} ) (?!\w)
    | (?<![\w.-]) (?P<card> [0-9]{13,19} | [0-9]{4}(?:-[0-9]{4}){3}(?:-[0-9]{1,3})?
        | [0-9]{4}(?:\ [0-9]{4}){3} | [0-9]{4}[\ -][0-9]{6}[\ -][0-9]{5} ) (?!\w|[.-][0-9])
    """,
    re.VERBOSE,
)
_KINDS = {
    kind: re.compile(alternative, re.VERBOSE)
    for alternative in re.split(r"\n    \| (?=\(\?<!)", _PATTERN.pattern)
    for kind in re.findall(r"\(\?P<(\w+)>", alternative)
}
_MAY_HOLD = re.compile(r"[0-9@]").search


class Permuter:
    """Keyed permutations of ``range(size)``, one for each label and size."""

    def __init__(self, key: str):
        self._key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def _round(self, label: str, size: int, number: int, half: int) -> int:
        message = f"{label}/{size}/{number}/{half}".encode()
        width = min(64, (size.bit_length() + 7) // 8 + 8)
        blocks = -(-((size.bit_length() + 7) // 8 + 8) // width)
        digest = b"".join(
            hashlib.blake2b(message + bytes([i]), digest_size=width, key=self._key).digest()
            for i in range(blocks)
        )
        return int.from_bytes(digest, "big")

    def _pass(self, label: str, size: int, value: int, inverse: bool) -> int:
        left_size = math.isqrt(size - 1) + 1
        right_size = -(-size // left_size)
        left, right = divmod(value, right_size)
        numbers = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
        sign = -1 if inverse else 1
        for number in numbers:
            if number % 2 == 0:
                left = (left + sign * self._round(label, size, number, right)) % left_size
            else:
                right = (right + sign * self._round(label, size, number, left)) % right_size
        return left * right_size + right

    def permute(
        self,
        label: str,
        size: int,
        value: int,
        inverse: bool = False,
        allowed: Callable[[int], bool] | None = None,
    ) -> int:
        """The value's image among the allowed values; walks on while outside them."""
        if size < 2:
            return value
        while True:
            value = self._pass(label, size, value, inverse)
            if value < size and (allowed is None or allowed(value)):
                return value


def luhn_digit(digits: str) -> str:
    """The check digit that completes ``digits``."""
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += sum(divmod(2 * digit, 10)) if i % 2 == 0 else digit
    return str(-total % 10)


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    fresh = iter(digits)
    return "".join(next(fresh) if c.isdigit() else c for c in pattern)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


class Pseudonymizer:
    """Replaces personal data in a text; ``inverse`` brings the originals back."""

    def __init__(self, key: str, inverse: bool = False):
        self._permuter = Permuter(key)
        self._inverse = inverse
        # equal values are frequent within a task
        self._known = lru_cache(maxsize=100_000)(self._replace)

    def _permute(self, label, size, value, allowed=None) -> int:
        return self._permuter.permute(label, size, value, self._inverse, allowed)

    def _permute_digits(self, label: str, digits: str) -> str:
        size = 10 ** len(digits)
        return str(self._permute(f"{label}{len(digits)}", size, int(digits))).zfill(len(digits))

    def _permute_letters(self, label: str, text: str) -> str:
        """ASCII letters and digits within their class; the case pattern stays."""
        value, size = 0, 1
        shape = []
        for c in text:
            base = 10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 1
            shape.append(base)
            code = ord(c) - 48 if base == 10 else ord(c.lower()) - 97 if base == 26 else 0
            value, size = value * base + code, size * base
        kinds = "".join({10: "9", 26: "a", 1: "-"}[b] for b in shape)
        value = self._permute(f"{label}:{kinds}", size, value)
        out = []
        for c, base in zip(reversed(text), reversed(shape)):
            value, code = divmod(value, base)
            if base == 10:
                c = chr(48 + code)
            elif base == 26:
                c = chr((65 if c.isupper() else 97) + code)
            out.append(c)
        return "".join(reversed(out))

    def _email(self, value: str) -> str:
        local, _, domain = value.rpartition("@")
        return f"{self._permute_letters('email', local)}@{domain}"

    def _iban(self, value: str) -> str | None:
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        head = value
        while True:  # the match may reach into the words behind
            plain = head.replace(" ", "")
            if 15 <= len(plain) <= 34 and number(plain[4:] + plain[:4]) % 97 == 1:
                break
            head, space, _ = head.rpartition(" ")
            if not space:
                return None
        body = self._permute_letters("iban" + plain[:2], plain[4:])
        check = 98 - number(body + plain[:2] + "00") % 97
        fresh = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(fresh) for c in head)

    def _token(self, value: str) -> str | None:
        if value.isdigit() or value.isalpha():
            return None
        size = 16 ** len(value)
        fits = lambda n: not (t := f"{n:0{len(value)}x}").isdigit() and not t.isalpha()
        fresh = f"{self._permute(f'token{len(value)}', size, int(value, 16), fits):0{len(value)}x}"
        return fresh.upper() if value.upper() == value else fresh

    def _ip(self, value: str) -> str | None:
        octets = value.split(".")
        if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
            return None
        number = int.from_bytes(bytes(map(int, octets)), "big")
        return ".".join(map(str, self._permute("ip", 1 << 32, number).to_bytes(4, "big")))

    def _date(self, value: str) -> str | None:
        mark = re.search(r"\D", value)[0]
        fields = value.split(mark)
        if len(fields[0]) == 4:
            orders = [(0, 1, 2)]
        elif mark == ".":
            orders = [(2, 1, 0)]
        else:
            orders = [(2, 0, 1), (2, 1, 0)]  # month first where that is a date
        for order in orders:
            year, month, day = (int(fields[i]) for i in order)
            try:
                number = datetime.date(year, month, day).toordinal() - FIRST_DAY
            except ValueError:
                continue
            if not 0 <= number < DAYS:
                return None
            narrow = any(len(f) == 1 for f in fields)
            # days that cannot be months map among themselves, or a day-first date would
            # turn into one that reads month-first; so do all other spellings of them
            late = day > 12
            fits = lambda n: n < DAYS and (datetime.date.fromordinal(FIRST_DAY + n).day > 12) == late
            fresh = datetime.date.fromordinal(FIRST_DAY + self._permute("date", DAYS, number, fits))
            parts = {order[0]: f"{fresh.year}", order[1]: f"{fresh.month:02d}", order[2]: f"{fresh.day:02d}"}
            if narrow:
                parts = {i: str(int(p)) for i, p in parts.items()}
            return mark.join(parts[i] for i in range(3))
        return None

    def _ssn(self, value: str) -> str | None:
        fits = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        digits = _digits(value)
        if not fits(digits):
            return None
        number = self._permute("ssn", 10**9, int(digits), lambda n: fits(f"{n:09d}"))
        return _refill(value, f"{number:09d}")

    def _phone(self, value: str) -> str | None:
        head = value
        while len(_digits(head)) > 15:  # longer than any number: groups behind it
            parts = re.fullmatch(r"(.*)[ .-][0-9]+", head)
            if parts is None:
                return None
            head = parts[1]
        digits = _digits(head)
        country = re.match(r"\+([0-9]+)", head)
        kept = len(country[1]) if country else 0
        if kept > 3 or head.startswith("+1"):  # no mark after the country code
            kept = 1
        if not 7 <= len(digits) - kept <= 14:
            return None
        return _refill(head, digits[:kept] + self._permute_digits("phone", digits[kept:]))

    def _card(self, value: str) -> str | None:
        digits = _digits(value)
        if luhn_digit(digits[:-1]) != digits[-1]:
            return None
        body = self._permute_digits("card", digits[:-1])
        return _refill(value, body + luhn_digit(body))

    def _replace(self, kind: str, value: str) -> str | None:
        return getattr(self, f"_{kind}")(value)

    def text(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms, and the kind of each value replaced."""
        if not text or not _MAY_HOLD(text):
            return text, []
        kinds: list[str] = []
        parts: list[str] = []
        done = at = 0
        while match := _PATTERN.search(text, at):
            start = match.start()
            at = start + 1  # a match without a valid value may hold one farther on
            for kind, pattern in _KINDS.items():
                match = pattern.match(text, start)
                fresh = self._known(kind, match[0]) if match else None
                if fresh is None:
                    continue
                # a phone number or IBAN may end before the match does, and keeps its length
                at = start + len(fresh) if kind in ("phone", "iban") else match.end()
                kinds.append(kind)
                parts += [text[done:start], fresh]
                done = at
                break
        return "".join([*parts, text[done:]]), kinds


_RESULT = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("n_values", T.LongType()),
        T.StructField("kinds", T.ArrayType(T.StringType())),
    ]
)


def pseudonyms(text: Column, key: str, inverse: bool = False) -> Column:
    """A struct of the new text, ``n_values`` replaced and their distinct ``kinds``."""

    @F.pandas_udf(_RESULT)
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker = Pseudonymizer(key, inverse)
        for texts in batches:
            found = [worker.text(t) for t in texts]
            yield pd.DataFrame(
                {
                    "text": pd.Series([t for t, _ in found], dtype=object),
                    "n_values": pd.Series([len(k) for _, k in found], dtype="int64"),
                    "kinds": pd.Series([sorted(set(k)) for _, k in found], dtype=object),
                }
            )

    return replace(text)


def pseudonymize(
    docs: DataFrame, text_col: str = "text", key: str | None = None, inverse: bool = False
) -> DataFrame:
    """All columns, the text with pseudonyms, and ``n_values`` and ``kinds`` of them.

    Kinds: email, iban, token (hexadecimal secrets), ip, date, ssn, phone, card. Values
    that fail their check stay as they are, so do texts without values; what follows a
    value, or stands inside a failed one, is searched again. A date is linked in all its
    spellings; whether its day is over 12 stays. Null texts stay
    null and empty ones empty; each row is handled alone, so repeated rows come out
    equal; columns of the input named like the two new ones are replaced. No shuffle.
    The key is ``key`` or the session's ``spark.tidemark.pii.key``; there is no other, as
    whoever knows the key can undo the pseudonyms.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"give a key, or set {KEY_SETTING}")
    result = f"{PREFIX}result"
    kept = [c for c in docs.columns if c not in ("n_values", "kinds")]
    changed = docs.select(
        *(F.col(f"`{c}`") for c in kept), pseudonyms(F.col(f"`{text_col}`"), key, inverse).alias(result)
    )
    return changed.select(
        *(F.col(f"{result}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in kept),
        F.col(f"{result}.n_values"),
        F.col(f"{result}.kinds"),
    )
