"""Pseudonyms for personal numbers and dates: keyed permutations within their format.

A value that passes its validation is mapped to an integer of its kind's domain, permuted
there by a keyed Feistel network with cycle walking, and written back in its own layout.
The permutation depends on key and kind only, so equal values stay linked across
documents, also where they are written in different layouts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trendloom.llm.arrow import with_text_columns

ROUNDS = 8
KINDS = ("iban", "card", "ssn", "ip", "phone", "date", "email", "secret")


@lru_cache(maxsize=65536)
def permute(value: int, size: int, key: bytes, kind: str) -> int:
    """A keyed permutation of range(size): Feistel on two halves, walked into the range."""
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            tag = b"%s|%d|%d|" % (kind.encode(), size, r) + right.to_bytes(width, "big")
            f = hashlib.blake2b(tag, key=key, digest_size=width).digest()
            left, right = right, left ^ (int.from_bytes(f, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def _fill(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in layout)


def luhn_digit(body: str) -> int:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(s: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", s)
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != int(digits[-1]):
        return None
    n = len(digits) - 1
    body = str(permute(int(digits[:-1]), 10**n, key, f"card{n}")).zfill(n)
    return _fill(s, body + str(luhn_digit(body)))


def _outside_nanp(digits: str, key: bytes) -> str:
    """Ten digits whose area code or exchange begins with 0 or 1, permuted among themselves."""
    low, inner = 200 * 10**7, 200 * 10**4  # all numbers under area code 200; for each other one, exchanges under 200
    area, rest = divmod(int(digits), 10**7)
    rank = int(digits) if area < 200 else low + (area - 200) * inner + rest
    v = permute(rank, low + 800 * inner, key, "outside nanp")
    if v >= low:
        area, rest = divmod(v - low, inner)
        v = (area + 200) * 10**7 + rest
    return f"{v:010d}"


def _phone(s: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", s)
    prefix = ""
    if s.startswith("+") and not digits.startswith("1"):
        if not 8 <= len(digits) <= 15:
            return None
        n = len(digits) - 2  # the country code's first two digits stay
        return _fill(s, digits[:2] + str(permute(int(digits[2:]), 10**n, key, f"tel{n}")).zfill(n))
    if len(digits) == 11 and digits[0] == "1":
        prefix, digits = "1", digits[1:]
    if len(digits) != 10:
        return None
    if digits[0] < "2" or digits[3] < "2":
        return _fill(s, prefix + _outside_nanp(digits, key)) if prefix and s.startswith("+") else None
    area, office, line = int(digits[:3]) - 200, int(digits[3:6]) - 200, int(digits[6:])
    v = permute((area * 800 + office) * 10_000 + line, 800 * 800 * 10_000, key, "nanp")
    area, office, line = v // 8_000_000 + 200, v // 10_000 % 800 + 200, v % 10_000
    return _fill(s, f"{prefix}{area:03d}{office:03d}{line:04d}")


def _ip(s: str, key: bytes) -> str | None:
    parts = s.split(".")
    if len(parts) != 4 or any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
        return None
    v = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, v.to_bytes(4, "big")))


def _ssn(s: str, key: bytes) -> str | None:
    area, group, serial = map(int, s.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    rank = area - 1 - (area > 666)
    v = permute((rank * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn")
    rank = v // (99 * 9999)
    area = rank + 1 + (rank >= 665)
    return f"{area:03d}-{v // 9999 % 99 + 1:02d}-{v % 9999 + 1:04d}"


_FIRST_DAY = dt.date(1900, 1, 1)
_DAYS = (dt.date(2100, 1, 1) - _FIRST_DAY).days


def _date(s: str, key: bytes) -> str | None:
    """Year first, or day and month first: day before month where both readings hold."""
    sep = re.search(r"\D", s)[0]
    parts = s.split(sep)
    order = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))
    for y, m, d in order:
        try:
            day = dt.date(int(parts[y]), int(parts[m]), int(parts[d])) - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day.days < _DAYS:
            return None
        new = _FIRST_DAY + dt.timedelta(permute(day.days, _DAYS, key, "date"))
        out = [""] * 3
        out[y], out[m], out[d] = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
        return sep.join(out)
    return None


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = "0123456789abcdef"


def _letters(s: str, key: bytes, kind: str) -> str:
    """Letters and digits permuted as one mixed-radix number, each within its own alphabet."""
    hexed = kind == "secret" and not set(s) - set(_HEX)
    sets = [_HEX if hexed else next((a for a in _ALPHABETS if c in a), "") for c in s]
    size, value = 1, 0
    for c, a in zip(s, sets, strict=True):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)
    if size == 1:
        return s
    shape = "".join(str(len(a)) + "." for a in sets)
    value = permute(value, size, key, kind + hashlib.blake2b(shape.encode(), digest_size=8).hexdigest())
    out = []
    for c, a in zip(reversed(s), reversed(sets), strict=True):
        if a:
            value, i = divmod(value, len(a))
            c = a[i]
        out.append(c)
    return "".join(reversed(out))


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(s: str, key: bytes) -> str | None:
    plain = s.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = _letters(plain[4:], key, "iban" + plain[:2])
    new = iter(plain[:2] + f"{98 - _mod97(plain[:2] + '00' + body):02d}" + body)
    return "".join(c if c == " " else next(new) for c in s)


def _email(s: str, key: bytes) -> str | None:
    local, _, domain = s.partition("@")
    return f"{_letters(local, key, 'email')}@{domain}"


def _secret(s: str, key: bytes) -> str | None:
    head, value = re.fullmatch(r"(?s)(.*?)([0-9A-Za-z]+)", s).groups() if not s.startswith("AKIA") else ("AKIA", s[4:])
    return head + _letters(value, key, "secret")


_PATTERN = re.compile(
    r"""
    (?P<secret>(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])
        |(?<![0-9A-Za-z])(?i:password|passwd|secret|token|api_?key)[ ]?[=:][ ]?["']?[0-9A-Za-z]{12,})
    |(?P<email>(?<![0-9A-Za-z._%+-])[0-9A-Za-z][0-9A-Za-z._%+-]{0,63}@(?:[0-9A-Za-z-]+\.)+[A-Za-z]{2,})
    |(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ ]?[0-9A-Z]{4}){2,7}(?:[ ]?[0-9A-Z]{1,3})?(?![0-9A-Za-z]))
    |(?P<ip>(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))
    |(?P<date>(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}
        |[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4})(?![0-9/]|[.-][0-9]))
    |(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))
    |(?P<card>(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,4}(?:(?P=gap)[0-9]{1,3})?
        |[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z]|\.[0-9]))
    |(?P<phone>(?<![0-9A-Za-z+.])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}
        |\+[0-9](?:[ .()-]{0,2}[0-9]){7,14}
        |(?:1[ .-])?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z]|\.[0-9]))
    """,
    re.X,
)
_PSEUDONYM = {
    "iban": _iban, "card": _card, "ssn": _ssn, "ip": _ip, "phone": _phone, "date": _date,
    "email": _email, "secret": _secret,
}
_MARKS = b"0123456789@=:"


def pseudonymise(text: str, key: bytes, counts: dict[str, int] | None = None) -> str:
    """``text`` with every validated value replaced; ``counts`` is filled by kind.

    Where a match fails its validation, it is tried again without its last groups (a
    number may follow another), and then the search goes on behind its first group.
    """
    out, at, kept = [], 0, 0
    while m := _PATTERN.search(text, at):
        kind = next(k for k in KINDS if m[k] is not None)
        for found in _shorter(m[0]):
            new = _PSEUDONYM[kind](found, key)
            if new is not None:
                break
        else:
            at = _next_start(text, m)
            continue
        if counts is not None:
            counts[kind] = counts.get(kind, 0) + 1
        out += [text[kept : m.start()], new]
        at = kept = m.start() + len(found)
    return "".join(out) + text[kept:]


def _shorter(found: str) -> list[str]:
    """The match, then what is left of it at each blank from the right."""
    return [found, *[found[: m.start()] for m in reversed(list(re.finditer(" ", found)))]]


def _next_start(text: str, m: re.Match) -> int:
    """Past the run of digits or letters that the failed match began with."""
    at = m.start() + 1
    while at < m.end() and text[at].isalnum():
        at += 1
    return at


_ADDED = T.StructType(
    [
        T.StructField("pseudonymised", T.StringType()),
        T.StructField("n_values", T.LongType()),
        *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
    ]
)


def pseudonymise_documents(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``pseudonymised``, ``n_values`` and a count for each kind.

    A null text gives an empty one. A map over partitions: no shuffle, nothing shared
    between rows but the key. Equal rows get equal results; columns named like a result
    are replaced. A permutation may leave a value as it is, once in its domain's size.
    """

    def compute(texts: list[bytes]) -> list:
        rows = []
        for t in texts:
            counts: dict[str, int] = {}
            new = t.decode("utf-8", "replace")
            if len(t) != len(t.translate(None, _MARKS)):
                new = pseudonymise(new, key, counts)
            rows.append((new, sum(counts.values()), *[counts.get(k, 0) for k in KINDS]))
        return list(zip(*rows, strict=True)) if rows else [[] for _ in _ADDED]

    return with_text_columns(docs, text, _ADDED, compute)
