"""Format-preserving pseudonyms: validated numbers, dates and addresses are permuted by a keyed Feistel network inside their format.

A value is found by its pattern, validated (check digits, calendar, ranges) and turned into its index in the set of all valid values of
the kind. A Feistel network over two parts, keyed with BLAKE2b, permutes the indexes; it walks on until the result is in the set.
The result is written in the original's layout. So a valid value becomes another valid value of the kind, equal values become
equal pseudonyms in every document, however they are punctuated, and whoever has the key can undo it. Two exceptions keep a result
readable like its original: a date that only reads month first (02/28/2001) has the pseudonym of 2001-02-28 where that has a day above
12, some three times in five, else the next of its cycle that has; and see ``pseudonymize`` for values beside readings that failed.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrain.llm.common import slices

ROUNDS = 10
FIRST_DAY, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email")
#: What a value of each kind looks like, tried in this order where a word starts. An ISO date may go on with T and a time.
PATTERNS = {
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\.\d)(?!\w)",
    "iso": r"\d{4}(?P<m1>[-/.])\d{1,2}(?P=m1)\d{1,2}(?=[Tt]\d|(?!\w))",
    "day": r"\d{1,2}(?P<m2>[-/.])\d{1,2}(?P=m2)\d{4}(?!\w)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\w)",
    "card": r"(?:\d{4}(?P<m3>[ -])\d{4}(?P=m3)\d{4}(?P=m3)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\w)",
    "nanp": r"(?:\+?1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)",
    "phone": r"\+\d{1,3}(?:[ .()-]{0,2}\d){6,12}(?!\w)"}
NUMBER = re.compile(r"(?<!\w)(?:" + "|".join(PATTERNS.values()) + ")")
EACH = {kind: re.compile(r"(?<!\w)" + p) for kind, p in PATTERNS.items()}
WORD = re.compile(r"\w+|.", re.S)
#: Characters of the IBANs of each country that has them.
IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 "
    "IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 "
    "ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}
#: Country codes of one and of two digits; all others have three.
ONE_DIGIT = "17"
TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
EMAIL = re.compile(r"(?<![\w.+-])([A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?)@((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})(?![\w-])")


def permute(key: bytes, kind: str, n: int, index: int, valid: Callable[[int], bool] = lambda i: True, undo: bool = False) -> int:
    """Keyed permutation of the valid indexes below ``n``."""
    a = isqrt(n - 1) + 1
    b = -(-n // a)

    def half(i: int, value: int, modulus: int) -> int:
        data = f"{kind}|{n}|{i}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest(), "big") % modulus

    while True:
        x, y = index % a, index // a
        for i in reversed(range(ROUNDS)) if undo else range(ROUNDS):
            sign = -1 if undo else 1
            if i % 2:
                y = (y + sign * half(i, x, b)) % b
            else:
                x = (x + sign * half(i, y, a)) % a
        index = y * a + x
        if index < n and valid(index):
            return index


def luhn(digits: str) -> int:
    """Check digit of a card number without it."""
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(digits)))
    return -total % 10


def iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _fill(layout: str, chars: str) -> str:
    """``layout`` with its letters and digits replaced by ``chars`` in turn."""
    left = iter(chars)
    return "".join(next(left) if c.isalnum() else c for c in layout)


class Mixed:
    """Strings of a fixed pattern of digits, upper-case and lower-case letters as numbers."""

    ALPHABETS = ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def __init__(self, like: str):
        self.sets = [next(a for a in self.ALPHABETS if c in a) for c in like]
        self.kind = "".join("dUl"[self.ALPHABETS.index(a)] for a in self.sets)
        self.n = 1
        for a in self.sets:
            self.n *= len(a)

    def index(self, text: str) -> int:
        value = 0
        for a, c in zip(self.sets, text):
            value = value * len(a) + a.index(c)
        return value

    def text(self, value: int) -> str:
        out = []
        for a in reversed(self.sets):
            value, r = divmod(value, len(a))
            out.append(a[r])
        return "".join(reversed(out))


def _card(s, move):
    d = re.sub(r"\D", "", s)
    if luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    body = d[0] + str(move(f"card{d[0]}", 10 ** (len(d) - 2), int(d[1:-1]), lambda i: len(set(f"{d[0]}{i:0{len(d) - 2}d}{luhn(f'{d[0]}{i:0{len(d) - 2}d}')}")) > 1)).zfill(len(d) - 2)
    return _fill(s, body + str(luhn(body)))


def _iban(s, move):
    d = s.replace(" ", "")
    if not 15 <= len(d) <= 34 or iban_check(d[:2], d[4:]) != d[2:4]:
        return None
    mixed = Mixed(d[4:])
    account = mixed.text(move(f"iban{d[:2]}{mixed.kind}", mixed.n, mixed.index(d[4:])))
    return _fill(s, d[:2] + iban_check(d[:2], account) + account)


def _ssn(s, move):
    area, group, serial = (int(x) for x in s.split("-"))

    def valid(i):
        return 0 < i // 1_000_000 < 900 and i // 1_000_000 != 666 and i // 10_000 % 100 > 0 and i % 10_000 > 0

    index = area * 1_000_000 + group * 10_000 + serial
    return _fill(s, f"{move('ssn', 10**9, index, valid):09d}") if valid(index) else None


def _in_plan(i):
    """Is a number of ten digits one of the North American plan?"""
    return i // 10**9 >= 2 and i // 10**6 % 10 >= 2


def _nanp(s, move):
    d = re.sub(r"\D", "", s)
    front, d = d[:-10], d[-10:]
    return _fill(s, front + f"{move('nanp', 10**10, int(d), _in_plan):010d}") if _in_plan(int(d)) else None


def calling_code(digits: str) -> str:
    """The country code that begins an international number: one digit, two, or three where neither is a code."""
    return digits[: 1 if digits[0] in ONE_DIGIT else 2 if digits[:2] in TWO_DIGITS else 3]


def _phone(s, move):
    d = re.sub(r"\D", "", s)
    if not 8 <= len(d) <= 15:
        return None
    code = calling_code(d)
    rest = d[len(code):]
    if code == "1" and len(rest) == 10 and _in_plan(int(rest)):
        return _nanp(s, move)
    valid = (lambda i: not _in_plan(i)) if code == "1" and len(rest) == 10 else (lambda i: True)
    return _fill(s, code + f"{move(f'phone{code}', 10 ** len(rest), int(rest), valid):0{len(rest)}d}")


def _ip(s, move):
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255 or any(x != str(int(x)) for x in s.split(".")) or not 0 < octets[0] < 224:
        return None
    value = move("ip", 1 << 32, int.from_bytes(bytes(octets), "big"), lambda i: 0 < i >> 24 < 224)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(s, move, order):
    mark = next(c for c in s if not c.isdigit())
    fields = s.split(mark)
    for names in order:
        part = dict(zip(names, fields))
        try:
            day = dt.date(int(part["y"]), int(part["m"]), int(part["d"])).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            continue
        # A date that can only be read month first stays one of those: where the day's pseudonym is not, it is permuted on.
        valid = (lambda i: dt.date.fromordinal(FIRST_DAY + i).day > 12) if names == "mdy" else (lambda i: True)
        new = dt.date.fromordinal(FIRST_DAY + move("date", DAYS, day, valid))
        value = {"y": new.year, "m": new.month, "d": new.day}
        return mark.join(f"{value[n]:0{len(f)}d}" for n, f in zip(names, fields))
    return None


def _email(local, domain, move):
    chars = "".join(c for c in local if c.isalnum())
    mixed = Mixed(chars)
    return f"{_fill(local, mixed.text(move(f'email{mixed.kind}@{domain.lower()}', mixed.n, mixed.index(chars))))}@{domain}" if mixed.n > 1 else None


VALIDATED = {
    "card": ("card", _card), "iban": ("iban", _iban), "ssn": ("ssn", _ssn), "nanp": ("phone", _nanp), "phone": ("phone", _phone), "ip": ("ip", _ip),
    "iso": ("date", lambda s, move: _date(s, move, ("ymd",))), "day": ("date", lambda s, move: _date(s, move, ("dmy", "mdy")))}


def _readings(text: str, start: int) -> Iterator[tuple[int, str]]:
    """(stop, name) of every reading of the value that starts at ``start``, the preferred first."""
    for name, pattern in EACH.items():
        if not (m := pattern.match(text, start)):
            continue
        if name == "iban":
            ends = [i + 1 for i in range(start, m.end()) if text[i] != " " and not re.match(r"\w", text[i + 1 : i + 2])]
            sizes = {e: len(text[start:e].replace(" ", "")) for e in ends}
            length = IBAN_LENGTH.get(text[start : start + 2])
            # Another length than the country's is read from the longest match only; unknown countries may have any.
            first = [e for e in ends if sizes[e] == length]
            rest = [e for e in reversed(ends) if e not in first and sizes[e] >= 15]
            yield from ((e, name) for e in first + [e for e in rest if length is None or e == m.end()])
        else:
            yield m.end(), name


def _found(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(start, stop, name) of the valid values in ``text``, and of the readings before them that failed."""
    values = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text) if _email(m[1], m[2], _same)] if "@" in text else []
    taken, failed, at = list(values), [], 0
    while m := NUMBER.search(text, at):
        start, at = m.start(), 0
        for stop, name in _readings(text, start):
            if any(start < b and a < stop for a, b, _ in taken):
                continue
            if VALIDATED[name][1](text[start:stop], _same):
                values.append((start, stop, name))
                at = stop
                break
            failed.append((start, stop, name))
        at = at or WORD.match(text, start).end()
    return sorted(values), failed


def _same(kind, n, index, valid=lambda i: True):
    return index


def replacements(text: str, key: bytes, undo: bool = False) -> Iterator[tuple[int, int, str, str]]:
    """(start, stop, kind, pseudonym) of the values found in ``text``, in order.

    Where a reading that failed overlaps a value, the pseudonym is permuted on until the reading still fails, so that the result is
    read like the original. For that, values are replaced from the left and undone from the right.
    """

    def move(kind, n, index, valid=lambda i: True):
        return permute(key, kind, n, index, valid, undo)

    values, failed = _found(text)
    now: dict[tuple[int, int], str] = {}

    def as_read(start: int, stop: int) -> str:
        chars = list(text[start:stop])
        for (a, b), new in now.items():
            if a < stop and start < b and len(new) == b - a:
                for i in range(max(a, start), min(b, stop)):
                    chars[i - start] = new[i - a]
        return "".join(chars)

    found = []
    for start, stop, name in reversed(values) if undo else values:
        old = text[start:stop]
        if name == "email":
            local, _, domain = old.partition("@")
            found.append((start, stop, "email", _email(local, domain, move)))
            continue
        kind, build = VALIDATED[name]
        near = [(a, b, other) for a, b, other in failed if a < stop and start < b]
        new = build(old, move)
        now[start, stop] = new
        while any(VALIDATED[other][1](as_read(a, b), _same) for a, b, other in near):
            now[start, stop] = new = build(new, move)
        found.append((start, stop, kind, new))
    return iter(sorted(found))


def replaced(text: str, key: bytes, undo: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its pseudonyms, and the spans (start, stop, kind) of the values in the given text."""
    out, at, spans = [], 0, []
    for start, stop, kind, new in replacements(text, key, undo):
        out += [text[at:start], new]
        at = stop
        spans.append((start, stop, kind))
    return "".join([*out, text[at:]]), spans


def pseudonymize(docs: DataFrame, key: bytes, undo: bool = False) -> DataFrame:
    """(doc_id, text, spans), one row per document: the whole text with pseudonyms, and where and what the originals were.

    spans holds (start, stop, kind) in characters of the input. Cards pass the Luhn check and keep their first digit, IBANs their
    mod-97 check and country, telephone numbers their country code, dates (1900 to 2099) their order of fields, e-mail addresses
    their domain; strings that no reading makes valid stay as they are. A value that overlaps a reading that failed may get another
    pseudonym than elsewhere, where its usual one would make that reading valid. Null text stays null without spans, empty text empty. A key has 1 to 64
    bytes; ``undo`` turns pseudonyms back. Other columns are not read; repeated rows come out alike.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("kind", T.StringType())])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(span))])

    def run(batches):
        for batch in slices(batches, "text"):
            done = [(None, []) if t is None else replaced(t, key, undo) for t in batch.column("text").to_pylist()]
            spans = [[{"start": a, "stop": b, "kind": k} for a, b, k in s] for _, s in done]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array(spans, kind)], ["doc_id", "text", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def counted(result: DataFrame) -> DataFrame:
    """(doc_id, text, text_sha256, n_replaced and one count per kind)."""
    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return result.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), F.size("spans").cast("long").alias("n_replaced"), *map(of, KINDS))
