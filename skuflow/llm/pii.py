"""Format-preserving Feistel pseudonyms for personal data (operator 2).

Validated values - card numbers (Luhn), IBANs (mod 97), IP addresses, telephone and
social security numbers, calendar dates, e-mail addresses, keys and passwords - are
replaced within their own format. Each kind numbers the values of one format from 0
to N - 1; a keyed Feistel network permutes that range (cycle walking keeps it inside),
so equal values get equal pseudonyms in every document, different values different
ones, and check digits are made anew. The permutation moves every number: the network
P is used as P^-1(P(x) + 1), which has no fixed points.

Card: first digit kept, the rest but the check digit permuted. Phone: country code and
separators kept; it ends where the country's numbers end or another valid value begins. IP: each octet keeps its number of digits. Date: any day from 1900 to
2099 in the same notation (day and month keep leading zeros as two digits). E-mail: the
local part's letters and digits, class by class; the domain stays. Secret: digits,
capitals and small letters (hex: hex digits of
its case), class by class.

Defined cases: a null text stays null, an empty one empty; values and texts may have any length (values above
BLOCK signs are permuted in blocks, and the search is linear in the text); repeated rows, null ids, ties
and any further columns are passed through; an empty table gives no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import release, small_batches

#: For tests and the registered query only; a real run passes its secret key.
KEY = b"not a secret: pass your own key"
ROUNDS = 8
KINDS = ("email", "secret", "iban", "ip", "phone", "card", "ssn", "date")
_DAY0, _DAYS = dt.date(1900, 1, 1), (dt.date(2099, 12, 31) - dt.date(1900, 1, 1)).days + 1
_EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
#: An e-mail is looked for once in each run of its signs, from the run's start, however long the run is.
_PATTERN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[._%+-]*+(?P<email>" + _EMAIL + r")"
    r"|(?P<secret>\bAKIA[A-Z0-9]{16}\b|(?<=password=)[^\s\"']{6,}|(?<=password: )[^\s\"']{6,}|\b(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}\b)"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
    r"|(?P<phone>\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d.-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{4,5})(?![\d-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}(?P<sep>[./])\d{1,2}(?P=sep)\d{4})(?![\d-]))", re.ASCII)


_REST = re.compile(f"(?P<email>{_EMAIL})", re.ASCII)
#: Signs that are permuted as one number; longer values go block by block.
BLOCK = 64


class Permutation:
    """A keyed permutation of 0 .. n - 1 for each format (``tweak``)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, value: int, turn: int, tweak: bytes, half: int) -> int:
        raw = value.to_bytes((half + 7) // 8, "little")
        size = min(64, (half + 7) // 8 + 8)
        out = hashlib.blake2b(bytes([turn]) + tweak + b"\0" + raw, key=self.key, digest_size=size).digest()
        while len(out) * 8 < half:
            out += hashlib.blake2b(out, key=self.key).digest()
        return int.from_bytes(out, "little") & ((1 << half) - 1)

    def _network(self, x: int, n: int, tweak: bytes, back: bool) -> int:
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        low = (1 << half) - 1
        while True:                                   # cycle walking
            a, b = x >> half, x & low
            for turn in range(ROUNDS):
                if back:
                    a, b = b ^ self._round(a, ROUNDS - 1 - turn, tweak, half), a
                else:
                    a, b = b, a ^ self._round(b, turn, tweak, half)
            x = a << half | b
            if x < n:
                return x

    def __call__(self, x: int, n: int, tweak: str) -> int:
        """Another number than x below n (x itself only if n is 1)."""
        mark = f"{tweak}/{n}".encode()
        return self._network((self._network(x, n, mark, False) + 1) % n, n, mark, True)


def _luhn(digits: str) -> int:
    """The Luhn sum of digits that end with the check digit, modulo 10."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _refill(text: str, digits: str) -> str:
    """The digits put into the places of the text's digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in text)


def _classes(text: str, alphabets: tuple[str, ...], permute: Permutation, tweak: str) -> str:
    """Signs of the alphabets permuted, BLOCK signs as one mixed-radix number; other signs stay.

    A later block's permutation depends on the blocks before it, so equal blocks of one value differ.
    """
    out, before = [], hashlib.blake2b(digest_size=16)
    for i in range(0, max(len(text), 1), BLOCK):
        block = text[i:i + BLOCK]
        out.append(_block(block, alphabets, permute, f"{tweak}#{i}:{before.hexdigest()}" if i else tweak))
        before.update(block.encode())
    return "".join(out)


def _block(text: str, alphabets: tuple[str, ...], permute: Permutation, tweak: str) -> str:
    used = [next((a for a in alphabets if c in a), "") for c in text]
    x, n = 0, 1
    for c, a in zip(text, used):
        if a:
            x, n = x * len(a) + a.index(c), n * len(a)
    shape = tweak + ":" + "".join(str(alphabets.index(a)) if a else c for c, a in zip(text, used))
    x, out = permute(x, n, shape), []
    for c, a in zip(reversed(text), reversed(used)):
        if a:
            x, r = divmod(x, len(a))
            out.append(a[r])
        else:
            out.append(c)
    return "".join(reversed(out))


_D, _U, _L, _H = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
_HEX = re.compile("[0-9A-F]{32,}"), re.compile("[0-9A-Fa-f]{32,}")


def _email(value, permute):
    local, domain = value.rsplit("@", 1)
    return _classes(local, (_D, _L, _U), permute, "email") + "@" + domain


def _secret(value, permute):
    if value.startswith("AKIA") and len(value) == 20:
        return "AKIA" + _classes(value[4:], (_D + _U,), permute, "akia")
    if re.fullmatch("[0-9a-f]+", value):
        return _classes(value, (_H,), permute, "secret")
    if _HEX[0].fullmatch(value):
        return _classes(value, (_H.upper(),), permute, "upper secret")
    if _HEX[1].fullmatch(value):                                         # both cases: each sign stays in its class
        return _classes(value, (_D, "abcdef", "ABCDEF"), permute, "mixed secret")
    return _classes(value, (_D, _L, _U), permute, "secret")


def _iban(value, permute):
    plain = value.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))          # noqa: E731
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    account = _classes(plain[4:], (_D, _U), permute, plain[:2])
    made = plain[:2] + f"{98 - number(account + plain[:2] + '00') % 97:02d}" + account
    it = iter(made)
    return "".join(c if c == " " else next(it) for c in value)


def _ip(value, permute):
    octets = value.split(".")
    if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
        return None
    ranges = [((0, 10), (10, 90), (100, 156))[len(o) - 1] for o in octets]
    x, n = 0, 1
    for o, (low, size) in zip(octets, ranges):
        x, n = x * size + int(o) - low, n * size
    x, out = permute(x, n, "ip" + "".join(str(len(o)) for o in octets)), []
    for low, size in reversed(ranges):
        x, r = divmod(x, size)
        out.append(str(low + r))
    return ".".join(reversed(out))


def _code(value: str) -> str:
    """The country code with its plus; without a sign after it the one in the table, else one digit."""
    if value[0] != "+":
        return ""
    signed = re.match(r"\+\d{1,3}(?=[ .(-])", value)
    return signed.group() if signed else "+" + next((c for c in _NATIONAL if value.startswith(c, 1)), value[1])


def _phone(value, permute):
    code = _code(value)
    rest = value[len(code):]
    digits = re.sub(r"\D", "", rest)
    if not 6 <= len(digits) <= 14:
        return None
    return code + _refill(rest, f"{permute(int(digits), 10 ** len(digits), 'phone' + str(len(digits))):0{len(digits)}d}")


def _card(value, permute):
    digits = re.sub(r"\D", "", value)
    if digits[0] == "0" or len(set(digits)) == 1 or _luhn(digits):
        return None
    n = len(digits) - 2
    body = digits[0] + f"{permute(int(digits[1:-1]), 10 ** n, 'card' + digits[0]):0{n}d}"
    return _refill(value, body + str(-_luhn(body + "0") % 10))


def _ssn(value, permute):
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    areas = area - 1 - (area > 666)                                       # 898 areas: 1 .. 899 without 666
    x = permute((areas * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    x, serial = divmod(x, 9999)
    areas, group = divmod(x, 99)
    return f"{areas + 1 + (areas >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(value, permute):
    parts = re.split(r"[-./]", value)
    sign = value[4] if "-" in value else re.search(r"[./]", value).group()
    try:
        if sign == "-":
            day = dt.date(*map(int, parts))
        else:
            a, b, year = map(int, parts)
            first = b > 12                                                # month first only if it can't be day first
            day = dt.date(year, a if first else b, b if first else a)
    except ValueError:
        return None
    x = (day - _DAY0).days
    if not 0 <= x < _DAYS:
        return None
    day = _DAY0 + dt.timedelta(permute(x, _DAYS, "date"))
    if sign == "-":
        return day.isoformat()
    return sign.join((f"{day.month:02d}", f"{day.day:02d}") if first else (f"{day.day:02d}", f"{day.month:02d}")) + f"{sign}{day.year}"


#: Most digits of a national number, by country code; others have 15 with their code (E.164).
_NATIONAL = {"1": 10, "7": 10, "30": 10, "31": 9, "32": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "49": 11, "52": 10, "55": 11,
             "61": 9, "81": 10, "82": 10, "86": 11, "90": 10, "91": 10, "351": 9, "353": 9, "420": 9}


def _phone_end(text: str, start: int, end: int, permute: Permutation) -> int:
    """Where a number with a country code ends: not beyond the code's length, nor within another value that follows it."""
    value = text[start:end]
    if value[0] != "+":
        return end
    code = _code(value)[1:]
    groups = list(re.finditer(r"\d+", value[1 + len(code):]))
    first = start + 1 + len(code)
    most = _NATIONAL.get(code, 15 - len(code)) + (code != "1" and groups[0].group()[0] == "0")
    n, stop = 0, first
    for group in groups:
        if n >= 7 and (n + len(group.group()) > most or _other_value(text, first + group.start(), permute)):
            return stop
        n, stop = n + len(group.group()), first + group.end()
    return end


def _other_value(text: str, at: int, permute: Permutation) -> bool:
    """Whether a valid value that is no telephone number begins here."""
    m = _PATTERN.match(text, at)
    if not m or m.group("phone"):
        return False
    return _MAKERS[_kind(m)](m.group(), permute) is not None


def _kind(m: re.Match) -> str:
    return next(k for k in KINDS if m.group(k) is not None)


_MAKERS = dict(zip(KINDS, (_email, _secret, _iban, _ip, _phone, _card, _ssn, _date)))


def pseudonymise(text: str | None, permute: Permutation) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each in the new text."""
    if not text:
        return text, []
    out, found, last, size, at = [], [], 0, 0, 0
    # after a value an e-mail may begin within a run of its signs
    while m := (at and at == last and _REST.match(text, at)) or _PATTERN.search(text, at):
        kind = "email" if m.re is _REST else _kind(m)
        start, end = m.span(kind)
        if kind == "phone":
            end = _phone_end(text, start, end, permute)
        made = _MAKERS[kind](text[start:end], permute)
        if made is None:                              # not valid: another value may begin within it
            at = start + 1
            continue
        at = end
        out += [text[last:start], made]
        size += start - last
        found.append((kind, size, size + len(made)))
        size, last = size + len(made), end
    return ("".join(out) + text[last:], found) if found else (text, [])


_SIGNAL = re.compile("[0-9@]|password[=:]|AKIA")


def _texts(column: pa.Array, permute: Permutation):
    for text in column.to_pylist():
        yield pseudonymise(text, permute) if text and _SIGNAL.search(text) else (text, [])


def pseudonymise_documents(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """Per document: doc_id, text with pseudonyms, spans of them, and their number by kind."""
    small_batches(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(key)
        for batch in batches:
            texts, spans = [], []
            for text, found in _texts(batch.column(1), permute):
                texts.append(text)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(spans, span)], ["doc_id", "text", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "doc_id bigint, text string, spans array<struct<kind:string,start:int,end:int>>")
    return found.select("*", *(F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("bigint").alias(f"n_{k}") for k in KINDS))


def pseudonymise_table(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The table itself, all columns, with pseudonyms in ``text``."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(key)
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([text for text, _ in _texts(columns[at], permute)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
        release()

    return docs.mapInArrow(run, docs.schema)
