"""Operator 7, PII: format-preserving Feistel pseudonyms.

Personal values are found by pattern and checked (Luhn sum of card numbers,
mod-97 of IBANs, octets of addresses, calendar of dates, reserved ranges of
social security numbers).  A value is read as a number in the mixed radix of its
characters (digits, capital and small letters; separators and the rest of the
format stay), permuted by a keyed Feistel network over exactly that range
(cycle walking keeps it inside, and inside the valid values), and written back
in place.  The permutation depends on the key, the kind and the format alone: no
table is kept, equal values get equal pseudonyms in every document, and the
result passes the same checks.  Dates move within 1900 to 2099; an e-mail address
keeps its domain, a phone number its country code.  A secret is taken to its end;
one of over 200 characters is permuted in blocks, each with its number as tweak.
Letters and digits beyond ASCII stay where they are and belong to the format, so
values that differ in them alone get different pseudonyms.

Not taken for personal values: an e-mail name of over 64 characters (no address
has one), and a secret without any digit (``token: something`` is mostly prose).

A find that its check refuses hides nothing: from every start of a token in it
all kinds are tried, IBANs, phone and card numbers also up to each earlier
separator.  Of those that overlap the surest kind goes first (card numbers in a
usual grouping before dates, any other grouping of 13 to 19 digits with a valid
Luhn sum last), then the longest.

Defined results: a null text stays null with no finds; an empty text stays
empty; texts without a find are unchanged; a null id stays null; repeated rows
change alike; other columns pass through ``pseudonymise`` unchanged, but columns
named like its own results are replaced by them.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_BLOCK = 200
_FIRST_DAY, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days
_PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w@])",
    "secret": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)|(?<!\w)(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{6,}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "date": r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}([./])\d{1,2}\1\d{4})(?![\w-]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "phone": r"(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,}(?![\w-])",      # a whole run of digits: _cards finds the numbers in a longer one
}
KINDS = tuple(_PATTERNS)
_EACH = {k: re.compile(p.replace("\\1", r"(?P=sep)").replace("([./])", "(?P<sep>[./])")) for k, p in _PATTERNS.items()}
_SURE = {k: i for i, k in enumerate(("secret", "email", "iban", "usual card", "ssn", "ip", "date", "phone", "card"))}
_USUAL = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}|\d{4}([ -])\d{3}\3\d{3}\3\d{3}")
_ANY = re.compile("|".join(f"(?P<{k}>{p.replace(chr(92) + '1', f'(?P={k}_sep)').replace('([./])', f'(?P<{k}_sep>[./])')})" for k, p in _PATTERNS.items()))
_HINT = re.compile(r"[\d@]")


class Cipher:
    """Keyed permutations of number ranges and of strings within their format."""

    def __init__(self, key: bytes):
        self.key = key

    def permute(self, value: int, size: int, tweak: str, valid: Callable[[int], bool] = lambda v: True) -> int:
        """The image of ``value`` in a permutation of the valid numbers below ``size``."""
        half = isqrt(size - 1) + 1
        width = (half.bit_length() + 7) // 8
        while True:
            left, right = divmod(value, half)
            for r in range(ROUNDS):
                word = blake2b(f"{tweak}|{size}|{r}|".encode() + right.to_bytes(width, "big"), key=self.key, digest_size=min(64, width + 8)).digest()
                left, right = right, (left + int.from_bytes(word, "big")) % half
            value = left * half + right
            if value < size and valid(value):
                return value

    def spell(self, text: str, tweak: str, valid: Callable[[str], bool] = lambda s: True) -> str:
        """``text`` with its digits and letters permuted within their classes."""
        sets = [_alphabet(c) for c in text]
        radix = [len(s) for s in sets if s]
        if not radix:
            return text
        value = 0
        for c, s in zip(text, sets):
            if s:
                value = value * len(s) + s.index(c)

        def write(v: int) -> str:
            out = []
            for c, s in zip(reversed(text), reversed(sets)):
                if s:
                    v, d = divmod(v, len(s))
                    c = s[d]
                out.append(c)
            return "".join(reversed(out))
        form = "".join((c if c.isalnum() else "-") if s is None else s[0] for c, s in zip(text, sets))
        return write(self.permute(value, prod(radix), f"{tweak}|{form}", lambda v: valid(write(v))))


_ALPHABETS = ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _alphabet(c: str) -> str | None:
    """The class that a character is permuted in; others (letters and digits beyond
    ASCII too) stay, and are part of the format."""
    return next((a for a in _ALPHABETS if c in a), None)


def luhn(digits: str) -> int:
    """The sum that a valid card number has divisible by 10."""
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))


def _refill(form: str, digits: str) -> str:
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


def _email(c: Cipher, s: str) -> str | None:
    name, _, domain = s.rpartition("@")
    return f"{c.spell(name, 'email')}@{domain}"


def _secret_parts(s: str) -> tuple[str, str]:
    m = re.match(r"AKIA(?=[0-9A-Z]{16}$)|\w+?(?:[_-]?\w+)?\s*[=:]\s*[\"']?", s)
    return s[:m.end()], s[m.end():]


def _secret(c: Cipher, s: str) -> str | None:
    name, value = _secret_parts(s)
    if not any(x.isdigit() for x in value):
        return None
    n = -(-len(value) // _BLOCK)                    # one number each of blocks alike in length
    if n == 1:
        return name + c.spell(value, "secret")
    cut = [len(value) * i // n for i in range(n + 1)]
    return name + "".join(c.spell(value[a:b], f"secret {i} of {n}") for i, (a, b) in enumerate(zip(cut, cut[1:])))


def _iban(c: Cipher, s: str) -> str | None:
    plain = s.replace(" ", "")
    number = lambda t: int("".join(str(int(x, 36)) for x in t))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = c.spell(plain[4:], "iban" + plain[:2])
    new = plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body
    left = iter(new)
    return "".join(x if x == " " else next(left) for x in s)


def _date(c: Cipher, s: str) -> str | None:
    parts = re.split(r"[./-]", s)
    orders = ((0, 1, 2),) if "-" in s else ((2, 1, 0), (2, 0, 1))
    for order in orders:
        try:
            day = date(*(int(parts[i]) for i in order))
        except ValueError:
            continue
        if not 0 <= (day - _FIRST_DAY).days < _DAYS:
            return None
        new = _FIRST_DAY + timedelta(c.permute((day - _FIRST_DAY).days, _DAYS, "date"))     # alike in every format
        values = dict(zip(order, (new.year, new.month, new.day)))
        return re.sub(r"\d+", lambda m, k=iter(range(3)): str(values[i := next(k)]).zfill(len(parts[i])), s)
    return None


def _ssn(c: Cipher, s: str) -> str | None:
    good = lambda t: t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000"
    return c.spell(s, "ssn", good) if good(s) else None


def _ip(c: Cipher, s: str) -> str | None:
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255:
        return None
    return ".".join(map(str, c.permute(int.from_bytes(bytes(octets), "big"), 2**32, "ip").to_bytes(4, "big")))


def _phone(c: Cipher, s: str) -> str | None:
    if not 8 <= sum(x.isdigit() for x in s) <= 15:
        return None
    head = re.match(r"\+\d{1,3}(?=\D)|\+\d|", s).group()
    return head + c.spell(s[len(head):], "phone" + head)


def _card(c: Cipher, s: str) -> str | None:
    digits = re.sub(r"\D", "", s)
    if not 13 <= len(digits) <= 19 or luhn(digits) % 10 or len(set(digits)) == 1:
        return None
    body = c.spell(digits[:-1], "card")
    return _refill(s, body + str(-luhn(body + "0") % 10))


_REWRITE = {"email": _email, "secret": _secret, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}


def _cards(text: str, a: int, e: int) -> Iterator[tuple[int, int, str]]:
    """The stretches between separators of a run of digits that are card numbers."""
    places = [i for i in range(a, e) if text[i].isdigit()]
    sums = ([0], [0])                               # of the digits before, those at even or odd places doubled
    for n, i in enumerate(places):
        for odd in (0, 1):
            sums[odd].append(sums[odd][-1] + sum(divmod(int(text[i]) * (1 + (n % 2 == odd)), 10)))
    starts = [n for n, i in enumerate(places) if n == 0 or places[n - 1] != i - 1]
    ends = {n + 1 for n, i in enumerate(places) if n + 1 == len(places) or places[n + 1] != i + 1}
    for n in starts:
        for m in range(n + 13, min(n + 19, len(places)) + 1):
            if m in ends and (sums[m % 2][m] - sums[m % 2][n]) % 10 == 0:
                x, y = places[n], places[m - 1] + 1
                if len({c for c in text[x:y] if c.isdigit()}) > 1:
                    yield x, y, "usual card" if _USUAL.fullmatch(text, x, y) else "card"


def _inside(text: str, a: int, e: int, cipher: Cipher) -> tuple[list[tuple[int, int, str, str]], int]:
    """The finds (start, end, kind, pseudonym) that begin in a refused span, in
    order, and the place up to which the text is settled."""
    maybe, digits, s = [], a, a
    while s < e:
        if s == a or not (text[s - 1].isalnum() or text[s - 1] == "_"):
            for kind, pattern in _EACH.items():
                if kind == "card" and s < digits:   # once for each run
                    continue
                m = pattern.match(text, s)
                if m is None:
                    continue
                if kind == "card":
                    maybe += _cards(text, s, m.end())
                    digits = m.end()
                    e = max(e, digits)
                elif kind == "secret" or _REWRITE[kind](cipher, m.group()) is not None:
                    if kind != "secret" or any(c.isdigit() for c in _secret_parts(m.group())[1]):
                        maybe.append((s, m.end(), kind))
                elif kind in ("iban", "phone"):
                    for y in range(m.end() - 1, s, -1):
                        if not text[y].isalnum() and pattern.fullmatch(text, s, y) and _REWRITE[kind](cipher, text[s:y]) is not None:
                            maybe.append((s, y, kind))
                            break
        s += 1
    taken, finds = [], []
    for x, y, kind in sorted(maybe, key=lambda f: (_SURE[f[2]], f[0] - f[1], f[0])):
        at = bisect(taken, (x, y))
        if (at == 0 or taken[at - 1][1] <= x) and (at == len(taken) or y <= taken[at][0]):
            taken.insert(at, (x, y))
            kind = kind.removeprefix("usual ")
            finds.append((x, y, kind, _REWRITE[kind](cipher, text[x:y])))
    finds.sort()
    return finds, max([e, *(y for _, y, _, _ in finds)])


def rewrite(text: str, cipher: Cipher) -> tuple[str, Counter]:
    """The text with pseudonyms, and the number of finds by kind."""
    found: Counter = Counter()
    if not _HINT.search(text):
        return text, found
    out, done, at = [], 0, 0
    while m := _ANY.search(text, at):
        kind = m.lastgroup.removesuffix("_sep")
        new = _REWRITE[kind](cipher, m.group())
        if new is not None:
            finds, at = [(*m.span(), kind, new)], m.end()
        elif kind == "secret":                      # a value without a digit holds no other kind than this
            value, at = m.start() + len(_secret_parts(m.group())[0]), m.end()
            finds = [(*x.span(), "email", _email(cipher, x.group())) for x in _EACH["email"].finditer(text, value, at)]
        else:
            finds, at = _inside(text, *m.span(), cipher)
        for x, y, kind, new in finds:
            out += (text[done:x], new)
            done = y
            found[kind] += 1
    return "".join([*out, text[done:]]), found


def pseudonymise(docs: DataFrame, key: bytes, column: str = "text", finds: str = "n_pii") -> DataFrame:
    """``docs`` with pseudonyms in ``column``, and two columns more: ``finds``
    (number of values replaced) and ``finds``_kinds (their kinds, in order)."""
    own = {finds.lower(), f"{finds}_kinds".lower()}
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Cipher(key)
        for b in batches:
            at = b.schema.get_field_index(column)
            done = [(t, Counter()) if t is None else rewrite(t, cipher) for t in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            columns += [pa.array([sum(f.values()) for _, f in done], pa.int64()), pa.array([",".join(k for k in KINDS if f[k]) for _, f in done], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*b.schema.names, finds, f"{finds}_kinds"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{finds}` bigint, `{finds}_kinds` string")
