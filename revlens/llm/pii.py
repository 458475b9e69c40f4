"""PII: format-preserving Feistel pseudonyms.

Validated values (payment cards, telephone and social-security numbers, bank
account numbers, IP addresses, calendar dates, mail addresses, hexadecimal
secrets) are replaced inside the whole text.  Each kind is a finite set of N
values of its format; a value is its number in 0..N-1, a keyed Feistel
network permutes the numbers (walking on while a result falls outside), and
the permuted number is written in the layout of the original.  The
permutation depends on the key and the kind alone, so equal values of
different documents stay equal, different ones stay different, and who
holds the key can go back.

A card or bank account number may stand next to other digits or capitals: of
digits and separators in a row, any stretch from one separator to another is
tried, longer ones first; an account number is tried with the length that
its country fixes, then with other ends at separators, longer ones first,
then from later starts.  Pseudonyms walk on while the new text would be read
differently, so the way back finds the same stretches.

Numbers that fail their validation (check digit, issuer range, octet range,
calendar) stay as they are, but for telephone numbers written with +1: those
are permuted in their ten digits even with an area or exchange code that
North America does not give out.  Other countries' numbers have no rule.

Defined results: a null text stays null with zero counts; an empty text and
a text without values are unchanged; repeated rows are treated alike; an
empty table gives no rows; other columns, whatever their names, pass
through.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator  # noqa: F401

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

KINDS = ["email", "secret", "iban", "card", "ssn", "phone", "ip", "date"]
ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutation of 0..n-1 for any n, and its inverse."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        h = hashlib.blake2b(tweak + bytes([i]) + half.to_bytes(size, "big"), key=self.key, digest_size=min(64, size + 8))
        return int.from_bytes(h.digest(), "big") & ((1 << bits) - 1)

    def _walk(self, x: int, n: int, kind: str, rounds: list[int]) -> int:
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask, tweak = (1 << bits) - 1, f"{kind}:{n}:".encode()
        while True:
            a, b = x >> bits, x & mask
            if rounds[0] == 0:
                for i in rounds:
                    a, b = b, a ^ self._round(tweak, i, b, bits)
            else:
                for i in rounds:
                    a, b = b ^ self._round(tweak, i, a, bits), a
            x = a << bits | b
            if x < n:
                return x

    def permute(self, x: int, n: int, kind: str) -> int:
        return self._walk(x, n, kind, list(range(ROUNDS)))

    def invert(self, x: int, n: int, kind: str) -> int:
        return self._walk(x, n, kind, list(range(ROUNDS))[::-1])


def _number(digits: list[int], radices: list[int]) -> tuple[int, int]:
    x, n = 0, 1
    for d, r in zip(digits, radices, strict=True):
        x, n = x * r + d, n * r
    return x, n


def _digits(x: int, radices: list[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        x, d = divmod(x, r)
        out.append(d)
    return out[::-1]


def luhn_sum(digits: str) -> int:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


def issued(d: str) -> bool:
    """Card numbers by issuer range and length."""
    n = len(d)
    return (d[0] == "4" and n in (13, 16, 19) or n == 16 and (51 <= int(d[:2]) <= 55 or 2221 <= int(d[:4]) <= 2720)
            or n == 15 and d[:2] in ("34", "37") or 16 <= n <= 19 and (d[:4] == "6011" or d[:2] == "65"))


IBAN_LENGTHS = dict((x[:2], int(x[2:])) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
    "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split())
_IBAN_HEAD = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}")
_IBAN_MOST = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}")
_CARD_RUN = re.compile(r"(?<!\d)\d(?:[ -]?\d){12,}")
_DIGITS = re.compile(r"\d+")
Spans = list[tuple[int, int]]


def _free(spans: Spans, a: int, b: int) -> bool:
    return not any(x < b and a < y for x, y in spans)


def ibans(text: str, taken: Spans) -> Spans:
    """Where account numbers stand in ``text``."""
    out, done = [], 0
    for head in _IBAN_HEAD.finditer(text):
        if head.start() < done or not (m := _IBAN_MOST.match(text, head.start())):
            continue
        s, ends = "", []
        for i, c in enumerate(m[0], m.start() + 1):
            s += c.strip()
            if c != " " and len(s) >= 15 and not (i < len(text) and text[i].isascii() and text[i].isalnum()):
                ends.append((len(s) != IBAN_LENGTHS.get(s[:2]), -len(s), i))
        for _, n, end in sorted(ends):
            if _free(taken, m.start(), end) and int("".join(str(int(c, 36)) for c in s[4:-n] + s[:4])) % 97 == 1:
                out.append((m.start(), end))
                done = end
                break
    return out


def cards(run: str, at: int, taken: Spans) -> Spans:
    """Where card numbers stand in digits and separators in a row that begin at ``at`` of the text."""
    groups = [(m.start(), m.end()) for m in _DIGITS.finditer(run)]
    able = []
    for i, (a, _) in enumerate(groups):
        d = ""
        for x, b in groups[i:]:
            if len(d) + b - x > 19:
                break
            d += run[x:b]
            if len(d) >= 13 and issued(d) and luhn_sum(d) % 10 == 0 and _free(taken, at + a, at + b):
                able.append((-len(d), a, b))
    out: Spans = []
    for _, a, b in sorted(able):
        if _free(out, a, b):
            out.append((a, b))
    return sorted(out)


def _read(text: str, taken: Spans) -> tuple[Spans, Spans]:
    """Account numbers and card numbers of ``text`` outside ``taken``."""
    accounts = ibans(text, taken)
    taken = taken + accounts
    return accounts, [(m.start() + a, m.start() + b) for m in _CARD_RUN.finditer(text) for a, b in cards(m[0], m.start(), taken)]


def _put(text: str, spans: Spans, values: list[str]) -> str:
    out, at = [], 0
    for (a, b), v in zip(spans, values, strict=True):
        out += [text[at:a], v]
        at = b
    return "".join(out) + text[at:]


def _relayout(layout: str, chars: str) -> str:
    """``chars`` in place of the letters and digits of ``layout``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in layout)


class Pseudonyms:
    """Replaces the values of one text; ``back`` restores them."""

    def __init__(self, key: bytes, back: bool = False):
        f = Feistel(key)
        self.move = f.invert if back else f.permute
        # Bounded repeats only: a candidate starts at a digit (or at the sign, letter or
        # bracket right before one) and never scans further than its longest format.
        self.rules: list[tuple[str, re.Pattern, Callable[..., str | None]]] = [
            ("email", re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64})(@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})(?![A-Za-z0-9])"), self.email),
            ("secret", re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"), self.secret),
            ("iban", _IBAN_HEAD, self.iban),  # these two: see ``ibans`` and ``cards``
            ("card", _CARD_RUN, self.card),
            ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), self.ssn),
            ("phone", re.compile(r"(?<![\d.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"), self.phone),
            ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"), self.ip),
            ("date", re.compile(r"(?<![\d./-])(?:(\d{4})([-/.])(\d{2})\2(\d{2})|(\d{1,2})([/.-])(\d{1,2})\6(\d{4}))(?!\d|[./-]\d)"), self.date),
        ]

    def email(self, m: re.Match) -> str | None:
        local = m[1]
        radices = [10 if c.isdigit() else 26 for c in local if c.isalnum()]
        if not radices or local[0] == "." or local[-1] == "." or ".." in local:
            return None
        marks = [int(c) if c.isdigit() else ord(c.lower()) - 97 for c in local if c.isalnum()]
        x, n = _number(marks, radices)
        new = _digits(self.move(x, n, "email"), radices)
        it = iter(new)
        out = "".join((str(next(it)) if c.isdigit() else chr(next(it) + (65 if c.isupper() else 97))) if c.isalnum() else c
                      for c in local)
        return out + m[2]

    def secret(self, m: re.Match) -> str | None:
        s = m[0]
        if s.isdigit():
            return None
        out = format(self.move(int(s, 16), 16 ** len(s), "secret"), f"0{len(s)}x")
        return out.upper() if s.upper() == s else out

    def iban(self, value: str) -> str:
        s = value.replace(" ", "")
        body = s[4:]
        radices = [10 if c.isdigit() else 26 for c in body]
        x, n = _number([int(c) if c.isdigit() else ord(c) - 65 for c in body], radices)
        new = "".join(str(d) if r == 10 else chr(65 + d) for d, r in zip(_digits(self.move(x, n, "iban"), radices), radices, strict=True))
        rest = int("".join(str(int(c, 36)) for c in new + s[:2] + "00")) % 97
        return _relayout(value, f"{s[:2]}{98 - rest:02d}{new}")

    def card(self, value: str) -> str:
        d = new = re.sub(r"[ -]", "", value)
        head = 1 if d[0] == "4" else 4 if d[0] == "2" else 2 if d[:2] != "60" else 4  # keeps the issuer's range
        while True:
            body = new[head:-1]
            new = d[:head] + str(self.move(int(body), 10 ** len(body), f"card{d[:head]}")).zfill(len(body))
            new += str(-luhn_sum(new + "0") % 10)
            # With the same sum one place on, longer stretches around the card stay valid or invalid as they were.
            if luhn_sum(new + "0") % 10 == luhn_sum(d + "0") % 10:
                return _relayout(value, new)

    def _together(self, text: str, found: list[tuple[int, int, str, str]], read: tuple[Spans, Spans]) -> list[tuple[int, int, str, str]]:
        """``found`` with other new values where account or card numbers would be read differently in the new text.

        Values in the midst of more digits or capitals walk on, all at once, until the same numbers are read."""
        regions = [m.span() for h in _IBAN_HEAD.finditer(text) if (m := _IBAN_MOST.match(text, h.start()))]
        regions += [m.span() for m in _CARD_RUN.finditer(text)]
        crowd = sorted(f[:3] for f in found if any(a < f[1] and f[0] < b and (a, b) != f[:2] for a, b in regions))
        if not crowd:
            return found
        firm = [(a, b) for a, b, kind, _ in found if kind in ("email", "secret")]
        rules = {kind: (pattern, rule) for kind, pattern, rule in self.rules}
        while True:
            new = [rules[k][1](text[a:b] if k in ("iban", "card") else rules[k][0].match(text, a)) for a, b, k in crowd]
            text = _put(text, [(a, b) for a, b, _ in crowd], new)
            if _read(text, firm) == read:
                break
        made = dict(zip(crowd, new, strict=True))
        return [(a, b, k, made.get((a, b, k), v)) for a, b, k, v in found]

    def ssn(self, m: re.Match) -> str | None:
        a, g, s = map(int, m[0].split("-"))
        if a in (0, 666) or a >= 900 or g == 0 or s == 0:
            return None
        x, n = _number([a - 1 - (a > 666), g - 1, s - 1], [898, 99, 9999])
        a, g, s = _digits(self.move(x, n, "ssn"), [898, 99, 9999])
        a += 1
        return f"{a + (a >= 666):03d}-{g + 1:02d}-{s + 1:04d}"

    def phone(self, m: re.Match) -> str | None:
        d = re.sub(r"\D", "", m[0])
        lead, d = d[:-10], d[-10:]
        if d[0] in "01" or d[3] in "01":
            if m[0][0] != "+":
                return None
            while True:  # unmistakable with + and country code: permuted among numbers of this sort
                d = f"{self.move(int(d), 10 ** 10, 'phone+'):010d}"
                if d[0] in "01" or d[3] in "01":
                    return _relayout(m[0], lead + d)
        radices = [8, 10, 10, 8, 10, 10, 10, 10, 10, 10]
        x, n = _number([int(c) - 2 if r == 8 else int(c) for c, r in zip(d, radices, strict=True)], radices)
        new = _digits(self.move(x, n, "phone"), radices)
        return _relayout(m[0], lead + "".join(str(v + 2 if r == 8 else v) for v, r in zip(new, radices, strict=True)))

    def ip(self, m: re.Match) -> str | None:
        parts = m[0].split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        x, n = _number(list(map(int, parts)), [256] * 4)
        return ".".join(map(str, _digits(self.move(x, n, "ip"), [256] * 4)))

    def date(self, m: re.Match) -> str | None:
        if m[1]:
            order, (y, mo, d) = "ymd", (int(m[1]), int(m[3]), int(m[4]))
        else:
            y, a, b = int(m[8]), int(m[5]), int(m[7])
            order, (mo, d) = ("mdy", (a, b)) if a <= 12 and m[6] == "/" else ("dmy", (b, a))
        try:
            x = datetime.date(y, mo, d).toordinal() - FIRST_DAY
        except ValueError:
            return None
        n = LAST_DAY - FIRST_DAY + 1
        if not 0 <= x < n:
            return None
        x = self.move(x, n, "date")
        while order == "dmy" and m[6] == "/" and datetime.date.fromordinal(FIRST_DAY + x).day <= 12:
            x = self.move(x, n, "date")  # stays unmistakable as day/month: walks on within such dates
        new = datetime.date.fromordinal(FIRST_DAY + x)
        if order == "ymd":
            return f"{new.year}{m[2]}{new.month:02d}{m[2]}{new.day:02d}"
        a, b = (new.month, new.day) if order == "mdy" else (new.day, new.month)
        return f"{a:0{len(m[5])}d}{m[6]}{b:0{len(m[7])}d}{m[6]}{new.year}"

    def __call__(self, text: str) -> tuple[str, dict[str, int]]:
        found: list[tuple[int, int, str, str]] = []
        if _DIGIT.search(text) or "@" in text:
            taken: Spans = []
            read: tuple[Spans, Spans] = [], []
            for kind, pattern, rule in self.rules:
                if kind == "iban":
                    read = _read(text, taken)
                if kind in ("iban", "card"):
                    found += [(a, b, kind, rule(text[a:b])) for a, b in read[kind == "card"]]
                    taken = [(a, b) for a, b, _, _ in found]
                    continue
                if kind == "ip":  # all before keep their length
                    found = self._together(text, found, read)
                spots = self._emails(text, pattern) if kind == "email" else pattern.finditer(text)
                for m in spots:
                    if any(a < m.end() and m.start() < b for a, b in taken):
                        continue
                    new = rule(m)
                    if new is not None:
                        found.append((m.start(), m.end(), kind, new))
                taken = [(a, b) for a, b, _, _ in found]
        if not found:
            return text, {}
        found.sort()
        out, at, counts = [], 0, {}
        for a, b, kind, new in found:
            out += [text[at:a], new]
            at = b
            counts[kind] = counts.get(kind, 0) + 1
        return "".join(out) + text[at:], counts

    @staticmethod
    def _emails(text: str, pattern: re.Pattern) -> Iterator[re.Match]:
        """Matches around each @ only, so long words are never scanned twice."""
        at = text.find("@")
        last = 0
        while at >= 0:
            start = at
            while start > max(last, at - 65) and (text[start - 1] in _LOCAL):
                start -= 1
            if m := pattern.match(text, start):
                last = m.end()
                yield m
            at = text.find("@", max(at + 1, last))


_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text", counts: str | None = "pii_counts",
                 back: bool = False) -> DataFrame:
    """``docs`` with ``text_column`` rewritten; ``counts`` names an added
    map column of values replaced by kind (None: not added).  ``back``
    restores the originals, given the same key.  One pass, no shuffle."""

    @F.pandas_udf("text string, counts map<string,int>")
    def rewrite(texts: pd.Series) -> pd.DataFrame:
        change = Pseudonyms(key.encode(), back)
        got = [(None, {}) if t is None else change(t) for t in texts]
        return pd.DataFrame({"text": [g[0] for g in got], "counts": [g[1] for g in got]})

    ship(docs.sparkSession)
    made = rewrite(docs[text_column])
    keep = [made["text"].alias(c) if c == text_column else docs[c] for c in docs.columns]
    return docs.select(*keep, *([made["counts"].alias(counts)] if counts else []))
