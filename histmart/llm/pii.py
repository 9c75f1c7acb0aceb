r"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

Each value found is validated, read as a number within the set of all valid
values of its format, permuted by a keyed Feistel network (generalised to sets
of any size, walking the cycle until the result lies in the set) and written
in the format it had. The map is a bijection per format and key: equal values
get equal pseudonyms in every document and on every executor without shared
state, different values stay different, and ``restore`` gives the text back.

Formats: payment cards (Luhn; the check digit is recomputed), IBANs (mod 97;
check digits recomputed), telephone numbers of ten national digits (with + and
a country code or a bracketed area code; without either mark the area code must
begin with 2 to 9, as the numbering plan has it, and separators are needed; a
number within the plan stays within it), US social
security numbers, IPv4 addresses, calendar dates from 1900 to 2099 (with a
slash month/day, else day/month; with - or . day first, else month first),
e-mail addresses (the part before the @) and secrets after token, key, secret
or password (16 or more letters, digits, - and _, with a digit). Equal dates
are linked across formats but for those in the second order, whose pseudonyms
keep a day over 12. Letters stay letters
of their case and digits digits. What fails its validation is left alone. Not
looked for: telephone numbers without exactly ten national digits, IPv6
addresses, dates in words and year-first dates with full stops.

Defined cases: a NULL text stays NULL with nothing found; texts without digit
or @ are not sent to Python; repeated rows are treated alike; an empty table
gives an empty result; an input column named ``pii`` is replaced.
"""

from __future__ import annotations

import calendar
import datetime as dt
import hashlib
import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.llm.common import prepare

KEY = "change-me"  # default of the registered query; give your own secret
ROUNDS = 10
PIECE = 128  # characters of a secret permuted together

PATTERN = re.compile(
    r"(?<![A-Za-z0-9._%+\-])(?P<email>[A-Za-z0-9._%+\-]{1,64})@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}"
    r"|(?<![A-Za-z])(?:token|key|secret|password)\s{0,4}[=:]\s{0,4}[\"']?(?P<secret>[A-Za-z0-9_\-]{16,})"
    r"|(?<![A-Za-z0-9])(?P<iban>[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?<![\d.])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?!\d|\.\d)"
    r"|(?<![\d+])(?P<phone>(?:\+\d{1,3}[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}|\+\d{1,3}[ .\-]\d{3}[ .\-]\d{3}[ .\-]\d{4}|\+\d{1,3}[ .\-]?\d{10}"
    r"|(?<!\d[.\- ])(?:1[ .\-])?\d{3}(?P<dash>[ .\-])\d{3}(?P=dash)\d{4}(?![.\- ]\d))(?!\d)"
    r"|(?<!\d)(?<!\d[.\-])(?P<card>\d{13,19}|\d{4}(?P<gap>[ \-])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)"
    r"|(?<![\d\-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d\-])"
    r"|(?<![\d.\-/])(?P<date>\d{4}-\d{2}-\d{2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}(?P<sep>[./\-])\d{1,2}(?P=sep)\d{4})(?![\d/\-]|\.\d)",
    re.IGNORECASE | re.ASCII)
KINDS = ("email", "secret", "iban", "ip", "phone", "card", "ssn", "date")
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: str, tweak: str, back: bool = False) -> int:
    """Keyed bijection of 0..size-1: Feistel on pairs (left, right) below side**2 >= size, cycle-walked."""
    if size < 2:
        return value
    side = math.isqrt(size - 1) + 1
    width = (side.bit_length() + 7) // 8 + 8

    def mix(r: int, x: int) -> int:
        h = hashlib.shake_256(f"{key}|{tweak}|{size}|{r}|{x}".encode())
        return int.from_bytes(h.digest(width), "big") % side

    while True:
        left, right = divmod(value, side)
        if back:
            for r in reversed(range(ROUNDS)):
                left, right = (right - mix(r, left)) % side, left
        else:
            for r in range(ROUNDS):
                left, right = right, (left + mix(r, right)) % side
        value = left * side + right
        if value < size:
            return value


def _characters(s: str, key: str, tweak: str, back: bool) -> str:
    """Permute a string among those with the same kinds of characters at the same places."""
    low = s.lower()
    radix = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in low]
    value, size = 0, 1
    for c, r in zip(low, radix):
        value = value * r + (int(c) if r == 10 else ord(c) - 97 if r == 26 else 0)
        size *= r
    value = permute(value, size, key, f"{tweak}|{''.join('.' if r == 1 else 'd' if r == 10 else 'a' for r in radix)}", back)
    out = []
    for c, r in zip(reversed(s), reversed(radix)):
        value, x = divmod(value, r)
        new = c if r == 1 else str(x) if r == 10 else chr(97 + x)
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out))


def _into(pattern: str, digits: str) -> str:
    """Write characters into the alphanumeric places of a pattern."""
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in pattern)


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _card(s, key, back):
    digits = "".join(c for c in s if c.isdigit())
    if _luhn(digits) or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = str(permute(int(digits[:-1]), 10 ** n, key, f"card{n}", back)).zfill(n)
    return _into(s, body + str(-_luhn(body + "0") % 10))


def _iban_value(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s))


def _iban(s, key, back):
    plain = "".join(s.split()).upper()
    if s != s.upper() or not 15 <= len(plain) <= 34 or _iban_value(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _characters(plain[4:], key, "iban" + plain[:2], back)
    check = 98 - _iban_value(body + plain[:2] + "00") % 97
    return _into(s, f"{plain[:2]}{check:02d}{body}")


def _ip(s, key, back):
    parts = [int(x) for x in s.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    v = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, v.to_bytes(4, "big")))


def _phone(s, key, back):
    digits = "".join(c for c in s if c.isdigit())
    country, rest = digits[:-10], digits[-10:]
    planned = rest[0] > "1"
    if not planned and "+" not in s and "(" not in s:
        return None
    while True:  # within the plan, or outside of it
        rest = str(permute(int(rest), 10 ** 10, key, "phone", back)).zfill(10)
        if (rest[0] > "1") == planned:
            return _into(s, country + rest)


def _ssn(s, key, back):
    area, group, serial = (int(x) for x in s.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    v = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    v, serial = divmod(permute(v, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(v, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(s, key, back):
    sep = next(c for c in s if not c.isdigit())
    parts = s.split(sep)
    # year first, else day first; with slashes month first; else the other order, which has a day over 12
    orders = ("ymd",) if len(parts[0]) == 4 else ("mdy", "dmy") if sep == "/" else ("dmy", "mdy")
    for order in orders:
        y, m, d = (int(parts[order.index(c)]) for c in "ymd")
        if 1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]:
            break
    else:
        return None
    n = dt.date(y, m, d).toordinal() - FIRST_DAY
    while True:
        n = permute(n, LAST_DAY - FIRST_DAY + 1, key, "date", back)
        new = dt.date.fromordinal(FIRST_DAY + n)
        if order == orders[0] or new.day > 12:  # walks on until the new date is read in the same order
            break
    part = {"y": str(new.year), "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    return sep.join(part[c] for c in order)


def _email(s, key, back):
    return _characters(s, key, "email", back)


def _secret(s, key, back):
    if not any(c.isdigit() for c in s):
        return None
    # pieces bound the numbers that are permuted
    return "".join(_characters(s[i:i + PIECE], key, f"secret{i or ''}", back) for i in range(0, len(s), PIECE))


_RULES = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "phone": _phone, "card": _card,
          "ssn": _ssn, "date": _date}


@lru_cache(maxsize=50_000)
def pseudonym(kind: str, value: str, key: str, back: bool = False) -> str | None:
    """The pseudonym of a value, None if it fails its validation."""
    return _RULES[kind](value, key, back)


# a run (a secret is one, of any length) from its start, with a digit or an @
_HINT = re.compile(r"(?<![A-Za-z_\-])[A-Za-z_\-]*+[0-9@][A-Za-z0-9_\-@]*+", re.ASCII)
BEFORE, AFTER = 176, 384  # farthest that a value reaches to either side of such a run


def _regions(text: str):
    """Stretches of the text that can hold a value: around every run with a digit or @, overlapping ones joined."""
    m = _HINT.search(text)
    while m:
        start, end = max(0, m.start() - BEFORE), m.end() + AFTER
        m = _HINT.search(text, m.end())
        while m and m.start() - BEFORE <= end:
            end = m.end() + AFTER
            m = _HINT.search(text, m.end())
        yield start, end


def rewrite(text: str, key: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The rewritten text and (kind, start, length) of each pseudonym in it."""
    out, found, at, grown = [], [], 0, 0
    for pos, stop in _regions(text):
        while m := PATTERN.search(text, pos, stop):
            kind = next(k for k in KINDS if m.group(k) is not None)
            start, end = m.span(kind)
            after = m.end()
            new = pseudonym(kind, m.group(kind), key, back)
            while new is None and kind == "iban" and (shorter := text.rfind(" ", start, end)) > 0:
                after = end = shorter  # a following word may have been taken for a group
                new = pseudonym(kind, text[start:end], key, back)
            if new is None:
                end = m.end(kind)
                pos = m.start() + 1
                while pos < end and text[pos].isalnum():  # past this run: its tail is no value of its own
                    pos += 1
                continue
            out += [text[at:start], new]
            found.append((kind, start + grown, len(new)))
            grown += len(new) - (end - start)
            at, pos = end, after
    return "".join(out) + text[at:], found


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY, back: bool = False) -> DataFrame:
    """The input with its text rewritten, and ``pii``: array of (kind, start, length) in the new text."""
    prepare(docs.sparkSession)

    @F.pandas_udf("struct<text:string,found:array<struct<kind:string,start:int,length:int>>>")
    def udf(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, []) if t is None else rewrite(t, key, back) for t in texts]
        return pd.DataFrame({"text": [r[0] for r in rows], "found": [r[1] for r in rows]})

    t = F.col(f"`{text}`")
    candidates = F.when(t.rlike("[0-9@]"), t)  # every format has a digit or an @
    out = docs.withColumn("_llm_pii", udf(candidates))
    return (out.withColumn(text, F.coalesce(F.col("_llm_pii.text"), t))
            .withColumn("pii", F.coalesce(F.col("_llm_pii.found"), F.array().cast("array<struct<kind:string,start:int,length:int>>")))
            .drop("_llm_pii"))


def restore(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """Undo ``pseudonymise`` with the same key (dates come back in two-digit days and months)."""
    return pseudonymise(docs, text, key, back=True)


def op7_query(docs: DataFrame) -> DataFrame:
    kinds = F.array_sort(F.array_distinct(F.transform("pii", lambda p: p["kind"])))
    return pseudonymise(docs).select("doc_id", "text", F.size("pii").alias("n_pii"), F.array_join(kinds, ",").alias("kinds"))
