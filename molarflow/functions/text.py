"""Name folding, digit extraction and list parsing (STR1-3, STR6-8).

Stored-side folding is one Column expression (`fold_name`) materialised at
merge time, so a filter on it stays inside whole-stage codegen and needs no
Python. The request side (`fold_text`) runs once on the driver over the
request parameters only.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

def _accent_table() -> tuple[str, str]:
    """Lower-case Latin letters that decompose into an ASCII letter and marks, and that letter
    (`ß`, `ø` and `æ` do not decompose)."""
    pairs = {}
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(point)
        base, *marks = unicodedata.normalize("NFD", c)
        if c == c.lower() and base.isascii() and base.isalpha() and marks and all(unicodedata.combining(m) for m in marks):
            pairs[c] = base
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _accent_table()

_COMBINING = re.compile("[̀-ͯ]")
_SPACES = re.compile(r"\s+")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: Column | str) -> Column:
    """Lower-case, drop diacritics from Latin letters and combining marks."""
    return F.regexp_replace(F.translate(F.lower(_col(c)), ACCENTED, PLAIN), "[\u0300-\u036f]", "")


def fold_name(c: Column | str) -> Column:
    """STR1: strip accents, lower, collapse whitespace runs to one space, trim."""
    return F.trim(F.regexp_replace(strip_accents(c), r"(?U)\s+", " "))


def phone_digits(c: Column | str) -> Column:
    """STR3: keep decimal digits only."""
    return F.regexp_replace(_col(c), r"[^0-9]", "")


def truncate(c: Column | str, n: int = 500) -> Column:
    """STR8: cut text to at most n characters."""
    return F.substring(_col(c), 1, n)


# ---- request-side helpers (driver, tiny inputs) ----

def fold_text(s: str | None) -> str:
    """Driver twin of `fold_name` for request parameters."""
    if s is None:
        return ""
    s = _COMBINING.sub("", unicodedata.normalize("NFD", str(s))).lower()
    return _SPACES.sub(" ", s).strip()


def search_text(s: str | None) -> str:
    """STR2: the free-text search box folded, without `(`, `)`, `,` and `*`."""
    if s is None:
        return ""
    s = _COMBINING.sub("", unicodedata.normalize("NFD", str(s))).lower()
    return re.sub(r"[(),*]", " ", s).strip()


def parse_list(raw: str | None, sep: str = ",", fold: bool = False) -> list[str]:
    """STR7: split on `sep`, trim, drop blanks; optionally fold each item."""
    if raw is None:
        return []
    items = (fold_text(x) if fold else x.strip() for x in str(raw).split(sep))
    return [x for x in items if x]


def parse_int_list(raw: str | None) -> list[int]:
    """Comma list of integers; non-numeric items are dropped (FLT3)."""
    out = []
    for x in parse_list(raw):
        m = re.match(r"^\s*([+-]?\d+)", x)
        if m:
            out.append(int(m.group(1)))
    return out
