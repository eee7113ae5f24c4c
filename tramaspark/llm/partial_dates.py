"""Dates as typed: partial, in several notations."""

from __future__ import annotations

import re
from datetime import date

from ..functions.names import folded

#: Spanish month names by their first three letters.
MONTHS = {"ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6, "jul": 7, "ago": 8, "sep": 9, "set": 9, "oct": 10, "nov": 11, "dic": 12}

Partial = tuple[int, int | None, int | None]


def month(text: str | None) -> int | None:
    t = folded(text or "").strip()
    return (int(t) if 1 <= int(t) <= 12 else None) if t.isdigit() else MONTHS.get(t[:3])


def _checked(y: int, m: int | None, d: int | None) -> Partial | None:
    if y < 100:
        y += 1900
    if not 1800 <= y <= 2100 or (m is not None and not 1 <= m <= 12):
        return None
    if d is not None and m is not None:
        try:
            date(y, m, d)
        except ValueError:
            return None
    return (y, m, d)


def partial_date(text: str | None) -> Partial | None:
    """(year, month or None, day or None) of a typed date, null if unreadable; two-digit years are of the 1900s."""
    t = folded(text or "").strip(" .")
    if m := re.fullmatch(r"(\d{4})(?:[-/.](\d{1,2})(?:[-/.](\d{1,2}))?)?", t):
        return _checked(int(m[1]), int(m[2]) if m[2] else None, int(m[3]) if m[3] else None)
    if m := re.fullmatch(r"(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})", t):
        return _checked(int(m[3]), int(m[2]), int(m[1]))
    if m := re.fullmatch(r"(\d{1,2})[-/.](\d{4})", t):
        return _checked(int(m[2]), int(m[1]), None)
    if (m := re.fullmatch(r"(?:(\d{1,2})\W* de )?([a-z]{3,})\W*(?:del?)? (\d{4})", t)) and month(m[2]):
        return _checked(int(m[3]), month(m[2]), int(m[1]) if m[1] else None)
    return None


def date_evidence(a: Partial | None, b: Partial | None) -> float:
    """How much two typed dates speak for one day: from 1 (the same full date) to -1 (plainly others); 0 says nothing."""
    if not a or not b:
        return 0.0
    fields = [(x, y) for x, y in zip(a, b, strict=True) if x is not None and y is not None]
    same = [x == y for x, y in fields]
    if all(same):
        return (0.3, 0.6, 1.0)[len(same) - 1]
    if len(fields) == 3:
        if a[0] == b[0] and a[1] == b[2] and a[2] == b[1]:
            return 0.9
        days = abs((date(*a) - date(*b)).days)  # type: ignore[arg-type]
        if days <= 31:
            return 0.7 if days <= 3 else 0.5
        if sum(same) == 2:
            return 0.5 if not same[0] and abs(a[0] - b[0]) in (1, 10) or same[0] else 0.1
        return -1.0
    if abs(a[0] - b[0]) <= 1:
        return 0.3 if len(fields) == 2 and same[1] else -0.2
    return -1.0
