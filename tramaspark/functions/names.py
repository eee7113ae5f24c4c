"""Folding of typed text, and similarities of short strings."""

from __future__ import annotations

import re
import unicodedata

_GARBLED = re.compile("[ÃÂ][\u0080-¿Œ-™]")


def mended(text: str) -> str:
    """UTF-8 that was read as Latin-1 or Windows-1252, put right character by character where it can be."""

    def back(m: re.Match[str]) -> str:
        for codec in ("cp1252", "latin-1"):
            try:
                return m.group().encode(codec).decode("utf-8")
            except UnicodeError:
                continue
        return m.group()

    return _GARBLED.sub(back, text) if "Ã" in text or "Â" in text else text


def folded(text: str) -> str:
    """Lower case, without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


_MISREAD = str.maketrans("015@$|", "olsasl")
_IN_WORD = re.compile(r"[^\W\d_][\w@$|]*[015@$|][\w@$|]*|[015@$|]+[^\W\d_][\w@$|]*")


def unscanned(text: str) -> str:
    """Digits and signs that a scanner took for letters, put back inside words (Cor0nel, Genera1, Est@cion)."""

    def fix(m: re.Match[str]) -> str:
        word = m.group()
        letters = sum(c.isalpha() for c in word)
        return word.translate(_MISREAD) if letters >= 3 and letters * 2 > len(word) else word

    return _IN_WORD.sub(fix, text)


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours; more than `most` comes out as most + 1.

    Only the cells within `most` of the diagonal are worked.
    """
    if a == b:
        return 0
    n, m, over = len(a), len(b), most + 1
    if abs(n - m) > most:
        return over
    before: list[int] = []
    row = [j if j < over else over for j in range(m + 1)]
    for i in range(1, n + 1):
        x = a[i - 1]
        first, last = max(1, i - most), min(m, i + most)
        now = [over] * (m + 1)
        if i < over:
            now[0] = i
        least = now[0]
        for j in range(first, last + 1):
            y = b[j - 1]
            d = row[j - 1] if x == y else row[j - 1] + 1
            if row[j] < d:
                d = row[j] + 1 if row[j] + 1 < d else d
            if now[j - 1] + 1 < d:
                d = now[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            now[j] = d
            if d < least:
                least = d
        if least > most:
            return over
        before, row = row, now
    return min(row[-1], over)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(0, max(n, m) // 2 - 1)
    used = [False] * m
    left = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                left.append(x)
                break
    k = len(left)
    if not k:
        return 0.0
    right = [b[j] for j in range(m) if used[j]]
    turned = sum(x != y for x, y in zip(left, right, strict=True)) / 2
    jaro = (k / n + k / m + (k - turned) / k) / 3
    prefix = 0
    while prefix < min(4, n, m) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)
