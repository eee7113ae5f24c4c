"""Similarities of names and place names. Python only where Spark has no function; in Arrow batches."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import folded, osa
from .text import STOP_TOKENS

DIRECTIONS = {"este", "oeste", "norte", "sur"}
SOFT = 0.84


def token_set(text: str | None) -> set[str]:
    words = re.sub(r"[^a-z0-9\s]", " ", folded((text or "").replace("_", " "))).split()
    return {w for w in words if len(w) > 1 and w not in STOP_TOKENS}


def mended(own: set[str], other: set[str]) -> set[str]:
    """Own words, each replaced by a word of the other name that one slip parts from it.

    Exact words stay, and the first in alphabetical order is taken, so that a score never depends on set order.
    """
    fixed = lambda w: w in DIRECTIONS or w.isdigit()
    out = set()
    for w in own:
        near = [] if fixed(w) or w in other else [o for o in sorted(other) if not fixed(o) and abs(len(o) - len(w)) <= 1 and osa(w, o, 1) <= 1 and _one_edit(w, o)]
        out.add(near[0] if near else w)
    return out


def _one_edit(a: str, b: str) -> bool:
    """One insertion, deletion or replacement; a swap of neighbours is two."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return True


def soft_dice(a: set[str], b: set[str], least: float = SOFT) -> float:
    """Dice's coefficient in which words at least `least` alike count by their likeness."""
    if not a or not b:
        return 0.0
    same = a & b
    left, right = sorted(a - same), sorted(b - same)
    total = float(len(same))
    for w in left:
        best = max(right, key=lambda o: SequenceMatcher(None, w, o).ratio(), default=None)
        if best is not None and (r := SequenceMatcher(None, w, best).ratio()) >= least:
            total += r
            right.remove(best)
    return 2 * total / (len(a) + len(b))


def name_score(a: str | None, b: str | None) -> float:
    """From 0 to 1; 0 if numbers or directions differ, or one name has no words."""
    x, y = token_set(a), token_set(b)
    if not x or not y or x & DIRECTIONS != y & DIRECTIONS or {w for w in x if w.isdigit()} != {w for w in y if w.isdigit()}:
        return 0.0
    return round((soft_dice(mended(x, y), y) + soft_dice(mended(y, x), x)) / 2, 6)


@F.pandas_udf(T.DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([name_score(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def place_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def merge_verdict(a: str | None, b: str | None) -> tuple[bool, float, str]:
    """Whether two place names are one with a slip in one word: (verdict, score, reason)."""
    if not a or not b or a == b:
        return False, 0.0, "sin_cambio"
    if set(re.findall(r"\d+", a)) != set(re.findall(r"\d+", b)):
        return False, 0.0, "numeros_distintos"
    x, y = a.split(), b.split()
    dx, dy = ({w for w in t if w.lower() in DIRECTIONS} for t in (x, y))
    if dx != dy:
        return False, 0.0, "direccion_conflictiva" if dx and dy else "direccion_incompleta"
    if len(x) != len(y):
        return False, 0.0, "estructura_distinta"
    other = [(p, q) for p, q in zip(x, y, strict=True) if p != q]
    if len(other) != 1:
        return False, 0.0, "muchas_diferencias"
    word, whole = SequenceMatcher(None, *other[0]).ratio(), SequenceMatcher(None, a, b).ratio()
    if word < 0.8 or whole < 0.9:
        return False, whole, "diferencia_no_tipografica"
    return True, min(1.0, whole + (0.02 if dx else 0.0)), "typo_un_token"
