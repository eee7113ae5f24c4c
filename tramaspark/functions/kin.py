"""Words for kinship as relation types and directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import norm_space, strip_accents

#: Type of the edge, whether it runs from the related person to the record's own (turned), and its words.
RULES = (
    ("MADRE_DE", True, "madre"),
    ("PADRE_DE", True, "padre"),
    ("HIJE_DE", True, "hijo;hija"),
    ("HERMANX_DE", False, "hermano;hermana;hermanx"),
    ("PAREJA_DE", False, "esposo;esposa;conyuge;pareja;companero;companera;novio;novia;ex esposo;ex esposa"),
    ("CUÑADX_DE", False, "cunado;cunada;cuñado;cuñada"),
    ("SUEGRX_DE", True, "suegro;suegra"),
    ("YERNX_NUERX_DE", True, "yerno;nuera"),
)
GRANDMOTHER = ("ABUELX_DE", True, "abuela")
#: Kin words as the kind of relation.
KINDS = {
    "madre": "MADRE", "padre": "PADRE", "hermanx": "HERMANO", "hermano": "HERMANO", "hermana": "HERMANO", "abuela materna": "ABUELA_MATERNA",
    "abuela paterna": "ABUELA_PATERNA", "esposo": "PAREJA", "esposa": "PAREJA", "conyuge": "PAREJA", "pareja": "PAREJA", "ex esposo": "PAREJA", "ex esposa": "PAREJA",
    "companero": "PAREJA", "companera": "PAREJA", "novio": "PAREJA", "novia": "PAREJA", "hijo": "HIJO", "hija": "HIJO",
}


def edge_type(word: Column, normalized: bool = False) -> Column:
    """STRUCT<tipo, turned> of a kin word; null for words without a rule. With normalized, accents do not matter."""
    w = F.lower(F.trim(word))
    if normalized:
        w = strip_accents(w)
    made = lambda kind, turned: F.struct(F.lit(kind).alias("tipo"), F.lit(turned).alias("turned"))
    out = F.when(w.contains(GRANDMOTHER[2]), made(*GRANDMOTHER[:2]))
    for kind, turned, words in RULES:
        out = out.when(w.isin(words.split(";")), made(kind, turned))
    return out


def relation_kind(word: Column) -> Column:
    """The kind of relation a word names, accents aside, else OTRA."""
    w = norm_space(F.regexp_replace(strip_accents(F.lower(word)), r"[\.,;:_\-]+", " "))
    out = F.when(F.lit(False), F.lit(""))
    for kind in sorted(set(KINDS.values())):
        out = out.when(w.isin([k for k, v in KINDS.items() if v == kind]), kind)
    return out.otherwise("OTRA")
