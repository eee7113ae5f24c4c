"""Text functions as column expressions; everything here stays in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a regular expression class: ASCII and Unicode separators and the control separators.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def _plain_letters() -> tuple[str, str]:
    """Characters whose compatibility form, without combining marks, is one other character; and these characters."""
    source, target = [], []
    for code in [*range(0xA1, 0x250), *range(0x1E00, 0x1F00), *range(0x2100, 0x2150)]:
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != c:
            source.append(c)
            target.append(plain)
    marks = [chr(code) for code in range(0x300, 0x370) if unicodedata.combining(chr(code))]
    return "".join(source + marks), "".join(target)


_FROM, _TO = _plain_letters()
#: Compatibility forms of several characters.
_LONGER = {"ﬁ": "fi", "ﬂ": "fl", "½": "1⁄2", "¼": "1⁄4", "¾": "3⁄4", "…": "...", "™": "TM"}


def norm_space(c: Column) -> Column:
    """Runs of white space, Unicode's included, as one blank; none at the ends. null stays null."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks, for Latin text."""
    for one, several in _LONGER.items():
        c = F.replace(c, F.lit(one), F.lit(several))
    return F.translate(c, _FROM, _TO)


def slug(c: Column) -> Column:
    """Lower case without accents, words of a-z and 0-9 joined by underscores."""
    return F.replace(norm_space(F.regexp_replace(strip_accents(F.lower(c)), r"[^a-z0-9\s]", " ")), F.lit(" "), F.lit("_"))


#: Texts that say nothing. The accented form counts as well, unlike in the data's first loader.
NOTHING = ["", "-", "No hay informacion.", "No hay información."]


def clean_text(c: Column) -> Column:
    """The text with its white space normalised; null if it says nothing."""
    t = norm_space(c.cast("string"))
    return F.when(~t.isin(NOTHING), t)


def name_key(c: Column) -> Column:
    """The key of a person known by name only."""
    return F.concat(F.lit("nombre:"), slug(c))


def geo_name(c: Column) -> Column:
    """Upper case without accents; all that is neither letter nor digit becomes a blank."""
    return norm_space(F.regexp_replace(strip_accents(F.upper(c)), r"[^\p{L}\p{N}\s]", " "))


def place_text(c: Column) -> Column:
    """Upper case without accents, A-Z and 0-9 only."""
    return norm_space(F.regexp_replace(strip_accents(F.upper(c)), r"[^A-Z0-9\s]", " "))


def scoped_key(*parts: Column) -> Column:
    """The first 20 hexadecimal digits of the SHA-1 of the parts joined by a bar."""
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 20)


#: Words that do not tell names apart.
STOP_TOKENS = "de del la las el los y mr mrs miss ms da junior jr das di van der dos filho do".split()


def name_tokens(c: Column) -> Column:
    """The distinct words of a name, sorted, without stop words and single letters; empty for null and blank names."""
    plain = norm_space(F.regexp_replace(strip_accents(F.lower(F.replace(c, F.lit("_"), F.lit(" ")))), r"[^a-z0-9\s]", " "))
    words = F.filter(F.split(F.coalesce(plain, F.lit("")), " "), lambda w: (F.length(w) > 1) & ~w.isin(STOP_TOKENS))
    return F.array_sort(F.array_distinct(words))


def label_key(c: Column) -> Column:
    """A card's label as a key: no colon, lower case, blanks as underscores."""
    return F.replace(F.lower(F.trim(F.replace(c, F.lit(":"), F.lit("")))), F.lit(" "), F.lit("_"))


def split_list(c: Column, keep_blank: bool = True) -> Column:
    """The trimmed parts between commas; without keep_blank, only those that are not blank."""
    parts = F.transform(F.split(c, ","), lambda p: F.trim(p))
    return parts if keep_blank else F.filter(parts, lambda p: p != "")


def plain_blanks(c: Column) -> Column:
    """No-break spaces as blanks, trimmed."""
    return F.trim(F.translate(c, " ", " "))
