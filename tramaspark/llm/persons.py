"""Personal names as typed: their words, nicknames and initials, how they may be read, and whether two can name one person.

Which words are given and which are family names is often open: Silva, Ramos and Sosa are near Silvia, Ramon and Rosa, Martin
is both, and most names of the world are on no list. So a typed name is kept as all its likely readings, and two names
are compared by the pair of readings that agree best. The list of names serves to make nicknames equal; nearness to an entry
of it never decides alone what a word is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, pairwise

from ..functions.names import folded, jaro_winkler, mended, osa, unscanned

#: Usual given names with the familiar forms they go by; cut-off forms and -ito, -ita need no entry.
FAMILIAR = {
    "adolfo": "dolfi", "adriana": "", "agustin": "tino", "alberto": "tito", "alejandra": "", "alejandro": "", "alfredo": "", "alicia": "",
    "amalia": "mali", "ana": "anita", "andrea": "", "andres": "", "angel": "", "antonia": "tona", "antonio": "tono", "armando": "", "arturo": "", "beatriz": "betty bety",
    "carlos": "carlitos charly", "carmen": "", "carolina": "", "catalina": "", "cecilia": "", "clara": "", "claudia": "", "claudio": "", "cristina": "",
    "daniel": "", "daniela": "", "diego": "", "dolores": "lola", "domingo": "mingo", "eduardo": "lalo edu", "elena": "nena", "elsa": "", "elvira": "vira",
    "emilia": "mila", "emilio": "", "enrique": "quique kike", "ernesto": "", "estela": "telita", "esther": "", "eva": "", "felipe": "", "fernando": "nando",
    "francisca": "paca", "francisco": "fco pancho paco", "gabriel": "", "gabriela": "gaby", "gerardo": "yayo", "gloria": "", "graciela": "chela", "gregorio": "goyo",
    "guadalupe": "lupe lupita", "guillermo": "gmo memo", "gustavo": "", "hector": "tato", "hilda": "hildita", "horacio": "lacho", "hugo": "huguito", "ignacio": "nacho",
    "ines": "inesita", "irene": "nene", "isabel": "chabela isa", "jesus": "chucho", "jorge": "coco", "jose": "pepe", "josefina": "pepa", "juan": "jn juancho juani", "juana": "",
    "julia": "", "julio": "", "laura": "", "leandro": "", "leonor": "", "liliana": "", "lucia": "luchi", "luis": "lucho", "luisa": "", "manuel": "ml manolo manu",
    "marcela": "", "marcelo": "", "marcos": "", "margarita": "", "maria": "ma mary mari", "mario": "marito", "marta": "", "martin": "tincho", "mercedes": "meche", "miguel": "",
    "monica": "", "nelida": "", "nestor": "", "nicolas": "", "nora": "", "norma": "normita", "olga": "", "oscar": "cachito", "osvaldo": "valdo", "pablo": "", "patricia": "pato",
    "pedro": "", "rafael": "", "ramon": "moncho", "raquel": "quela", "raul": "ruli", "ricardo": "cacho richi", "roberto": "beto", "rodolfo": "fito", "rosa": "", "rosario": "charo",
    "ruben": "", "santiago": "", "sebastian": "", "sergio": "", "silvia": "", "soledad": "", "susana": "susi", "teresa": "tere", "veronica": "", "vicente": "", "victor": "vitorio",
    "victoria": "vicky", "zulema": "",
}
UNNAMED = re.compile(r"\b(no hay|sin) (informacion|datos?|nombre|identificar)\b|^\W*(n\W?n|s\W?[dn]|n\W?c|ignorad[oa]|desconocid[oa]|no identificad[oa]|se desconoce)\W*$")
TITLES = set("sr sra srta dr dra don dona ing prof lic cnel gral cap abog arq".split())
PARTICLES = set("la las los del".split())


def _nicknames() -> dict[str, frozenset[str]]:
    out: dict[str, set[str]] = {}
    for given, short in FAMILIAR.items():
        for w in [given, *short.split()]:
            out.setdefault(w, set()).add(given)
    return {w: frozenset(g) for w, g in out.items()}


NICKNAMES = _nicknames()


@lru_cache(100_000)
def _familiar(word: str) -> frozenset[str]:
    """The given names a word is, is a nickname of, or is the beginning of."""
    return NICKNAMES.get(word) or frozenset(g for g in FAMILIAR if g.startswith(word))


@lru_cache(200_000)
def letters(word: str) -> int:
    """Bits of a word's letters, up to three of a kind: an edit changes two at most, and a swap of neighbours none."""
    out = 0
    for c in word:
        bit = 1 << (ord(c) & 31) * 3
        out |= bit if not out & bit else bit << 1 if not out & bit << 1 else bit << 2
    return out


@lru_cache(200_000)
def neighbours(word: str) -> int:
    """Bits of a word's pairs of adjacent letters: an edit or a swap of neighbours changes six at most."""
    out = 0
    for a, b in pairwise(word):
        out |= 1 << (ord(a) * 31 + ord(b)) % 251
    return out


@lru_cache(100_000)
def givens(word: str, dotted: bool = False) -> frozenset[str]:
    """The given names a word may stand for; empty if it looks like none."""
    if word in NICKNAMES:
        return NICKNAMES[word]
    if dotted and 2 <= len(word) <= 4:

        def inside(name: str) -> bool:
            rest = iter(name)
            return all(c in rest for c in word)

        return frozenset(g for g in FAMILIAR if g[0] == word[0] and inside(g))
    if len(word) >= 3:
        cut = frozenset(g for g in FAMILIAR if g.startswith(word) and len(word) < len(g))
        if not cut and word.endswith(("ito", "ita", "ino", "ina")) and len(word) >= 6:
            cut = frozenset(g for g in FAMILIAR if g.startswith(word[:-3]) and len(g) - len(word) <= 1)
        if cut:
            return cut
    if len(word) >= 4:
        own = letters(word)
        close = [n for n in NICKNAMES if (letters(n) ^ own).bit_count() <= 4]  # others are more than two edits away
        for most in (1, 2) if len(word) >= 7 else (1,):
            near = frozenset(g for g in close if g in FAMILIAR and abs(len(g) - len(word)) <= most and osa(word, g, most) <= most)
            if near:
                return near
        alike = [n for n in close if n[-1] == word[-1] and code(n) == code(word) and osa(word, n, 2) <= 2]
        if not alike:
            alike = [n for n in close if len(n) >= 4 and abs(len(n) - len(word)) <= 1 and n[0] == word[0] and osa(word, n, 1) <= 1]
        return frozenset().union(*[NICKNAMES[n] for n in alike])
    return frozenset()


@dataclass(frozen=True)
class Name:
    """One reading of a name: given and family words in their order; a single letter is an initial."""

    given: tuple[str, ...]
    family: tuple[str, ...]

    @property
    def form(self) -> str:
        return " ".join(self.given) + "|" + " ".join(self.family)

    @property
    def known(self) -> int:
        """How much the name says: 2 for a word, 1 for an initial."""
        return sum(2 if len(w) > 1 else 1 for w in self.given + self.family)


def joined(readings: Iterable[Name]) -> str:
    """The form of a name: all its readings, in order."""
    return "/".join(sorted({n.form for n in readings}))


@lru_cache(50_000)
def from_form(form: str) -> tuple[Name, ...]:
    out = []
    for one in form.split("/"):
        g, _, f = one.partition("|")
        out.append(Name(tuple(g.split()), tuple(f.split())))
    return tuple(out)


_ASIDE = re.compile(r"\(a\)\s*\w+|\([^)]*\)|[\"“”«»][^\"“”«»]*[\"“”«»]|\balias\s+\w+")
#: Names of more words have their likeliest reading only.
MANY_WORDS = 12
#: Codes of words with more sounds are cut in keys (words that differ behind it share a key); glued names are no longer either.
LONG_CODE = 24


@lru_cache(100_000)
def glued(word: str) -> tuple[str, str] | None:
    """Two given names run together (Juanjose, Santiagoagustin): the first may be a beginning."""
    if len(word) < 7 or word in NICKNAMES:
        return None
    return next(((word[:i], word[i:]) for i in range(3, min(len(word) - 2, LONG_CODE)) if word[i:] in FAMILIAR and _familiar(word[:i])), None)


@dataclass(frozen=True)
class Word:
    """A word of a name: where a comma put it (True: given), and whether it is a listed given name, near one, or neither."""

    text: str
    dot: bool
    side: bool | None

    @property
    def names(self) -> frozenset[str]:
        return givens(self.text, self.dot) if len(self.text) > 1 else frozenset()

    @property
    def listed(self) -> bool:
        return self.text in NICKNAMES or (self.dot and bool(self.names)) or bool((halves := glued(self.text)) and halves[0] in NICKNAMES)

    @property
    def near(self) -> bool:
        return bool(self.names or glued(self.text))

    def as_given(self) -> list[str]:
        if halves := glued(self.text):
            return [next(iter(n)) if len(n := _familiar(x)) == 1 else x for x in halves]
        if len(self.names) == 1:
            return [next(iter(self.names))]
        return [self.text[0]] if self.dot and len(self.text) > 1 and not self.names else [self.text]


def name_words(text: str | None) -> list[Word]:
    """The words that name; titles, nicknames in brackets or quotes, particles and a married name behind "de" are set aside."""
    if UNNAMED.search(folded(text or "")):
        return []
    plain = _ASIDE.sub(" ", unscanned(folded(mended(text or "")))).replace("-", " ")
    head, comma, tail = plain.partition(",")
    sides = bool(comma and head.strip() and tail.strip())
    out: list[Word] = []
    for side, part in ((False, head), (True, tail)):
        found = re.findall(r"([a-z]+)(\.?)", part)
        taken = 0
        skip = False
        for k, (w, dot) in enumerate(found):
            if w in TITLES and (dot or k == 0) and len(found) > 1 and not taken:
                continue
            if skip:
                skip = False
                continue
            if w == "de" and taken >= 2:
                skip = True
                continue
            if w in PARTICLES or w in ("de", "y", "e") and not dot and len(w) > 1:
                continue
            taken += 1
            out.append(Word(w, bool(dot), side if sides else None))
    return out


def _reading(given: list[Word], family: list[Word]) -> Name:
    return Name(tuple(x for w in given for x in (w.as_given() if len(w.text) > 1 else [w.text])), tuple(w.text for w in family))


def _costs(words: list[Word]) -> list[float]:
    """How odd each split would be: first those with k = 1, 2, ... given words before the family, then those with k family words before them.

    Odd is a word of several letters among the given ones that is near no listed name, and a listed one among the family
    names; an initial that does not go with the word before it; and more than two family names.
    """
    n = len(words)
    as_given = [0.0, *accumulate(2.0 if len(w.text) > 1 and not w.near else 0.0 for w in words)]
    as_family = [0.0, *accumulate(2.0 if w.listed else 0.0 for w in words)]
    initial = [len(w.text) == 1 for w in words]
    first = [as_given[k] + as_family[n] - as_family[k] + initial[k] + 1.5 * max(0, n - k - 2) for k in range(1, n)]
    return first + [as_family[k] + as_given[n] - as_given[k] + initial[k] + 1.5 * max(0, k - 2) for k in range(1, n)]


def readings(text: str | None) -> list[Name]:
    """How a typed name may be read, the likeliest ways; empty if nothing is left of it.

    With a comma the family words come first. Without one, given words stand before family words or behind them, and at
    least one word is either. Listed given names tell which way it is; words that are only near one may be either, and if
    no word is listed or near, every split counts. One word alone is a family name.
    """
    words = name_words(text)
    if not words:
        return []
    if words[0].side is not None:
        return [_reading([w for w in words if w.side], [w for w in words if not w.side])]
    if len(words) == 1:
        return [_reading([], words)]
    splits = [(words[:k], words[k:]) for k in range(1, len(words))] + [(words[k:], words[:k]) for k in range(1, len(words))]
    if any(w.near or len(w.text) == 1 for w in words) or len(words) > MANY_WORDS:
        costs = _costs(words)
        best = min(costs)
        splits = [s for s, c in zip(splits, costs, strict=True) if c <= best][: 1 if len(words) > MANY_WORDS else None]
    return list({n.form: n for n in (_reading(g, f) for g, f in splits)}.values())


def parse(text: str | None) -> str | None:
    """The form of a typed name: its readings; None if it names nobody."""
    found = readings(text)
    return joined(found) if found else None


@lru_cache(200_000)
def code(word: str) -> str:
    """A phonetic code: the first sound and the following consonant sounds of Spanish."""
    w = word.replace("h", "").replace("qu", "k").replace("ll", "y").replace("v", "b").replace("x", "s").replace("z", "s")
    w = re.sub(r"g(?=[ei])", "j", w)
    w = re.sub(r"c(?=[ei])", "s", w).replace("c", "k").replace("w", "u")
    w = w[:1] + re.sub(r"[aeiouy]", "", w[1:])
    return re.sub(r"(.)\1+", r"\1", w) or word


@lru_cache(500_000)
def family_close(a: str, b: str) -> float:
    """How alike two family names are: Jaro-Winkler where few slips or one sound part them, else 0; initials 0.9."""
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return 0.9 if a[0] == b[0] else 0.0
    most = 3 if code(a) == code(b) else 1 if min(len(a), len(b)) < 7 else 2
    if (letters(a) ^ letters(b)).bit_count() > 2 * most or (neighbours(a) ^ neighbours(b)).bit_count() > 6 * most or osa(a, b, most) > most:
        return 0.0
    j = jaro_winkler(a, b)
    return j if j >= 0.84 else 0.0


@lru_cache(500_000)
def given_close(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = givens(a), givens(b)
    if len(a) == 1 or len(b) == 1:
        one, other, names = (a, b, y) if len(a) == 1 else (b, a, x)
        return 0.9 if one == other[0] or any(n[0] == one for n in names) else 0.0
    if x and y:
        return 0.97 if x & y else 0.0
    j = jaro_winkler(a, b)
    return j if j >= 0.88 else 0.0


def compare_readings(a: Name, b: Name) -> tuple[float, bool]:
    """(score, whole) of two readings: 0 if they cannot name one person; whole if every word of both has its counterpart.

    Family names are matched in order from the first. A name with fewer given words must have all of them in the other, its
    first one as the first; equally many may stand in any order.
    """
    n = min(len(a.family), len(b.family))
    if not n or not a.given or not b.given:
        return 0.0, False
    total, whole = 0.0, len(a.family) == len(b.family) and len(a.given) == len(b.given)
    for x, y in zip(a.family, b.family, strict=False):
        s = family_close(x, y)
        if not s:
            return 0.0, False
        whole = whole and (x == y or (len(x) > 1 and len(y) > 1))
        total += s
    short, long = (a.given, list(b.given)) if len(a.given) <= len(b.given) else (b.given, list(a.given))
    for k, x in enumerate(short):
        if k == 0 and len(short) < len(long) and not given_close(x, long[0]):
            return 0.0, False
        s, y = max(((given_close(x, y), y) for y in long), default=(0.0, ""))
        if not s:
            return 0.0, False
        whole = whole and (x == y or (len(x) > 1 and len(y) > 1))
        long.remove(y)
        total += s
    return total / (n + len(short)), whole


Form = tuple[Name, ...]


def best_readings(a: Form, b: Form) -> tuple[float, bool, Name, Name]:
    """(score, whole, reading, reading): the two readings that agree best; those that agree in all words first."""
    if len(a) == len(b) == 1:
        return *compare_readings(a[0], b[0]), a[0], b[0]
    found = [(*compare_readings(x, y), x, y) for x in a for y in b]
    return max(found, key=lambda f: (f[0] > 0, f[1], f[0], f[2].form, f[3].form))


def compare(a: Form, b: Form) -> tuple[float, bool]:
    """(score, whole) of two names by the readings that agree best."""
    return best_readings(a, b)[:2]


def known(a: Form) -> int:
    return max(n.known for n in a)


def block_keys(form: Form) -> list[tuple[str, str]]:
    """(key, kind) by phonetic codes, in whatever order the words were typed.

    A key joins the code of one word, which a reading takes for a first or second family name, with the first sound of
    another, which the same reading takes for given. kind is "f" for a whole code of a first family name, "d" for one sound
    left out of it and "s" for the second.
    """
    out: set[tuple[str, str]] = set()
    for name in form:
        letters = {n[0] for g in name.given for n in (givens(g) or [g])}
        made: set[tuple[str, str]] = set()
        if name.family and len(name.family[0]) > 1:
            c = code(name.family[0])[:LONG_CODE]
            made.add((c, "f"))
            made |= {(v, "d") for v in (c, *(c[:k] + c[k + 1 :] for k in range(len(c)))) if len(v) > 1}
        if len(name.family) > 1 and len(name.family[1]) > 1:
            made.add((code(name.family[1])[:LONG_CODE], "s"))
        out |= {(f"{kind}:{letter}:{c}", kind) for c, kind in made for letter in letters}
    return sorted(out)
