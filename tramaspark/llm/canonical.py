"""Typed places as entries of a reference list: character n-gram index, weighted cosine, threshold and margin."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import folded, mended, osa, unscanned
from ..runtime import cores, discard, lookup, stored

NOT_FOUND = "NO_HALLADO"
THRESHOLD = 0.32
MARGIN = 0.06
#: Entries of the reference list that one index holds; results do not depend on it.
REFERENCE_BLOCK = 20_000
#: A usual first word begins at least this share of all names, and three: so there are at most 400.
USUAL = 1 / 400
VALUES_PER_TASK = 5_000
#: Weight of the usual grams of a text whose postings need not be read.
TAIL = 0.1

#: How the first words of place names are shortened, and words that only introduce a name.
SHORT = {
    "sta": "santa", "sto": "santo", "gral": "general", "gnral": "general", "cnel": "coronel", "cap": "capitan", "ing": "ingeniero",
    "est": "estacion", "pto": "puerto", "lag": "laguna", "col": "colonia", "va": "villa", "vla": "villa", "bque": "bosque", "cdad": "ciudad", "4": "cuatro",
}
PROVINCE_WORDS = {"prov", "pcia", "provincia", "pcia.", "prov."}
DEPARTMENT_WORDS = {"partido", "pdo", "departamento", "depto", "dpto", "dto"}
FORMERLY = {"ex", "antes"}
LINKS = {"de", "del", "la", "las", "los", "el", "y"}
ABROAD = {"extranjero", "exterior"}

_SEPARATOR = re.compile(r"[,;()/]| [-–] |(?<=\w{5})\.(?=\s)|\.$")


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text)


def fits(typed: list[str], name: list[str]) -> bool:
    """Whether typed words are a name's words, whole, shortened to a beginning, or with a slip; links may be left out."""
    want = [w for w in name if w not in LINKS]
    have = [SHORT.get(w, w) for w in typed if w not in LINKS]
    if len(want) != len(have) or not have:
        return False
    whole = 0
    for h, w in zip(have, want, strict=True):
        if h == w or (len(w) >= 5 and osa(h, w, 1) <= 1):
            whole += len(w)
        elif w.startswith(h) and (len(h) <= 4 or len(name) == 1):
            whole += len(h) if len(h) > 1 else 0
        else:
            return False
    return whole >= 4


@dataclass
class Typed:
    parts: list[list[str]] = field(default_factory=list)  # words of the parts that may name a place, in order
    provinces: set[str] = field(default_factory=set)
    department: list[str] | None = None
    abroad: bool = False


def read(value: str, province: str | None, provinces: dict[str, list[str]]) -> Typed:
    """The parts of a typed place, and what it says of province and department."""
    out = Typed()

    def known(typed: list[str]) -> str | None:
        return next((p for p, name in provinces.items() if fits(typed, name)), None)

    for raw in _SEPARATOR.split(unscanned(folded(mended(value)))):
        w = words(raw or "")
        if not w or w[0] in FORMERLY:
            continue
        if w[0] in PROVINCE_WORDS:
            w = [x for k, x in enumerate(w) if k > 1 or x not in PROVINCE_WORDS | {"de"}]
        if ABROAD & set(w):
            out.abroad = True
        elif w and w[0] in DEPARTMENT_WORDS and len(w) > 1:
            out.department = w[1:]
        elif (p := known(w)) is not None:
            out.provinces.add(p)
        elif w:
            out.parts.append(w)
    if not out.provinces and province and (p := known(words(unscanned(folded(mended(province)))))):
        out.provinces.add(p)
    return out


def spellings(part: list[str], firsts: list[str]) -> list[str]:
    """What of a part may be the name: all of it, and what follows a linking word; shortened first words written out.

    A single letter stands for every usual first word (firsts) that begins with it.
    """
    starts = [0] + [k + 1 for k, w in enumerate(part) if w in ("de", "en") and k + 1 < len(part)]
    out = []
    for s in starts:
        w = part[s:]
        if len(w) > 1 and len(w[0]) == 1:
            out += [" ".join([f, *w[1:]]) for f in firsts if f[0] == w[0]]
        out.append(" ".join([SHORT.get(w[0], w[0]) if len(w) > 1 else w[0], *w[1:]]))
    return list(dict.fromkeys(out))


def grams(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    padded = f"  {text} ".replace(" ", "_")
    for n in (2, 3):
        for k in range(len(padded) - n + 1):
            g = padded[k : k + n]
            out[g] = out.get(g, 0) + 1
    return out


def _letters(text: str) -> int:
    """The signs of a text as a set of bits, with others for a second and a third of each."""
    out = 0
    for c, n in Counter(text).items():
        out |= (1 | (1 << 128 if n > 1 else 0) | (1 << 256 if n > 2 else 0)) << (ord(c) & 127)
    return out


def plain_name(text: str | None) -> str:
    return " ".join(words(folded(text or "")))


@dataclass(frozen=True)
class Weights:
    """What is counted over the whole list before it is cut into blocks: gram frequencies and usual first words.

    Grams are of 2 and 3 of 37 signs, so there are at most 37 ** 2 + 37 ** 3 of them however long the list is.
    """

    entries: int
    idf: dict[str, float]
    firsts: tuple[str, ...]

    @classmethod
    def counted(cls, entries: int, df: dict[str, int], first: dict[str, int]) -> Weights:
        least = max(3, math.ceil(USUAL * entries))
        return cls(entries, {k: math.log(1 + entries / v) for k, v in df.items()}, tuple(sorted(w for w, k in first.items() if k >= least)))

    @classmethod
    def of(cls, names: list[str]) -> Weights:
        df: dict[str, int] = {}
        first: dict[str, int] = {}
        for name in names:
            for g in grams(name):
                df[g] = df.get(g, 0) + 1
            if " " in name:
                first[name.split()[0]] = first.get(name.split()[0], 0) + 1
        return cls.counted(len(names), df, first)

    def vector(self, text: str) -> dict[str, float]:
        """The text's grams with their weights, of length 1."""
        default = math.log(1 + self.entries)
        weight = {k: v * self.idf.get(k, default) for k, v in grams(text).items()}
        norm = math.sqrt(sum(w * w for w in weight.values())) or 1.0
        return {k: w / norm for k, w in weight.items()}


class Index:
    """An inverted index over the names of one block of the reference list."""

    def __init__(self, rows: list[tuple[str, str, str, str]], weights: Weights) -> None:
        self.rows = rows
        self.weights = weights
        self.names = [plain_name(r[1]) for r in rows]
        self.provinces = [folded(r[3] or "") for r in rows]
        self.departments = [words(folded(r[2] or ""))[1:] for r in rows]
        self.letters = [_letters(n) for n in self.names]
        self.vectors = [weights.vector(n) for n in self.names]
        post: dict[str, tuple[list[int], list[float]]] = {}
        for i, vector in enumerate(self.vectors):
            for g, w in vector.items():
                ids, ws = post.setdefault(g, ([], []))
                ids.append(i)
                ws.append(w)
        self.post = {g: (np.array(i), np.array(w)) for g, (i, w) in post.items()}
        self.held: dict[str, list[tuple[int, float, int]]] = {}

    def hits(self, text: str) -> list[tuple[int, float, int]]:
        """(entry, weighted cosine, edit distance) of every entry from THRESHOLD on.

        Postings are read from the text's heaviest gram on, until what is left of the text weighs less than TAIL: the
        usual grams with their long postings are mostly never read. Entries whose sum so far cannot reach THRESHOLD
        with what is left fall out, and the others' sums are completed from their own grams.
        """
        if (found := self.held.get(text)) is not None:
            return found
        vector = self.weights.vector(text)
        order = sorted(vector, key=lambda g: (-vector[g], g))
        rest = np.sqrt(np.maximum(0.0, np.cumsum([vector[g] ** 2 for g in reversed(order)])))[::-1]  # from each gram on
        read = next((k for k, r in enumerate(rest) if r < TAIL), len(order))
        lists = [(self.post[g], vector[g]) for g in order[:read] if g in self.post]
        out = []
        if lists:
            ids, at = np.unique(np.concatenate([p[0] for p, _ in lists]), return_inverse=True)
            sums = np.bincount(at, weights=np.concatenate([p[1] * w for p, w in lists]))
            left = float(rest[read]) if read < len(order) else 0.0
            mask = _letters(text)
            for k in np.nonzero(sums + left >= THRESHOLD - 1e-9)[0]:
                i = int(ids[k])
                own = self.vectors[i]
                s = round(float(sums[k]) + sum(vector[g] * own[g] for g in order[read:] if g in own), 12)
                if s >= THRESHOLD:
                    most = allowed(self.names[i])
                    # every slip brings in one such bit at most
                    far = (mask & ~self.letters[i]).bit_count() > most or (self.letters[i] & ~mask).bit_count() > most
                    out.append((i, s, most + 1 if far else osa(text, self.names[i], most)))
        if len(self.held) < 200_000:
            self.held[text] = out
        return out


def rank(c: tuple) -> tuple:
    """The order of found entries: cosine less a tenth per slip, then slips; ties by part and id."""
    return (c[5] - 0.1 * c[6], -c[6], -c[0], c[1])


def candidates(index: Index, typed: Typed) -> list[tuple]:
    """(part, georef id, name, province, department, score, distance, spelling): what decide() can need of this block.

    These are, of every part, the best by score, and the two best by rank of the entries near enough, of those in a named
    province, and of those in the named department as well. They are chosen after province and department were looked at,
    and any block of a list passes on its own two, so that the decision is that of the whole list.
    """
    out: dict[tuple[int, int], tuple] = {}
    for k, part in enumerate(typed.parts):
        best: dict[int, tuple[float, int, str]] = {}
        for text in spellings(part, index.weights.firsts):
            for i, s, d in index.hits(text):
                if i not in best or (s, -d, text) > (best[i][0], -best[i][1], best[i][2]):
                    best[i] = (s, d, text)
        rows = {i: (k, index.rows[i][0], index.names[i], index.provinces[i], " ".join(index.departments[i]), s, d, text) for i, (s, d, text) in best.items()}
        if rows:
            top = max(rows, key=lambda i: (rows[i][5], rows[i][1]))
            out[k, top] = rows[top]
        good = [i for i in rows if rows[i][6] <= allowed(rows[i][2])]
        inside = [i for i in good if rows[i][3] in typed.provinces] if typed.provinces else good
        said = [i for i in inside if fits(typed.department, index.departments[i])] if typed.department else []
        for pool in (good, inside, said):
            for i in sorted(pool, key=lambda i: rank(rows[i]), reverse=True)[:2]:
                out[k, i] = rows[i]
    return [out[key] for key in sorted(out)]


def allowed(name: str) -> int:
    """Slips that a name of this length may have."""
    return 1 if len(name) < 7 else 2 if len(name) < 13 else 3


def decide(typed: Typed, found: list[tuple]) -> tuple[str, float]:
    """(georef id or NOT_FOUND, score): the entry above threshold and margin that the value names alone.

    The part with the best score is the name; what stands behind it and is neither province, department nor an earlier
    name says that the place is elsewhere.
    """
    good = [c for c in found if c[5] >= THRESHOLD and c[6] <= allowed(c[2])]
    if typed.abroad or not good:
        return NOT_FOUND, max((c[5] for c in found), default=0.0)
    pool = [c for c in good if c[3] in typed.provinces] if typed.provinces else good
    if not pool:
        return NOT_FOUND, max(c[5] for c in good)
    if typed.department:
        said = [c for c in pool if fits(typed.department, c[4].split())]
        pool = said or pool
    first = max(pool, key=rank)
    if any(k > first[0] for k in range(len(typed.parts))):
        return NOT_FOUND, first[5]
    others = [c for c in pool if c[1] != first[1] and c[0] == first[0]]
    second = max(others, key=rank, default=None)
    exact = first[6] == 0 and (second is None or second[6] > 0)
    if second is not None and not exact and rank(first)[0] - rank(second)[0] < MARGIN - 1e-9:
        return NOT_FOUND, first[5]
    return first[1], first[5]


FOUND = "valor string, provincia string, part int, id string, name string, prov string, dept string, score double, distance int, text string"


def weights_of(ref: DataFrame) -> Weights:
    """The weights of the whole list, counted where its rows are; what comes to the driver is bounded (see Weights)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: dict[tuple[str, str], int] = {}
            for text in pdf["localidad"]:
                name = plain_name(text)
                for g in grams(name):
                    rows["g", g] = rows.get(("g", g), 0) + 1
                if " " in name:
                    rows["f", name.split()[0]] = rows.get(("f", name.split()[0]), 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["kind", "word", "n"])

    counts, path = stored(ref.select("localidad").mapInPandas(count, "kind string, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n")))
    entries = ref.count()
    df = {r.word: r.n for r in counts.where("kind = 'g'").toLocalIterator()}
    usual = counts.where((F.col("kind") == "f") & (F.col("n") >= max(3, math.ceil(USUAL * entries))))
    first = {r.word: r.n for r in usual.toLocalIterator()}
    discard(ref.sparkSession, path)
    return Weights.counted(entries, df, first)


def map_to_reference(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(valor, provincia, georef_id, puntaje) of every distinct pair in values (valor, provincia).

    reference: georef_id, localidad, departamento, provincia; rows without id or name are left out. Values are made
    distinct before anything is compared, so that a value on a third of all rows costs one comparison. The list is
    worked in blocks of about REFERENCE_BLOCK entries, one after the other: the driver holds and sends one block at a time,
    workers index it, and all values pass by it; a value on several blocks is decided over what all of them found. null
    and blank values are to be left out by the caller; a value that names no entry, or more than one, gets NO_HALLADO with
    the best score there was.
    """
    spark = values.sparkSession
    ref = reference.where("georef_id is not null and localidad is not null").select("georef_id", "localidad", "departamento", "provincia").distinct()
    ref, ref_path = stored(ref)
    n = ref.count()
    blocks = max(1, -(-n // REFERENCE_BLOCK))
    marked = ref.withColumn("b", F.pmod(F.xxhash64("georef_id"), F.lit(blocks)))
    weights = spark.sparkContext.broadcast(weights_of(ref))
    known = {p: words(p) for p in sorted(folded(r[0]) for r in ref.select("provincia").where("provincia is not null").distinct().collect())}
    distinct, distinct_path = stored(values.select("valor", F.coalesce("provincia", F.lit("")).alias("provincia")).distinct())
    tasks = max(cores(spark), -(-distinct.count() // VALUES_PER_TASK))
    # values that read alike come together, so that a worker scores their spelling once
    pairs, pairs_path = stored(distinct.repartition(tasks, F.lower(F.substring(F.regexp_replace("valor", r"[^\p{L}]", ""), 1, 6))))
    whole, paths = None, [distinct_path, pairs_path, ref_path]
    for b in range(blocks):
        rows = spark.sparkContext.broadcast(sorted(tuple(r)[:4] for r in marked.where(F.col("b") == b).collect()))

        def find(batches: Iterator[pd.DataFrame], rows=rows) -> Iterator[pd.DataFrame]:
            index = Index(rows.value, weights.value)
            for pdf in batches:
                out = []
                for value, province in zip(pdf["valor"], pdf["provincia"], strict=True):
                    got = candidates(index, read(value, province, known))
                    out += [(value, province, *c) for c in got] or [(value, province, None, None, None, None, None, None, None, None)]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

        one, path = stored(pairs.mapInPandas(find, FOUND))
        rows.destroy()
        paths.append(path)
        whole = one if whole is None else whole.unionByName(one)
    listed = whole.groupBy("valor", "provincia").agg(F.collect_list(F.struct("part", "id", "name", "prov", "dept", "score", "distance", "text")).alias("found"))

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for value, province, found in zip(pdf["valor"], pdf["provincia"], pdf["found"], strict=True):
                rows = [tuple(c.values()) if isinstance(c, dict) else tuple(c) for c in found]
                out.append((value, province, *decide(read(value, province, known), [r for r in rows if r[1] is not None])))
            yield pd.DataFrame(out, columns=["valor", "provincia", "georef_id", "puntaje"])

    out, _ = stored(listed.mapInPandas(settle, "valor string, provincia string, georef_id string, puntaje double"))
    discard(spark, *paths)
    return out


def mapped(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """rows (campo, clave, valor, provincia) with georef_id and puntaje; a value on any number of rows is no hot key."""
    key = F.concat_ws("\u0001", F.col("valor"), F.coalesce("provincia", F.lit(""))).alias("__k")
    found = map_to_reference(rows, reference).select(key, "georef_id", "puntaje")
    return lookup(rows.select("*", key), found, "__k", rows=rows.count()).drop("__k")
