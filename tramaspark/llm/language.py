"""Languages of documents and of their lines by cross-parsing entropy.

A language is a suffix automaton of labelled text. Reading a line greedily, the automaton cuts it into the longest
phrases that occur in that text; phrases * log2(length of the labelled text) is the number of bits the line costs in
that language, and the cheapest language wins. The automata are flattened into one transition table, and all lines of
a batch go through all languages at once, one character per step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import folded, mended

#: The languages told apart, each with the codes and names it goes by, lower case and without accents.
NAMES = {
    "es": "es spa esp espanol castellano spanish castilian espagnol spanisch spagnolo espanhol espanyol castella",
    "pt": "pt por portugues portuguese portugais portugiesisch portoghese",
    "it": "it ita italiano italian italien italienisch italia",
    "fr": "fr fra fre francais frances french franzosisch francese",
    "en": "en eng ingles english anglais englisch inglese angles",
    "de": "de deu ger deutsch aleman german allemand tedesco alemao alemany",
    "ca": "ca cat catala catalan katalanisch catalano catalao",
}
LANGS = sorted(NAMES)
BY_NAME = {name: code for code, names in NAMES.items() for name in names.split()}
SYMBOLS = 32  # 26 letters, space, apostrophe, digits, other marks, other letters, end of line
PIECE = 1024
STATE_BITS = 40
#: A line whose two cheapest languages are closer than this many bits says too little by itself.
DECISIVE_BITS = 24.0


def named_language(label: str | None) -> str | None:
    """The language a label names by code, name or code with region, or None if it names none of LANGS."""
    words = re.split(r"[^a-z]+", folded(label or "").strip(" ()[]"))
    known = [BY_NAME[w] for w in words[:1] if w in BY_NAME]
    return known[0] if known else None


def _symbols() -> np.ndarray:
    table = np.full(0x10000, 30, dtype=np.int64)
    for code in range(0x10000):
        c = chr(code)
        base = folded(c)[:1] if 0xD800 > code or code > 0xDFFF else ""
        if "a" <= base <= "z":
            table[code] = ord(base) - 97
        elif c.isspace():
            table[code] = 26
        elif c in "'’‘´`":
            table[code] = 27
        elif c.isdigit():
            table[code] = 28
        elif not c.isalpha():
            table[code] = 29
    return table


TABLE = _symbols()
def encode(text: str) -> np.ndarray:
    """The text's symbols, runs of spaces as one."""
    points = np.frombuffer(mended(text).encode("utf-32-le", "replace"), dtype="<u4")
    s = TABLE[np.minimum(points, 0xFFFF)]
    if len(s) > 1:
        s = s[np.concatenate([[True], ~((s[1:] == 26) & (s[:-1] == 26))])]
    return s


class SuffixAutomaton:
    """Built online: moves holds the transitions of every state, of which 0 is the start."""

    def __init__(self) -> None:
        self.moves: list[dict[int, int]] = [{}]
        self.link, self.length, self.last, self.size = [-1], [0], 0, 0

    def extend(self, symbols: list[int]) -> None:
        moves, link, length = self.moves, self.link, self.length
        for c in symbols:
            new = len(moves)
            moves.append({})
            length.append(length[self.last] + 1)
            link.append(0)
            p = self.last
            while p != -1 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p != -1:
                q = moves[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            self.last = new
        self.size += len(symbols)

    def phrases(self, symbols: list[int]) -> int:
        n, at, moves = 1, 0, self.moves
        for c in symbols:
            to = moves[at].get(c)
            if to is None:
                n += 1
                to = moves[0].get(c, 0)
            at = to
        return n


@dataclass
class Model:
    """One table for all languages: next state (times SYMBOLS), and 2**STATE_BITS where a new phrase begins."""

    langs: list[str]
    table: np.ndarray
    starts: np.ndarray
    bits: np.ndarray

    def phrases(self, lines: list[np.ndarray]) -> np.ndarray:
        """Phrases of every line in every language."""
        out = np.zeros((len(lines), len(self.langs)), dtype=np.int64)
        owner, pieces = [], []
        for i, s in enumerate(lines):
            for at in range(0, len(s), PIECE):
                owner.append(i)
                pieces.append(s[at : at + PIECE])
        step = 4096
        order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
        owners = np.array(owner, dtype=np.int64)
        for at in range(0, len(order), step):
            part = order[at : at + step]
            got = self._run([pieces[k] for k in part])
            np.add.at(out, owners[part], got)
        return out

    def _run(self, pieces: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(p) for p in pieces])
        grid = np.zeros((int(lengths[0]), len(pieces)), dtype=np.int64)
        for k, p in enumerate(pieces):
            grid[: len(p), k] = p
        state = np.repeat(self.starts[None, :], len(pieces), axis=0)
        total = np.zeros_like(state)
        value = np.empty_like(state)
        mask = (1 << STATE_BITS) - 1
        ends = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        for t, k in enumerate(ends.tolist()):
            s, v = state[:k], value[:k]
            s += grid[t, :k, None]
            np.take(self.table, s, out=v, mode="clip")
            total[:k] += v
            np.bitwise_and(v, mask, out=s)
        return (total >> STATE_BITS) + 1

    def costs(self, lines: list[np.ndarray]) -> np.ndarray:
        """Bits of every line in every language."""
        return self.phrases(lines) * self.bits[None, :]


END = 31
#: A line of which the text so far covers phrases of more than this many symbols on average teaches nothing new.
COVERED = 9


def learn(lines: list[np.ndarray], most: int, novel: bool) -> SuffixAutomaton:
    """The automaton of the lines in their order, up to `most` symbols; with novel, without the lines it covers already."""
    made = SuffixAutomaton()
    for line in lines:
        if made.size >= most:
            break
        symbols = line.tolist()
        if novel and made.size and len(symbols) > COVERED * made.phrases(symbols):
            continue
        made.extend([*symbols, END])
    return made


def build(by: dict[str, list[np.ndarray]], most: int, novel: bool) -> Model:
    langs = sorted(by)
    parts, starts, sizes, base = [], [], [], 0
    for lang in langs:
        made = learn(by[lang], most, novel)
        n = len(made.moves)
        t = np.zeros((n, SYMBOLS), dtype=np.int64)
        first = np.full(SYMBOLS, base * SYMBOLS, dtype=np.int64)
        for c, to in made.moves[0].items():
            first[c] = (base + to) * SYMBOLS
        t[:] = first + (1 << STATE_BITS)
        for i, m in enumerate(made.moves):
            for c, to in m.items():
                t[i, c] = (base + to) * SYMBOLS
        parts.append(t.ravel())
        starts.append(base * SYMBOLS)
        sizes.append(max(2, made.size))
        base += n
    return Model(langs, np.concatenate(parts), np.array(starts, dtype=np.int64), np.log2(np.array(sizes, dtype=float)))


def _by_language(rows: list[tuple[int, str, np.ndarray]]) -> dict[str, list[np.ndarray]]:
    by: dict[str, list[np.ndarray]] = {}
    for _, lang, s in rows:
        by.setdefault(lang, []).append(s)
    return by


def fit(rows: list[tuple[int, str, str]], sample_chars: int) -> Model | None:
    """A model from (document, language, line), of which some labels are wrong.

    Two folds by document judge each other's lines. Only documents of which every decided line is confirmed by the other
    fold are learnt, so that neither a mislabelled document nor the foreign lines of a mixed one teach their language to
    another's automaton. The second pass repeats this with the cleaner folds.
    """
    everything = [(doc, lang, encode(line)) for doc, lang, line in rows]
    kept = everything
    for novel in (False, True):
        impure: set[int] = set()
        for fold in (0, 1):
            by = _by_language([r for r in kept if r[0] % 2 == fold])
            others = [r for r in everything if r[0] % 2 != fold]
            if len(by) < 2 or not others:
                continue
            model = build(by, sample_chars, novel)
            cost = model.costs([s for _, _, s in others])
            at = {lang: k for k, lang in enumerate(model.langs)}
            for (doc, lang, _), c in zip(others, cost, strict=True):
                if lang in at and c[at[lang]] > c.min() + DECISIVE_BITS / 4:
                    impure.add(doc)
        kept = [r for r in everything if r[0] not in impure]
        for lang in {r[1] for r in everything} - {r[1] for r in kept}:
            kept += [r for r in everything if r[1] == lang]
    return build(_by_language(kept), sample_chars, True) if kept else None


def segments(text: str | None) -> list[str]:
    return [line for line in (text or "").split("\n") if line.strip()]


def judge(model: Model, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, int, float]]:
    """By document: languages (index) and confidence of its segments, the document's language (-1: no text) and confidence.

    A segment whose evidence is under DECISIVE_BITS takes, of the languages its document's decided segments have, the
    cheapest; with none decided, the document's cheapest overall.
    """
    lines: list[np.ndarray] = []
    spans = []
    for text in texts:
        own = [encode(x) for x in segments(text)]
        spans.append((len(lines), len(lines) + len(own)))
        lines += own
    cost = model.costs(lines) if lines else np.zeros((0, len(model.langs)))
    out = []
    for a, b in spans:
        c = cost[a:b]
        if not len(c):
            out.append((np.array([], int), np.array([]), -1, 0.0))
            continue
        order = np.sort(c, axis=1)
        margin = order[:, 1] - order[:, 0] if c.shape[1] > 1 else np.full(len(c), np.inf)
        best = c.argmin(axis=1)
        whole = c.sum(axis=0)
        sure = margin >= DECISIVE_BITS
        allowed = np.unique(best[sure]) if sure.any() else np.array([int(whole.argmin())])
        for i in np.nonzero(~sure)[0]:
            best[i] = allowed[(c[i, allowed] + whole[allowed] * 1e-9).argmin()]
        rest = np.array([np.delete(c[i], best[i]).min() - c[i, best[i]] if c.shape[1] > 1 else 0.0 for i in range(len(c))])
        confidence = 1 / (1 + np.exp2(-np.clip(rest / 24, -40, 40)))
        sizes = np.array([len(x) for x in lines[a:b]])
        share = np.bincount(best, weights=sizes, minlength=c.shape[1])
        main = int(share.argmax())
        out.append((best, confidence, main, float((confidence * sizes)[best == main].sum() / max(1, sizes.sum()))))
    return out


def sample(documents: DataFrame, most_docs: int = 200, most_lines: int = 16) -> list[tuple[int, str, str]]:
    """(document, language, line) of at most about most_docs labelled documents a language, by hash of doc_id.

    Each gives at most most_lines of its lines of 40 to 1,000 characters, those of smallest hash. The sample is bounded whatever the corpus;
    labels are resolved on the driver by their distinct spellings' counts, of which only those that name a language matter.
    """
    label = F.lower(F.trim(F.regexp_extract(F.coalesce("lang", F.lit("")), r"^\s*([^-_\s]{0,24})", 1)))
    known = [w for n in NAMES.values() for w in n.split()]
    plain = F.translate(label, "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    labelled = documents.withColumn("__l", plain).where(F.col("__l").isin(known) & F.col("doc_id").isNotNull())
    counts: dict[str, int] = {}
    for r in labelled.groupBy("__l").count().collect():
        counts[BY_NAME[r["__l"]]] = counts.get(BY_NAME[r["__l"]], 0) + r["count"]
    if not counts:
        return []
    share = F.create_map(*[x for name, code in BY_NAME.items() if code in counts for x in (F.lit(name), F.lit(min(1.0, most_docs / counts[code])))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    chosen = labelled.where(draw < F.element_at(share, F.col("__l")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x).between(40, 1000))
    drawn = F.slice(F.array_sort(F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x")))), 1, most_lines)
    rows = chosen.select("doc_id", "__l", F.explode(drawn).alias("s")).select("doc_id", "__l", "s.h", "s.x").collect()
    rows.sort(key=lambda r: (r["h"], r["doc_id"]))
    return [(r["doc_id"], BY_NAME[r["__l"]], r["x"]) for r in rows]


def languages(documents: DataFrame, sample_chars: int = 24_000, only_doubtful: bool = False, per_document: bool = False) -> DataFrame:
    """Every segment (doc_id, segmento, lang, confianza), or with per_document every document (doc_id, etiqueta, lang, confianza, mixto).

    Segments are the non-blank lines, numbered from 0. Documents without text give no segment and the language null;
    with no usable label in the whole corpus nothing can be learnt, and the result is empty. only_doubtful keeps the
    segments of documents whose label is missing, meaningless or not their language, or which mix languages. The model is
    fitted on a bounded sample (see sample; sample_chars symbols a language at most) and everything else covers whole
    texts, without any shuffle.
    """
    spark = documents.sparkSession
    schema = "doc_id long, etiqueta string, lang string, confianza double, mixto boolean" if per_document else "doc_id long, segmento int, lang string, confianza double"
    model = fit(sample(documents), sample_chars)
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        names = np.array(m.langs, dtype=object)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                pdf = whole.iloc[at : at + 1000]
                ids, labels = pdf["doc_id"].tolist(), pdf["lang"].tolist()
                got = judge(m, pdf["text"].tolist())
                rows: list[tuple] = []
                for doc, label, (best, confidence, main, sure) in zip(ids, labels, got, strict=True):
                    mixed = len(np.unique(best)) > 1
                    if per_document:
                        rows.append((doc, label, names[main] if main >= 0 else None, sure, mixed))
                    elif not only_doubtful or mixed or (main >= 0 and named_language(label) != names[main]):
                        rows += [(doc, k, names[x], float(y)) for k, (x, y) in enumerate(zip(best, confidence, strict=True))]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return documents.select("doc_id", "text", "lang").mapInPandas(run, schema)
