"""Variant spellings of personal names: phonetic blocks, Jaro-Winkler with nicknames, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, combinations, product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import discard, lookup, stored
from .groups import components
from .persons import LONG_CODE, Form, block_keys, code, compare, from_form, givens, known, letters, neighbours, parse

#: A block of more forms, and a group of more records, is worked as pairs of sub-blocks of so many.
BLOCK = 1500
#: The couples of a block of no more are tried one by one.
FEW = 1000


def forms(records: DataFrame) -> DataFrame:
    """(clave, form) of records (clave, nombre): names with their readings; unreadable ones drop out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"clave": pdf["clave"], "form": [parse(x) for x in pdf["nombre"]]})

    return records.mapInPandas(run, "clave string, form string").where("form is not null")


Row = tuple[str, str, Form]


def _same_first(a: Form, b: Form) -> bool:
    return len(a) == len(b) == 1 and a[0].family[:1] == b[0].family[:1]


def _pairs(couples: Iterable[tuple[Row, Row]]) -> Iterator[tuple]:
    """Accepted pairs of rows (form, kind, readings)."""
    for (fa, kind, a), (fb, _, b) in couples:
        if kind == "d" and _same_first(a, b):
            continue  # found in the block of the whole code
        score, whole = compare(a, b)
        if score:
            yield (fa, fb, whole, known(a), known(b), score)


def couples(left: list[Row], right: list[Row] | None = None) -> Iterable[tuple[Row, Row]]:
    """Every pair of one sub-block, or of one with another, once."""
    return combinations(left, 2) if right is None else product(left, right)


@lru_cache(200_000)
def _sounds(word: str) -> tuple[str, int, int]:
    return code(word)[:LONG_CODE], letters(word), neighbours(word)


def _family(form: Form) -> tuple[str, int, int] | None:
    """The first family name's code and bits; None if it is open which it is."""
    return _sounds(form[0].family[0]) if len(form) == 1 and form[0].family else None


def _apart(x: tuple[str, int, int] | None, y: tuple[str, int, int] | None) -> bool:
    """Whether two family names that share all sounds but one are more than two slips apart, or met in the block of the whole code."""
    return bool(x and y) and (x[0] == y[0] or (x[1] ^ y[1]).bit_count() > 4 or (x[2] ^ y[2]).bit_count() > 12)


def _listed(form: Form, sound: str) -> list[str] | None:
    """The listed given names with a first sound that a form names; None if any of its words may stand for others as well."""
    if len(form) > 1 or any(len(g) == 1 or not givens(g) for g in form[0].given):
        return None
    return [n for n in frozenset().union(*map(givens, form[0].given)) if n[0] == sound]


def likely(key: str, left: list[Row], right: list[Row] | None = None) -> Iterator[tuple[Row, Row]]:
    """Those couples of a block, or of two sub-blocks, that can be accepted and have not met in another block.

    Where a sound is left out, the family names must be within two slips, which bits of their letters tell mostly. In a
    block of more than FEW couples, names of listed given words alone must share one of these with the block's first sound:
    such couples are looked up and not tried one by one, for the block of a common sound grows with its bearers' square.
    """
    kind, sound = key.split(":", 2)[:2]
    other = left if right is None else right
    family = [_family(r[2]) if kind == "d" else None for r in other]
    by: dict[str, list[int]] = {}
    few = len(left) * len(other) <= FEW
    open_ones = []
    for j, r in enumerate(() if few else other):
        names = _listed(r[2], sound)
        if names is None:
            open_ones.append(j)
        for n in names or ():
            by.setdefault(n, []).append(j)
    for i, row in enumerate(left):
        own = None if few else _listed(row[2], sound)
        first = i + 1 if right is None else 0
        found = range(first, len(other)) if own is None else {*open_ones, *chain.from_iterable(by.get(n, ()) for n in own)}
        mine = family[i] if right is None else _family(row[2]) if kind == "d" else None
        for j in found:
            if j >= first and not _apart(mine, family[j]):
                yield row, other[j]


def name_pairs(names: DataFrame) -> DataFrame:
    """(form_a, form_b, whole, known_a, known_b, score) of all pairs of different forms that can name one person.

    names: form, distinct. Blocks are keyed by the phonetic code of one word (and its one-sound deletions) with the first
    sound of another, whatever their order (persons.block_keys). A block of more than BLOCK forms is worked as pairs of sub-blocks of BLOCK, spread over
    tasks: all its pairs that can be accepted are compared (likely), and only accepted ones leave a task.
    """
    key_type = "form string, key string, kind string"

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(f, k, kind) for f in pdf["form"] for k, kind in block_keys(from_form(f))]
            yield pd.DataFrame(rows, columns=["form", "key", "kind"])

    keyed, keyed_path = stored(names.mapInPandas(keys, key_type).distinct())
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized, sized_path = stored(sizes.withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")))
    rows = lookup(keyed, sized.select("key", "parts"), "key", how="inner", rows=keyed.count())
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("form"), F.col("parts"))).otherwise(0).cast("int")
    spread = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other"))
    tasks = max(8, -(-sized.agg(F.coalesce(F.sum(F.col("n") * F.col("parts")), F.lit(0))).collect()[0][0] // 40_000))
    placed = spread.select("form", "kind", "part", F.concat_ws("/", "key", "x", "y").alias("cell")).repartition(tasks, "cell").sortWithinPartitions("cell")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []

        def settle() -> list[tuple]:
            if len(held) < 2:
                return []
            x, y = map(int, cell.rsplit("/", 2)[1:])
            part = lambda n: [(f, k, from_form(f)) for f, k, p in held if p == n]
            return list(_pairs(likely(cell, part(x), None if x == y else part(y))))

        out: list[tuple] = []
        for pdf in batches:
            for form, kind, part_no, c in zip(pdf["form"], pdf["kind"], pdf["part"], pdf["cell"], strict=True):
                if c != cell:
                    out += settle()
                    cell, held = c, []
                held.append((form, kind, part_no))
            yield _frame(out)
            out = []
        out += settle()
        yield _frame(out)

    made = placed.mapInPandas(work, "form_a string, form_b string, whole boolean, known_a int, known_b int, score double")
    turn = F.col("form_a") > F.col("form_b")
    pick = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    out, _ = stored(
        made.select(
            pick("form_a", "form_b").alias("form_a"), pick("form_b", "form_a").alias("form_b"), "whole",
            pick("known_a", "known_b").alias("known_a"), pick("known_b", "known_a").alias("known_b"), "score",
        ).dropDuplicates(["form_a", "form_b"])
    )
    discard(names.sparkSession, keyed_path, sized_path)
    return out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["form_a", "form_b", "whole", "known_a", "known_b", "score"])


def clusters(names: DataFrame) -> DataFrame:
    """(form, group_key): forms that name one person.

    Forms of which every word has its counterpart are connected first. Then a component joins the fuller one that its
    forms can be, if these are one and the same (of two equally full ones, the one of the greater form joins the other),
    until none moves: fuller ones that were several persons may have become one. Where a short name fits several persons
    to the end it stays by itself. The order does not matter: a component that has joined brings no further edges along,
    and joining others never makes one fuller component into two.
    """
    names, names_path = stored(names.select("form").distinct())
    pairs = name_pairs(names)
    whole = components(pairs.where("whole"), F.col("form_a"), F.col("form_b"))
    label, label_path = stored(names.join(whole.withColumnRenamed("record_key", "form"), "form", "left").select("form", F.coalesce("group_key", "form").alias("root")))
    partial = pairs.where(~F.col("whole"))
    up = F.col("known_a") < F.col("known_b")
    weak = partial.select(
        F.when(up, F.col("form_a")).otherwise(F.col("form_b")).alias("less"), F.when(up, F.col("form_b")).otherwise(F.col("form_a")).alias("more")
    )
    own = label.select(F.col("form").alias("less"), F.col("root").alias("own"))
    above = label.select(F.col("form").alias("more"), F.col("root").alias("up"))
    n = pairs.count()
    edge, path = stored(lookup(lookup(weak, own, "less", rows=n), above, "more", rows=n).where("own != up").select("own", "up").distinct())
    while True:
        parent = edge.groupBy("own").agg(F.min("up").alias("up"), F.max("up").alias("__last")).where(F.col("up") == F.col("__last")).select("own", "up")
        if not parent.take(1):
            break
        joined, joined_path = stored(components(parent, F.col("own"), F.col("up")))
        to = lambda c: joined.select(F.col("record_key").alias(c), F.col("group_key").alias("__to"))  # noqa: E731, B023
        follow = lambda df, c: lookup(df, to(c), c, rows=df.count()).withColumn(c, F.coalesce("__to", c)).drop("__to")  # noqa: E731, B023
        old, old_label = path, label_path
        label, label_path = stored(follow(label, "root").select("form", "root"))
        edge, path = stored(follow(follow(edge, "own"), "up").where("own != up").select("own", "up").distinct())
        discard(edge.sparkSession, old, old_label, joined_path)
    discard(label.sparkSession, path, names_path)
    return label.withColumnRenamed("root", "group_key")


def members(records: DataFrame) -> DataFrame:
    """(clave, group_key) of records (clave unique, nombre) with a readable name: one row per record with its group."""
    named, _ = stored(forms(records))
    groups = clusters(named.select("form").distinct())
    return lookup(named, groups, "form", rows=named.count()).select("clave", "group_key")


def linked_pairs(records: DataFrame) -> DataFrame:
    """(clave_a, clave_b), clave_a < clave_b, of records (clave unique, nombre) that name one person.

    Records without a readable name link to nothing; equal names link their records. The pairs of a group of more than
    BLOCK records are made as pairs of sub-blocks, spread over tasks.
    """
    member, _ = stored(members(records))
    sizes = member.groupBy("group_key").count().where("count > 1")
    parts, _ = stored(sizes.select("group_key", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")))
    several = lookup(member, parts, "group_key", how="inner", rows=member.count())
    own = F.pmod(F.xxhash64("clave"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = several.select("group_key", own.alias("x"), every.alias("y"), F.col("clave").alias("clave_a"))
    b = several.select("group_key", every.alias("x"), own.alias("y"), F.col("clave").alias("clave_b"))
    return a.join(b, ["group_key", "x", "y"]).where("clave_a < clave_b").select("clave_a", "clave_b")
