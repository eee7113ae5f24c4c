"""Parent-child links of unknown depth as full hierarchies, by heavy-path decomposition.

1. Climbing: every node doubles its pointer towards the top each round, so a tree of depth d takes log2(d) rounds; the
   same rounds add up subtree sizes. Nodes that no round brings to a top lie on a circle or below one.
2. Cycle separation: among those, doubling shrinks the pointers' image to exactly the nodes on circles.
3. Heavy paths: each parent's child of the largest subtree continues its chain; every other child heads a new one. At
   most log2(n) chains lie on any way to the top, so the tree of chains is flat however deep the hierarchy is.
4. Depth, root, preorder number and path of a node are those of its chain's head plus its position in the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..runtime import discard, lookup, stored
from .latest import latest

SALTS = 256


def parents(links: DataFrame, child: str, parent: str, ts: str) -> DataFrame:
    """(node, parent) of every key in either column; a child's parent is that of its newest row.

    Null and empty keys name no node; a newest row without parent makes its child a root. Of rows of the same time the
    one with the greatest hash is taken.
    """
    rows = links.select(F.col(child).alias("node"), F.nullif(F.col(parent), F.lit("")).alias("parent"), F.col(ts).alias("ts"))
    named = rows.where(F.col("node") != "")
    own = latest(named, "node", "ts", ["parent"])
    alone = rows.where(F.col("parent").isNotNull()).select(F.col("parent").alias("node"), F.lit(None).cast("string").alias("parent"))
    return own.unionByName(alone.dropDuplicates(["node"])).groupBy("node").agg(F.max("parent").alias("parent"))


def climb(start: DataFrame, sums: list[str], size: bool = False) -> tuple[DataFrame, DataFrame]:
    """Double the pointers of (node, ptr, *sums) until every node knows its top and the sums on its way there.

    Returns (reached: node, top, *sums[, size]) and (rest: node; those that lead into a circle). size is the number of
    nodes at or below the node.

    Only nodes that have not reached their top are moved and written again; they are joined to where their pointer stands
    by an inner join, of which the side that shrinks may be broadcast. A node that has reached its top keeps its row, and
    what is found below it later is added in the end.
    """
    spark = start.sparkSession
    cols = ["node", "ptr", "top", *sums, *(["size"] if size else [])]
    one = [F.lit(1).cast("long").alias("size")] if size else []
    top = F.when(F.col("ptr").isNull(), F.col("node")).alias("top")
    state, path = stored(start.select("node", "ptr", top, *[F.col(s).cast("long").alias(s) for s in sums], *one))
    reached, active, paths = state.where(F.col("ptr").isNull()), state.where(F.col("ptr").isNotNull()), [path]
    later: DataFrame | None = None
    before, n = -1, active.count()
    while n not in (0, before):
        before = n
        where = reached.unionByName(active)
        above = where.select(F.col("node").alias("ptr"), F.col("ptr").alias("__p"), F.col("top").alias("__t"), *[F.col(s).alias(f"__{s}") for s in sums])
        moved = lookup(active, above, "ptr", how="inner", rows=n).select(
            "node", F.col("__p").alias("ptr"), F.col("__t").alias("top"), *[(F.col(s) + F.col(f"__{s}")).alias(s) for s in sums], *(["size"] if size else []),
        )
        if size:
            below = active.groupBy(F.col("ptr").alias("node")).agg(F.sum("size").alias("__add"))
            moved = moved.join(below, "node", "left").withColumn("size", F.col("size") + F.coalesce("__add", F.lit(0))).drop("__add")
            settled = below.join(active.select("node"), "node", "left_anti")
            later = settled if later is None else later.unionByName(settled)
        seen = Observation()
        state, path = stored(moved.select(*cols).observe(seen, F.count("ptr").alias("n")))
        paths.append(path)
        reached, active = reached.unionByName(state.where(F.col("ptr").isNull())), state.where(F.col("ptr").isNotNull())
        n = seen.get["n"]
    done = reached.drop("ptr")
    if later is not None:
        added = later.groupBy("node").agg(F.sum("__add").alias("__add"))
        done = done.join(added, "node", "left").withColumn("size", F.col("size") + F.coalesce("__add", F.lit(0))).drop("__add")
    out, _ = stored(done)
    rest, _ = stored(active.select("node"))
    discard(spark, *paths)
    return out, rest


def circles(links: DataFrame) -> DataFrame:
    """Of nodes (node, parent) that all lead into circles: (node, root_key, depth).

    depth is -1 on a circle and -2 below one; root_key is the smallest key on the circle.
    """
    spark = links.sparkSession
    state, path = stored(links.select("node", F.col("parent").alias("ptr"), F.col("node").alias("low")))
    total = state.count()
    image, changed, first = -1, True, True
    while True:
        now = state.select("ptr").distinct()
        n = now.count()
        if n == 0 or (n == image and not changed and not first):
            break
        onward = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("__p"), F.col("low").alias("__low"))
        new = lookup(state, onward, "ptr", rows=total).select(
            "node", F.col("__p").alias("ptr"), F.least("low", "__low").alias("low"), (F.col("__low") < F.col("low")).alias("__fell")
        )
        old = path
        state, path = stored(new)
        on_circle = state.join(state.select(F.col("ptr").alias("node")).distinct(), "node", "left_semi")
        changed = bool(on_circle.where("__fell").take(1))
        state = state.drop("__fell")
        first, image = False, n
        discard(spark, old)
    on = state.select(F.col("ptr").alias("node")).distinct().join(state, "node").select("node", F.col("low").alias("root_key"))
    rest = state.join(on.select("node"), "node", "left_anti")
    below = lookup(rest.select("node", "ptr"), on.select(F.col("node").alias("ptr"), "root_key"), "ptr", rows=total)
    return on.withColumn("depth", F.lit(-1)).unionByName(below.select("node", "root_key").withColumn("depth", F.lit(-2)))


def chains(tree: DataFrame) -> DataFrame:
    """Heavy-path labels of a forest (node, parent, size): adds head (the top of the node's chain) and pos (its position)."""
    child = tree.where(F.col("parent").isNotNull())
    heavy = child.groupBy("parent").agg(F.max_by("node", F.struct("size", "node")).alias("node"), F.max("size").alias("heavy_size"))
    marked = tree.join(heavy.select("node", F.col("parent").alias("__up")), "node", "left")
    heads, _ = climb(marked.select("node", F.col("__up").alias("ptr"), F.when(F.col("__up").isNull(), 0).otherwise(1).alias("pos")), ["pos"])
    return tree.join(heads.select("node", F.col("top").alias("head"), "pos"), "node").join(
        heavy.select(F.col("parent").alias("node"), "heavy_size"), "node", "left"
    )


def light_offsets(labelled: DataFrame) -> DataFrame:
    """(head, before) of every chain that hangs below another: the nodes under earlier light siblings.

    Siblings are ordered by (salt, key), and sums run per salt first, so that a parent of any number of children is
    never one task's window.
    """
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    light = labelled.where((F.col("head") == F.col("node")) & F.col("parent").isNotNull()).select("node", "parent", "size", salt.alias("salt"))
    per = light.groupBy("parent", "salt").agg(F.sum("size").alias("total"))
    above = per.withColumn(
        "base", F.coalesce(F.sum("total").over(Window.partitionBy("parent").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("parent", "salt", "base")
    inside = Window.partitionBy("parent", "salt").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    own = light.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return own.join(above, ["parent", "salt"]).select(F.col("node").alias("head"), (F.col("base") + F.col("own")).alias("before"))


def hierarchy(links: DataFrame, child: str, parent: str, ts: str, intervals: bool = True) -> tuple[DataFrame, DataFrame]:
    """(nodes, cyclic) of parent-child rows.

    nodes: node, parent, root_key, depth, size (nodes at or below), head, pos, level and, with intervals, pre (preorder
    number within the root's tree: the descendants of a node are those of its root with pre in (pre, pre + size)). cyclic:
    node, root_key, depth (-1 on a circle, -2 leading up into one; root_key is then the smallest key on it). Empty input
    gives empty tables; a key that is its own parent is a circle of one.
    """
    base, base_path = stored(parents(links, child, parent, ts))
    reached, rest = climb(base.select("node", F.col("parent").alias("ptr")), [], size=True)
    cyclic = circles(base.join(rest, "node", "left_semi")) if rest.take(1) else base.limit(0).select("node", F.col("node").alias("root_key"), F.lit(-1).alias("depth"))
    total = base.count()
    tree, tree_path = stored(base.join(reached.select("node", "size"), "node"))
    labelled, _ = stored(chains(tree))
    heads = labelled.where(F.col("head") == F.col("node"))
    roots = heads.where(F.col("parent").isNull()).select("node", F.lit(None).cast("string").alias("ptr"), F.lit(0).alias("depth"), F.lit(0).alias("pre"), F.lit(0).alias("level"))
    up = labelled.select(F.col("node").alias("parent"), F.col("head").alias("up_head"), F.col("pos").alias("up_pos"), F.col("heavy_size").alias("up_heavy"))
    # roots have no parent: they are kept out of the join, where their nulls would meet in one task
    hung = lookup(heads.where(F.col("parent").isNotNull()).select("head", "parent"), up, "parent", how="inner", rows=total)
    sums = ["depth", "pre", "level"] if intervals else ["depth", "level"]
    pre = F.lit(0)
    if intervals:
        hung = hung.join(light_offsets(labelled), "head", "left")
        pre = F.col("up_pos") + 1 + F.col("up_heavy") + F.col("before")
    below = hung.select(F.col("head").alias("node"), F.col("up_head").alias("ptr"), (F.col("up_pos") + 1).alias("depth"), pre.alias("pre"), F.lit(1).alias("level"))
    resolved, _ = climb(roots.unionByName(below).select("node", "ptr", *sums), sums)
    number = [F.col("pre").alias("h_pre")] if intervals else []
    by_head = resolved.select(F.col("node").alias("head"), F.col("top").alias("root_key"), F.col("depth").alias("h_depth"), "level", *number)
    nodes = lookup(labelled, by_head, "head", rows=total).select(
        "node", "parent", "root_key", (F.col("h_depth") + F.col("pos")).cast("int").alias("depth"), "size", "head",
        "pos", *([(F.col("h_pre") + F.col("pos")).alias("pre")] if intervals else []), F.col("level").cast("int").alias("level"),
    )
    discard(base.sparkSession, tree_path)
    return nodes, cyclic


def paths(nodes: DataFrame, separator: str = " > ", length: int = 1024) -> DataFrame:
    """Add `path`, the keys from the root down to the node, by joining chain segments.

    Chains are cut into segments of `length` nodes. A segment's prefix is its chain's prefix and the chain's segments
    before it; a chain's prefix is that of the segment it hangs from and that segment's part above the fork. Chains are
    taken level by level in the tree of chains (at most log2(n) levels), so that a row holds one segment and one prefix,
    and no chain is ever gathered as a whole but in the texts that end with it.
    """
    spark = nodes.sparkSession
    nodes, _ = stored(nodes)
    number = lambda c: F.floor(F.col(c) / length).cast("int")
    member = F.array_sort(F.collect_list(F.struct("pos", "node")))
    segments, _ = stored(
        nodes.groupBy("head", number("pos").alias("s")).agg(member.alias("m"), F.max("level").alias("level"), F.max(F.when(F.col("node") == F.col("head"), F.col("parent"))).alias("up"))
        .select("head", "s", "level", "up", F.col("m.node").alias("seg"))
    )
    deepest = segments.agg(F.max("level")).collect()[0][0]
    if deepest is None:
        return nodes.withColumn("path", F.lit(None).cast("string"))
    place = nodes.select(F.col("node").alias("up"), F.col("head").alias("up_head"), number("pos").alias("up_s"), (F.col("pos") % length + 1).cast("int").alias("up_n"))
    earlier = Window.partitionBy("head").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    text = segments.withColumn("before", F.array_join(F.collect_list(F.array_join("seg", separator)).over(earlier), separator))
    parts: list[DataFrame] = []
    for level in range(deepest + 1):
        here = text.where(F.col("level") == level)
        if level:
            firsts = segments.where((F.col("level") == level) & (F.col("s") == 0)).select("head", "up")
            last = parts[-1].select(F.col("head").alias("up_head"), F.col("s").alias("up_s"), F.col("seg").alias("up_seg"), F.col("prefix").alias("up_prefix"))
            hung = lookup(firsts, place, "up", how="inner", rows=firsts.count()).join(last, ["up_head", "up_s"])
            own = hung.select("head", F.concat_ws(separator, F.nullif("up_prefix", F.lit("")), F.array_join(F.slice("up_seg", F.lit(1), F.col("up_n")), separator)).alias("own"))
            here = here.join(own, "head")
        else:
            here = here.withColumn("own", F.lit(""))
        made, _ = stored(here.select("head", "s", "seg", F.concat_ws(separator, F.nullif("own", F.lit("")), F.nullif("before", F.lit(""))).alias("prefix")))
        parts.append(made)
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    one = whole.select("prefix", "seg", F.posexplode("seg").alias("k", "node"))
    path = F.concat_ws(separator, F.nullif("prefix", F.lit("")), F.array_join(F.slice("seg", F.lit(1), F.col("k") + 1), separator))
    return nodes.join(one.select("node", path.alias("path")), "node")


def descendants(nodes: DataFrame, of: DataFrame) -> DataFrame:
    """(ancestor, node) of every descendant of the keys in `of` (column node), by their preorder intervals.

    The intervals are cut at blocks of preorder numbers and joined by (root, block), an equality that hashes evenly.
    """
    width = 1024
    span = of.select("node").distinct().join(nodes, "node").where("size > 1").select(
        F.col("node").alias("ancestor"), "root_key", F.col("pre").alias("lo"), (F.col("pre") + F.col("size")).alias("hi"),
        F.explode(F.sequence(F.floor((F.col("pre") + 1) / width), F.floor((F.col("pre") + F.col("size") - 1) / width))).alias("block"),
    )
    at = nodes.select("node", "root_key", "pre", F.floor(F.col("pre") / width).alias("block"))
    return at.join(span, ["root_key", "block"]).where("pre > lo and pre < hi").select("ancestor", "node")
