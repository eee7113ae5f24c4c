"""Points near other points, and the regions that hold them.

Radius joins: a Voronoi partition around pivots, with the triangle inequality deciding which points a neighbouring cell
needs as well, then vantage-point trees over each cell with the great-circle metric. The result is complete.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M = 6371.0088 * 1000
LEAF = 24
#: Regions with more edges over all tiles (32 bytes each) are not broadcast; points of a tile are then spread over so many tasks.
FEW_EDGES = 500_000
SALTS = 32


def degrees(c: Column) -> Column:
    """Degrees from text in any usual notation, null if unreadable.

    Decimal point or comma, sign or hemisphere letter (N S E W, O for oeste) before or after, degree sign, exponents,
    and degrees-minutes[-seconds] with the usual marks, colons or spaces.
    """
    return F.get(F.transform(F.array(c), _degrees), 0)


def _degrees(raw: Column) -> Column:
    clean = F.upper(F.trim(F.regexp_replace(raw, r"(?U)[\s ]+", " ")))
    clean = F.translate(clean, "−–º˚′’´″”“,", "--°°\'\'\'\"\"\".")
    clean = F.regexp_replace(clean, "\'\'", '"')
    for word, letter in (("NORTE", "N"), ("SUR", "S"), ("OESTE", "W"), ("ESTE", "E")):
        clean = F.regexp_replace(clean, word, letter)
    # the cleaned text is bound once by a lambda: inlined into each use it would outgrow generated code
    return F.get(F.transform(F.array(clean), _read_degrees), 0)


def _read_degrees(s: Column) -> Column:
    decimal = r"^([NSEWO])? ?([+-]?) ?(\d+(?:\.\d*)?|\.\d+)(E[+-]?\d+)? ?°? ?([NSEWO])?$"
    parts = r"^([NSEWO])? ?([+-]?) ?(\d+) ?[°: ] ?(\d+(?:\.\d+)?) ?(?:[\': ] ?(?:(\d+(?:\.\d+)?) ?\"?)?)? ?([NSEWO])?$"
    west = lambda pattern, last: F.concat(F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, last)).rlike("[SWO]") | (F.regexp_extract(s, pattern, 2) == "-")
    number = lambda pattern, i: F.coalesce(F.regexp_extract(s, pattern, i).try_cast("double"), F.lit(0.0))
    plain = F.concat(F.regexp_extract(s, decimal, 3), F.regexp_extract(s, decimal, 4)).try_cast("double")
    dms = number(parts, 3) + number(parts, 4) / 60 + number(parts, 5) / 3600
    fits = (number(parts, 4) < 60) & (number(parts, 5) < 60)
    return F.when(s.rlike(decimal), F.when(west(decimal, 5), -plain).otherwise(plain)).when(
        s.rlike(parts) & fits, F.when(west(parts, 6), -dms).otherwise(dms)
    )


def located(df: DataFrame, key: Column, lat: Column, lon: Column) -> DataFrame:
    """(key, lat, lon) of the rows that name a point: null, not-a-number, |lat| > 90, |lon| > 180 and exactly 0, 0 are none."""
    out = df.select(key.alias("key"), lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))
    real = F.col("key").isNotNull() & (F.abs("lat") <= 90) & (F.abs("lon") <= 180)
    return out.where(real & ~((F.col("lat") == 0) & (F.col("lon") == 0)))


def _great_circle(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Metres, by the haversine formula; radians in."""
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


class VantageTree:
    """A vantage-point tree over points in radians; all queries go down it together."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray) -> None:
        self.lat, self.lon = lat, lon
        self.root = self._build(np.arange(len(lat)))

    def _build(self, ids: np.ndarray) -> tuple:
        if len(ids) <= LEAF:
            return (None, ids)
        at, rest = ids[0], ids[1:]
        d = _great_circle(self.lat[at], self.lon[at], self.lat[rest], self.lon[rest])
        mu = float(np.median(d))
        near = d <= mu
        if near.all():
            # many points at one distance (copies of one place): halves keep the tree shallow, both within mu
            half = len(rest) // 2
            return (at, mu, self._build(rest[:half]), self._build(rest[half:]), True)
        return (at, mu, self._build(rest[near]), self._build(rest[~near]), False)

    def within(self, lat: np.ndarray, lon: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query index, point index) at most radius apart."""
        qs: list[np.ndarray] = []
        ps: list[np.ndarray] = []
        stack = [(self.root, np.arange(len(lat)))]
        while stack:
            node, q = stack.pop()
            if not len(q):
                continue
            if node[0] is None:
                ids = node[1]
                d = _great_circle(lat[q][:, None], lon[q][:, None], self.lat[ids][None, :], self.lon[ids][None, :])
                i, j = np.nonzero(d <= radius)
                qs.append(q[i])
                ps.append(ids[j])
                continue
            at, mu, near, far, flat = node
            d = _great_circle(lat[q], lon[q], self.lat[at], self.lon[at])
            hit = d <= radius
            qs.append(q[hit])
            ps.append(np.full(int(hit.sum()), at))
            slack = 1e-6
            stack.append((near, q[d <= mu + radius + slack]))
            stack.append((far, q[d <= mu + radius + slack] if flat else q[d >= mu - radius - slack]))
        return np.concatenate(qs) if qs else np.array([], int), np.concatenate(ps) if ps else np.array([], int)


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


class Pivots:
    """Pivots in two levels: every pivot is kept with the nearest of a few leading ones, and whole groups too far off are passed over."""

    def __init__(self, unit: np.ndarray) -> None:
        lead = unit[: max(1, math.isqrt(len(unit)))]
        home = np.concatenate([_angle(unit[at : at + 4096], lead).argmin(axis=1) for at in range(0, len(unit), 4096)])
        self.lead, self.members = lead, [np.nonzero(home == s)[0] for s in range(len(lead))]
        self.vectors = [unit[m] for m in self.members]
        self.radius = np.array([_angle(v, lead[s : s + 1]).max() if len(v) else 0.0 for s, v in enumerate(self.vectors)])

    def near(self, points: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point, pivot, whether it is the nearest one) of every pivot at most `reach` farther from a point than its nearest.

        The nearest leading pivot bounds the distance to the nearest of all; a group farther off than that, its own
        radius and reach holds none that counts. Of pivots at one distance the lower number is the nearest.
        """
        d = _angle(points, self.lead)
        bound = d.min(axis=1) + reach + 1.0
        rows, pivots, metres = [], [], []
        for s, members in enumerate(self.members):
            at = np.nonzero(d[:, s] - self.radius[s] <= bound)[0]
            if len(at) and len(members):
                own = _angle(points[at], self.vectors[s])
                i, j = np.nonzero(own <= bound[at][:, None])
                rows.append(at[i])
                pivots.append(members[j])
                metres.append(own[i, j])
        i, j, m = np.concatenate(rows), np.concatenate(pivots), np.concatenate(metres)
        order = np.lexsort((j, m, i))
        i, j, m = i[order], j[order], m[order]
        first = np.r_[True, i[1:] != i[:-1]]
        least = m[first][np.cumsum(first) - 1]
        keep = m <= least + reach
        return i[keep], j[keep], first[keep]


def _angle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Metres between all unit vectors of a and of b."""
    return EARTH_M * np.arccos(np.clip(a @ b.T, -1, 1))


def near_pairs(points: DataFrame, radius_m: float, per_cell: int = 1000, most_pivots: int = 262_144, block: int = 2000) -> DataFrame:
    """(key_a, key_b, metres), key_a < key_b, of all pairs of different points at most radius_m apart.

    points: key (unique), lat, lon in degrees. Pivots are the distinct places of smallest hash, so that dense areas get
    more of them; there are never more than most_pivots (6 MB), and only they are broadcast, in two levels. A point belongs to the cell of its
    nearest pivot p and also goes, as a guest, to each lower cell q with d(q) - d(p) <= 2 * radius: by the triangle
    inequality no pair is lost, and each is found in one cell only. A cell with more than `block` points is worked as
    pairs of blocks, so that no task holds more than two blocks however crowded a spot is.
    """
    spark = points.sparkSession
    n = points.count()
    wanted = max(1, min(most_pivots, n // per_cell))
    places = points.select("lat", "lon").distinct()
    chosen = places.orderBy(F.xxhash64("lat", "lon"), "lat", "lon").limit(wanted).collect()
    if not chosen:
        return spark.createDataFrame([], "key_a string, key_b string, metres double")
    plat, plon = (np.radians(np.array([r[i] for r in chosen])) for i in (0, 1))
    pivots = spark.sparkContext.broadcast(_unit(plat, plon))
    reach = 2 * radius_m + 2.0  # 2 m of slack for the rounding of arc cosines

    def assign(it):
        index = Pivots(pivots.value)
        for pdf in it:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at : at + 4096]
                i, j, nearest = index.near(_unit(np.radians(part["lat"].to_numpy()), np.radians(part["lon"].to_numpy())), reach)
                home = np.empty(len(part), dtype="int64")
                home[i[nearest]] = j[nearest]
                keep = j <= home[i]
                out = part.iloc[i[keep]].copy()
                out["cell"] = j[keep].astype("int32")
                out["own"] = nearest[keep]
                yield out

    placed = points.select("key", "lat", "lon").mapInPandas(assign, "key string, lat double, lon double, cell int, own boolean")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = placed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"].iat[0], pdf["y"].iat[0]
        a, b = pdf[pdf["block"] == x], pdf[pdf["block"] == y]
        found: dict[str, list] = {"key_a": [], "key_b": [], "metres": []}
        if len(a) and len(b):
            rad = lambda p: (np.radians(p["lat"].to_numpy()), np.radians(p["lon"].to_numpy()))
            qa, qb = rad(a), rad(b)
            i, j = VantageTree(*qb).within(*qa, radius_m)
            keep = a["own"].to_numpy()[i] | b["own"].to_numpy()[j]
            if x == y:
                keep &= i < j
            i, j = i[keep], j[keep]
            ka, kb = a["key"].to_numpy()[i], b["key"].to_numpy()[j]
            turn = ka > kb
            found = {"key_a": np.where(turn, kb, ka), "key_b": np.where(turn, ka, kb), "metres": _great_circle(qa[0][i], qa[1][i], qb[0][j], qb[1][j])}
        return pd.DataFrame(found)

    return spread.groupBy("cell", "x", "y").applyInPandas(local, "key_a string, key_b string, metres double")


def regions(areas: DataFrame, key: Column, wkt: Column) -> DataFrame:
    """(area, edges, and the bounding box) of POLYGON and MULTIPOLYGON texts ("lon lat"); unreadable ones are left out."""
    ring = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def edges(text: Column) -> Column:
        xy = F.transform(
            F.split(text, ","),
            lambda p: F.struct(
                F.split(F.trim(p), r"\s+")[0].try_cast("double").alias("x"), F.split(F.trim(p), r"\s+")[1].try_cast("double").alias("y")
            ),
        )
        return F.zip_with(
            F.slice(xy, F.lit(1), F.size(xy) - 1), F.slice(xy, F.lit(2), F.size(xy) - 1),
            lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")),
        )

    out = areas.where(key.isNotNull() & wkt.isNotNull()).select(key.alias("area"), F.flatten(F.transform(ring, edges)).alias("edges"))
    return out.where(F.size("edges") > 2).select(
        "area", "edges", *[f("edges." + a).alias(n) for f, a, n in ((F.array_min, "x1", "w"), (F.array_max, "x1", "e"), (F.array_min, "y1", "s"), (F.array_max, "y1", "n"))]
    )


def inside(points: DataFrame, areas: DataFrame) -> DataFrame:
    """(key, area) of every point in a region of regions(): planar, even-odd over all rings, so holes count as outside.

    Regions are cut into one-degree tiles and joined to the points by tile; the exact test stays in the JVM. Regions of
    at most FEW_EDGES edges in all are broadcast. More are joined by a shuffle in which the points of a tile are spread over
    SALTS tasks, so that a tile with a third of all points is none's alone.
    """
    tile = lambda c: F.floor(c).cast("int")
    tiles = areas.withColumn("tx", F.explode(F.sequence(tile(F.col("w")), tile(F.col("e"))))).withColumn("ty", F.explode(F.sequence(tile(F.col("s")), tile(F.col("n")))))
    at = points.withColumn("tx", tile(F.col("lon"))).withColumn("ty", tile(F.col("lat")))
    x, y = F.col("lon"), F.col("lat")

    def crosses(e: Column) -> Column:
        at_x = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return F.when((e["y1"] > y) != (e["y2"] > y), x < at_x).otherwise(F.lit(False))

    box = x.between(F.col("w"), F.col("e")) & y.between(F.col("s"), F.col("n"))
    edges = tiles.agg(F.coalesce(F.sum(F.size("edges")), F.lit(0))).collect()[0][0]
    if edges <= FEW_EDGES:
        hits = at.join(F.broadcast(tiles), ["tx", "ty"]).where(box)
    else:
        salted = tiles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = at.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["tx", "ty", "salt"]).where(box)
    return hits.where(F.size(F.filter("edges", crosses)) % 2 == 1).select("key", "area").distinct()


def metres_per_degree(lat: float) -> float:
    return math.cos(math.radians(lat)) * math.pi * EARTH_M / 180
