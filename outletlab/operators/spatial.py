"""Exact nearest neighbour within a radius, over a space partition learned
from the donors.

For every query point find the nearest donor point (Euclidean distance on
(lat, lon) in degrees, reported in km) and keep it if it is closer than
``max_km``. Ties go to the smallest donor key.

Plan (no cross join, no driver-side index):

1. Donors at exactly the same coordinates are interchangeable except for the
   tie-break, so they collapse to one point carrying the smallest key
   (map-side combined group-by). Query points with the same coordinates get
   the same answer and are also searched once. A location holding a third of
   all rows therefore costs one row.
2. Donors are counted in square cells of side R, the search radius in degrees.
   A cell with more than LEAF_POINTS is cut into cells of a quarter of the side,
   down to leaves (``_partition``). The counts of a pass say how many levels a
   crowd needs, and the next pass counts these together, so an even crowd takes
   two passes. Each leaf's donors are written once.
3. Every query meets the leaves among the 3x3 cells around it of every level:
   a query in sparse land its nine cells, one in a crowd those of each level,
   in one join. Around a query all donors closer than the side of the first
   level that has no cut cell there are in these leaves; if the nearest one
   found is, the query is answered.
4. Only queries beside a crowd are left. They descend the levels with a bound,
   the smallest distance at which one of their cells must hold a donor (the far
   corner of its bounding box), and keep the cells whose box is not farther.

Boxes, bounds and distances are computed by the same formula, which rounds
monotonically, so the result is exact, ties included.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.session import cut_lineage

LEAF_POINTS = 32
SPLIT = 4  # sub-cells of a side; a power of two, so that cells nest exactly
MAX_LEVELS = 14  # sides of the radius / 4 ** 13, under a tenth of a millimetre for 5 km
WIDER = 1 + 1e-9  # for bounds: what rounds to the same distance stays
_NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def _distance(dlat: Column, dlon: Column) -> Column:
    return F.sqrt(dlat * dlat + dlon * dlon)


def _in_cells(points: DataFrame, side: float, lat: str = "d_lat", lon: str = "d_lon") -> DataFrame:
    return points.withColumns({"cx": F.floor(F.col(lat) / side), "cy": F.floor(F.col(lon) / side)})


def _in_levels(points: DataFrame, side: float, levels, around: bool = False, lat: str = "d_lat", lon: str = "d_lon") -> DataFrame:
    """Each point once a level with its cell there, or with the 3x3 ``around`` it."""
    cell = [F.struct(F.lit(level).alias("level"), (F.floor(F.col(lat) / (side / SPLIT ** level)) + dx).alias("cx"),
                     (F.floor(F.col(lon) / (side / SPLIT ** level)) + dy).alias("cy"))
            for level in levels for dx, dy in (_NEIGHBOURS if around else [(0, 0)])]
    return points.withColumn("cell", F.explode(F.array(*cell))).select("*", "cell.*").drop("cell")


def _boxes(points: DataFrame) -> DataFrame:
    """(level, cx, cy, n, bounding box) of every cell that holds a donor."""
    return points.groupBy("level", "cx", "cy").agg(
        F.count(F.lit(1)).alias("n"), F.min("d_lat").alias("lat0"), F.max("d_lat").alias("lat1"),
        F.min("d_lon").alias("lon0"), F.max("d_lon").alias("lon1"))


def _ranges(cells: DataFrame) -> DataFrame:
    """Add the least and the largest distance from the query to the box."""
    lat, lon = F.col("q_lat"), F.col("q_lon")
    zero = F.lit(0.0)
    return cells.withColumns({
        "near": _distance(F.greatest(F.col("lat0") - lat, lat - F.col("lat1"), zero),
                          F.greatest(F.col("lon0") - lon, lon - F.col("lon1"), zero)),
        "far": _distance(F.greatest(F.abs(F.col("lat0") - lat), F.abs(F.col("lat1") - lat)),
                         F.greatest(F.abs(F.col("lon0") - lon), F.abs(F.col("lon1") - lon)))})


def _partition(points: DataFrame, side: float, leaf_points: int) -> tuple[DataFrame, DataFrame, int]:
    """(cells, donors of the leaves, levels): ``cells`` has every leaf and every
    cut cell (level, cx, cy, n, box, leaf), the donors their leaf's level and
    place. Cells of the last level are leaves whatever they hold."""
    cells, donors = [], []
    inside, first, passes = points, 0, 1
    while True:
        levels = range(first, min(first + passes, MAX_LEVELS))
        placed = _in_levels(inside, side, levels)
        boxes = cut_lineage(_boxes(placed).withColumn("leaf", (F.col("n") <= leaf_points) | (F.col("level") == MAX_LEVELS - 1)), "space_cells")
        up = boxes.filter("NOT leaf").select((F.col("level") + 1).alias("level"), F.col("cx").alias("ux"), F.col("cy").alias("uy"))
        below = boxes.withColumns({"ux": F.floor(F.col("cx") / SPLIT), "uy": F.floor(F.col("cy") / SPLIT)})
        # of a cell that isn't cut, no cell below counts
        held = boxes.filter(F.col("level") == first).unionByName(
            below.filter(F.col("level") > first).join(up, ["level", "ux", "uy"], "left_semi").select(*boxes.columns))
        held = cut_lineage(held, "space_cells") if len(levels) > 1 else boxes
        cells.append(held)
        donors.append(cut_lineage(placed.join(held.filter("leaf").select("level", "cx", "cy"), ["level", "cx", "cy"], "left_semi"), "leaf_donors"))
        last = levels[-1]
        crowd = held.filter((F.col("level") == last) & ~F.col("leaf"))
        most = crowd.agg(F.max("n")).first()[0]
        if not most:
            break
        rest = placed.filter(F.col("level") == last).join(crowd.select("cx", "cy"), ["cx", "cy"], "left_semi")
        inside = cut_lineage(rest.select(*points.columns), "crowded_points")
        first, passes = last + 1, max(1, math.ceil(math.log(most / leaf_points, SPLIT * SPLIT)))
    return reduce(DataFrame.unionByName, cells), reduce(DataFrame.unionByName, donors), last + 1


def _nearest(reach: DataFrame, donors: DataFrame, donor_key: str, km_per_degree: float) -> DataFrame:
    """(q_lat, q_lon, best: kilometres and donor) over the leaves (q_lat,
    q_lon, level, cx, cy) in reach."""
    km = _distance(F.col("q_lat") - F.col("d_lat"), F.col("q_lon") - F.col("d_lon")) * F.lit(km_per_degree)
    return (reach.join(donors, ["level", "cx", "cy"]).groupBy("q_lat", "q_lon")
            .agg(F.min(F.struct(km.alias("km"), F.col(donor_key))).alias("best")))


def _around(queries: DataFrame, cells: DataFrame, side: float, levels, radius: Column) -> DataFrame:
    """The cells within the radius among the 3x3 around each query, by level."""
    near = _in_levels(queries, side, levels, True, "q_lat", "q_lon")
    return _ranges(near.join(cells, ["level", "cx", "cy"])).filter(F.col("near") <= radius)


def _descend(queries: DataFrame, cells: DataFrame, donors: DataFrame, side: float, levels: int, donor_key: str, km_per_degree: float) -> DataFrame:
    """The nearest donor of (q_lat, q_lon, bound), level by level: a cut cell
    is replaced by its cells below while its box is within the bound."""
    here = _around(queries, cells, side, [0], F.col("bound"))
    leaves = []
    for level in range(levels):
        least = here.groupBy("q_lat", "q_lon").agg(F.min("far").alias("least"))
        here = cut_lineage(here.join(least, ["q_lat", "q_lon"]).withColumn("bound", F.least(F.col("bound"), F.col("least") * WIDER)).filter("near <= bound")
                           .select("q_lat", "q_lon", "bound", "level", "cx", "cy", "leaf"), "near_cells")
        leaves.append(here.filter("leaf").select("q_lat", "q_lon", "bound", "level", "cx", "cy"))
        cut = here.filter("NOT leaf").select("q_lat", "q_lon", "bound", F.col("cx").alias("ux"), F.col("cy").alias("uy"))
        if level + 1 == levels or cut.isEmpty():
            break
        below = cells.filter(F.col("level") == level + 1).withColumns({"ux": F.floor(F.col("cx") / SPLIT), "uy": F.floor(F.col("cy") / SPLIT)})
        here = _ranges(cut.join(below, ["ux", "uy"])).filter("near <= bound")
    return _nearest(reduce(DataFrame.unionByName, leaves), donors, donor_key, km_per_degree)


def nearest_within(queries: DataFrame, donors: DataFrame, *, key: str = "CUSTOMER",
                   donor_key: str = "DONOR", lat: str = "LATITUDE", lon: str = "LONGITUDE",
                   max_km: float = conf.NEAREST_MAX_KM, km_per_degree: float = conf.KM_PER_DEGREE,
                   leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Return (key, donor_key, distance_km) for every query with a donor
    closer than ``max_km``. ``queries`` has (key, lat, lon); ``donors`` has
    (donor_key, lat, lon). Rows without coordinates never match. Cells and
    leaves are written to the shared checkpoint folder.
    """
    side = max_km / km_per_degree
    points = (donors.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
              .groupBy(F.col(lat).alias("d_lat"), F.col(lon).alias("d_lon"))
              .agg(F.min(donor_key).alias(donor_key)))
    cells, leaf_donors, levels = _partition(cut_lineage(points, "donor_points"), side, leaf_points)
    q_rows = queries.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(key, lat, lon)
    at = cut_lineage(q_rows.select(F.col(lat).alias("q_lat"), F.col(lon).alias("q_lon")).distinct(), "query_points")
    wide = F.lit(side * WIDER)  # what rounds into the radius is decided by the kilometres below
    found = _around(at, cells, side, [0], wide)
    if levels > 1:
        crowded = found.filter("NOT leaf").select("q_lat", "q_lon").distinct()
        found = found.unionByName(_around(crowded, cells, side, range(1, levels), wide))
    found = cut_lineage(found.select("q_lat", "q_lon", "level", "cx", "cy", "leaf", "near", "far"), "near_cells")
    known = found.groupBy("q_lat", "q_lon").agg((F.min("far") * WIDER).alias("bound"), F.max(F.when(~F.col("leaf"), F.col("level"))).alias("cut"))
    reach = found.filter("leaf").join(known, ["q_lat", "q_lon"]).filter("near <= bound").select("q_lat", "q_lon", "level", "cx", "cy")
    best = known.join(_nearest(reach, leaf_donors, donor_key, km_per_degree), ["q_lat", "q_lon"], "left")
    # all donors closer than the side of the first level without a cut cell around are in the leaves met
    covered = F.lit(side) / F.pow(F.lit(float(SPLIT)), F.col("cut") + 1)
    degrees = F.col("best.km") / F.lit(km_per_degree) * WIDER
    best = best.withColumn("open", F.col("cut").isNotNull() & F.coalesce(degrees > covered, F.lit(True)))
    if levels > 1:
        best = cut_lineage(best, "nearest_found")
        left = best.filter("open").select("q_lat", "q_lon", F.least(degrees, F.col("bound"), wide).alias("bound"))
        answered = best.filter("NOT open AND best IS NOT NULL").select("q_lat", "q_lon", "best")
        best = answered if left.isEmpty() else answered.unionByName(_descend(left, cells, leaf_donors, side, levels, donor_key, km_per_degree))
    matches = best.filter(F.col("best.km") < F.lit(max_km)).select(
        "q_lat", "q_lon", F.col(f"best.{donor_key}").alias(donor_key), F.col("best.km").alias("distance_km"))
    return (q_rows.join(matches, (F.col(lat) == F.col("q_lat")) & (F.col(lon) == F.col("q_lon")))
            .select(key, donor_key, "distance_km"))
