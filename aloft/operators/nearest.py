"""Sites within a radius and the k nearest per place.

The source forms every place x station pair (a cross join), computes the
distance on an RDD and ranks.  Here no pair outside a grid neighbourhood is
ever formed: each site lands in one lat/lon grid cell; each place is
expanded to the cells its search circle overlaps (longitude wraps at
+-180, the span widens with latitude and covers the whole circle near a
pole); the two meet by an equi-join on the cell.  The exact haversine
distance and the strict radius test follow, then ``row_number`` per place
(Catalyst turns ``rn <= k`` into a partial + final ``WindowGroupLimit``).
A cell with more than ``max_sites`` sites (a city) is split into four, and so on
(a quad tree): a site lies in the first cell of its path that is not over-full, a place is expanded
into the parts of over-full cells that its circle overlaps.  So no task gets a dense city as one key,
and far parts of a city are not compared with each other.
The radius test runs before the ranking: the k nearest among sites inside
the radius are the same sites as the k nearest overall, then cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.functions.geo import haversine_km, lat_span_deg, lon_span_deg
from aloft.sources.io import stage

# Distances are ranked after rounding to this many decimals of a km (1 mm),
# so ulp-level differences between math libraries never reorder equal sites.
RANK_DECIMALS = 6


def _cells_per_circle(cell_deg: float) -> int:
    n = round(360.0 / cell_deg)
    if abs(n * cell_deg - 360.0) > 1e-9:
        raise ValueError("cell_deg must divide 360")
    return n


def one_position_per_site(sites: DataFrame, site_id: str, lat: str, lon: str) -> DataFrame:
    """One coordinate pair per site (the smallest (lat, lon) seen)."""
    p = sites.where(F.col(site_id).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()) \
        .groupBy(site_id).agg(F.min(F.struct(F.col(lat).alias("la"), F.col(lon).alias("lo"))).alias("p"))
    return p.select(site_id, F.col("p.la").alias(lat), F.col("p.lo").alias(lon))


def _cell(lat: str, lon: str, level: int | Column, cell_deg: float, ncx: int) -> tuple[Column, Column]:
    """(cy, cx) of a point in the grid of ``cell_deg / 2**level`` degrees."""
    n = F.pow(F.lit(2.0), level if isinstance(level, Column) else F.lit(level))
    return (F.floor(F.col(lat) * n / cell_deg).cast("long"),
            F.pmod(F.floor(F.col(lon) * n / cell_deg).cast("long"), (F.lit(ncx) * n).cast("long")))


def _overfull(sites: DataFrame, cell_deg: float, ncx: int, max_sites: int, max_level: int) -> tuple[DataFrame | None, int]:
    """The cells (__lv, __cy, __cx) with more than ``max_sites`` sites, in a written table of few rows, and how many levels they have."""
    cy, cx = _cell("__slat", "__slon", F.col("__lv"), cell_deg, ncx)
    levels = sites.select("__slat", "__slon", F.explode(F.sequence(F.lit(0), F.lit(max_level - 1))).alias("__lv"))
    counted = levels.groupBy("__lv", cy.alias("__cy"), cx.alias("__cx")).agg(F.count(F.lit(1)).alias("n"))
    full = stage(counted.where(F.col("n") > max_sites).select("__lv", "__cy", "__cx"))
    deepest = full.agg(F.max("__lv")).first()[0]
    return (None, 0) if deepest is None else (full, deepest + 1)


def pairs_within(places: DataFrame, sites: DataFrame, place_id: str, place_lat: str, place_lon: str,
                 site_id: str, site_lat: str, site_lon: str, max_km: float,
                 cell_deg: float = 1.0, distance: str = "distance_km", max_sites: int = 4096, max_level: int = 12) -> DataFrame:
    """All (place, site) pairs closer than ``max_km`` with their distance.

    Exact: equal to filtering the full cross product by ``distance <
    max_km``, without forming it.  Places and sites are reduced to one row
    per id first (distinct before the join).  Cells of more than ``max_sites`` sites are split, ``max_level``
    times at most (12: cells of 30 m).
    """
    ncx = _cells_per_circle(cell_deg)
    dlat = lat_span_deg(max_km)
    pl = places.select(F.col(place_id), F.col(place_lat).try_cast("double").alias("__plat"),
                       F.col(place_lon).try_cast("double").alias("__plon")) \
        .where(F.col(place_id).isNotNull() & F.col("__plat").isNotNull() & F.col("__plon").isNotNull()) \
        .dropDuplicates([place_id, "__plat", "__plon"])
    dlon = lon_span_deg(F.col("__plat"), max_km)
    cy = F.sequence(F.floor((F.col("__plat") - F.lit(dlat)) / cell_deg).cast("long"),
                    F.floor((F.col("__plat") + F.lit(dlat)) / cell_deg).cast("long"))
    cx_raw = F.sequence(F.floor((F.col("__plon") - dlon) / cell_deg).cast("long"),
                        F.floor((F.col("__plon") + dlon) / cell_deg).cast("long"))
    cx = F.array_distinct(F.transform(cx_raw, lambda x: F.pmod(x, F.lit(ncx))))
    pl_cells = pl.withColumn("__cy", F.explode(cy)).withColumn("__cx", F.explode(cx))

    st = one_position_per_site(
        sites.select(F.col(site_id), F.col(site_lat).try_cast("double").alias("__slat"),
                     F.col(site_lon).try_cast("double").alias("__slon")),
        site_id, "__slat", "__slon")
    full, depth = _overfull(st, cell_deg, ncx, max_sites, max_level)
    on = ["__cy", "__cx"]
    if depth:
        on = ["__lv", *on]
        own_cy, own_cx = _cell("__slat", "__slon", F.col("__lv"), cell_deg, ncx)
        path = st.withColumn("__lv", F.explode(F.sequence(F.lit(0), F.lit(depth - 1)))).withColumns({"__cy": own_cy, "__cx": own_cx})
        deeper = path.join(full, on, "left_semi").groupBy(site_id).agg(F.count(F.lit(1)).cast("int").alias("__lv"))
        st = st.join(deeper, site_id, "left").withColumn("__lv", F.coalesce("__lv", F.lit(0)))
        level = pl_cells.withColumn("__lv", F.lit(0))
        pl_cells = level
        for lv in range(1, depth + 1):
            side = cell_deg / 2**lv
            parts = F.array(*[F.struct((F.col("__cy") * 2 + a).alias("cy"), (F.col("__cx") * 2 + c).alias("cx")) for a in (0, 1) for c in (0, 1)])
            parts = level.join(full, on, "left_semi").withColumn("__p", F.explode(parts)) \
                .withColumns({"__lv": F.lit(lv), "__cy": F.col("__p.cy"), "__cx": F.col("__p.cx")}).drop("__p")
            away = F.pmod((F.col("__cx") + 0.5) * side - F.col("__plon"), F.lit(360.0))         # of the cell's middle, around the globe
            near = (F.abs((F.col("__cy") + 0.5) * side - F.col("__plat")) <= dlat + side / 2 + 1e-9) \
                & (F.least(away, 360.0 - away) <= lon_span_deg(F.col("__plat"), max_km) + side / 2 + 1e-9)
            level = parts.where(near)
            pl_cells = pl_cells.unionByName(level)
    else:
        st = st.withColumn("__lv", F.lit(0))
    st_cy, st_cx = _cell("__slat", "__slon", F.col("__lv"), cell_deg, ncx)
    pairs = pl_cells.join(st.withColumns({"__cy": st_cy, "__cx": st_cx}), on=on, how="inner")
    d = haversine_km("__plat", "__plon", "__slat", "__slon")
    return (pairs.withColumn(distance, d)
            .where(F.col(distance) < F.lit(max_km))
            .select(place_id, site_id, distance))


def nearest_k(places: DataFrame, sites: DataFrame, place_id: str, place_lat: str, place_lon: str,
              site_id: str, site_lat: str, site_lon: str, k: int = 3, max_km: float = 30.0,
              cell_deg: float = 1.0, distance: str = "distance_km", rank: str | None = None) -> DataFrame:
    """The ``k`` nearest sites strictly within ``max_km`` of each place (G1).

    Ties on (rounded) distance are broken by site id.  ``rank`` names an
    optional output column with the 1-based rank.
    """
    if k <= 0 or max_km <= 0 or not math.isfinite(max_km):
        raise ValueError("k and max_km must be positive and finite")
    pairs = pairs_within(places, sites, place_id, place_lat, place_lon, site_id, site_lat, site_lon,
                         max_km, cell_deg, distance)
    w = Window.partitionBy(place_id).orderBy(F.round(distance, RANK_DECIMALS), F.col(site_id))
    rn = rank or "__rn"
    out = pairs.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)
    return out if rank else out.drop(rn)
