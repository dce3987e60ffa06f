import math
import random

import pytest

from aloft.functions.geo import EARTH_RADIUS_KM
from aloft.operators import nearest


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    dl, dn = math.radians(c - a), math.radians(d - b)
    x = math.sin(dl / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dn / 2) ** 2
    return EARTH_RADIUS_KM * 2 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


def km_north(lat, km):
    return lat + math.degrees(km / EARTH_RADIUS_KM)


def test_geo_edges(spark):
    # same point, 29.9 km, 30.1 km, across +-180, 4 sites in range, two positions for one site
    places = spark.createDataFrame([("A", 40.0, -100.0), ("D", 10.0, 179.99)], "p string, la double, lo double")
    sites = spark.createDataFrame([
        ("s0", 40.0, -100.0), ("s1", km_north(40.0, 29.9), -100.0), ("s2", km_north(40.0, 30.1), -100.0),
        ("s3", km_north(40.0, 10.0), -100.0), ("s4", km_north(40.0, 20.0), -100.0),
        ("s4", km_north(40.0, 5.0), -100.0),
        ("w1", 10.0, -179.99), ("w2", 10.0, 179.5)], "s string, la double, lo double")
    out = nearest.nearest_k(places, sites, "p", "la", "lo", "s", "la", "lo", k=3, max_km=30.0, rank="rank")
    got = sorted((r.p, r.rank, r.s) for r in out.collect())
    # s4 has two positions: the smallest (lat, lon) pair (5 km) is used, once
    assert got == [("A", 1, "s0"), ("A", 2, "s4"), ("A", 3, "s3"), ("D", 1, "w1")]
    pairs = nearest.pairs_within(places, sites, "p", "la", "lo", "s", "la", "lo", max_km=30.0)
    assert sorted(r.s for r in pairs.where("p = 'A'").collect()) == ["s0", "s1", "s3", "s4"]


@pytest.mark.parametrize("seed,radius", [(1, 100.0), (2, 500.0), (3, 30.0)])
def test_grid_equals_brute_force(spark, seed, radius):
    rnd = random.Random(seed)
    pts = [(f"p{i}", rnd.uniform(-89.5, 89.5), rnd.uniform(-180, 180)) for i in range(60)]
    pts += [("pole", 89.9, 10.0), ("date", 0.0, 179.9)]
    sts = [(f"s{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(600)]
    sts += [(f"n{i}", p[1] + rnd.uniform(-0.5, 0.5), p[2] + rnd.uniform(-0.5, 0.5)) for i, p in enumerate(pts)]
    sts += [("pole2", 89.95, -170.0), ("date2", 0.1, -179.95)]
    sts = [(s, max(-90.0, min(90.0, la)), ((lo + 180) % 360) - 180) for s, la, lo in sts]
    expect = sorted((p, s) for p, pa, po in pts for s, sa, so in sts if hav(pa, po, sa, so) < radius)
    places = spark.createDataFrame(pts, "p string, la double, lo double")
    sites = spark.createDataFrame(sts, "s string, la double, lo double")
    got = sorted((r.p, r.s) for r in nearest.pairs_within(places, sites, "p", "la", "lo", "s", "la", "lo",
                                                          max_km=radius, cell_deg=2.0).collect())
    assert got == expect


@pytest.mark.parametrize("max_sites,max_level", [(1, 3), (4, 12), (50, 6)])
def test_dense_cells_are_split(spark, max_sites, max_level):
    rnd = random.Random(max_sites)
    city = [(f"c{i}", 48.0 + rnd.gauss(0, 0.05), 2.0 + rnd.gauss(0, 0.05)) for i in range(400)]
    line = [(f"d{i}", rnd.gauss(0, 0.2), ((179.9 + rnd.gauss(0, 0.2) + 180) % 360) - 180) for i in range(200)]
    same = [(f"e{i}", -33.0, 18.5) for i in range(60)]                        # more than any split can part
    sts = city + line + same + [(f"s{i}", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(100)] + [("pole", 89.99, 5.0)]
    pts = [("a", 48.02, 2.01), ("b", 47.0, 2.9), ("c", 0.05, -179.95), ("d", -33.1, 18.4), ("p", 89.9, -170.0)]
    pts += [(f"p{i}", 48.0 + rnd.gauss(0, 0.1), 2.0 + rnd.gauss(0, 0.1)) for i in range(20)]
    for radius in (3.0, 40.0):
        expect = sorted((p, s) for p, pa, po in pts for s, sa, so in sts if hav(pa, po, sa, so) < radius)
        places = spark.createDataFrame(pts, "p string, la double, lo double")
        sites = spark.createDataFrame(sts, "s string, la double, lo double")
        found = nearest.pairs_within(places, sites, "p", "la", "lo", "s", "la", "lo", max_km=radius, max_sites=max_sites, max_level=max_level)
        assert sorted((r.p, r.s) for r in found.collect()) == expect


def test_a_city_spreads_over_cells(spark):
    rnd = random.Random(9)
    sites = spark.createDataFrame([(i, 10.5 + rnd.gauss(0, 0.1), 20.5 + rnd.gauss(0, 0.1)) for i in range(20_000)], "s int, __slat double, __slon double")
    full, depth = nearest._overfull(sites, 1.0, 360, 500, 12)
    assert depth > 2 and full.where("__lv = 0").count() >= 1
    lv = depth                                                                # at the deepest level no cell is over-full any more
    cy, cx = nearest._cell("__slat", "__slon", lv, 1.0, 360)
    assert sites.groupBy(cy, cx).count().agg({"count": "max"}).first()[0] <= 500
