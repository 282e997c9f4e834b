"""The quadtree cover: same answers as the grid, a bounded number of cells whatever the polygon."""

import math
import random

from pyspark.sql import functions as F

from spendlens.operators.cover import PlaceIndex, edge_levels, point_in_cover, polygon_cover
from spendlens.operators.spatial import point_in_polygon

EDGES = "place_id string, part int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"


def ring(name, pts, part=0, r=0):
    return [(name, part, r, i, *map(float, (*a, *b))) for i, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1]))]


def star(name, cx, cy, n, lo, hi, seed):
    rng = random.Random(seed)
    return ring(name, [(cx + rng.uniform(lo, hi) * math.cos(2 * math.pi * i / n), cy + rng.uniform(lo, hi) * math.sin(2 * math.pi * i / n)) for i in range(n)])


def square(name, x, y, w, part=0, r=0):
    return ring(name, [(x, y), (x + w, y), (x + w, y + w), (x, y + w)], part, r)


def world(spark):
    rows = (star("city", -76.6, 39.3, 400, .02, .2, 1) + star("spiky", 10, -5, 60, .1, 4, 2)
            + square("holed", 0, 0, 4) + square("holed", 1, 1, 2, 0, 1) + square("two", 20, 0, 1) + square("two", 22, 0, 1, 1)
            + ring("huge", [(-179.5, -89.5), (179.25, -88), (178, 89), (-170, 80)]) + ring("thin", [(30, 0), (30, 50), (30.0001, 50), (30.0001, 0)])
            + square("tiny", 5.00001, 5.00001, 1e-5) + ring("line", [(40, 1), (42, 1)]))
    return spark.createDataFrame(rows, EDGES)


def points(spark):
    rng = random.Random(3)
    pts = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)]
    pts += [(rng.gauss(-76.6, .15), rng.gauss(39.3, .15)) for _ in range(500)] + [(rng.uniform(6, 14), rng.uniform(-9, -1)) for _ in range(500)]
    pts += [(x / 4, y / 4) for x in range(-2, 20) for y in range(-2, 20)]                      # cell corners, edges and vertices of the squares
    pts += [(20.5, .5), (21.5, .5), (22.5, .5), (30.00005, 25), (30, 25), (30.0002, 25), (5.000015, 5.000015), (41, 1), (41, 1.5), (-179.5, -89.5)]
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(map(lambda p: tuple(map(float, p)), pts))] + [(None, 2.0, .5), (None, 1.5, 1.5), (-1, None, 1.0)],
                                 "pid int, x double, y double")


def by_point(df):
    return sorted(((r.pid, r.x, r.y, r.place_id, r.n_hits) for r in df.collect()), key=str)


def test_same_answers_as_the_grid(spark):
    edges, pts = world(spark), points(spark)
    edges.persist()
    want = by_point(point_in_polygon(pts, edges, id_col="pid", cell=2.0, band=.5))
    assert sum(p[3] == "city" for p in want) > 50 and sum(p[4] == 2 for p in want) > 100 and sum(p[4] == 0 for p in want) > 5
    index = PlaceIndex.build(edges)
    assert by_point(point_in_cover(pts, index, id_col="pid")) == want
    assert by_point(point_in_cover(pts, index, id_col="pid", how="inner", broadcast_limit=0)) == [p for p in want if p[4]]
    coarse = PlaceIndex.build(edges, max_cells=20, depth=3)
    assert by_point(point_in_cover(pts, coarse, id_col="pid")) == want
    open_ = by_point(point_in_polygon(pts, edges, id_col="pid", cell=2.0, band=.5, boundary_in=False))
    assert by_point(point_in_cover(pts, index, id_col="pid", boundary_in=False)) == open_ != want


def test_a_point_without_an_id_keeps_its_place(spark):
    edges, pts = world(spark), points(spark).filter("pid IS NULL")
    for got in (point_in_polygon(pts, edges, id_col="pid", cell=2.0, band=.5), point_in_cover(pts, PlaceIndex.build(edges), id_col="pid")):
        assert sorted((r.x, r.place_id, r.n_hits) for r in got.collect()) == [(1.5, "huge", 1), (2.0, "holed", 2)]


def test_the_number_of_cells_and_rows_is_bounded(spark):
    edges = world(spark).persist()
    for most, depth in ((256, 7), (60, 7), (10, 4)):
        cover = polygon_cover(edges, max_cells=most, depth=depth).persist()
        n = {r.place_id: r["count"] for r in cover.groupBy("place_id").count().collect()}
        assert set(n) == {r.place_id for r in edges.select("place_id").distinct().collect()} and max(n.values()) <= most
    # four edges around the whole world: a few dozen cells, and most of its points need no edge
    cover = polygon_cover(edges).filter("place_id = 'huge'").persist()
    share = cover.filter("inside").agg(F.sum(F.expr("power(2D, 2 * e)"))).first()[0] / (358.0 * 175)
    assert cover.count() <= 256 and share > .8
    assert edge_levels(edges).count() <= 2 * edges.count()        # a tall edge costs two rows
    assert edge_levels(edges.filter("place_id = 'huge'")).count() <= 8


def test_cells_of_one_polygon_do_not_overlap(spark):
    rows = polygon_cover(world(spark), max_cells=100).collect()
    by = {}
    for r in rows:
        by.setdefault(r.place_id, []).append((r.e, r.ix, r.iy))
    for cells in by.values():
        held = set(cells)
        assert len(held) == len(cells)
        top = max(e for e, _, _ in cells)
        for e, ix, iy in cells:
            assert not any((e + k, ix >> k, iy >> k) in held for k in range(1, top - e + 1))
