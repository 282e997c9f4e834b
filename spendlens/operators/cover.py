"""J8 by a hierarchical cover: quadtree cells of every polygon, inside or on its boundary, in a bounded number.

Cells are squares with sides of powers of two, aligned to the origin, so a cell's four children lie inside it. A polygon's
root cells are as large as its box; cells that an edge touches are split, down to ``depth`` levels or until the cover
would have more than ``max_cells`` cells. What is left are *inside* cells (no edge touches them, their centre is inside): a
point in one is in the polygon, no edge is looked at; and *boundary* cells: only their points go on to the
crossing test. A country with four edges and a city with fifty thousand have covers of the same size.

The edges for the crossing test are kept by height: an edge of a height up to 2^e lies in at most two bands of 2^e, so a tall
edge costs two rows, not one for each band of its height. A point looks into its band of each size that occurs.

The cover is made by joins and aggregates over the edges of all polygons at once: every edge marks the cells it runs
through on the finest level (some hundred at most), coarser cells are their parents. A cell within 1e-6 of its
side of an edge counts as touched, so rounding can never make a cell inside that is not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.joins import broadcast_if_small
from spendlens.operators.spatial import CROSSES, ON_EDGE, ROW_BYTES, nearest_place
from spendlens.session import written_copy

MAX_CELLS, DEPTH = 256, 7
LEAST_EXPONENT = -20            # no cell or band is smaller than 2^-20 degrees (about 10 cm)
NEAR = "1e-6D"                  # in sides of the finest cell


def _exponent(size: str, least: int = LEAST_EXPONENT) -> str:
    """The least e with 2^e >= ``size``."""
    return f"CAST(greatest({least}, CASE WHEN {size} > 0 THEN ceil(log2({size})) ELSE {least} END) AS INT)"


def _at(value: str, e: str) -> str:
    return f"CAST(floor({value} / power(2D, {e})) AS BIGINT)"


def edge_levels(edges: DataFrame, id_col: str = "place_id") -> DataFrame:
    """Every edge in the one or two bands of its own size: id, x1, y1, x2, y2, e, b."""
    sized = edges.selectExpr(f"`{id_col}`", "x1", "y1", "x2", "y2", f"{_exponent('abs(y2 - y1)')} AS e")
    return sized.selectExpr("*", f"explode(sequence({_at('least(y1, y2)', 'e')}, {_at('greatest(y1, y2)', 'e')})) AS b")


def _exponents(df: DataFrame) -> str:
    """The different sizes, as a SQL array: some dozens at most, whatever the number of cells."""
    found = sorted(r["e"] for r in df.select("e").distinct().collect())
    return f"array({', '.join(map(str, found))})" if found else "CAST(array() AS ARRAY<INT>)"


def _crossings(cand: DataFrame, bands: DataFrame, sizes: str, id_col: str, keys: list[str]) -> DataFrame:
    """Per row of ``cand`` (``keys``, __x, __y, id): whether the polygon's edges hold the point (parity) and whether one touches it."""
    asked = cand.selectExpr("*", f"explode({sizes}) AS e").selectExpr("*", f"{_at('__y', 'e')} AS b")
    return (asked.join(bands, [id_col, "e", "b"]).groupBy(*keys, "__x", "__y", id_col)
            .agg(F.expr(f"sum(CASE WHEN {CROSSES} THEN 1 ELSE 0 END) % 2 = 1").alias("__odd"), F.expr(f"max({ON_EDGE})").alias("__on")))


def polygon_cover(edges: DataFrame, id_col: str = "place_id", max_cells: int = MAX_CELLS, depth: int = DEPTH) -> DataFrame:
    """The cover: id, e (side 2^e), ix, iy, inside; at most ``max_cells`` rows for a polygon (its root cells, up to nine, at least)."""
    q = f"`{id_col}`"
    box = edges.groupBy(id_col).agg(F.expr("greatest(max(greatest(x1, x2)) - min(least(x1, x2)), max(greatest(y1, y2)) - min(least(y1, y2)))").alias("w"))
    box = box.selectExpr(q, f"{_exponent('w')} - {int(depth)} AS e0")
    # the cells on the finest level that an edge runs through: row by row, the part of the edge inside the row
    u = edges.join(box, id_col).selectExpr(q, "e0", *[f"{c} / power(2D, e0) AS {n}" for c, n in (("x1", "u1"), ("y1", "v1"), ("x2", "u2"), ("y2", "v2"))])
    u = u.selectExpr("*", "least(v1, v2) AS lo", "greatest(v1, v2) AS hi").selectExpr(
        "*", f"explode(sequence(CAST(floor(lo - {NEAR}) AS BIGINT), CAST(floor(hi + {NEAR}) AS BIGINT))) AS iy")
    at = "CASE WHEN v1 = v2 THEN {flat} ELSE u1 + ({v} - v1) * (u2 - u1) / (v2 - v1) END"
    va, vb = f"least(hi, greatest(lo, iy - {NEAR}))", f"greatest(lo, least(hi, iy + 1 + {NEAR}))"
    u = u.selectExpr(q, "e0", "iy", f"{at.format(flat='u1', v=va)} AS a", f"{at.format(flat='u2', v=vb)} AS z")
    cells = u.selectExpr(q, "e0", f"explode(sequence(CAST(floor(least(a, z) - {NEAR}) AS BIGINT), CAST(floor(greatest(a, z) + {NEAR}) AS BIGINT))) AS ix", "iy").distinct()
    touched = written_copy(cells.selectExpr(q, "e0", f"explode(sequence(0, {int(depth)})) AS up", "ix", "iy")
                           .selectExpr(q, "e0", "up", "shiftright(ix, up) AS ix", "shiftright(iy, up) AS iy").distinct(), "cover-touched")
    # children of touched cells that no edge touches: inside or outside as a whole, as their centres are
    quarters = "explode(array(named_struct('a', 0, 'b', 0), named_struct('a', 1, 'b', 0), named_struct('a', 0, 'b', 1), named_struct('a', 1, 'b', 1))) AS k"
    free = (touched.filter("up > 0").selectExpr(q, "e0", "up - 1 AS up", "ix", "iy", quarters)
            .selectExpr(q, "e0", "up", "2 * ix + k.a AS ix", "2 * iy + k.b AS iy").join(touched, [id_col, "e0", "up", "ix", "iy"], "left_anti"))
    centres = free.selectExpr("*", "(ix + 0.5D) * power(2D, e0 + up) AS __x", "(iy + 0.5D) * power(2D, e0 + up) AS __y")
    bands = edge_levels(edges, id_col)
    keys = ["e0", "up", "ix", "iy"]
    inside = _crossings(centres, bands, _exponents(bands), id_col, keys).filter("__odd").select(id_col, *keys)
    both = written_copy(touched.withColumn("inside", F.lit(False)).unionByName(inside.withColumn("inside", F.lit(True))), "cover-cells")
    # the finest level whose boundary cells and all inside cells down to it are few enough
    sums = both.groupBy(id_col, "up").agg(F.expr("count_if(NOT inside)").alias("edge"), F.expr("count_if(inside)").alias("full"))
    down = sums.selectExpr(q, "up", f"edge + sum(full) OVER (PARTITION BY {q} ORDER BY up DESC) AS cells")
    level = down.groupBy(id_col).agg(F.expr(f"coalesce(min(CASE WHEN cells <= {int(max_cells)} THEN up END), max(up))").alias("last"))
    return both.join(level, id_col).filter("(inside AND up >= last) OR (NOT inside AND up = last)").selectExpr(q, "e0 + up AS e", "ix", "iy", "inside")


@dataclass
class PlaceIndex:
    """The cover and the edges of all polygons, written once and used for any number of points."""
    cover: DataFrame
    bands: DataFrame
    id_col: str
    cell_sizes: str
    band_sizes: str
    n_cells: int
    n_bands: int

    @staticmethod
    def build(edges: DataFrame, id_col: str = "place_id", max_cells: int = MAX_CELLS, depth: int = DEPTH) -> PlaceIndex:
        cover = written_copy(polygon_cover(edges, id_col, max_cells, depth), "cover")
        bands = written_copy(edge_levels(edges, id_col), "cover-edges")
        return PlaceIndex(cover, bands, id_col, _exponents(cover), _exponents(bands), cover.count(), bands.count())

    def containing(self, points: DataFrame, point_id: str, x: str, y: str, boundary_in: bool = True, broadcast_limit: int | None = None) -> DataFrame:
        """(point id, __x, __y, place) for every place whose polygon holds the point."""
        cover = broadcast_if_small(self.cover, broadcast_limit, self.n_cells * ROW_BYTES)
        bands = broadcast_if_small(self.bands, broadcast_limit, self.n_bands * ROW_BYTES)
        p = points.selectExpr(f"`{point_id}` AS __id", f"CAST(`{x}` AS DOUBLE) AS __x", f"CAST(`{y}` AS DOUBLE) AS __y").filter("__x IS NOT NULL AND __y IS NOT NULL").distinct()
        found = (p.selectExpr("*", f"explode({self.cell_sizes}) AS e").selectExpr("*", f"{_at('__x', 'e')} AS ix", f"{_at('__y', 'e')} AS iy")
                 .join(cover, ["e", "ix", "iy"]).select("__id", "__x", "__y", self.id_col, "inside"))
        tested = _crossings(found.filter("NOT inside").drop("inside"), bands, self.band_sizes, self.id_col, ["__id"])
        tested = tested.filter("__odd OR __on" if boundary_in else "__odd").select("__id", "__x", "__y", self.id_col)
        return found.filter("inside").select("__id", "__x", "__y", self.id_col).unionByName(tested).withColumnRenamed("__id", point_id)


def point_in_cover(points: DataFrame, index: PlaceIndex, id_col: str = "point_id", x: str = "x", y: str = "y", how: str = "left",
                   boundary_in: bool = True, broadcast_limit: int | None = None) -> DataFrame:
    """``point_in_polygon`` by a ``PlaceIndex``: the same rows."""
    return nearest_place(points, index.containing(points, id_col, x, y, boundary_in, broadcast_limit), id_col, x, y, index.id_col, how)
