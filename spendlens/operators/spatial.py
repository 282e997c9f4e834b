"""Point-in-polygon join on an edge table, with no UDF and no cross join.

1. Candidate places: every polygon's bounding box is cut into grid cells of
   ``cell`` degrees; a point joins the cells table on its own cell id
   (equi-join), then keeps places whose box holds it.
2. Crossing test: edges are indexed by horizontal bands of ``band`` degrees
   over their y range; a (point, place) candidate joins the edges of that
   place in the point's band. A horizontal ray from the point crosses an odd
   number of edges iff the point is inside (holes and extra parts included).
   An edge that holds the point counts as inside (``boundary_in``), like
   ``st_intersects``.

Both index tables come from the boundary files, not from the data. Their rows
(cells of the boxes, bands of the edges) are counted by one small aggregate before
they are broadcast; a place that owns a third of all points is then matched
inside each point's own task. Beyond the limit the joins shuffle, and Spark splits
a place's hot cell or band. Ids of points need not be unique: a point is its id
and coordinates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.joins import broadcast_if_small


def polygon_cells(edges: DataFrame, id_col: str = "place_id", cell: float = 0.05) -> DataFrame:
    """Grid cells covering each polygon's bounding box (id, xmin..ymax, cx, cy)."""
    box = edges.groupBy(id_col).agg(
        F.expr("min(least(x1, x2))").alias("xmin"), F.expr("max(greatest(x1, x2))").alias("xmax"),
        F.expr("min(least(y1, y2))").alias("ymin"), F.expr("max(greatest(y1, y2))").alias("ymax"))
    c = f"CAST({cell!r} AS DOUBLE)"
    return box.selectExpr(
        "*", f"explode(sequence(CAST(floor(xmin / {c}) AS BIGINT), CAST(floor(xmax / {c}) AS BIGINT))) AS cx"
    ).selectExpr("*", f"explode(sequence(CAST(floor(ymin / {c}) AS BIGINT), CAST(floor(ymax / {c}) AS BIGINT))) AS cy")


def index_rows(edges: DataFrame, id_col: str, cell: float, band: float) -> tuple[int, int]:
    """Rows of the cell table and of the band table, counted without building them."""
    span = lambda lo, hi, step: f"(floor({hi} / {step!r}D) - floor({lo} / {step!r}D) + 1)"
    bands = edges.agg(F.expr(f"sum({span('least(y1, y2)', 'greatest(y1, y2)', float(band))})")).first()[0]
    box = edges.groupBy(id_col).agg(F.expr("min(least(x1, x2))").alias("x0"), F.expr("max(greatest(x1, x2))").alias("x9"),
                                    F.expr("min(least(y1, y2))").alias("y0"), F.expr("max(greatest(y1, y2))").alias("y9"))
    cells = box.agg(F.expr(f"sum({span('x0', 'x9', float(cell))} * {span('y0', 'y9', float(cell))})")).first()[0]
    return int(cells or 0), int(bands or 0)


def edge_bands(edges: DataFrame, id_col: str = "place_id", band: float = 0.0125) -> DataFrame:
    """Every edge once per horizontal band its y range touches."""
    b = f"CAST({band!r} AS DOUBLE)"
    return edges.selectExpr(
        f"`{id_col}`", "x1", "y1", "x2", "y2",
        f"explode(sequence(CAST(floor(least(y1, y2) / {b}) AS BIGINT), "
        f"CAST(floor(greatest(y1, y2) / {b}) AS BIGINT))) AS b")


# A row of an index table: id, a box or an edge, a cell or a band.
ROW_BYTES = 96

# Ray casting to +x: an edge is crossed when it straddles the point's y and
# the crossing lies right of the point (the division only runs for edges
# that straddle, so horizontal edges never divide by zero).
CROSSES = ("CASE WHEN (y1 > __y) <> (y2 > __y) "
           "THEN __x < (x2 - x1) * (__y - y1) / (y2 - y1) + x1 ELSE false END")
# The point lies on the edge: zero cross product and inside the edge's box.
ON_EDGE = ("(x2 - x1) * (__y - y1) - (y2 - y1) * (__x - x1) = 0 "
           "AND __x BETWEEN least(x1, x2) AND greatest(x1, x2) "
           "AND __y BETWEEN least(y1, y2) AND greatest(y1, y2)")


def containing_places(points: DataFrame, edges: DataFrame, id_col: str = "point_id",
                      x: str = "x", y: str = "y", place_col: str = "place_id",
                      cell: float = 0.05, band: float | None = None,
                      boundary_in: bool = True, broadcast_limit: int | None = None) -> DataFrame:
    """(point id, x, y, place) for every place whose polygon holds the point."""
    band = band or cell / 4.0
    n_cells, n_bands = (0, 0) if broadcast_limit == 0 else index_rows(edges, place_col, cell, band)
    cells = broadcast_if_small(polygon_cells(edges, place_col, cell), broadcast_limit, n_cells * ROW_BYTES)
    bands = broadcast_if_small(edge_bands(edges, place_col, band), broadcast_limit, n_bands * ROW_BYTES)
    c, b = f"CAST({cell!r} AS DOUBLE)", f"CAST({band!r} AS DOUBLE)"
    p = points.selectExpr(f"`{id_col}` AS __id", f"CAST(`{x}` AS DOUBLE) AS __x", f"CAST(`{y}` AS DOUBLE) AS __y")
    p = p.filter("__x IS NOT NULL AND __y IS NOT NULL").selectExpr(
        "*", f"CAST(floor(__x / {c}) AS BIGINT) AS cx", f"CAST(floor(__y / {c}) AS BIGINT) AS cy",
        f"CAST(floor(__y / {b}) AS BIGINT) AS b")
    cand = (p.join(cells, ["cx", "cy"])
            .filter("__x BETWEEN xmin AND xmax AND __y BETWEEN ymin AND ymax")
            .select("__id", "__x", "__y", "b", place_col))
    j = cand.join(bands, [place_col, "b"])
    agg = j.groupBy("__id", "__x", "__y", place_col).agg(
        F.expr(f"sum(CASE WHEN {CROSSES} THEN 1 ELSE 0 END)").alias("__n"),
        F.expr(f"max({ON_EDGE})").alias("__on"))
    inside = "__n % 2 = 1" + (" OR __on" if boundary_in else "")
    return agg.filter(inside).selectExpr(f"__id AS `{id_col}`", "__x", "__y", f"`{place_col}`")


def point_in_polygon(points: DataFrame, edges: DataFrame, id_col: str = "point_id",
                     x: str = "x", y: str = "y", place_col: str = "place_id",
                     cell: float = 0.05, band: float | None = None, how: str = "left",
                     boundary_in: bool = True, broadcast_limit: int | None = None) -> DataFrame:
    """Every point with the place that holds it.

    ``how='left'`` keeps points outside every polygon with a NULL place;
    ``how='inner'`` keeps only located points. When polygons overlap, the
    smallest place id wins and ``n_hits`` tells how many held the point.
    """
    hits = containing_places(points, edges, id_col, x, y, place_col, cell, band, boundary_in,
                             broadcast_limit)
    return nearest_place(points, hits, id_col, x, y, place_col, how)


def nearest_place(points: DataFrame, hits: DataFrame, id_col: str, x: str, y: str, place_col: str, how: str) -> DataFrame:
    """Every point with the least place that holds it and their number; a point without an id is matched by its coordinates."""
    best = (hits.groupBy(id_col, "__x", "__y").agg(F.min(place_col).alias(place_col), F.count("*").alias("n_hits"))
            .withColumnRenamed(id_col, "__id"))
    own = [F.col(id_col).eqNullSafe(F.col("__id")), F.col(x).cast("double") == F.col("__x"), F.col(y).cast("double") == F.col("__y")]
    out = points.join(best, own, how).drop("__id", "__x", "__y")
    if how == "inner":
        return out
    return out.withColumn("n_hits", F.coalesce(F.col("n_hits"), F.lit(0)).cast("bigint"))
