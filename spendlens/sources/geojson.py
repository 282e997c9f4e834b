"""Boundary GeoJSON: FeatureCollections -> one geometry row per feature -> edges.

A document is parsed once, into a VARIANT; the parts of different nesting (Polygon, MultiPolygon, GeometryCollections
inside one another) are taken out of it by path. Coordinates become ``array<array<array<array<double>>>>`` (part -> ring
-> point -> [x, y, ...]). Other geometry types have no area: their coordinates are NULL and the place is listed as one
without edges. A document that is not JSON fails the read.

Coordinates are used as given, so the reader checks what system they are given in: a document that names another one
than the accepted ones fails the read by name (without a name GeoJSON means longitude and latitude on WGS 84).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MULTI, POLY = "array<array<array<array<double>>>>", "array<array<array<double>>>"
# Longitude and latitude; the datums differ by a metre or two and are not converted.
ACCEPTED_CRS = ("EPSG:4269", "EPSG:4326", "OGC:CRS84")
COLLECTION_DEPTH = 4        # GeometryCollections inside one another; a deeper one fails the read


def crs_code(name: str) -> str:
    """SQL: ``urn:ogc:def:crs:EPSG::4269`` or ``epsg:4269`` as ``EPSG:4269``; NULL (no name) as the format's own default."""
    return f"coalesce(upper(regexp_replace(regexp_replace({name}, '(?i)^urn:(x-)?ogc:def:crs:', ''), ':[^:]*:', ':')), 'OGC:CRS84')"


def _polygons(g: str, depth: int = 0) -> str:
    """SQL: the polygons of geometry ``g`` (a VARIANT) in one array; NULL when it has no area."""
    kind = f"variant_get({g}, '$.type', 'string')"
    if depth < COLLECTION_DEPTH:
        x = f"g{depth}"
        inner = (f"flatten(filter(transform(variant_get({g}, '$.geometries', 'array<variant>'), {x} -> {_polygons(x, depth + 1)}), p -> p IS NOT NULL))")
    else:
        inner = "raise_error('GeoJSON: GeometryCollections are nested too deeply')"
    return (f"CASE {kind} WHEN 'Polygon' THEN array(variant_get({g}, '$.coordinates', '{POLY}')) "
            f"WHEN 'MultiPolygon' THEN variant_get({g}, '$.coordinates', '{MULTI}') WHEN 'GeometryCollection' THEN {inner} END")


def _features(docs: DataFrame, id_prop: str, accepted: Sequence[str] | None) -> DataFrame:
    """``docs``: doc (VARIANT) and the columns to keep; one row for each feature."""
    keep = [f"`{c}`" for c in docs.columns if c != "doc"]
    name = "variant_get(doc, '$.crs.properties.name', 'string')"
    features = "variant_get(doc, '$.features', 'array<variant>')"
    if accepted is not None:    # checked where the features are taken out, so no plan can leave it out
        known = ", ".join(f"'{c.upper()}'" for c in accepted)
        features = (f"CASE WHEN {crs_code(name)} IN ({known}) THEN {features} "
                    f"ELSE raise_error(concat('GeoJSON: coordinates are in ', {name}, ', not in one of {known.replace(chr(39), '')}')) END")
    rows = docs.selectExpr(*keep, f"{name} AS crs", f"explode({features}) AS f")
    return rows.selectExpr(f"variant_get(f, '$.properties.{id_prop}', 'string') AS `{id_prop}`", *keep, "crs",
                           "CAST(variant_get(f, '$.properties') AS MAP<STRING, STRING>) AS properties",
                           "variant_get(f, '$.geometry.type', 'string') AS geom_type",
                           f"{_polygons('g')} AS coordinates".replace("(g,", "(variant_get(f, '$.geometry'),"))


def read_geojson_dir(spark: SparkSession, pattern: str, id_prop: str = "place_id", accepted_crs: Sequence[str] | None = ACCEPTED_CRS) -> DataFrame:
    """Read every FeatureCollection file matching ``pattern`` (one per city); each file is one task.

    Output: id_prop, source_file, crs, properties, geom_type, coordinates. ``accepted_crs=None`` takes any system.
    """
    docs = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.parse_json("value").alias("doc"))
    return _features(docs, id_prop, accepted_crs)


def parse_geojson_text(df: DataFrame, text_col: str = "geojson", id_prop: str = "place_id", accepted_crs: Sequence[str] | None = ACCEPTED_CRS) -> DataFrame:
    """Same as ``read_geojson_dir`` for documents held in a string column."""
    return _features(df.select(F.parse_json(F.col(text_col)).alias("doc")), id_prop, accepted_crs)


def places_without_edges(places: DataFrame, edges: DataFrame, id_col: str = "place_id") -> DataFrame:
    """Listed places that no boundary file gives an edge (missing file, other geometry type, empty feature)."""
    return places.select(id_col).distinct().join(edges.select(id_col).distinct(), id_col, "left_anti")


def to_edges(geoms: DataFrame, id_col: str = "place_id", coords_col: str = "coordinates") -> DataFrame:
    """Edge table: id, part, ring, seq, x1, y1, x2, y2 (rings closed if open)."""
    rings = (geoms.selectExpr(f"`{id_col}`", f"posexplode(`{coords_col}`) AS (part, rings)")
             .selectExpr(f"`{id_col}`", "part", "posexplode(rings) AS (ring, pts)")
             .selectExpr(f"`{id_col}`", "part", "ring",
                         "CASE WHEN element_at(pts, 1) = element_at(pts, -1) THEN pts "
                         "ELSE concat(pts, array(element_at(pts, 1))) END AS pts"))
    pairs = ("zip_with(slice(pts, 1, size(pts) - 1), slice(pts, 2, size(pts) - 1), "
             "(a, b) -> named_struct('x1', a[0], 'y1', a[1], 'x2', b[0], 'y2', b[1]))")
    return (rings.selectExpr(f"`{id_col}`", "part", "ring", f"posexplode({pairs}) AS (seq, e)")
            .selectExpr(f"`{id_col}`", "part", "ring", "seq", "e.x1", "e.y1", "e.x2", "e.y2"))
