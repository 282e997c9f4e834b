"""Point in polygon on hand-made boundary files (holes, two parts, a triangle)."""

import json
import os

from spendlens.operators.spatial import point_in_polygon
from spendlens.sources.geojson import read_geojson_dir, to_edges


def _fc(place_id, gtype, coords):
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::4269"}},
            "features": [{"type": "Feature", "properties": {"place_id": place_id},
                          "geometry": {"type": gtype, "coordinates": coords}}]}


def _write(d):
    shapes = {
        "sq": _fc("sq", "Polygon", [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]]),
        "two": _fc("two", "MultiPolygon", [[[[10, 0], [11, 0], [11, 1], [10, 1], [10, 0]]],
                                           [[[12, 0], [13, 0], [13, 1], [12, 1], [12, 0]]]]),
        "tri": _fc("tri", "Polygon", [[[20, 0], [24, 0], [20, 4]]]),  # open ring: closed by the reader
    }
    for k, v in shapes.items():
        with open(os.path.join(d, f"c-{k}.geojson"), "w") as f:
            f.write(json.dumps(v, indent=1))


def test_geojson_to_edges(spark, tmp_dir):
    _write(tmp_dir)
    g = read_geojson_dir(spark, f"{tmp_dir}/*.geojson")
    assert sorted(r.place_id for r in g.collect()) == ["sq", "tri", "two"]
    assert all("4269" in r.crs for r in g.collect())
    e = to_edges(g)
    counts = {r.place_id: r["count"] for r in e.groupBy("place_id").count().collect()}
    assert counts == {"sq": 8, "two": 8, "tri": 3}


def test_point_in_polygon(spark, tmp_dir):
    _write(tmp_dir)
    edges = to_edges(read_geojson_dir(spark, f"{tmp_dir}/*.geojson"))
    pts = [("in_sq", 0.5, 0.5), ("in_hole", 1.5, 1.5), ("on_edge", 4.0, 2.0), ("in_part1", 10.5, 0.5),
           ("gap", 11.5, 0.5), ("in_part2", 12.5, 0.5), ("in_tri", 21.0, 1.0), ("above_tri", 23.0, 3.0),
           ("on_diag", 22.0, 2.0), ("outside", -1.0, -1.0), ("no_coords", None, None)]
    df = spark.createDataFrame(pts, "pid string, x double, y double")
    for cell in (0.5, 3.0):
        got = {r.pid: r.place_id for r in point_in_polygon(df, edges, id_col="pid", cell=cell).collect()}
        assert got == {"in_sq": "sq", "in_hole": None, "on_edge": "sq", "in_part1": "two", "gap": None,
                       "in_part2": "two", "in_tri": "tri", "above_tri": None, "on_diag": "tri", "outside": None,
                       "no_coords": None}
    strict = {r.pid: r.place_id for r in point_in_polygon(df, edges, id_col="pid", cell=0.5,
                                                          boundary_in=False).collect()}
    assert strict["on_edge"] is None and strict["in_sq"] == "sq"


def test_overlapping_polygons_keep_smallest_id(spark):
    edges = spark.createDataFrame(
        [("b", 0, 0, 0, 0.0, 0.0, 2.0, 0.0), ("b", 0, 0, 1, 2.0, 0.0, 2.0, 2.0), ("b", 0, 0, 2, 2.0, 2.0, 0.0, 2.0),
         ("b", 0, 0, 3, 0.0, 2.0, 0.0, 0.0),
         ("a", 0, 0, 0, 1.0, 1.0, 3.0, 1.0), ("a", 0, 0, 1, 3.0, 1.0, 3.0, 3.0), ("a", 0, 0, 2, 3.0, 3.0, 1.0, 3.0),
         ("a", 0, 0, 3, 1.0, 3.0, 1.0, 1.0)],
        "place_id string, part int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([("p", 1.5, 1.5), ("q", 0.5, 0.5)], "pid string, x double, y double")
    got = {r.pid: (r.place_id, r.n_hits) for r in point_in_polygon(pts, edges, id_col="pid", cell=1.0).collect()}
    assert got == {"p": ("a", 2), "q": ("b", 1)}


def test_points_with_one_id_are_kept_apart(spark, tmp_dir):
    _write(tmp_dir)
    edges = to_edges(read_geojson_dir(spark, f"{tmp_dir}/*.geojson"))
    pts = spark.createDataFrame([("p", 0.5, 0.5), ("p", 3.0, 3.0), ("p", 10.5, 0.5)], "pid string, x double, y double")
    got = sorted((r.x, r.place_id) for r in point_in_polygon(pts, edges, id_col="pid", cell=0.5).collect())
    assert got == [(0.5, "sq"), (3.0, "sq"), (10.5, "two")]


def test_broken_boundary_file_fails_and_missing_places_are_listed(spark, tmp_dir):
    import pytest

    from spendlens.sources.geojson import places_without_edges
    _write(tmp_dir)
    edges = to_edges(read_geojson_dir(spark, f"{tmp_dir}/*.geojson"))
    listed = spark.createDataFrame([("sq",), ("gone",)], "place_id string")
    assert [r.place_id for r in places_without_edges(listed, edges).collect()] == ["gone"]
    with open(os.path.join(tmp_dir, "c-bad.geojson"), "w") as f:
        f.write('{"type": "FeatureCollection", "features": [{"type"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_geojson_dir(spark, f"{tmp_dir}/*.geojson").collect()


def test_collections_other_types_and_features_without_a_geometry(spark, tmp_dir):
    sq = lambda x: [[[x, 0], [x + 1, 0], [x + 1, 1, 5.5], [x, 1], [x, 0]]]
    nested = {"type": "GeometryCollection", "geometries": [
        {"type": "Point", "coordinates": [9, 9]}, {"type": "Polygon", "coordinates": sq(0)},
        {"type": "GeometryCollection", "geometries": [{"type": "MultiPolygon", "coordinates": [sq(2), sq(4)]}, {"type": "GeometryCollection", "geometries": []}]}]}
    feature = lambda i, g, **p: {"type": "Feature", "properties": {"place_id": i, **p}, "geometry": g}
    doc = {"type": "FeatureCollection", "features": [feature("col", nested, pop=5, names={"a": 1}), feature("pt", {"type": "Point", "coordinates": [1, 1]}),
                                                     feature("none", None), feature(7, {"type": "Polygon", "coordinates": sq(8)})]}
    with open(f"{tmp_dir}/x.geojson", "w") as f:
        json.dump(doc, f)
    g = read_geojson_dir(spark, f"{tmp_dir}/*.geojson")
    rows = {r.place_id: r for r in g.collect()}
    assert {k: (r.geom_type, r.coordinates and len(r.coordinates)) for k, r in rows.items()} == {
        "col": ("GeometryCollection", 3), "pt": ("Point", None), "none": (None, None), "7": ("Polygon", 1)}
    assert rows["col"].properties["pop"] == "5" and rows["col"].crs is None
    counts = {r.place_id: r["count"] for r in to_edges(g).groupBy("place_id").count().collect()}
    assert counts == {"col": 12, "7": 4}
    pts = spark.createDataFrame([(x + .5, .5) for x in range(9)], "x double, y double").withColumn("pid", __import__("pyspark").sql.functions.col("x"))
    got = {r.pid: r.place_id for r in point_in_polygon(pts, to_edges(g), id_col="pid", cell=1.0, how="inner").collect()}
    assert got == {.5: "col", 2.5: "col", 4.5: "col", 8.5: "7"}


def test_coordinates_in_another_system_stop_the_read(spark, tmp_dir):
    import pytest

    from spendlens.sources.geojson import parse_geojson_text
    poly = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    for name, ok in (("urn:ogc:def:crs:EPSG::4269", True), ("epsg:4326", True), ("urn:ogc:def:crs:OGC:1.3:CRS84", True), ("EPSG:3857", False), ("urn:ogc:def:crs:EPSG:9.8:26985", False)):
        doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": name}}, "features": [{"type": "Feature", "properties": {"place_id": "p"}, "geometry": poly}]}
        df = spark.createDataFrame([(json.dumps(doc),)], "geojson string")
        if ok:
            assert to_edges(parse_geojson_text(df)).count() == 3
        else:
            with pytest.raises(Exception, match="coordinates are in"):
                to_edges(parse_geojson_text(df)).select("x1").collect()      # also when no one asks for the column
            assert to_edges(parse_geojson_text(df, accepted_crs=None)).count() == 3
    deep = poly
    for _ in range(6):
        deep = {"type": "GeometryCollection", "geometries": [deep]}
    df = spark.createDataFrame([(json.dumps({"features": [{"properties": {"place_id": "p"}, "geometry": deep}]}),)], "geojson string")
    with pytest.raises(Exception, match="nested too deeply"):
        parse_geojson_text(df).collect()
