"""Regional layer (S8, Z1-Z7, F7, F13, F14, F16) on a vertex table
``(region, level, part, ring, seq, x, y)`` in degrees (WGS84).  A region is
one or more parts (polygons); ring 0 of a part is its outline, further rings
are holes.  Tables without ``part`` hold one-part regions."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelkit.functions.bands import band_colour, risk_band_nullsafe
from panelkit.functions.text import short_label

# The nesting of the coordinates depends on the geometry type, so they are
# first taken as JSON text.
FEATURE_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("properties", StructType([StructField("name", StringType()), StructField("level", IntegerType())])),
    StructField("geometry", StructType([StructField("type", StringType()), StructField("coordinates", StringType())])),
])
POLYGON = "array<array<array<double>>>"

# Equatorial radius in km and flattening of the WGS84 ellipsoid.
WGS84 = (6378.137, 1 / 298.257223563)


def read_features(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """GeoJSON Polygon and MultiPolygon features, one per line (JSON
    Lines, so a large layer splits across tasks) -> vertex table.  The
    closing vertex that repeats the first one is dropped.  Features without
    a geometry have no vertices; any other geometry type is an error."""
    f = lines.select(F.from_json(F.col(text_col), FEATURE_SCHEMA).alias("f")).where(F.col("f.geometry").isNotNull())
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    parts = (F.when(kind == "Polygon", F.array(F.from_json(text, POLYGON)))
              .when(kind == "MultiPolygon", F.from_json(text, f"array<{POLYGON}>"))
              .otherwise(F.raise_error(F.concat(F.lit("not a polygon layer: "), F.coalesce(kind, F.lit("no type"))))))
    parts = f.select(F.col("f.properties.name").alias("region"), F.col("f.properties.level").alias("level"),
                     F.posexplode(parts).alias("part", "_rs"))
    rings = parts.select("region", "level", "part", F.posexplode("_rs").alias("ring", "_r"))
    pts = rings.select("region", "level", "part", "ring", F.size("_r").alias("_n"), F.posexplode("_r").alias("seq", "_p"))
    closing = (F.col("seq") == F.col("_n") - 1) & (F.col("_n") > 1)
    return pts.where(~closing).select("region", "level", "part", "ring", "seq", F.col("_p")[0].alias("x"), F.col("_p")[1].alias("y"))


def _with_part(vertices: DataFrame) -> DataFrame:
    return vertices if "part" in vertices.columns else vertices.withColumn("part", F.lit(0))


def to_features(vertices: DataFrame) -> DataFrame:
    """Vertex table -> one GeoJSON feature per line (closed rings): a Polygon,
    or a MultiPolygon where a region has several parts.  Vertices are gathered
    per region, which is bounded by its vertex count."""
    ring = _with_part(vertices).groupBy("region", "level", "part", "ring").agg(
        F.sort_array(F.collect_list(F.struct("seq", F.array("x", "y").alias("p")))).alias("_v"))
    ring = ring.select("region", "level", "part", "ring", F.transform("_v", lambda v: v["p"]).alias("_pts"))
    ring = ring.withColumn("_pts", F.concat("_pts", F.slice("_pts", 1, 1)))
    part = ring.groupBy("region", "level", "part").agg(F.sort_array(F.collect_list(F.struct("ring", "_pts"))).alias("_rs"))
    part = part.withColumn("_rs", F.transform("_rs", lambda r: r["_pts"]))
    region = part.groupBy("region", "level").agg(F.sort_array(F.collect_list(F.struct("part", "_rs"))).alias("_ps"))
    polygons = F.transform("_ps", lambda q: q["_rs"])

    def feature(kind: str, coordinates) -> F.Column:
        return F.to_json(F.struct(F.lit("Feature").alias("type"),
                                  F.struct(F.col("region").alias("name"), F.col("level").alias("level")).alias("properties"),
                                  F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry")))

    return region.select(F.when(F.size("_ps") == 1, feature("Polygon", polygons[0]))
                          .otherwise(feature("MultiPolygon", polygons)).alias("value"))


def equal_area(lon: F.Column, lat: F.Column, radius: float = WGS84[0], flattening: float = WGS84[1]) -> tuple[F.Column, F.Column]:
    """Cylindrical equal-area projection of an ellipsoid, in the unit of
    ``radius``: x grows with the longitude, y is half the authalic function of
    the latitude, so that plane areas are areas on the ellipsoid."""
    sin = F.sin(F.radians(lat))
    e = math.sqrt(flattening * (2 - flattening))
    if e == 0:
        half = sin
    else:
        half = (1 - e * e) / 2 * (sin / (1 - e * e * sin * sin) - F.log((1 - e * sin) / (1 + e * sin)) / (2 * e))
    return radius * F.radians(lon), radius * half


def polygon_measures(vertices: DataFrame, radius: float = WGS84[0], flattening: float = WGS84[1]) -> DataFrame:
    """Shoelace area and centroid per (region, level) over all its
    parts, holes taken off whichever way their rings turn; planar in degrees,
    and the area in km² from the vertices in an equal-area projection.  The
    window holds one ring."""
    ring = ["region", "level", "part", "ring"]
    w = Window.partitionBy(*ring).orderBy("seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt_x = F.coalesce(F.lead("x").over(w), F.first("x").over(whole))
    nxt_y = F.coalesce(F.lead("y").over(w), F.first("y").over(whole))
    e = _with_part(vertices).select(*ring, "x", "y", nxt_x.alias("x2"), nxt_y.alias("y2"))
    px, py = equal_area(F.col("x"), F.col("y"), radius, flattening)
    px2, py2 = equal_area(F.col("x2"), F.col("y2"), radius, flattening)
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    r = e.groupBy(*ring).agg(
        (F.sum(cross) / 2).alias("_a"), (F.sum((px - px2) * (py + py2)) / 2).alias("_km2"),
        F.sum((F.col("x") + F.col("x2")) * cross).alias("_cx"), F.sum((F.col("y") + F.col("y2")) * cross).alias("_cy"),
        F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"),
        F.count(F.lit(1)).alias("vertices"))
    sign = F.signum("_a") * F.when(F.col("ring") == 0, 1).otherwise(-1)
    a = r.groupBy("region", "level").agg(
        F.sum(sign * F.col("_a")).alias("_a"), F.sum(sign * F.col("_km2")).alias("_km2"), F.sum(sign * F.col("_cx")).alias("_cx"), F.sum(sign * F.col("_cy")).alias("_cy"),
        F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"),
        F.sum("vertices").alias("vertices"))
    cx = F.try_divide("_cx", 6 * F.col("_a"))
    cy = F.try_divide("_cy", 6 * F.col("_a"))
    return a.select("region", "level", "vertices", F.col("_a").alias("area_grados2"), cx.alias("centro_x"),
                    cy.alias("centro_y"), F.col("_km2").alias("area_km2"), "xmin", "xmax", "ymin", "ymax")


def layer_profile(measures: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, bounds and area statistics of a layer (per level)."""
    by = by or []
    return measures.groupBy(*by).agg(
        F.count(F.lit(1)).alias("regiones"), F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"),
        F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"), F.min("area_km2").alias("area_min"),
        F.max("area_km2").alias("area_max"), F.avg("area_km2").alias("area_media"), F.sum("area_km2").alias("area_total"))


def name_map(mapping: dict[str, str]):
    """literal name map with identity default, and its inverse."""
    fwd = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    inv = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[1]), F.lit(kv[0]))])
    return (lambda c: F.coalesce(fwd[c], c)), (lambda c: F.coalesce(inv[c], c))


def geo_enrich(regions: DataFrame, data: DataFrame, to_entity, entity: str, period: str, value: str,
               periods: list[str], low: float, high: float) -> DataFrame:
    """Every region for every period (periods exploded inside the
    region table — no join), left-joined to the data by mapped name; band
    with 'sin datos' for missing (F6) and its colour (F16)."""
    r = regions.select("region", F.explode(F.array(*[F.lit(p) for p in periods])).alias(period))
    r = r.withColumn(entity, to_entity(F.col("region")))
    j = r.join(data.select(entity, period, value), [entity, period], "left")
    band = risk_band_nullsafe(F.col(value), low, high)
    return j.select("region", entity, period, value, band.alias("riesgo"), band_colour(band).alias("color"))


def geo_export(regions: DataFrame, preds: DataFrame, to_entity, entity: str, order_col: str,
               real: str, pred: str, low: float, high: float) -> DataFrame:
    """Region rows with actual and predicted values and both
    bands; duplicate entities in the prediction table: the last one (by
    ``order_col``) wins; values rounded to 2 dp, missing -> 0 / 'sin datos'."""
    last = preds.groupBy(entity).agg(F.max_by(F.struct(real, pred), F.col(order_col)).alias("_p"))
    last = last.select(entity, F.col(f"_p.{real}").alias(real), F.col(f"_p.{pred}").alias(pred))
    r = regions.select("region").distinct().withColumn(entity, to_entity(F.col("region")))
    j = r.join(last, entity, "left")
    return j.select("region", short_label(F.col("region")).alias("etiqueta"),
                    F.coalesce(F.round(real, 2), F.lit(0.0)).alias(real),
                    F.coalesce(F.round(pred, 2), F.lit(0.0)).alias(pred),
                    risk_band_nullsafe(F.col(real), low, high).alias("riesgo_real"),
                    risk_band_nullsafe(F.col(pred), low, high).alias("riesgo_predicho"),
                    band_colour(risk_band_nullsafe(F.col(pred), low, high)).alias("color"))


def geo_real_vs_pred(regions: DataFrame, preds: DataFrame, to_entity, entity: str, period: str, at: str,
                     real: str, pred: str, low: float, high: float) -> DataFrame:
    """Every region with the actual and the predicted value of one period, their
    bands ('sin datos' where a value is missing), colours and whether the bands agree."""
    one = preds.where(F.col(period) == at).select(entity, real, pred)
    r = regions.select("region").distinct().withColumn(entity, to_entity(F.col("region")))
    j = r.join(one, entity, "left")
    bands = {c: risk_band_nullsafe(F.col(c), low, high) for c in (real, pred)}
    return j.select("region", entity, F.lit(at).alias(period), real, pred, bands[real].alias("riesgo_real"), bands[pred].alias("riesgo_predicho"),
                    band_colour(bands[real]).alias("color_real"), band_colour(bands[pred]).alias("color_predicho"),
                    F.when(F.col(real).isNotNull() & F.col(pred).isNotNull(), bands[real] == bands[pred]).alias("coincide"))


def regular_polygons(keys: DataFrame, key: str, name: F.Column) -> DataFrame:
    """Fixture rule: a regular polygon per key (3-7 vertices) on a grid."""
    k = F.col(key)
    nv = (3 + k % 5).cast("int")
    cx = -80.0 + (k % 5) * 1.0
    cy = 8.0 + F.floor(k / 5) * 0.5
    rad = 0.2 + (k % 3) * 0.05
    v = keys.select(name.alias("region"), (k % 4).cast("int").alias("level"), cx.alias("_cx"), cy.alias("_cy"),
                    rad.alias("_r"), nv.alias("_nv"), F.explode(F.sequence(F.lit(0), nv - 1)).alias("seq"))
    ang = 2 * math.pi * F.col("seq") / F.col("_nv")
    return v.select("region", "level", F.lit(0).alias("part"), F.lit(0).alias("ring"), F.col("seq").cast("int").alias("seq"),
                    (F.col("_cx") + F.col("_r") * F.cos(ang)).alias("x"), (F.col("_cy") + F.col("_r") * F.sin(ang)).alias("y"))


def holes_and_islands(vertices: DataFrame) -> DataFrame:
    """Fixture rule: every outline gets a hole of half its size around the
    same centre, and every region of an even level a second part ten degrees east.
    The centre is a window over one region's vertices: a join would broadcast a row per region."""
    w = Window.partitionBy("region", "level")
    c = F.col
    v = vertices.where(c("region").isNotNull() & c("level").isNotNull()).withColumns({"_mx": F.avg("x").over(w), "_my": F.avg("y").over(w)})
    piece = lambda part, ring, x, y: F.struct(part.alias("part"), ring.alias("ring"), x.alias("x"), y.alias("y"))
    hole = piece(c("part"), F.lit(1), (c("x") + c("_mx")) / 2, (c("y") + c("_my")) / 2)
    island = F.when(c("level") % 2 == 0, piece(F.lit(1), c("ring"), c("x") + 10, c("y")))
    pieces = F.explode(F.array_compact(F.array(piece(c("part"), c("ring"), c("x"), c("y")), hole, island)))
    return v.select("region", "level", "seq", pieces.alias("_p")).select("region", "level", "_p.part", "_p.ring", "seq", "_p.x", "_p.y")
