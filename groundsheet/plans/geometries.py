"""Geometry column queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.operators import columns, process
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer

BOX_AREA = "round((x1 - x0) * (y1 - y0), 6)"
ROUNDED_BOX = "round(x0, 6) as xmin, round(y0, 6) as ymin, round(x1, 6) as xmax, round(y1, 6) as ymax"


def _rounded_bounds(c: str = "geom"):
    return [F.round(v, 6).alias(k) for k, v in G.bounds(c).items()]


@query(
    "b1_decode_geometry",
    ctes("footprints")
    + f"select id, {BOX_AREA} as area_wkt, {BOX_AREA} as area_geojson, {BOX_AREA} as area_wkb from footprints",
)
def decode_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = layer(spark, sf_dir, "footprints", spread=True)
    wkt = G.envelope_wkt("x0", "y0", "x1", "y1")
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    doc = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    texts = boxes.select("id", wkt.alias("wkt"), doc.alias("doc"))
    out = columns.decode_geometry(texts, "wkt", "wkt", out="g_wkt", on_error="null")
    out = columns.decode_geometry(out, "doc", "geojson", out="g_geojson")
    out = columns.decode_geometry(out, "g_wkt", "wkb", out="g_wkb")
    area = lambda c: F.round(G.area(f"g_{c}"), 6).alias(f"area_{c}")
    return out.select("id", area("wkt"), area("geojson"), area("wkb"))


@query(
    "b2_decode_esri",
    ctes("footprints")
    + """select id,
           case id % 5 when 0 then 'POINT' when 1 then 'POLYGON' when 2 then 'MULTIPOINT'
                when 3 then 'LINESTRING' else 'POLYGON' end as kind,
           round(x0, 6) as xmin, round(y0, 6) as ymin,
           round(case when id % 5 = 0 then x0 else x1 end, 6) as xmax,
           round(case when id % 5 = 0 then y0 else y1 end, 6) as ymax
         from footprints""",
)
def decode_esri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every footprint as service JSON, in one of the five accepted forms."""
    text = """
        case id % 5
          when 0 then concat('{"x":', x0, ',"y":', y0, '}')
          when 1 then concat('{"xmin":', x0, ',"ymin":', y0, ',"xmax":', x1, ',"ymax":', y1, '}')
          when 2 then concat('{"points":[[', x0, ',', y0, '],[', x1, ',', y1, '],[7]]}')
          when 3 then concat('{"paths":[[[', x0, ',', y0, '],[', x1, ',', y1, ']],[[0,0]]]}')
          else concat('{"rings":[[[', x0, ',', y0, '],[', x1, ',', y0, '],[', x1, ',', y1, '],[',
                      x0, ',', y0, ']]],"spatialReference":{"wkid":4326}}')
        end"""
    docs = layer(spark, sf_dir, "footprints", spread=True).select("id", F.expr(text).alias("doc"))
    shapes = columns.decode_esri(docs, "doc")
    return shapes.select("id", G.kind("geom").alias("kind"), *_rounded_bounds())


@query("b3_make_points", ctes("sites") + "select id, lon as x, lat as y, 'POINT' as kind from sites")
def make_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = columns.make_points(layer(spark, sf_dir, "sites"), "lon", "lat")
    return points.select("id", G.x("geom").alias("x"), G.y("geom").alias("y"), G.kind("geom").alias("kind"))


@query(
    "b4_make_lines",
    ctes("tracks")
    + """, steps as (
           select track, lon - lag(lon) over w as dx, lat - lag(lat) over w as dy
           from tracks window w as (partition by track order by seq))
         select track, count(*) as vertices, round(sum(coalesce(sqrt(dx*dx + dy*dy), 0)), 4) as length
         from steps group by track""",
)
def make_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = process.make_lines(layer(spark, sf_dir, "tracks"), ["track"], ["seq"])
    return lines.select("track", "vertices", F.round(F.coalesce(G.length("geom"), F.lit(0.0)), 4).alias("length"))


@query("b5_make_envelopes", ctes("footprints") + f"select id, {BOX_AREA} as area, {ROUNDED_BOX} from footprints")
def make_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = columns.make_envelopes(layer(spark, sf_dir, "footprints", spread=True), "x0", "y0", "x1", "y1")
    return boxes.select("id", F.round(G.area("geom"), 6).alias("area"), *_rounded_bounds())


def _corners(pair: str, sep: str) -> str:
    """SQL text of the five corners of an integer box."""
    at = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    texts = [pair.format(*[f"', cast(cast({c} as bigint) as varchar(20)), '" for c in xy]) for xy in at]
    return sep.join(texts)


@query(
    "b6_encode_geometry",
    ctes("parcels")
    + f"""select id,
            concat('POLYGON ((', '{_corners("{} {}", ", ")}', '))') as wkt,
            concat('{{"type":"Polygon","coordinates":[[', '{_corners("[{},{}]", ",")}', ']]}}') as geojson,
            93 as wkb_bytes
          from parcels""",
)
def encode_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    parcels = layer(spark, sf_dir, "parcels", geom=True)
    out = columns.encode_geometry(parcels, "geom", "wkt", "wkt")
    out = columns.encode_geometry(out, "geom", "geojson", "geojson")
    out = columns.encode_geometry(out, "geom", "wkb", "wkb")
    return out.select("id", "wkt", "geojson", F.octet_length("wkb").alias("wkb_bytes"))


@query(
    "b7_geometry_accessors",
    ctes("tracks", "sites")
    + """select 'track' as layer, track as id, 'LINESTRING' as geom_type,
                cast(count(*) as int) as n_points, true as is_valid,
                cast(null as double) as x, cast(null as double) as y,
                arg_min(lon, seq) as start_x, arg_min(lat, seq) as start_y,
                arg_max(lon, seq) as end_x, arg_max(lat, seq) as end_y
         from tracks group by track having count(*) > 1
         union all
         select 'site', id, 'POINT', 1, true, lon, lat, null, null, null, null from sites""",
)
def geometry_accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = process.make_lines(layer(spark, sf_dir, "tracks"), ["track"], ["seq"])
    lines = lines.where("geom is not null").select(F.lit("track").alias("layer"), F.col("track").alias("id"), "geom")
    sites = layer(spark, sf_dir, "sites", geom=True).select(F.lit("site").alias("layer"), "id", "geom")
    return columns.geometry_accessors(lines.union(sites)).drop("geom")


@query(
    "b8_bounds_columns",
    ctes("footprints") + f"select id, {ROUNDED_BOX}, {BOX_AREA} as envelope_area from footprints",
)
def bounds_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of diagonal lines, whose envelopes are the footprints."""
    wkt = F.expr("concat('LINESTRING(', x0, ' ', y0, ', ', x1, ' ', y1, ')')")
    lines = layer(spark, sf_dir, "footprints", spread=True).select("id", G.from_wkt(wkt).alias("geom"))
    out = columns.bounds_columns(lines)
    box = [F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    return out.select("id", *box, F.round(G.area("envelope"), 6).alias("envelope_area"))


@query("b9_flip_layer", ctes("sites") + "select id, lat as x, lon as y from sites")
def flip_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    flipped = process.flip_layer(layer(spark, sf_dir, "sites", geom=True))
    return flipped.select("id", G.x("geom").alias("x"), G.y("geom").alias("y"))


@query(
    "b10_repair_layer",
    ctes("footprints")
    + f"""select id, id % 2 = 1 as was_fixed, true as is_valid,
            round((x1 - x0) * (y1 - y0) / (1 + id % 2), 6) as area from footprints""",
)
def repair_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other footprint is drawn as a bow tie; repaired it covers half its box."""
    wkt = F.expr(
        """case when id % 2 = 1
             then concat('POLYGON((', x0, ' ', y0, ', ', x1, ' ', y1, ', ', x1, ' ', y0, ', ',
                         x0, ' ', y1, ', ', x0, ' ', y0, '))')
             else concat('POLYGON((', x0, ' ', y0, ', ', x1, ' ', y0, ', ', x1, ' ', y1, ', ',
                         x0, ' ', y1, ', ', x0, ' ', y0, '))') end"""
    )
    shapes = layer(spark, sf_dir, "footprints", spread=True).select("id", G.from_wkt(wkt).alias("geom"))
    fixed = process.repair_layer(shapes)
    return fixed.select("id", "was_fixed", G.is_valid("geom").alias("is_valid"), F.round(G.area("geom"), 6).alias("area"))
