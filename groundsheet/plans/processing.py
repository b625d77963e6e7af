"""Geoprocessing queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.functions import geometry as G
from groundsheet.functions import project
from groundsheet.operators import joins, process
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer

BOX = ("x0", "y0", "x1", "y1")
CUT = "greatest(a.x0, b.x0)", "greatest(a.y0, b.y0)", "least(a.x1, b.x1)", "least(a.y1, b.y1)"
CUT_AREA = f"({CUT[2]} - {CUT[0]}) * ({CUT[3]} - {CUT[1]})"
MEET = "a.x0 <= b.x1 and a.x1 >= b.x0 and a.y0 <= b.y1 and a.y1 >= b.y0"
# a 32-sided polygon around a point, as the buffer draws it
ROUND_AREA = 16 * math.sin(math.pi / 16)


def _area(c: str = "geom", digits: int = 4):
    return (F.round(G.area(c), digits) + 0.0).alias("area")


@query(
    "f1_reproject_points",
    ctes("sites")
    + f""", r as (select *, sin(radians(lat)) as s from sites)
         select id, round({project.A} * radians(lon), 3) as x3857,
           round({project.A} * ln(tan(pi()/4 + radians(lat)/2)), 3) as y3857,
           round({project.A * project.EA_SCALE} * radians(lon), 3) as x6933,
           round({project.A / (2 * project.EA_SCALE)} * {1 - project.E2} * (s/(1 - {project.E2}*s*s)
             - ln((1 - {project.ECC}*s)/(1 + {project.ECC}*s))/{2 * project.ECC}), 3) as y6933
         from r""",
)
def reproject_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = layer(spark, sf_dir, "sites")
    for code in (3857, 6933):
        out = process.reproject_points(out, 4326, code, "lon", "lat", (f"x{code}", f"y{code}"))
    return out.select("id", *[(F.round(c, 3) + 0.0).alias(c) for c in ("x3857", "y3857", "x6933", "y6933")])


@query(
    "f1_reproject_layer",
    ctes("footprints")
    + f"""select id, round({project.A} * radians(x0), 3) as xmin, round({project.A} * radians(x1), 3) as xmax,
           round({project.A} * ln(tan(pi()/4 + radians(y0)/2)), 3) as ymin,
           round({project.A} * ln(tan(pi()/4 + radians(y1)/2)), 3) as ymax,
           round(x0, 6) as back_x, round(y0, 6) as back_y
         from footprints""",
)
def reproject_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons to web mercator, and back again for the check columns."""
    flat = process.reproject_layer(layer(spark, sf_dir, "footprints", geom=True), 4326, 3857)
    back = flat.withColumn("back", project.transform_geometry("geom", 3857, 4326))
    box, home = G.bounds("geom"), G.bounds("back")
    return back.select(
        "id",
        *[(F.round(box[k], 3) + 0.0).alias(k) for k in box],
        (F.round(home["xmin"], 6) + 0.0).alias("back_x"),
        (F.round(home["ymin"], 6) + 0.0).alias("back_y"),
    )


def _series(outer: str, inner: str) -> str:
    """Terms of the UTM series, as SQL: the sum of c * outer(2j xi) * inner(2j eta)."""
    return " + ".join(
        f"{c!r} * {outer}({2 * j} * xi) * {inner}({2 * j} * eta)" for j, c in enumerate(project.ALPHA, 1)
    )


@query(
    "f1_reproject_utm",
    ctes("sites")
    + f""", s as (select id, lon / 60 as dlon, abs(lat) as lat from sites),
          t as (select id, radians(dlon) as lam, sinh(atanh(sin(radians(lat)))
                  - {project.ECC!r} * atanh({project.ECC!r} * sin(radians(lat)))) as t from s),
          u as (select id, atan2(t, cos(lam)) as xi, asinh(sin(lam) / sqrt(t*t + cos(lam)*cos(lam))) as eta from t)
          select id, round({project.UTM_RADIUS!r} * (eta + {_series("cos", "sinh")}) + 500000, 2) as east,
            round({project.UTM_RADIUS!r} * (xi + {_series("sin", "cosh")}), 2) as north, true as closes
          from u""",
)
def reproject_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites moved into zone 32's strip, to UTM 32632 and back; the error is below a millimetre."""
    strip = layer(spark, sf_dir, "sites").select(
        "id", (F.lit(9.0) + F.col("lon") / 60).alias("lon"), F.abs("lat").alias("lat")
    )
    utm = process.reproject_points(strip, 4326, 32632, "lon", "lat", ("east", "north"))
    back = process.reproject_points(utm, 32632, 4326, "east", "north", ("lon2", "lat2"))
    off = G.haversine("lon", "lat", "lon2", "lat2")
    return back.select("id", F.round("east", 2).alias("east"), F.round("north", 2).alias("north"), (off < 0.001).alias("closes"))


@query(
    "f2_buffer_layer",
    ctes("sites") + f"select id, round(cast({ROUND_AREA} as double) * (1 + id % 5) * (1 + id % 5), 4) as area, 33 as vertices from sites",
)
def buffer_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = process.buffer_layer(layer(spark, sf_dir, "sites", geom=True), 1 + F.col("id") % 5)
    return grown.select("id", _area(), G.vertex_count("geom").alias("vertices"))


@query(
    "f3_clip_layer",
    ctes("footprints", "zones")
    + f"""select a.id as id, count(*) as pieces, round(sum({CUT_AREA}), 4) as area
          from footprints a join zones b on {MEET} group by a.id""",
)
def clip_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = process.clip_layer(
        layer(spark, sf_dir, "footprints", geom=True), layer(spark, sf_dir, "zones", geom=True), a_box=BOX, b_box=BOX
    )
    return cut.groupBy("id").agg(F.count("*").alias("pieces"), F.round(F.sum(G.area("geom")), 4).alias("area"))


@query(
    "f4_overlay_intersect",
    ctes("footprints", "zones")
    + f"""select a.id as id, b.id as zone, a.segment as segment, b.name as zone_name, round({CUT_AREA}, 4) as area
          from footprints a join zones b on {MEET}""",
)
def overlay_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = process.overlay_intersect(
        layer(spark, sf_dir, "footprints", geom=True), layer(spark, sf_dir, "zones", geom=True),
        prefix="zone_", a_box=BOX, b_box=BOX,
    )
    return pieces.select("id", F.col("zone_id").alias("zone"), "segment", "zone_name", _area())


@query(
    "f5_erase",
    ctes("footprints", "zones")
    + f""", gone as (select a.id as id, sum({CUT_AREA}) as area from footprints a
                     join (select * from zones where region = 0) b on {MEET} group by a.id),
          rest as (select f.id as id, round((f.x1-f.x0)*(f.y1-f.y0) - coalesce(g.area, 0), 4) as area
                   from footprints f left join gone g on f.id = g.id)
          select id, area from rest where area > 0""",
)
def erase(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = layer(spark, sf_dir, "zones", geom=True).where("region = 0")
    rest = process.erase(layer(spark, sf_dir, "footprints", geom=True), zones, "id", a_box=BOX, b_box=BOX)
    return rest.select("id", _area())


@query(
    "f6_overlay_union",
    ctes("parcels", "zones")
    + f""", pairs as (select a.id as id, b.id as zone, {CUT_AREA} as area from parcels a join zones b on {MEET}),
          left_a as (select f.id as id, cast(null as int) as zone,
                       round((f.x1-f.x0)*(f.y1-f.y0) - coalesce(sum(p.area), 0), 4) as area
                     from parcels f left join pairs p on f.id = p.id group by f.id, f.x0, f.y0, f.x1, f.y1),
          left_b as (select cast(null as bigint) as id, f.id as zone,
                       round((f.x1-f.x0)*(f.y1-f.y0) - coalesce(sum(p.area), 0), 4) as area
                     from zones f left join pairs p on f.id = p.zone group by f.id, f.x0, f.y0, f.x1, f.y1)
          select id, zone, round(area, 4) as area from pairs
          union all select * from left_a where area > 0
          union all select * from left_b where area > 0""",
)
def overlay_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels with zones; parcels do not overlap, so plain sums give every leftover area."""
    pieces = process.overlay_union(
        layer(spark, sf_dir, "parcels", geom=True), layer(spark, sf_dir, "zones", geom=True),
        "id", "id", prefix="zone_", a_box=BOX, b_box=BOX,
    )
    return pieces.select("id", F.col("zone_id").alias("zone"), _area())


@query(
    "f7_dissolve",
    ctes("parcels")
    + """select brand, cast(count(*) as double) as area, min(x0) as xmin, min(y0) as ymin, max(x1) as xmax, max(y1) as ymax
         from parcels group by brand""",
)
def dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = process.dissolve(layer(spark, sf_dir, "parcels", geom=True), ["brand"])
    box = [v.alias(k) for k, v in G.bounds("geom").items()]
    return merged.select("brand", _area(), *box)


@query(
    "f7_dissolve_perimeter",
    ctes("parcels")
    + """, shared as (select a.brand as brand, count(*) as n from parcels a join parcels b
           on a.brand = b.brand and a.id <> b.id and abs(a.x0 - b.x0) + abs(a.y0 - b.y0) = 1 group by a.brand),
         own as (select brand, count(*) as n from parcels group by brand)
         select o.brand as brand, cast(4 * o.n - coalesce(s.n, 0) as double) as perimeter
         from own o left join shared s on o.brand = s.brand""",
)
def dissolve_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Borders between parcels of one brand must be gone; the small cap forces tiling."""
    merged = process.dissolve(layer(spark, sf_dir, "parcels", geom=True), ["brand"], cap=50)
    return merged.select("brand", F.round(G.perimeter("geom"), 4).alias("perimeter"))


@query(
    "f8_collect_layer",
    ctes("footprints")
    + "select segment, count(*) as members, round(sum((x1-x0)*(y1-y0)), 4) as area from footprints group by segment",
)
def collect_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = process.collect_layer(layer(spark, sf_dir, "footprints", geom=True), ["segment"])
    return packed.select("segment", "members", F.round(G.area("geom"), 4).alias("area"))


@query(
    "f9_layer_extent",
    ctes("footprints")
    + """select segment, round(min(x0), 6) as xmin, round(min(y0), 6) as ymin, round(max(x1), 6) as xmax, round(max(y1), 6) as ymax
         from footprints group by segment""",
)
def layer_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = process.layer_extent(layer(spark, sf_dir, "footprints", geom=True), ["segment"])
    return out.select("segment", *[F.round(c, 6).alias(c) for c in joins.BOX])


@query(
    "f10_simplify_layer",
    ctes("tracks")
    + """select track, cast(count(*) as int) as vertices, arg_min(lon, seq) as start_x, arg_min(lat, seq) as start_y,
           arg_max(lon, seq) as end_x, arg_max(lat, seq) as end_y, true as thinner, true as shorter
         from tracks group by track having count(*) > 1""",
)
def simplify_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thinned line keeps its ends and gains no vertex and no length."""
    lines = process.make_lines(layer(spark, sf_dir, "tracks", spread=True), ["track"], ["seq"])
    lines = lines.where("geom is not null").withColumn("old", F.col("geom"))
    thin = process.simplify_layer(lines, 3.0)
    ends = {
        "start_x": G.x(G.start_point("geom")), "start_y": G.y(G.start_point("geom")),
        "end_x": G.x(G.end_point("geom")), "end_y": G.y(G.end_point("geom")),
    }
    return thin.select(
        "track", "vertices", *[c.alias(n) for n, c in ends.items()],
        (G.vertex_count("geom") <= F.col("vertices")).alias("thinner"),
        (G.length("geom") <= G.length("old") + 1e-9).alias("shorter"),
    )


@query("f11_centroids", ctes("footprints") + "select id, round((x0+x1)/2, 6) as x, round((y0+y1)/2, 6) as y from footprints")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    middles = process.centroids(layer(spark, sf_dir, "footprints", geom=True))
    return middles.select("id", *[(F.round(f("geom"), 6) + 0.0).alias(n) for n, f in (("x", G.x), ("y", G.y))])


@query(
    "f12_hulls",
    ctes("tracks")
    + """select track, min(lon) as xmin, min(lat) as ymin, max(lon) as xmax, max(lat) as ymax, true as is_valid
         from tracks group by track""",
)
def hulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hull of a track's points reaches exactly as far as they do."""
    around = process.hulls(layer(spark, sf_dir, "tracks", geom=True), ["track"])
    box = [v.alias(k) for k, v in G.bounds("geom").items()]
    return around.select("track", *box, G.is_valid("geom").alias("is_valid"))


@query(
    "f13_measure_layer",
    ctes("footprints", "tracks")
    + """, steps as (
           select track, lon - lag(lon) over w as dx, lat - lag(lat) over w as dy, count(*) over (partition by track) as n
           from tracks window w as (partition by track order by seq))
         select 'footprint' as layer, id, round((x1-x0)*(y1-y0), 4) as area, cast(0 as double) as length,
                round(2*((x1-x0)+(y1-y0)), 4) as perimeter from footprints
         union all
         select 'track', track, 0, round(sum(coalesce(sqrt(dx*dx + dy*dy), 0)), 4), 0 from steps where n > 1 group by track""",
)
def measure_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = layer(spark, sf_dir, "footprints", geom=True).select(F.lit("footprint").alias("layer"), "id", "geom")
    lines = process.make_lines(layer(spark, sf_dir, "tracks"), ["track"], ["seq"]).where("geom is not null")
    both = boxes.union(lines.select(F.lit("track").alias("layer"), F.col("track").alias("id"), "geom"))
    sizes = process.measure_layer(both)
    return sizes.select("layer", "id", *[F.round(c, 4).alias(c) for c in ("area", "length", "perimeter")])


@query(
    "f14_grid_bin",
    ctes("tracks")
    + """select round(lon/2)*2 as cell_x, round(lat/2)*2 as cell_y, count(*) as n, count(distinct track) as tracks
         from tracks group by round(lon/2)*2, round(lat/2)*2""",
)
def grid_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [F.count("*").alias("n"), F.count_distinct("track").alias("tracks")]
    return process.grid_bin(layer(spark, sf_dir, "tracks"), 2.0, aggs)


@query(
    "f14_grid_bin_floor",
    ctes("sites")
    + """select floor(lon/10)*10 as cell_x, floor(lat/10)*10 as cell_y, count(*) as n, round(avg(acctbal), 3) as balance
         from sites group by floor(lon/10)*10, floor(lat/10)*10""",
)
def grid_bin_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [F.count("*").alias("n"), F.round(F.avg("acctbal"), 3).alias("balance")]
    return process.grid_bin(layer(spark, sf_dir, "sites"), 10.0, aggs, snap="floor")


@query(
    "f15_snap_layer",
    ctes("sites", "parcels")
    + """select 'site' as layer, id, round(lon/5)*5 as x, round(lat/5)*5 as y, cast(0 as double) as area from sites
         union all select 'parcel', id, x0, y0, 1 from parcels""",
)
def snap_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by column arithmetic; slightly shifted parcels back onto their grid."""
    sites = process.snap_points(layer(spark, sf_dir, "sites"), 5.0, "lon", "lat")
    nudged = layer(spark, sf_dir, "parcels").select(
        "id", G.envelope(F.col("x0") + 0.01, F.col("y0") - 0.02, F.col("x1") + 0.03, F.col("y1") + 0.01).alias("geom")
    )
    snapped = process.snap_layer(nudged, 1.0)
    box = G.bounds("geom")
    return sites.select(
        F.lit("site").alias("layer"), "id", (F.col("lon") + 0.0).alias("x"), (F.col("lat") + 0.0).alias("y"), F.lit(0.0).alias("area")
    ).union(snapped.select(F.lit("parcel"), "id", box["xmin"] + 0.0, box["ymin"] + 0.0, G.area("geom")))


@query(
    "f16_buffer_and_select",
    ctes("sites", "zones")
    + f""", m as (select id, {project.A} * radians(lon) as x, {project.A} * ln(tan(pi()/4 + radians(lat)/2)) as y from sites),
          z as (select id, {project.A} * radians(x0) as x0, {project.A} * radians(x1) as x1,
                  {project.A} * ln(tan(pi()/4 + radians(y0)/2)) as y0, {project.A} * ln(tan(pi()/4 + radians(y1)/2)) as y1
                from zones where region = 1)
          select m.id as id, z.id as zone, 'Polygon' as kind from m join z
            on greatest(z.x0 - m.x, m.x - z.x1, 0) * greatest(z.x0 - m.x, m.x - z.x1, 0)
             + greatest(z.y0 - m.y, m.y - z.y1, 0) * greatest(z.y0 - m.y, m.y - z.y1, 0) <= 150000.0 * 150000.0""",
)
def buffer_and_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = layer(spark, sf_dir, "zones", geom=True).where("region = 1").select("id", "geom")
    sites = layer(spark, sf_dir, "sites", geom=True).select("id", "geom")
    near = process.buffer_and_select(sites, 150_000, zones, metric=3857)
    return near.select("id", F.col("b_id").alias("zone"), F.get_json_object("geojson", "$.type").alias("kind"))
