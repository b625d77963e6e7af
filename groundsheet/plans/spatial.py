"""Joins by place and distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.operators import joins, sphere
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer, table

BOX = ("x0", "y0", "x1", "y1")
OVERLAP = "a.x0 <= b.x1 and a.x1 >= b.x0 and a.y0 <= b.y1 and a.y1 >= b.y0"
COVERS = "a.x0 <= b.x0 and a.x1 >= b.x1 and a.y0 <= b.y0 and a.y1 >= b.y1"
INTERIOR = "a.x0 < b.x1 and a.x1 > b.x0 and a.y0 < b.y1 and a.y1 > b.y0"
SELF = " from footprints a join footprints b on "


def _pairs(spark: SparkSession, sf_dir: str, predicate: str) -> DataFrame:
    shapes = layer(spark, sf_dir, "footprints", geom=True)
    return joins.spatial_join(shapes, shapes, predicate, a_box=BOX, b_box=BOX)


@query(
    "d1_spatial_join",
    ctes("footprints") + f"select a.id as id, b.id as other, a.segment as segment, b.segment as other_segment{SELF}{OVERLAP} where a.id < b.id",
)
def spatial_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir, "intersects").where("id < b_id")
    return pairs.selectExpr("id", "b_id as other", "segment", "b_segment as other_segment")


@query("d1_contains", ctes("footprints") + f"select a.id as id, b.id as other{SELF}{COVERS} where a.id <> b.id")
def contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "contains").where("id <> b_id").selectExpr("id", "b_id as other")


@query("d1_within", ctes("footprints") + f"select b.id as id, a.id as other{SELF}{COVERS}")
def within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "within").selectExpr("id", "b_id as other")


@query("d1_covers", ctes("footprints") + f"select a.id as id, b.id as other{SELF}{COVERS}")
def covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "covers").selectExpr("id", "b_id as other")


@query("d1_covered_by", ctes("footprints") + f"select b.id as id, a.id as other{SELF}{COVERS} where a.id <> b.id")
def covered_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "covered_by").where("id <> b_id").selectExpr("id", "b_id as other")


@query(
    "d1_overlaps",
    ctes("footprints")
    + f"""select a.id as id, b.id as other{SELF}{INTERIOR} where not ({COVERS})
          and not (b.x0 <= a.x0 and b.x1 >= a.x1 and b.y0 <= a.y0 and b.y1 >= a.y1)""",
)
def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "overlaps").selectExpr("id", "b_id as other")


@query("d1_equals", ctes("footprints") + f"select a.id as id, b.id as other{SELF}a.x0 = b.x0 and a.x1 = b.x1 and a.y0 = b.y0 and a.y1 = b.y1")
def equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "equals").selectExpr("id", "b_id as other")


@query(
    "d1_touches",
    ctes("parcels")
    + f"select a.id as id, b.id as other from parcels a join parcels b on {OVERLAP} where a.id <> b.id",
)
def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit parcels on a grid meet their neighbours in borders and corners only."""
    shapes = layer(spark, sf_dir, "parcels", geom=True)
    pairs = joins.spatial_join(shapes, shapes, "touches", a_box=BOX, b_box=BOX)
    return pairs.selectExpr("id", "b_id as other")


@query(
    "d1_crosses",
    ctes("footprints", "zones")
    + """select f.id as id, z.id as other from footprints f join zones z
         on f.x0 < z.x1 and f.x1 > z.x0 and (f.y0 + f.y1) / 2 > z.y0 and (f.y0 + f.y1) / 2 < z.y1
         where f.x0 < z.x0 or f.x1 > z.x1""",
)
def crosses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizontal middle lines of footprints against zones, found without box columns."""
    from groundsheet.functions import geometry as G

    middle = F.expr("concat('LINESTRING(', x0, ' ', (y0 + y1) / 2, ', ', x1, ' ', (y0 + y1) / 2, ')')")
    lines = layer(spark, sf_dir, "footprints").select("id", G.from_wkt(middle).alias("geom"))
    zones = layer(spark, sf_dir, "zones", geom=True).select("id", "geom")
    return joins.spatial_join(lines, zones, "crosses").selectExpr("id", "b_id as other")


@query(
    "d2_point_in_polygon",
    ctes("sites", "zones")
    + """select s.id as id, z.id as zone, z.name as zone_name from sites s
         join zones z on s.lon between z.x0 and z.x1 and s.lat between z.y0 and z.y1""",
)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = joins.point_in_polygon(
        layer(spark, sf_dir, "sites"), layer(spark, sf_dir, "zones", geom=True), box=BOX, prefix="zone_"
    )
    return found.selectExpr("id", "zone_id as zone", "zone_name")


@query(
    "d3_distance_join",
    ctes("sites", "depots")
    + """, pairs as (
           select s.id as id, d.id as depot,
                  sqrt((s.lon-d.lon)*(s.lon-d.lon) + (s.lat-d.lat)*(s.lat-d.lat)) as distance
           from sites s, depots d)
         select id, depot, round(distance, 6) as distance from pairs where distance <= 6""",
)
def distance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    xy = ("lon", "lat")
    near = joins.distance_join(layer(spark, sf_dir, "sites"), layer(spark, sf_dir, "depots"), 6.0, a_xy=xy, b_xy=xy)
    return near.select("id", F.col("b_id").alias("depot"), F.round("distance", 6).alias("distance"))


@query(
    "d3_distance_join_shapes",
    ctes("sites", "zones")
    + """, pairs as (
           select s.id as id, z.id as zone,
                  greatest(z.x0 - s.lon, s.lon - z.x1, 0) as dx, greatest(z.y0 - s.lat, s.lat - z.y1, 0) as dy
           from sites s, zones z)
         select id, zone, round(sqrt(dx*dx + dy*dy), 6) as distance from pairs where sqrt(dx*dx + dy*dy) <= 4""",
)
def distance_join_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = joins.distance_join(
        layer(spark, sf_dir, "sites"), layer(spark, sf_dir, "zones", geom=True), 4.0, a_xy=("lon", "lat")
    )
    return near.select("id", F.col("b_id").alias("zone"), F.round("distance", 6).alias("distance"))


@query(
    "d3_distance_join_metres",
    ctes("sites", "depots")
    + """, halves as (
           select s.id as id, d.id as depot,
                  power(sin(radians(s.lat - d.lat) / 2), 2)
                  + cos(radians(s.lat)) * cos(radians(d.lat)) * power(sin(radians(s.lon - d.lon) / 2), 2) as h
           from sites s, depots d)
         select id, depot, round(2 * 6371008.8 * asin(sqrt(h)), 2) as metres from halves
         where 2 * 6371008.8 * asin(sqrt(least(h, 1))) <= 750000""",
)
def distance_join_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = sphere.distance_join_metres(layer(spark, sf_dir, "sites"), layer(spark, sf_dir, "depots"), 750_000)
    return near.select("id", F.col("b_id").alias("depot"), F.round("metres", 2).alias("metres"))


@query(
    "d4_nearest",
    ctes("sites", "depots")
    + """, ranked as (
           select s.id as id, d.id as depot, (s.lon-d.lon)*(s.lon-d.lon) + (s.lat-d.lat)*(s.lat-d.lat) as d2,
                  row_number() over (partition by s.id order by
                    (s.lon-d.lon)*(s.lon-d.lon) + (s.lat-d.lat)*(s.lat-d.lat), d.id) as rank
           from sites s, depots d)
         select id, depot, round(sqrt(d2), 6) as distance, rank from ranked where rank <= 3""",
)
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = joins.nearest(layer(spark, sf_dir, "sites", spread=True), layer(spark, sf_dir, "depots"), 3)
    return found.select("id", F.col("b_id").alias("depot"), F.round("distance", 6).alias("distance"), "rank")


@query(
    "d4_nearest_shapes",
    ctes("depots", "footprints")
    + """, far as (
           select d.id as id, greatest(f.x0 - d.lon, d.lon - f.x1, 0) as dx, greatest(f.y0 - d.lat, d.lat - f.y1, 0) as dy
           from depots d, footprints f),
         ranked as (select id, sqrt(dx*dx + dy*dy) as distance,
                      row_number() over (partition by id order by dx*dx + dy*dy) as rank from far)
         select id, round(distance, 6) as distance, rank from ranked where rank <= 3""",
)
def nearest_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances to the three nearest footprints; which of equally near ones is named is left to tests."""
    footprints = layer(spark, sf_dir, "footprints", geom=True).select("id", "geom")
    found = joins.nearest(layer(spark, sf_dir, "depots"), footprints, 3, b_xy=None)
    return found.select("id", F.round("distance", 6).alias("distance"), "rank")


NEAR_DEPOT = f"""exists (select 1 from depots d where d.lon between f.x0 and f.x1 and d.lat between f.y0 and f.y1)"""


def _depot_cover(spark: SparkSession, sf_dir: str):
    return (
        layer(spark, sf_dir, "footprints", geom=True),
        layer(spark, sf_dir, "depots", geom=True),
        {"a_box": BOX, "b_box": ("lon", "lat", "lon", "lat")},
    )


@query("d5_spatial_semi", ctes("footprints", "depots") + f"select id, segment from footprints f where {NEAR_DEPOT}")
def spatial_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, box = _depot_cover(spark, sf_dir)
    return joins.spatial_semi(a, b, "id", **box).select("id", "segment")


@query("d5_spatial_anti", ctes("footprints", "depots") + f"select id, segment from footprints f where not {NEAR_DEPOT}")
def spatial_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, box = _depot_cover(spark, sf_dir)
    return joins.spatial_anti(a, b, "id", **box).select("id", "segment")


@query(
    "d6_distance_pairs",
    ctes("sites", "depots")
    + """select l.l_orderkey as l_orderkey, l.l_linenumber as l_linenumber, o.o_custkey as site, l.l_suppkey as depot,
           round(sqrt((s.lon-d.lon)*(s.lon-d.lon) + (s.lat-d.lat)*(s.lat-d.lat)), 6) as distance,
           round(2*6371008.8*asin(sqrt(least(1, sin(radians(d.lat-s.lat)/2)*sin(radians(d.lat-s.lat)/2)
             + cos(radians(s.lat))*cos(radians(d.lat))*sin(radians(d.lon-s.lon)/2)*sin(radians(d.lon-s.lon)/2))))/1000, 2) as km
         from lineitem l join orders o on l.l_orderkey = o.o_orderkey
         join sites s on s.id = o.o_custkey join depots d on d.id = l.l_suppkey""",
)
def distance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each order line's customer site to its supplier's depot."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("depot"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("site"))
    sites = layer(spark, sf_dir, "sites").withColumnRenamed("id", "site")
    depots = layer(spark, sf_dir, "depots").withColumnRenamed("id", "depot")
    xy = ("lon", "lat")
    out = joins.distance_pairs(sites, depots, lines.join(orders, "l_orderkey"), a_key="site", b_key="depot", a_xy=xy, b_xy=xy)
    return out.select(
        "l_orderkey", "l_linenumber", "site", "depot",
        F.round("distance", 6).alias("distance"), F.round(F.col("metres") / 1000, 2).alias("km"),
    )


@query(
    "d6_distance_pairs_shapes",
    ctes("footprints", "depots")
    + """select o.o_orderkey as o_orderkey, l.l_linenumber as l_linenumber,
           round(sqrt(pow(greatest(f.x0 - d.lon, d.lon - f.x1, 0), 2) + pow(greatest(f.y0 - d.lat, d.lat - f.y1, 0), 2)), 6) as distance
         from lineitem l join orders o on l.l_orderkey = o.o_orderkey
         join footprints f on f.id = o.o_custkey join depots d on d.id = l.l_suppkey""",
)
def distance_pairs_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each order line's customer footprint to its supplier's depot."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_suppkey").alias("depot"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("footprint"))
    footprints = layer(spark, sf_dir, "footprints", geom=True).withColumnRenamed("id", "footprint")
    depots = layer(spark, sf_dir, "depots").withColumnRenamed("id", "depot")
    out = joins.distance_pairs(
        footprints, depots, lines.join(orders, "o_orderkey"), a_key="footprint", b_key="depot", b_xy=("lon", "lat")
    )
    return out.select("o_orderkey", "l_linenumber", F.round("distance", 6).alias("distance"))


@query(
    "d7_aggregate_in_polygons",
    ctes("sites", "zones")
    + """select z.id as id, z.name as name, count(s.id) as accounts, round(coalesce(sum(s.acctbal), 0), 2) as balance
         from zones z left join sites s on s.lon between z.x0 and z.x1 and s.lat between z.y0 and z.y1
         group by z.id, z.name""",
)
def aggregate_in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts and balance per zone; zones are boxes, so no geometry is decoded."""
    aggs = [F.count("*").alias("accounts"), F.sum("acctbal").alias("balance")]
    out = joins.aggregate_in_polygons(
        layer(spark, sf_dir, "sites"), layer(spark, sf_dir, "zones"), "id", aggs, geom=None, box=BOX
    )
    return out.select(
        "id", "name",
        F.coalesce("accounts", F.lit(0)).alias("accounts"),
        F.round(F.coalesce("balance", F.lit(0.0)), 2).alias("balance"),
    )
