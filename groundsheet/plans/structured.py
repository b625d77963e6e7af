"""Structured single-layer queries and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.layer import Layer
from groundsheet.operators import describe
from groundsheet.operators.query import query_data
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer, table


def _lineitem(spark: SparkSession, sf_dir: str) -> Layer:
    return Layer("lineitem", table(spark, sf_dir, "lineitem"))


def _sites(spark: SparkSession, sf_dir: str) -> Layer:
    return Layer("sites", layer(spark, sf_dir, "sites", geom=True), "geom", box=("lon", "lat", "lon", "lat"))


def _footprints(spark: SparkSession, sf_dir: str) -> Layer:
    return Layer("footprints", layer(spark, sf_dir, "footprints", geom=True), "geom", box=("x0", "y0", "x1", "y1"))


def _field(name: str, kind: str, hint: str) -> str:
    samples = f"(select string_agg(cast({name} as varchar), '|' order by id) from (select * from sites order by id limit 3))"
    return f"select '{name}' as name, '{kind}' as type, '{name}' as alias, '{hint}' as \"fieldValueType\", {samples} as samples, false as \"isGeometry\""


@query(
    "c1_describe_layer",
    ctes("sites")
    + " union all ".join([
        _field("id", "bigint", "countOrAmount"), _field("name", "string", "nameOrTitle"), _field("segment", "string", "text"),
        _field("acctbal", "double", "countOrAmount"), _field("lon", "double", "countOrAmount"), _field("lat", "double", "countOrAmount"),
        "select 'geom', 'binary', 'geom', 'text', '', true",
    ]),
)
def describe_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = describe.describe_layer(_sites(spark, sf_dir), order_by="id")
    return rows.withColumn("samples", F.array_join("sampleValues", "|")).drop("sampleValues")


@query(
    "c2_layer_summary",
    ctes("footprints")
    + """select count(*) as records, 'POLYGON' as kinds, round(min(x0), 6) as xmin, round(min(y0), 6) as ymin,
         round(max(x1), 6) as xmax, round(max(y1), 6) as ymax, 4326 as "spatialReference" from footprints""",
)
def layer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = describe.layer_summary(_footprints(spark, sf_dir))
    box = [F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    return out.select("records", F.array_join("geometryTypes", ",").alias("kinds"), *box, "spatialReference")


@query("c3_project_fields", "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem")
def project_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = "l_orderkey, l_linenumber, l_quantity, l_returnflag"
    return query_data(_lineitem(spark, sf_dir), out_fields=fields, page_size=None).records


@query(
    "c4_attribute_filter",
    """select l_orderkey, l_linenumber, l_extendedprice from lineitem
       where l_quantity between 10 and 20 and l_returnflag in ('R', 'A') and l_discount >= 0.05""",
)
def attribute_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_data(
        _lineitem(spark, sf_dir),
        where="l_quantity between 10 and 20 and l_returnflag in ('R', 'A') and l_discount >= 0.05",
        out_fields="l_orderkey, l_linenumber, l_extendedprice",
        page_size=None,
    ).records


@query(
    "c5_spatial_filter",
    ctes("footprints")
    + """select id, segment from footprints
         where x0 <= 60 and x1 >= -30 and y0 <= 45 and y1 >= -10 and segment <> 'MACHINERY'""",
)
def spatial_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_data(
        _footprints(spark, sf_dir),
        where="segment <> 'MACHINERY'",
        geometry={"xmin": -30, "ymin": -10, "xmax": 60, "ymax": 45},
        out_fields="id, segment",
        page_size=None,
    ).records


@query(
    "c5_spatial_filter_within",
    ctes("footprints")
    + "select id, segment from footprints where x1 <= 60 and x0 >= -30 and y1 <= 45 and y0 >= -10",
)
def spatial_filter_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_data(
        _footprints(spark, sf_dir),
        geometry={"rings": [[[-30, -10], [60, -10], [60, 45], [-30, 45], [-30, -10]]]},
        spatial_rel="esriSpatialRelWithin",
        out_fields="id, segment",
        page_size=None,
    ).records


@query(
    "c6_buffered_filter",
    ctes("sites")
    + """, polar as (
           select id, name, sqrt((lon-10)*(lon-10) + (lat-20)*(lat-20)) as r, atan2(lat-20, lon-10) as th from sites)
         select id, name from polar
         where r * cos(th - floor(th / (pi()/16)) * (pi()/16) - pi()/32) <= 35 * cos(pi()/32)""",
)
def buffered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 35-degree buffer of a point: a 32-sided polygon, as the check spells out."""
    return query_data(
        _sites(spark, sf_dir),
        geometry={"x": 10, "y": 20},
        buffer_distance=35,
        out_fields="id, name",
        page_size=None,
    ).records


STATS = [("avg", "l_quantity"), ("min", "l_discount"), ("max", "l_extendedprice"), ("sum", "l_quantity"),
         ("count", "l_tax"), ("stddev", "l_extendedprice"), ("var", "l_quantity")]
STATS_SQL = """round(avg(l_quantity), 3) as avg_l_quantity, round(min(l_discount), 3) as min_l_discount,
    round(max(l_extendedprice), 3) as max_l_extendedprice, round(sum(l_quantity), 3) as sum_l_quantity,
    count(l_tax) as count_l_tax, round(stddev(l_extendedprice), 3) as stddev_l_extendedprice,
    round(variance(l_quantity), 3) as var_l_quantity"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 3).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("c7_statistics", f"select l_returnflag, l_linestatus, {STATS_SQL} from lineitem group by l_returnflag, l_linestatus")
def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(query_data(_lineitem(spark, sf_dir), statistics=STATS, group_by="l_returnflag, l_linestatus").records)


@query(
    "c8_ordered_page",
    """select l_orderkey, l_linenumber, l_extendedprice from lineitem
       order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 500""",
)
def ordered_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_data(
        _lineitem(spark, sf_dir),
        out_fields="l_orderkey, l_linenumber, l_extendedprice",
        order_by_fields="l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey",
        page_size=500,
    ).records


@query(
    "c9_paging",
    "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' order by o_orderkey limit 5000 offset 2000",
)
def paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_data(
        Layer("orders", table(spark, sf_dir, "orders")),
        where="o_orderstatus = 'F'",
        out_fields="o_orderkey, o_totalprice",
        order_by_fields="o_orderkey",
        page_size=5000,
        record_offset=2000,
    ).records


@query(
    "c10_total_matches",
    ctes("sites")
    + """select count(*) as "totalMatchingRecords" from sites
         where acctbal > 1000 and lon between -100 and 100 and lat between -50 and 50""",
)
def total_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_data(
        _sites(spark, sf_dir),
        where="acctbal > 1000",
        geometry={"xmin": -100, "ymin": -50, "xmax": 100, "ymax": 50},
        page_size=10,
    ).total


@query(
    "c11_return_geometry",
    ctes("sites") + "select id, segment, 'Point' as kind, round(lon, 9) as x, round(lat, 9) as y from sites order by id limit 1000 offset 300",
)
def return_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = query_data(
        _sites(spark, sf_dir),
        out_fields="id, segment",
        order_by_fields="id",
        page_size=1000,
        record_offset=300,
        return_geometry=True,
    ).records
    part = lambda at: F.get_json_object("geometry", at)
    return page.select(
        "id",
        "segment",
        part("$.type").alias("kind"),
        F.round(part("$.coordinates[0]").cast("double"), 9).alias("x"),
        F.round(part("$.coordinates[1]").cast("double"), 9).alias("y"),
    )
