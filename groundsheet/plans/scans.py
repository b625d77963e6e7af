"""Sources and sinks, run on the given tables or on files Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundsheet.functions import geometry as G
from groundsheet.operators import guarded, lineage
from groundsheet.layer import Layer
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer, table
from groundsheet.sources import documents, files


def _places(sf_dir: str) -> files.Places:
    remote = sf_dir.lower().startswith(files.REMOTE)
    return files.Places(url_prefix=sf_dir) if remote else files.Places(local_root=sf_dir)


@query(
    "a1_read_geoparquet",
    "select c_custkey, c_name, c_acctbal from customer where c_acctbal > 0",
)
def read_geoparquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = sf_dir.lower().startswith(files.REMOTE)
    ref = f"{sf_dir}/customer.parquet" if remote else "customer.parquet"
    found = files.read_geoparquet(spark, ref, _places(sf_dir))
    return found.df.where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal")


@query("a2_read_featureset", ctes("sites") + "select id, name, acctbal, lon as x, lat as y from sites")
def read_featureset(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = layer(spark, sf_dir, "sites", spread=True)
    feature = F.struct(
        F.struct("id", "name", "acctbal").alias("attributes"),
        F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("geometry"),
    )
    # a service page holds up to 500 features
    pages = sites.groupBy(F.floor(F.col("id") / 500).alias("page")).agg(
        F.collect_list(feature).alias("features")
    )
    path = lineage.scratch_path(spark, "pages")
    pages.select(F.to_json(F.struct("features"))).write.text(path)
    df = files.read_featureset(spark, path, lines=True).df
    return df.select("id", "name", "acctbal", G.x("geom").alias("x"), G.y("geom").alias("y"))


@query(
    "a3_read_geojson",
    ctes("footprints")
    + """select id, segment, round(x0, 6) as xmin, round(y0, 6) as ymin,
         round(x1, 6) as xmax, round(y1, 6) as ymax from footprints""",
)
def read_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lineage.scratch_path(spark, "features")
    boxes = layer(spark, sf_dir, "footprints", geom=True).select("id", "segment", "geom")
    files.write_geojson(boxes, path)
    fields = T.StructType().add("id", "long").add("segment", "string")
    df = files.read_geojson(spark, path, fields, lines=True).df
    box = {k: F.round(v, 6).alias(k) for k, v in G.bounds("geom").items()}
    return df.select("id", "segment", *box.values())


@query(
    "a3_read_geojson_document",
    ctes("footprints")
    + """select id, segment, round(x0, 6) as xmin, round(y0, 6) as ymin,
         round(x1, 6) as xmax, round(y1, 6) as ymax from footprints""",
)
def read_geojson_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection over many lines in one file, as another program would have saved it."""
    boxes = layer(spark, sf_dir, "footprints", geom=True).select("id", "segment", "geom")
    members = files.geojson_features(boxes).select(F.monotonically_increasing_id().alias("n"), F.concat(F.lit(",\n"), "value").alias("value"))
    ends = spark.createDataFrame([(-2, '{"type": "FeatureCollection", "features": ['), (-1, '{"type": "note"}'), (1 << 62, "]}")], "n long, value string")
    path = lineage.scratch_path(spark, "collection")
    members.union(ends).repartition(1).sortWithinPartitions("n").select("value").write.text(path)
    fields = T.StructType().add("id", "long").add("segment", "string")
    df = documents.read_geojson_documents(spark, path, fields).df
    box = {k: F.round(v, 6).alias(k) for k, v in G.bounds("geom").items()}
    return df.select("id", "segment", *box.values())


@query(
    "a4_attach",
    """select o_orderpriority as priority, count(*) as n, round(sum(o_totalprice), 2) as total
       from orders where o_totalprice > 100000 group by o_orderpriority""",
)
def attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Layer("orders", table(spark, sf_dir, "orders"))
    item = guarded.Attach("big_orders", orders, "o_totalprice > 100000", max_records=None)
    return guarded.spatial_sql(
        spark,
        """select o_orderpriority as priority, count(*) as n, round(sum(o_totalprice), 2) as total
           from big_orders group by o_orderpriority""",
        [item],
        max_rows=None,
    ).df


@query(
    "a5_write_geojson",
    ctes("sites")
    + "select id, 'Feature' as feature, 'Point' as kind, round(lon, 9) as x, round(lat, 9) as y, segment from sites",
)
def write_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lineage.scratch_path(spark, "sites")
    sites = layer(spark, sf_dir, "sites", geom=True).select("id", "segment", "geom")
    files.write_geojson(sites, path)

    def part(at: str, kind: str = "string"):
        return F.get_json_object("value", at).cast(kind)

    return spark.read.text(path).select(
        part("$.properties.id", "long").alias("id"),
        part("$.type").alias("feature"),
        part("$.geometry.type").alias("kind"),
        F.round(part("$.geometry.coordinates[0]", "double"), 9).alias("x"),
        F.round(part("$.geometry.coordinates[1]", "double"), 9).alias("y"),
        part("$.properties.segment").alias("segment"),
    )
