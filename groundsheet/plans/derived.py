"""Map layers derived from the given tables, as SQL text that Spark and DuckDB both run.

The tables carry no geometry, so positions are computed from keys.  Coordinates are
degrees (EPSG:4326) unless a column says otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from groundsheet.functions import geometry as G
from groundsheet.operators import lineage

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

SQL = {
    "sites": """
        select c_custkey as id, c_name as name, c_mktsegment as segment, c_acctbal as acctbal,
               cast((c_custkey*7919)%36000 as double)/100 - 180 as lon,
               cast((c_custkey*104729)%16000 as double)/100 - 80 as lat
        from customer""",
    "depots": """
        select s_suppkey as id, s_name as name, s_acctbal as acctbal,
               cast((s_suppkey*15485863)%36000 as double)/100 - 180 as lon,
               cast((s_suppkey*32452843)%16000 as double)/100 - 80 as lat
        from supplier""",
    "zones": """
        select n_nationkey as id, n_name as name, n_regionkey as region,
               cast(-180 + 72*(n_nationkey%5) as double) as x0,
               cast(-80 + 32*cast(floor(n_nationkey/5) as int) as double) as y0,
               cast(-108 + 72*(n_nationkey%5) as double) as x1,
               cast(-48 + 32*cast(floor(n_nationkey/5) as int) as double) as y1
        from nation""",
    "parcels": """
        select p_partkey as id, p_brand as brand, p_size as size,
               cast(p_partkey%100 as double) as x0,
               cast(cast(floor(p_partkey/100) as int) as double) as y0,
               cast(p_partkey%100 + 1 as double) as x1,
               cast(cast(floor(p_partkey/100) as int) + 1 as double) as y1
        from part""",
    "footprints": """
        select c_custkey as id, c_mktsegment as segment,
               cast((c_custkey*7919)%36000 as double)/100 - 180 - (1 + c_custkey%5) as x0,
               cast((c_custkey*104729)%16000 as double)/100 - 80 - (1 + c_custkey%5) as y0,
               cast((c_custkey*7919)%36000 as double)/100 - 180 + (1 + c_custkey%5) as x1,
               cast((c_custkey*104729)%16000 as double)/100 - 80 + (1 + c_custkey%5) as y1
        from customer""",
    "tracks": """
        select user_id as track, event_id as seq, ts,
               cast((event_id*7919)%3600 as double)/100 as lon,
               cast((event_id*104729)%1800 as double)/100 as lat
        from events""",
    "scenes": """
        select o_orderkey as id, o_orderpriority as collection, o_orderdate as dt,
               (o_orderkey*37)%100 as cloud,
               cast((o_orderkey*7919)%36000 as double)/100 - 180 as x0,
               cast((o_orderkey*104729)%16000 as double)/100 - 80 as y0,
               cast((o_orderkey*7919)%36000 as double)/100 - 178 as x1,
               cast((o_orderkey*104729)%16000 as double)/100 - 78 as y1
        from orders""",
    "pixels": """
        select l_orderkey as scene, l_linenumber as px, l_shipdate as dt,
               l_discount + 0.05e0 as red, l_quantity/50 as nir, l_tax + 0.05e0 as green
        from lineitem""",
    "layer_changes": """
        select concat('layer_', cast(user_id as varchar(20))) as id, event_id as seq,
               case when event_type = 'error' then 'remove'
                    when event_id%3 = 0 then 'style' else 'upsert' end as op,
               event_type as name, value
        from events""",
    "layers": """
        select concat('layer_', cast(n_nationkey as varchar(20))) as id, n_name as name,
               case when n_nationkey%3 = 0 then 'arcgis' else 'geoparquet' end as type,
               case when n_nationkey%3 = 0
                    then concat('https://host/FeatureServer/', cast(n_nationkey as varchar(20)))
                    else concat('s3://bucket/', lower(n_name), '.parquet') end as ref,
               case when n_nationkey%3 = 0 then 'secret' end as token
        from nation""",
}

BOXES = {"zones", "parcels", "footprints", "scenes"}
POINTS = {"sites", "depots", "tracks"}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread`` deals a one-file table over all cores."""
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return lineage.spread(scan) if spread else scan


def view(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> None:
    """Temp view over one given table."""
    table(spark, sf_dir, name, spread).createOrReplaceTempView(name)


def source_table(name: str) -> str:
    """The one given table a layer is derived from."""
    return re.search(r"from (\w+)\s*$", SQL[name]).group(1)


def layer(spark: SparkSession, sf_dir: str, name: str, geom: bool = False, spread: bool = False) -> DataFrame:
    """A derived layer; ``geom=True`` adds the geometry column."""
    view(spark, sf_dir, source_table(name), spread or geom)
    df = spark.sql(SQL[name])
    if geom and name in BOXES:
        df = df.withColumn("geom", G.envelope("x0", "y0", "x1", "y1"))
    elif geom and name in POINTS:
        df = df.withColumn("geom", G.point("lon", "lat"))
    return df


def ctes(*names: str) -> str:
    """``with`` clause giving an oracle query the same layers."""
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in names) + "\n"
