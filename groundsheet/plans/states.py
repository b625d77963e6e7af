"""Layer inventory and keyed layer state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.operators import lineage, registry
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer, view
from groundsheet.streaming import layer_state

# Layers as a map application reports them, with names and paths partly missing.
REPORTED = """select concat('layer_', cast(s_suppkey as varchar(20))) as id,
    case when s_suppkey % 2 = 0 then s_name end as name,
    case s_suppkey % 5 when 0 then concat('/data/', s_name, '.parquet') when 1 then concat('/data/', s_name, '.GeoJSON')
      when 2 then concat('/data/', s_name, '.csv') end as path
    from supplier"""
PATHS = """select p_partkey, concat('/maps/', p_name, case p_partkey % 6 when 0 then '.parquet' when 1 then '.GeoParquet'
      when 2 then '.geojson' when 3 then '.JSON' when 4 then '.gpkg' else '' end) as path,
    case p_partkey % 7 when 0 then 'circle' when 1 then 'line' when 2 then 'fill' when 3 then 'raster'
      when 4 then 'fill-extrusion' when 5 then 'symbol' else 'background' end as style_type
    from part"""
REFS = "select distinct id as ref from layer_changes union all select ref from layers"


@query(
    "l1_layer_inventory",
    ctes("layers")
    + f""", reported as ({REPORTED})
        select r.id as id, coalesce(r.name, k.name, r.id) as name,
          case when r.path like '%.parquet' then 'geoparquet' when r.path like '%.GeoJSON' then 'geojson'
               when r.path is not null then 'file' else coalesce(k.type, 'app') end as source_type,
          coalesce(r.path, k.ref) as source_ref
        from reported r left join layers k on r.id = k.id""",
)
def layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = layer(spark, sf_dir, "layers")
    view(spark, sf_dir, "supplier")
    return registry.layer_inventory(spark.sql(REPORTED), known)


@query(
    "l1_layer_inventory_live",
    ctes("layers")
    + f""", reported as (select id, cast(null as varchar) as name, cast(null as varchar) as path from ({REPORTED}) r)
        select coalesce(r.id, k.id) as id, coalesce(k.name, r.id) as name, coalesce(k.type, 'app') as source_type,
          k.ref as source_ref
        from reported r full join layers k on r.id = k.id""",
)
def layer_inventory_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a layer model only ids are seen; known layers complete the list."""
    known = layer(spark, sf_dir, "layers")
    view(spark, sf_dir, "supplier")
    seen = spark.sql(REPORTED).select("id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("path"))
    return registry.layer_inventory(seen, known, live=True)


@query(
    "l2_classify_source",
    f"""select p_partkey, case p_partkey % 6 when 0 then 'geoparquet' when 1 then 'geoparquet' when 2 then 'geojson'
          when 3 then 'geojson' else 'file' end as source_type,
          case p_partkey % 7 when 0 then 'point' when 1 then 'line' when 2 then 'polygon' when 3 then 'raster'
          when 4 then 'polygon' when 5 then 'point' end as kind
        from ({PATHS}) p""",
)
def classify_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    view(spark, sf_dir, "part")
    return spark.sql(PATHS).select(
        "p_partkey",
        registry.classify_source("path").alias("source_type"),
        registry.geometry_kind("style_type").alias("kind"),
    )


@query(
    "l3_resolve_layer",
    ctes("layers", "layer_changes")
    + f""", refs as ({REFS}), hits as (
          select r.ref as ref, l.ref as found, l.token as token,
            row_number() over (partition by r.ref order by l.id) as rn
          from refs r join layers l on l.id = r.ref or l.ref = r.ref)
        select r.ref as ref, coalesce(h.found, r.ref) as reference, h.token as token
        from refs r left join hits h on h.ref = r.ref and h.rn = 1""",
)
def resolve_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = layer(spark, sf_dir, "layers")
    asked = layer(spark, sf_dir, "layer_changes").select(F.col("id").alias("ref")).distinct()
    return registry.resolve_layer(layers, asked.union(layers.select("ref")))


@query("l4_redact", ctes("layers") + "select id, ref, case when token is not null then '<redacted>' end as token from layers")
def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = layer(spark, sf_dir, "layers").select("id", F.struct("ref", "token").alias("source"))
    return registry.redact(nested, "source.token").select("id", "source.ref", "source.token")


def state_sql(changes: str) -> str:
    """Document after all changes: rows after the layer's last removal, last upsert, later style."""
    return f"""select u.id as id, u.name as name, u.value as value, s.name as style, u.seq as position
        from (select *, row_number() over (partition by id order by seq desc) as rn from {changes} where op = 'upsert') u
        left join (select *, row_number() over (partition by id order by seq desc) as rn from {changes} where op = 'style') s
          on s.id = u.id and s.rn = 1 and s.seq > u.seq
        where u.rn = 1 and not exists (select 1 from {changes} r where r.op = 'remove' and r.id = u.id and r.seq > u.seq)"""


@query("l5_apply_layer_changes", ctes("layer_changes") + state_sql("layer_changes"))
def apply_layer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.apply_layer_changes(layer(spark, sf_dir, "layer_changes"))


@query("l5_apply_layer_changes_stream", ctes("layer_changes") + state_sql("layer_changes"))
def apply_layer_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes read as a stream of files in several micro-batches."""
    source = lineage.scratch_path(spark, "changes")
    layer(spark, sf_dir, "layer_changes").repartition(4, "seq").write.parquet(source)
    state, marks = lineage.scratch_path(spark, "state"), lineage.scratch_path(spark, "marks")
    changes = layer_state.read_changes(spark, source, files_per_batch=2)
    layer_state.start(changes, state, marks).awaitTermination()
    return layer_state.current_state(spark, state)


DOCUMENT = """select id, name, cast(substr(id, 7) as double) as value, case when token is null then type end as style,
    cast(substr(id, 7) as int) as position from layers"""
FROM_DOCUMENT = f""", document as ({DOCUMENT}), begun as (
        select id, seq, op, name, value from layer_changes
        union all select id, -4611686018427387904 + 2 * position, 'upsert', name, value from document
        union all select id, -4611686018427387903 + 2 * position, 'style', style, null from document where style is not null)
        """


@query("l5_apply_layer_changes_document", ctes("layer_changes", "layers") + FROM_DOCUMENT + state_sql("begun"))
def apply_changes_to_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes applied to a stored document."""
    layer(spark, sf_dir, "layers").createOrReplaceTempView("layers")
    return registry.apply_layer_changes(layer(spark, sf_dir, "layer_changes"), spark.sql(DOCUMENT))


@query("l5_apply_layer_changes_document_stream", ctes("layer_changes", "layers") + FROM_DOCUMENT + state_sql("begun"))
def stream_changes_to_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of files."""
    layer(spark, sf_dir, "layers").createOrReplaceTempView("layers")
    document = spark.sql(DOCUMENT)
    source, state, marks = (lineage.scratch_path(spark, name) for name in ("changes", "state", "marks"))
    layer(spark, sf_dir, "layer_changes").repartition(4, "seq").write.parquet(source)
    layer_state.begin(document, state)
    layer_state.start(layer_state.read_changes(spark, source, files_per_batch=2), state, marks).awaitTermination()
    return layer_state.current_state(spark, state)


@query(
    "l6_layer_diff",
    ctes("layer_changes")
    + f""", early as (select * from layer_changes where seq <= (select max(seq) / 2 from layer_changes)),
        old as ({state_sql("early")}), new as ({state_sql("layer_changes")})
        select coalesce(o.id, n.id) as id,
          case when o.id is null then 'added' when n.id is null then 'removed' else 'changed' end as change
        from old o full join new n on o.id = n.id
        where o.id is null or n.id is null or o.name is distinct from n.name or o.value is distinct from n.value
          or o.style is distinct from n.style or o.position is distinct from n.position""",
)
def layer_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document after half of the changes against the one after all."""
    changes = layer(spark, sf_dir, "layer_changes")
    half = changes.select((F.max("seq") / 2).alias("half")).scalar()
    old = registry.apply_layer_changes(changes.where(F.col("seq") <= half))
    return registry.layer_diff(old, registry.apply_layer_changes(changes)).select("id", "change")
