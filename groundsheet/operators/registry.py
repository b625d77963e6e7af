"""Layer inventory and keyed layer state as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify_source(path) -> Column:
    """Kind of source a file reference names."""
    p = path if isinstance(path, Column) else F.col(path)
    low = F.lower(p)
    return (
        F.when(p.isNull() | (p == ""), "app")
        .when(low.rlike(r"\.(geo)?parquet$"), "geoparquet")
        .when(low.rlike(r"\.(geo)?json$"), "geojson")
        .otherwise("file")
    )


# Style layer type to geometry kind (fixed values).
STYLE_KINDS = {
    "point": ["circle", "heatmap", "symbol"],
    "line": ["line"],
    "polygon": ["fill", "fill-extrusion"],
    "raster": ["raster"],
}


def geometry_kind(style_type) -> Column:
    s = style_type if isinstance(style_type, Column) else F.col(style_type)
    out = F.lit(None).cast("string")
    for kind, types in STYLE_KINDS.items():
        out = F.when(s.isin(types), kind).otherwise(out)
    return out


def layer_inventory(reported: DataFrame, known: DataFrame, live: bool = False) -> DataFrame:
    """Reported layers (``id, name, path``) completed from known ones (``id, name, type, ref``).

    ``live`` is the fallback without a layer model: known layers that were not reported
    are listed too.
    """
    k = known.select("id", F.col("name").alias("k_name"), F.col("type").alias("k_type"), F.col("ref").alias("k_ref"))
    both = reported.join(k, "id", "full" if live else "left")
    given = F.col("path").isNotNull() & (F.col("path") != "")
    return both.select(
        "id",
        F.coalesce("name", "k_name", "id").alias("name"),
        F.when(given, classify_source("path")).otherwise(F.coalesce("k_type", F.lit("app"))).alias("source_type"),
        F.when(given, F.col("path")).otherwise(F.col("k_ref")).alias("source_ref"),
    )


def resolve_layer(layers: DataFrame, refs: DataFrame, order: str = "id") -> DataFrame:
    """Reference and token for each asked ``ref``: a layer id, or its url or path.

    The first matching layer with a source wins; an unknown ref stays as given, without
    token.  Both ways of naming a layer are equi-joins, and the winner is a minimum, so
    a ref asked or matched many times is reduced map-side.
    """
    usable = layers.where(F.col("ref").isNotNull())
    names = usable.select(F.col("id").alias("asked"), F.col(order).alias("at"), F.col("ref").alias("found"), "token")
    sources = usable.select(F.col("ref").alias("asked"), F.col(order).alias("at"), F.col("ref").alias("found"), "token")
    lookup = (
        names.union(sources)
        .groupBy("asked")
        .agg(F.min(F.struct("at", "found", "token")).alias("hit"))
    )
    joined = refs.join(lookup, refs["ref"] == lookup["asked"], "left")
    return joined.select(
        refs["ref"],
        F.coalesce("hit.found", refs["ref"]).alias("reference"),
        F.col("hit.token").alias("token"),
    )


def redact(layers: DataFrame, token: str = "token") -> DataFrame:
    """Replace present tokens; ``source.token`` style paths reach into a struct."""
    mask = F.when(F.col(token).isNotNull(), F.lit("<redacted>"))
    if "." not in token:
        return layers.withColumn(token, mask)
    outer, inner = token.split(".", 1)
    return layers.withColumn(outer, F.col(outer).withField(inner, mask))


def layer_diff(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Per layer: added, removed or changed; unchanged layers are left out."""
    fields = [c for c in old.columns if c != key]
    a = old.select(F.col(key), F.struct(*fields).alias("was"))
    b = new.select(F.col(key), F.struct(*fields).alias("now"))
    change = (
        F.when(F.col("was").isNull(), "added")
        .when(F.col("now").isNull(), "removed")
        .when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    )
    both = a.join(b, key, "full").withColumn("change", change)
    return both.where(F.col("change").isNotNull()).select(key, "change", "was", "now")


# --- keyed state -------------------------------------------------------------------------

FOLDED = (
    "id string, removed long, added struct<seq:bigint,name:string,value:double>, "
    "styled struct<seq:bigint,style:string>"
)


def fold_changes(changes: DataFrame) -> DataFrame:
    """Reduce change rows (``id, seq, op, name, value``) to one row per layer.

    Keeps the latest removal, the latest upsert and the latest style.  Every part is a
    maximum, so folding is associative and may be repeated: replayed or late rows change
    nothing, partial folds combine, and a layer with very many changes is reduced
    map-side before the shuffle.
    """
    seq = F.col("seq")
    return changes.groupBy("id").agg(
        F.max(F.when(F.col("op") == "remove", seq)).alias("removed"),
        F.max(F.when(F.col("op") == "upsert", F.struct(seq.alias("seq"), F.col("name"), F.col("value")))).alias("added"),
        F.max(F.when(F.col("op") == "style", F.struct(seq.alias("seq"), F.col("name").alias("style")))).alias("styled"),
    )


def merge_folded(folded: DataFrame) -> DataFrame:
    """Combine several folds of the same layers."""
    return folded.groupBy("id").agg(
        F.max("removed").alias("removed"), F.max("added").alias("added"), F.max("styled").alias("styled")
    )


def present_layers(folded: DataFrame) -> DataFrame:
    """The document's layers: upserted after any removal, style only if set afterwards.

    ``position`` orders the document: an upsert moves a layer to the end.
    """
    alive = F.col("added").isNotNull() & (
        F.col("removed").isNull() | (F.col("added.seq") > F.col("removed"))
    )
    return folded.where(alive).select(
        "id",
        "added.name",
        "added.value",
        F.when(F.col("styled.seq") > F.col("added.seq"), F.col("styled.style")).alias("style"),
        F.col("added.seq").alias("position"),
    )


#: Versions of a start state's layers lie around this number, below those of all changes.
START = -(1 << 62)


def fold_state(layers: DataFrame) -> DataFrame:
    """A stored document (``id, name, value, style, position``) as folded rows of the lowest version.

    Positions are taken from 0 on; of layers with one id the last in the document stands.
    """
    seq = F.lit(START) + 2 * F.col("position").cast("long")
    added = F.struct(seq.alias("seq"), F.col("name"), F.col("value").cast("double").alias("value"))
    styled = F.when(F.col("style").isNotNull(), F.struct((seq + 1).alias("seq"), F.col("style")))
    return layers.select("id", F.lit(None).cast("long").alias("removed"), added.alias("added"), styled.alias("styled"))


def apply_layer_changes(changes: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The document after all changes, begun empty or with the layers of ``state`` (see ``fold_state``)."""
    folded = fold_changes(changes)
    return present_layers(folded if state is None else merge_folded(folded.unionByName(fold_state(state))))
