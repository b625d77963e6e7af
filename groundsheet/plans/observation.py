"""Earth-observation tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsheet.operators import scenes
from groundsheet.plans.catalog import query
from groundsheet.plans.derived import ctes, layer


@query(
    "o1_scene_search",
    ctes("scenes")
    + """select id, collection, cloud from scenes where x0 <= 70 and x1 >= -40 and y0 <= 60 and y1 >= -20
         and dt >= timestamp '1995-01-01' and dt < timestamp '2000-01-01' and collection = '1-URGENT' and cloud < 30""",
)
def scene_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scenes.scene_search(
        layer(spark, sf_dir, "scenes"),
        box=(-40, -20, 70, 60),
        start=datetime.date(1995, 1, 1),
        end=datetime.date(2000, 1, 1),
        collection="1-URGENT",
        max_cloud=30,
    )
    return found.select("id", "collection", "cloud")


@query(
    "o2_least_cloudy",
    ctes("scenes", "footprints")
    + """, ranked as (select b.id as area, a.id as scene, a.cloud as cloud,
             row_number() over (partition by b.id order by a.cloud, a.id) as rn
           from scenes a join footprints b on a.x0 <= b.x1 and a.x1 >= b.x0 and a.y0 <= b.y1 and a.y1 >= b.y0)
         select area, scene, cloud from ranked where rn = 1""",
)
def least_cloudy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.least_cloudy(
        layer(spark, sf_dir, "scenes", spread=True), layer(spark, sf_dir, "footprints")
    )


@query(
    "o3_spectral_index",
    ctes("pixels")
    + """select scene, px, round((nir - red) / nullif(nir + red, 0), 5) as ndvi,
           round((green - nir) / nullif(green + nir, 0), 5) as ndwi from pixels""",
)
def spectral_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = layer(spark, sf_dir, "pixels")
    index = lambda k: (F.round(scenes.spectral_index(k), 5) + 0.0).alias(k)
    return pixels.select("scene", "px", index("ndvi"), index("ndwi"))


@query(
    "o4_index_series",
    ctes("pixels")
    + """, m as (select dt, avg((nir - red) / (nir + red)) as mean_index, count(*) as pixels from pixels group by dt)
         select cast(dt as date) as day, round(mean_index, 6) as mean_index, pixels,
           round(mean_index - lag(mean_index) over (order by dt), 6) as change from m""",
)
def index_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = scenes.index_series(layer(spark, sf_dir, "pixels"), "ndvi")
    return series.select(
        "day",
        F.round("mean_index", 6).alias("mean_index"),
        "pixels",
        (F.round("change", 6) + 0.0).alias("change"),
    )
