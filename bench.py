"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local threads.
Every query is run once in full (a ``noop`` write), after one small warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a1_read_geoparquet", "a2_read_featureset", "a3_read_geojson", "a3_read_geojson_document", "a5_write_geojson",
    "b1_decode_geometry", "b4_make_lines", "b6_encode_geometry",
    "c2_layer_summary", "c4_attribute_filter", "c5_spatial_filter", "c7_statistics", "c8_ordered_page",
    "d1_spatial_join", "d1_crosses", "d2_point_in_polygon", "d3_distance_join", "d4_nearest", "d4_nearest_shapes",
    "d5_spatial_semi", "d6_distance_pairs", "d7_aggregate_in_polygons",
    "e1_spatial_sql", "e1_buffer_join", "e1_outer_join", "e2_sql_geometry_names", "p4_left_join", "p7_asof_join", "p8_grouping",
    "p10_ranking", "p11_analytic", "p14_subqueries", "p20_quantiles",
    "f1_reproject_layer", "f2_buffer_layer", "f3_clip_layer", "f5_erase", "f6_overlay_union",
    "f7_dissolve", "f12_hulls", "f14_grid_bin", "f16_buffer_and_select",
    "s1_distribution", "s2_breaks_quantile", "s4_breaks_jenks", "s8_legend",
    "t1_normalize", "t3_tokenize", "t4_bm25_index", "t5_bm25_search",
    "l3_resolve_layer", "l5_apply_layer_changes", "l5_apply_layer_changes_stream", "l6_layer_diff",
    "o1_scene_search", "o2_least_cloudy", "o3_spectral_index", "o4_index_series",
]


def main() -> None:
    from groundsheet.plans import QUERIES
    from groundsheet.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", shuffle=max(8, int(cpus) if cpus.isdigit() else 8))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("d7_aggregate_in_polygons")
    times = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
