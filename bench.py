"""Time the headline queries; prints one JSON line.

Each query is built and fully consumed (``noop`` sink) once to warm up and then
``REPEATS`` times; the median counts.
"""

import json
import os
import statistics
import time

from tessera.plans.queries import QUERIES
from tessera.session import build_session

HEADLINE = [
    "relabel_filter", "proof_filter_client", "coord_parse", "normalize_u8", "point_lookup", "changelog_state",
    "changelog_effective_count", "component_labels", "bbox", "elongation", "remove_small", "erode_once", "label_adjacency",
    "voxel_components", "resample_linear", "cell_nuclei_merge",
]
REPEATS = 3


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(REPEATS)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
