"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query runs once
untimed over the smallest tables beside that folder, which compiles its plan's code, and once
timed to a full result (written to the no-op sink). Of that, ``build`` is the time until the
query's frame is there, with whatever it stages on the way.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rankflow.plans.catalog import QUERIES  # noqa: E402
from rankflow.session import local_session, scratch  # noqa: E402

HEADLINE = (
    "ranked_runs",
    "run_metrics",
    "fused_scores",
    "fused_rrf",
    "fusion_metrics",
    "pair_metrics",
    "training_sample_ids",
    "training_texts",
    "training_batches",
    "bm25_top",
    "bm25_reranked",
    "pair_features",
    "model_scored_pairs",
    "feedback_expanded_queries",
    "expansion_metrics",
    "reread_runs",
)


def timed(spark, name: str, folder: str) -> tuple[float, float]:
    """Seconds to build the frame and to run it; what it stages is deleted afterwards."""
    with scratch(spark):
        started = time.perf_counter()
        frame = QUERIES[name](spark, folder)
        built = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        return built - started, time.perf_counter() - built


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    smallest = Path(folder).parent / "sf0.001"
    warm = str(smallest) if smallest.exists() else folder
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    build: dict[str, float] = {}
    for name in names:
        timed(spark, name, warm)
        building, running = timed(spark, name, folder)
        seconds[name], build[name] = round(building + running, 3), round(building, 3)
        print(f"{name}: {seconds[name]} s, of which building {build[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "build": build,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
