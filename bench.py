"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpusloom.catalog import QUERIES  # noqa: E402
from corpusloom.session import local_session  # noqa: E402

HEADLINE = [
    "trigram_counts",
    "next_word_prob",
    "rank_continuations",
    "top_next_5",
    "feature_counts",
    "assoc_measures",
    "pair_similarity_24",
    "stemmed_feature_counts",
    "embedding_pair_measures",
    "convert_results",
    "status_summary",
    "job_complete",
    "stream_completion",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", spark__ui__showConsoleProgress="false")
    # One run on the smallest tables first, so that no query pays for starting the JVM.
    small = Path(sf_dir).with_name("sf0.001")
    QUERIES["next_word_prob"](spark, str(small if small.exists() else sf_dir)).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
