"""Time headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once to warm up and three times timed; the median counts. Results go to the `noop`
sink, which computes every row and column.
"""

from __future__ import annotations

import json
import logging
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from voxtally import build_session  # noqa: E402
from voxtally.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "feedback_rollup", "final_airlines", "final_airports", "prep_reviews", "prep_places",
    "prep_posts", "keyword_classify", "label_distribution", "detect_language", "extract_sentiment",
    "map_subtopic", "explode_phrases", "join_subtopic", "join_metadata", "dedup_latest",
    "distinct_rows", "dense_row_id", "batch_number_per_topic", "title_case", "token_count",
    "parse_mixed_date", "parse_reply", "extract_by_model", "translate_batches", "stream_ingest",
)


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    logging.disable(logging.WARNING)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(median(run(spark, sf_dir, name) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
