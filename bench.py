"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to a ``noop`` sink, so all rows and columns are computed and
nothing is collected. One untimed query warms the JVM, then each is run twice and
the better time counts: the first run includes compiling its code. Event cleaning is
measured as it runs in production, from gzip JSON-lines files, which are written
before the clock starts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame

from vitals.operators.cleaning import clean_events
from vitals.plans import testdata
from vitals.plans.queries import queries
from vitals.session import build_session
from vitals.sources.readers import read_events

HEADLINE = [
    "clean_models",
    "repo_daily_metrics",
    "top_repos",
    "star_growth_hype",
    "contributor_health",
    "bus_factor",
    "health_score",
    "era_summary",
    "era_summary_approx",
    "push_size_distribution",
    "pr_push_ratio",
    "active_repos_monthly",
    "pr_merge_time",
    "contributor_flow",
    "weekday_weekend",
    "push_per_actor",
    "era_quality",
    "event_value_percentiles",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = queries()

    def seconds(df: DataFrame) -> float:
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def query_seconds(name: str) -> float:
        start = time.perf_counter()
        df = available[name](spark, sf_dir)
        return round(time.perf_counter() - start + seconds(df), 3)

    with tempfile.TemporaryDirectory(prefix="vitals-bench-") as folder:
        lines = testdata.raw_event_lines(spark, sf_dir)
        lines.repartition(24).write.option("compression", "gzip").text(f"{folder}/raw")
        query_seconds("daily_counts")
        raw = f"{folder}/raw"
        times = {
            "clean_events_from_files": min(seconds(clean_events(read_events(spark, raw))) for _ in range(2))
        }
        times |= {name: min(query_seconds(name) for _ in range(2)) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
