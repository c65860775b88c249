"""Benchmark: build every layer from the raw tables, then answer the ten
batch questions and the five stream questions (batch form) from the written
layers.  Prints one JSON line.

Before timing, the same steps run once, untimed, on the smallest fixture
(sf0.001) so JVM start-up, JIT and code generation are not charged to the
first timed step.

    BENCH_SF_DIR  input tables       (default /root/testdata/sf0.1)
    BENCH_CPUS    local[N] threads   (default 8)
    BENCH_DIR     folder for the written layers (default: the session's checkpoint folder)
"""

from __future__ import annotations

import json
import os
import re

from tidemark.plans.lake import Lake, build_steps, question_frames, timed
from tidemark.session import local_session, scratch_path
from tidemark.sources import fixtures


def run_all(spark, lake: Lake, sf_dir: str) -> dict[str, float]:
    timings: dict[str, float] = {}
    for name, action in build_steps(
            lake,
            bars=lambda: fixtures.bars(spark, sf_dir, order="lead"),
            dim=lambda: fixtures.exchange_dim(spark, sf_dir),
            quotes=lambda: fixtures.daily_quotes(spark, sf_dir)):
        timings[f"build_{name}"] = round(timed(action), 3)
    trades = fixtures.trades(spark, sf_dir)
    for name, frame in question_frames(lake, trades).items():
        timings[name] = round(timed(lambda: frame().write.format("noop").mode("overwrite")
                                    .save()), 3)
    return timings


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    folder = os.environ.get("BENCH_DIR")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="tidemark-bench",
                          extra={"spark.checkpoint.dir": folder} if folder else None)
    root = scratch_path(spark, "bench-lake")
    lake = Lake(spark, root)

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        run_all(spark, Lake(spark, scratch_path(spark, "bench-warm")),
                warm_dir)

    timings = run_all(spark, lake, sf_dir)

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "layers_plus_questions_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
