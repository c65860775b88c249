"""Time the chosen operator forms against the straightforward ones on the
same written layers (best of 3, noop sink).  Prints one JSON line.

    python scripts/compare_forms.py [/root/testdata/sf0.1]
"""

import json
import sys
import time

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.windows import vs_group_mean  # noqa: E402
from tidemark.plans import layers  # noqa: E402
from tidemark.plans.lake import Lake, build_steps  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sources import fixtures  # noqa: E402


def best(df, runs=3):
    out = 1e9
    for _ in range(runs):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out = min(out, time.perf_counter() - t0)
    return round(out, 3)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app="tidemark-forms")
    lake = Lake(spark, scratch_path(spark, "forms"))
    for _, action in build_steps(lake, lambda: fixtures.bars(spark, sf_dir),
                                 lambda: fixtures.exchange_dim(spark, sf_dir),
                                 lambda: fixtures.daily_quotes(spark, sf_dir)):
        action()
    silver, daily = lake.read("stock_prices"), lake.read("daily_stock_metrics")
    clean = layers.clean(lake.read("bars"))
    vol = daily.filter(F.col("rolling_volatility_30d").isNotNull()).select(
        "ticker", "year", "rolling_volatility_30d")
    out = {
        "monthly_min_by": best(layers.monthly_performance(silver)),
        "dedupe_min_by_struct": best(layers.dedupe_bars(clean)),
        "dedupe_dropDuplicates_nondeterministic": best(
            clean.dropDuplicates(["ticker", "trade_date"])),
        "year_mean_partial_agg_join": best(vs_group_mean(
            vol, ["ticker", "year"], "rolling_volatility_30d", "m", method="join")),
        "year_mean_window": best(vs_group_mean(
            vol, ["ticker", "year"], "rolling_volatility_30d", "m", method="window")),
    }
    print(json.dumps({"sf_dir": sf_dir, "sec_best_of_3": out}))
    spark.stop()


if __name__ == "__main__":
    main()
