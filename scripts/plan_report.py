"""Write PLANS.md: the shape of the final (adaptive) physical plan of every
layer build and question, run over the written layers.

    python scripts/plan_report.py [/root/testdata/sf0.1]
"""

import re
import sys

sys.path.insert(0, ".")

from tidemark.plans import layers  # noqa: E402
from tidemark.plans.lake import Lake, build_steps, question_frames  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sources import fixtures  # noqa: E402

NODES = [("shuffles", r"(?<!Broadcast)Exchange (?:hashpartitioning|rangepartitioning|"
                      r"SinglePartition|RoundRobinPartitioning)"),
         ("broadcasts", r"BroadcastExchange"),
         ("sorts", r"\bSort \["),
         ("hash aggs", r"\bHashAggregate\("),
         ("sort aggs", r"\bSortAggregate\("),
         ("windows", r"\bWindow \["),
         ("group limits", r"\bWindowGroupLimit\b"),
         ("BHJ", r"\bBroadcastHashJoin\b"),
         ("SMJ", r"\bSortMergeJoin\b"),
         ("top-k", r"\bTakeOrderedAndProject\b")]


def shape(df) -> dict:
    rows = len(df.collect())    # run the frame itself so its adaptive plan is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    out = {name: len(re.findall(rx, final)) for name, rx in NODES}
    out["rows"] = rows
    text = df._jdf.queryExecution().toString()
    out["pushed"] = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", text)) - {""})
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app="tidemark-plans")
    lake = Lake(spark, scratch_path(spark, "plans"))
    for _, action in build_steps(lake, lambda: fixtures.bars(spark, sf_dir),
                                 lambda: fixtures.exchange_dim(spark, sf_dir),
                                 lambda: fixtures.daily_quotes(spark, sf_dir)):
        action()
    r = lake.read
    frames = {
        "bars (fixture adapter)": lambda: fixtures.bars(spark, sf_dir),
        "silver": lambda: layers.silver(layers.clean(r("bars"))),
        "ticker_exchanges": lambda: layers.ticker_exchanges(layers.clean(r("bars"))),
        "daily_metrics": lambda: layers.daily_metrics(r("stock_prices")),
        "monthly_performance": lambda: layers.monthly_performance(r("stock_prices")),
        "yearly_performance": lambda: layers.yearly_performance(r("stock_prices")),
        "daily_quotes (fixture adapter)": lambda: fixtures.daily_quotes(spark, sf_dir),
        "quote_baselines": lambda: layers.quote_baselines(r("streaming_daily_quotes")),
    }
    frames.update(question_frames(lake, fixtures.trades(spark, sf_dir)))
    cols = [n for n, _ in NODES]
    lines = ["# Final physical plans", "",
             f"Generated by `scripts/plan_report.py` on `{sf_dir}` (local[8], AQE on, layers",
             "read back from Parquet). Counts are nodes in the final adaptive plan;",
             "`shuffles` excludes broadcasts.", "",
             "| frame | rows | " + " | ".join(cols) + " | pushed filters |",
             "|---|---|" + "---|" * len(cols) + "---|"]
    for name, make in frames.items():
        s = shape(make())
        pushed = "; ".join(s["pushed"])[:120]
        lines.append(f"| {name} | {s['rows']} | " + " | ".join(str(s[c]) for c in cols)
                     + f" | {pushed} |")
    open("PLANS.md", "w").write("\n".join(lines) + "\n")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
