"""Command line for cluster runs (``spark-submit -m``-style or ``python -m tidemark``).

    build   bar CSVs + quote JSON -> every layer under --lake, registered as tables
    refresh the layers of --lake after bars of some months came late or changed
    export  the ten batch questions from --lake -> Parquet under --out (or JDBC)
    stream  one stream question from a Kafka topic or a folder of JSON messages

The session comes from ``SparkSession.builder.getOrCreate()``, so spark-submit
settings (master, memory, ``spark.checkpoint.dir``) apply unchanged.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tidemark import constants as C


def _options(pairs):
    return dict(p.split("=", 1) for p in pairs or [])


def main(argv=None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--bars-csv", required=True)
    b.add_argument("--quotes", required=True, help="glob of <yyyy-MM-dd>/quotes.json")
    b.add_argument("--lake", required=True)
    b.add_argument("--database", default="stock_analytics")
    b.add_argument("--min-date", default="1993-01-01")
    r = sub.add_parser("refresh")
    r.add_argument("--lake", required=True)
    r.add_argument("--month", required=True, action="append", help="yyyy-MM, repeatable")
    e = sub.add_parser("export")
    e.add_argument("--lake", required=True)
    e.add_argument("--out", help="Parquet folder for the result marts")
    e.add_argument("--jdbc-url")
    e.add_argument("--jdbc-option", action="append", help="key=value, repeatable")
    s = sub.add_parser("stream")
    s.add_argument("--question", required=True, choices=["sq1", "sq2", "sq3", "sq4", "sq5"])
    s.add_argument("--source", default="kafka", help="kafka or text (folder of JSON lines)")
    s.add_argument("--path")
    s.add_argument("--option", action="append", help="source option key=value, repeatable")
    s.add_argument("--lake", help="layer root holding the quote snapshot / baselines")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger", default=C.TRIGGER,
                   help="processing-time interval, or availableNow to drain and stop")
    s.add_argument("--baseline", help="SQ3: Parquet folder (symbol, baseline) instead of the constant")
    s.add_argument("--fold-every", type=int, help="fold the window sink after so many batches (sq1 to sq3)")
    s.add_argument("--static-join", default="broadcast", choices=["broadcast", "auto", "shuffle"])
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.getOrCreate()
    from tidemark.plans import layers
    from tidemark.plans.lake import Lake, build_steps, export_questions, file_sources
    from tidemark.sources import sinks

    if args.cmd == "build":
        lake = Lake(spark, args.lake)
        for _, action in build_steps(lake, **file_sources(spark, args.bars_csv, args.quotes,
                                                          min_date=args.min_date)):
            action()
        return {"tables": sinks.register_tables(spark, args.lake, database=args.database)}

    if args.cmd == "refresh":
        from tidemark.plans.incremental import refresh

        months = [tuple(map(int, m.split("-"))) for m in args.month]
        return refresh(Lake(spark, args.lake), months)._asdict()

    if args.cmd == "export":
        if args.jdbc_url:
            sink = sinks.jdbc_sink(args.jdbc_url, _options(args.jdbc_option))
        elif args.out:
            sink = sinks.parquet_sink(args.out)
        else:
            ap.error("export needs --out or --jdbc-url")
        return {"rows": export_questions(Lake(spark, args.lake), sink)}

    from tidemark.sources.stream import decode_trades, trade_stream
    from tidemark.streaming import questions as sq
    from tidemark.streaming.runner import start_enriched, start_upsert

    trades = decode_trades(trade_stream(spark, args.source, args.path, _options(args.option)))
    needs_lake = args.question in ("sq2", "sq4", "sq5")
    if needs_lake and not args.lake:
        ap.error(f"{args.question} needs --lake for its static side")
    lake = Lake(spark, args.lake) if args.lake else None
    trigger = None if args.trigger == "availableNow" else args.trigger
    run = dict(path=args.out, checkpoint=args.checkpoint, trigger=trigger, name=args.question)
    how = args.static_join
    if args.question == "sq4":
        query = start_enriched(sq.mean_price(trades, *C.SQ4_WINDOW),
                               lambda w, b: sq.enrich_range(w, b, static_join=how),
                               lambda: lake.read("streaming_7d_aggregates"), **run)
    elif args.question == "sq5":
        query = start_enriched(sq.mean_price(trades, *C.SQ5_WINDOW),
                               lambda w, b: sq.enrich_prev_close(w, b, static_join=how),
                               lambda: layers.latest_snapshot(lake.read("streaming_daily_quotes")), **run)
    else:
        baseline = spark.read.parquet(args.baseline) if args.baseline else C.TRADES_PER_WINDOW_BASELINE
        query = start_upsert({
            "sq1": lambda: sq.price_volatility(trades),
            "sq2": lambda: sq.market_sentiment(
                trades, layers.latest_snapshot(lake.read("streaming_daily_quotes")), static_join=how),
            "sq3": lambda: sq.trade_frequency(trades, baseline=baseline, static_join=how),
        }[args.question](), fold_every=args.fold_every, question=args.question, **run)
    query.awaitTermination()
    return {"query": args.question, "batches": len(query.recentProgress)}


if __name__ == "__main__":
    print(json.dumps(main()))
