"""Sources and sinks round trips in fresh temp folders."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.plans import layers
from tidemark.schemas import MARTS
from tidemark.sources import files, sinks

HEADER = "Date,Low,Open,Volume,High,Close,Adjusted Close\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def make_csv_tree(root):
    _write(f"{root}/nasdaq/csv/AAPL.csv", HEADER + "\n".join([
        "03-01-2000,9.0,10.0,1000,11.0,10.5,10.4",      # clean
        "04-01-2000,9.0,10.0,12.0,11.0,10.5,10.4",      # volume "12.0" -> 12
        "05-01-2000,9.0,,1000,11.0,10.5,10.4",          # empty open
        "31-12-1992,9.0,10.0,1000,11.0,10.5,10.4",      # before 1993
        "2000-01-06,9.0,10.0,1000,11.0,10.5,10.4",      # unparsable date
        "07-01-2000,9.0,10.0,abc,11.0,10.5,10.4",       # bad volume
    ]) + "\n")
    _write(f"{root}/nyse/csv/AAPL.csv", HEADER + "03-01-2000,9.0,10.0,500,11.0,10.9,10.9\n")
    _write(f"{root}/nyse/csv/BRK.A.csv", HEADER + "03-01-2000,90.0,100.0,5,110.0,105.0,105.0\n")
    _write(f"{root}/sp500/csv/ES TC.csv", HEADER + "03-01-2000,1.0,1.5,7,2.0,1.8,1.8\n")


def test_csv_bronze_to_silver(spark, tmp_path):
    root = str(tmp_path / "bars")
    make_csv_tree(root)
    bronze = files.read_bars_csv(spark, root)
    got = sorted((r.ticker, r.source_exchange, r.date, r.volume) for r in bronze.collect())
    assert ("BRK.A", "nyse", dt.date(2000, 1, 3), 5) in got
    assert ("AAPL", "nasdaq", dt.date(2000, 1, 4), 12) in got
    assert ("AAPL", "nasdaq", dt.date(2000, 1, 7), None) in got
    assert all(r[2] is not None and r[2] >= dt.date(1993, 1, 1) for r in got)
    assert ("ES TC", "sp500", dt.date(2000, 1, 3), 7) in got
    assert len(got) == 7  # 4 AAPL nasdaq rows after the date filter, 2 nyse, 1 sp500

    bars = files.bars_from_bronze(bronze, files.exchange_dim(spark))
    clean = layers.clean(bars)
    assert clean.count() == 5
    silver = layers.silver(clean)
    rows = {(r.ticker, r.trade_date): r for r in silver.collect()}
    # the same ticker/day on two exchanges: the lower exchange id (nasdaq) wins
    assert rows[("AAPL", dt.date(2000, 1, 3))].close_price == 10.5
    assert sorted((r.ticker, r.exchange_id) for r in layers.ticker_exchanges(clean).collect()) == [
        ("AAPL", 1), ("AAPL", 2), ("BRK.A", 2), ("ES TC", 3)]
    only_nyse = files.read_bars_csv(spark, root, exchanges=["nyse"])
    assert only_nyse.count() == 2


def test_quotes_json(spark, tmp_path):
    root = tmp_path / "daily"
    docs = {
        "2024-01-02": [
            {"symbol": "AAA", "exchange": ["US", "X"], "quote": {"c": 10.0, "d": 1.0, "dp": 11.1,
             "h": 11.0, "l": 9.0, "o": 9.5, "pc": 9.0, "t": 1704153600}},
            {"symbol": "BBB", "exchange": [], "quote": {"c": 0.0, "pc": 0.0}},
            {"symbol": "CCC", "exchange": None, "quote": {"c": None}},
        ],
        "2024-01-03": [
            {"symbol": "AAA", "exchange": ["US"], "quote": {"c": 12.0, "h": 12.5, "l": 10.0,
             "o": 10.0, "pc": 10.0, "t": 1704240000}},
        ],
    }
    for day, rows in docs.items():
        _write(str(root / day / "quotes.json"), json.dumps(rows, indent=2))
    quotes = files.read_quotes_json(spark, f"{root}/*/quotes.json")
    got = sorted((r.symbol, r.quote_date, r.current_price) for r in quotes.collect())
    assert got == [("AAA", "2024-01-02", 10.0), ("AAA", "2024-01-03", 12.0)]
    snap = layers.latest_snapshot(quotes).collect()
    assert [(r.symbol, r.quote_date) for r in snap] == [("AAA", "2024-01-03")]
    base = layers.quote_baselines(quotes).first()
    assert (base.max_7d_high, base.min_7d_low, base.avg_prev_close, base.days_count) == (
        12.5, 9.0, 9.5, 2)
    assert layers.quote_baselines(quotes, days=1).first().days_count == 1


def test_write_layer_idempotent_and_registration(spark, tmp_path, sf_small):
    from tidemark.plans.catalog import Layers
    L = Layers(spark, sf_small)
    root = str(tmp_path / "lake")
    path = f"{root}/stock_prices"
    sinks.write_layer(L.silver, path, partition_by=["year", "month"], max_records_per_file=100)
    n = spark.read.parquet(path).count()
    sinks.write_layer(L.silver, path, partition_by=["year", "month"])
    assert spark.read.parquet(path).count() == n == L.silver.count()
    sinks.write_layer(L.yearly, f"{root}/yearly_stock_performance", partition_by=["year"])
    names = sinks.register_tables(spark, root, database="tm_test",
                                  names=["stock_prices", "yearly_stock_performance"])
    assert names == ["tm_test.stock_prices", "tm_test.yearly_stock_performance"]
    assert spark.table("tm_test.stock_prices").count() == n
    assert spark.table("tm_test.yearly_stock_performance").filter(
        F.col("year") == 1996).count() == L.yearly.filter(F.col("year") == 1996).count()


def test_run_exports_counts_from_the_write(spark, tmp_path, sf_small):
    from tidemark.plans.catalog import QUERIES
    exports = {n: QUERIES[n](spark, sf_small) for n in ("q01_top_n", "q03_worst_vs_mean")}
    counts = sinks.run_exports(exports, sinks.parquet_sink(str(tmp_path / "marts")))
    assert counts == {"q01_top_n": 105, "q03_worst_vs_mean": 83}
    assert spark.read.parquet(str(tmp_path / "marts" / "q01_top_n")).count() == 105


def test_lake_from_original_files(spark, tmp_path):
    """CSV bars + quote JSON -> every layer -> registered tables -> questions."""
    import random

    from tidemark.plans.lake import Lake, build_steps, file_sources, question_frames
    from tidemark.sources.stream import decode_trades

    rnd = random.Random(7)
    root = tmp_path / "src"
    for exchange, tickers in (("nasdaq", ["AAA", "BBB"]), ("nyse", ["BBB", "CCC"])):
        for t in tickers:
            lines, price = [], 50.0
            for i in range(400):                     # ~13 months of calendar days
                d = dt.date(2000, 1, 3) + dt.timedelta(days=i)
                o = price
                c = max(1.0, o * (1 + rnd.uniform(-0.05, 0.05)))
                lo, hi = min(o, c) * 0.99, max(o, c) * 1.01
                vol = rnd.randint(100, 5000) * (5 if i % 37 == 0 else 1)
                lines.append(f"{d:%d-%m-%Y},{lo},{o},{vol},{hi},{c},{c}")
                price = c
            _write(f"{root}/{exchange}/csv/{t}.csv", HEADER + "\n".join(lines) + "\n")
    for k, day in enumerate(("2024-01-02", "2024-01-03")):
        docs = [{"symbol": s, "exchange": ["US", s[0]],
                 "quote": {"c": 10.0 + k + j, "h": 11.0 + k + j, "l": 9.0 + j, "o": 10.0 + j,
                           "pc": 9.5 + j + k, "t": 1704153600 + k * 86400}}
                for j, s in enumerate(("AAA", "BBB"))]
        _write(str(tmp_path / "daily" / day / "quotes.json"), json.dumps(docs))

    lake = Lake(spark, str(tmp_path / "lake"))
    src = file_sources(spark, str(root), f"{tmp_path}/daily/*/quotes.json")
    for _, action in build_steps(lake, **src):
        action()
    assert lake.read("stock_prices").count() == 3 * 400
    assert sorted(tuple(r) for r in lake.read("ticker_exchanges").collect()) == [
        ("AAA", 1), ("BBB", 1), ("BBB", 2), ("CCC", 2)]
    sinks.register_tables(spark, lake.root, database="tm_files")
    assert spark.sql("SELECT count(*) FROM tm_files.monthly_stock_performance").first()[0] == 3 * 14
    assert spark.table("tm_files.streaming_7d_aggregates").count() == 2

    # the questions as plain SQL over the registered tables agree with the operators
    sql_top = spark.sql("""
        SELECT exchange_id, exchange_name, year, ticker, yearly_return_pct, return_rank FROM (
          SELECT b.exchange_id, d.exchange_name, y.year, y.ticker, y.yearly_return_pct,
                 rank() OVER (PARTITION BY b.exchange_id, y.year
                              ORDER BY y.yearly_return_pct DESC) AS return_rank
          FROM tm_files.yearly_stock_performance y
          JOIN tm_files.ticker_exchanges b ON y.ticker = b.ticker
          JOIN tm_files.exchange_dim d ON b.exchange_id = d.exchange_id
          WHERE y.yearly_return_pct IS NOT NULL) r
        WHERE return_rank <= 3""")
    from tidemark.plans import questions as q
    op_top = q.top_n_per_exchange_year(spark.table("tm_files.yearly_stock_performance"),
                                       spark.table("tm_files.ticker_exchanges"),
                                       spark.table("tm_files.exchange_dim"))
    assert sorted(map(tuple, sql_top.collect())) == sorted(map(tuple, op_top.collect()))

    trades = decode_trades(spark.createDataFrame(
        [(json.dumps({"symbol": "AAA", "price": 11.0 + i / 10, "timestamp_ms":
                      1704240000000 + i * 20_000, "volume": 1.0}),) for i in range(60)],
        "value string"))
    frames = question_frames(lake, trades)
    counts = {name: frame().count() for name, frame in frames.items()}
    assert counts["q01"] == 2 * 2 * 2      # 2 exchanges x 2 years x 2 tickers (all in top 3)
    assert counts["q02"] == 3 * 2 and counts["q05"] == 3 * 14 and counts["q09"] == 4 * 14
    assert counts["q08"] > 0 and counts["q07"] > 0
    assert counts["sq1"] == 2 and counts["sq5"] == 20 and counts["sq4"] == 4


def test_command_line_build_export_stream(spark, tmp_path):
    from tidemark.__main__ import main
    from tidemark.streaming.sinks import read_latest_windows

    src = tmp_path / "src"
    make_csv_tree(str(src))
    _write(str(tmp_path / "daily" / "2024-01-02" / "quotes.json"), json.dumps(
        [{"symbol": "AAPL", "exchange": ["US"], "quote": {"c": 10.0, "h": 11.0, "l": 9.0,
                                                           "o": 9.5, "pc": 9.0, "t": 1}}]))
    lake, out = str(tmp_path / "lake"), str(tmp_path / "marts")
    built = main(["build", "--bars-csv", str(src), "--quotes",
                  f"{tmp_path}/daily/*/quotes.json", "--lake", lake, "--database", "tm_cli"],
                 spark=spark)
    assert "tm_cli.stock_prices" in built["tables"]
    rows = main(["export", "--lake", lake, "--out", out], spark=spark)["rows"]
    # year 2000 listings: nasdaq AAPL; nyse AAPL, BRK.A; sp500 ES TC
    assert set(rows) == {name for name, _ in MARTS.values()}
    assert rows["q01_top_performers_by_exchange_year"] == 4
    msgs = tmp_path / "msgs"
    _write(str(msgs / "m.json"), "\n".join(json.dumps(
        {"symbol": "AAPL", "price": 10.0 + i, "timestamp_ms": 1704189600000 + i * 1000,
         "volume": 1.0}) for i in range(5)) + "\n")
    res = main(["stream", "--question", "sq5", "--source", "text", "--path", str(msgs),
                "--lake", lake, "--out", str(tmp_path / "sq5"),
                "--checkpoint", str(tmp_path / "ck"), "--trigger", "availableNow"], spark=spark)
    assert res["batches"] >= 1
    got = read_latest_windows(spark, str(tmp_path / "sq5"), "sq5").collect()
    assert [(r.symbol, r.current_price, r.direction) for r in got] == [("AAPL", 12.0, "up")]


def test_rebuild_replaces_the_layer(spark, tmp_path):
    both = spark.createDataFrame([("A", 2000), ("B", 2001)], "ticker string, year int")
    path = str(tmp_path / "layer")
    sinks.write_layer(both, path, partition_by=["year"])
    sinks.write_layer(both.where("year = 2001"), path, partition_by=["year"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("B", 2001)]
    sinks.write_layer(both.where("year = 2000"), path, partition_by=["year"], mode="partitions")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("A", 2000), ("B", 2001)]


def test_only_listed_exchange_folders_are_read(spark, tmp_path):
    root = str(tmp_path / "bars")
    make_csv_tree(root)
    _write(f"{root}/otcbb/csv/AAPL.csv", HEADER + "03-01-2000,9.0,99.0,500,99.0,99.0,99.0\n")
    assert {r.source_exchange for r in files.read_bars_csv(spark, root).collect()} == {"nasdaq", "nyse", "sp500"}
    assert files.read_bars_csv(spark, root, exchanges=["otcbb", "absent"]).count() == 1
    empty = files.read_bars_csv(spark, str(tmp_path / "nothing"))
    assert empty.count() == 0 and empty.columns == files.read_bars_csv(spark, root).columns


def test_layers_keep_their_declared_types_and_exports_their_order(spark, tmp_path, sf_small):
    from tidemark.plans.lake import Lake, build_steps, export_questions
    from tidemark.sources import fixtures
    lake = Lake(spark, str(tmp_path / "lake"))
    for _, action in build_steps(lake, lambda: fixtures.bars(spark, sf_small), lambda: fixtures.exchange_dim(spark, sf_small),
                                 lambda: fixtures.daily_quotes(spark, sf_small)):
        action()
    assert dict(lake.read("streaming_daily_quotes").dtypes)["quote_date"] == "string"
    seen = {}
    export_questions(lake, lambda df, name: seen.__setitem__(name, (df.write.format("noop").mode("overwrite").save(), df.toPandas())[1]))
    assert set(seen) == {name for name, _ in MARTS.values()}
    for name, order in MARTS.values():
        frame = seen[name]
        by = [c.lstrip("-") for c in order]
        want = frame.sort_values(by, ascending=[not c.startswith("-") for c in order], kind="stable")
        assert frame[by].equals(want[by])
