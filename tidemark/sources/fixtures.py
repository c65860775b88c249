"""Adapters from the provided star-schema test tables to the market data model.

bars   lineitem x part x supplier x nation x region -> one OHLCV bar per
       (ticker = brand, exchange = region, trade date)
trades events -> (symbol = event type, price = value, event time = ts)
quotes trades -> one daily quote per (symbol, date) with the previous close

Everything is a Spark job over the whole tables; nothing is sampled.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import ntz_to_epoch_ms, pct_change
from tidemark.operators.aggregates import first_by, first_last_total, last_by, pack_order
from tidemark.operators.windows import lag_value
from tidemark.schemas import BAR_CSV
from tidemark.sources import folders
from tidemark.sources.files import parse_bars
from tidemark.sources.stream import decode_trades, trade_payloads, trade_stream
from tidemark.streaming.runner import start_upsert

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exchange_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exchange_id, exchange_name from the region table."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("exchange_id"),
        F.col("r_name").alias("exchange_name"))


def bar_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: ticker, exchange, trade date, price, quantity and
    the six-column order that decides open and close.

    The dimensions are joined one at a time onto the line items (left-deep),
    so each join sees its dimension's own size: small ones are broadcast at
    planning time.  Pre-joining supplier x nation x region would inflate the
    size estimate and make Spark plan a shuffle of every line item first.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(exchange_dim(spark, sf_dir), F.col("n_regionkey") == F.col("exchange_id"))
            .select(
                "ticker", "exchange_id", "exchange_name",
                F.col("l_shipdate").cast("date").alias("trade_date"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                F.col("l_quantity").alias("quantity"),
                F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_extendedprice", "l_quantity").alias("seq")))


def bars(spark: SparkSession, sf_dir: str, order: str = "struct") -> DataFrame:
    """Raw daily bars, one per (ticker, exchange, trade_date), open and close by
    the six-column line order.

    One aggregate with map-side partial aggregation, so a hot ticker costs one
    partial row per map task.  order="struct" keeps the six columns in the
    aggregate, which makes it a sort-based one.  order="lead", for building the
    layer, is a hash aggregate by order key and line number in one BIGINT; the other
    columns count where those two tie.  Its plan names the input three times (it is
    read once), which larger plans on top should be spared.
    """
    keys = ["ticker", "exchange_id", "exchange_name", "trade_date"]
    rows, seq = bar_trades(spark, sf_dir), F.col("seq")
    others = [F.max("price").alias("high_price"), F.min("price").alias("low_price"),
              F.sum("quantity").cast("bigint").alias("volume")]
    if order == "struct":
        out = rows.groupBy(*keys).agg(first_by("price", "seq").alias("open_price"), last_by("price", "seq").alias("close_price"), *others)
    elif order == "lead":
        rest = [seq[c] for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")]
        out = first_last_total(rows, keys, seq["l_orderkey"] * 128 + seq["l_linenumber"], rest,
                               {"open_price": "price"}, {"close_price": "price"}, others)
    else:
        raise ValueError(f"order must be 'struct' or 'lead', not {order!r}")
    return out.select(*keys, "open_price", "high_price", "low_price", "close_price", "volume",
                      F.col("close_price").alias("adjusted_close_price"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, price, timestamp_ms, volume, event_time (TIMESTAMP_NTZ), event_id."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        ntz_to_epoch_ms("ts").alias("timestamp_ms"),
        F.lit(1.0).alias("volume"),
        F.col("ts").alias("event_time"),
        "event_id")


def exchanges_of(symbol: str = "symbol"):
    """Many-to-many symbol -> exchange list used by the quote fixture:
    X<len(symbol) % 3> plus ALL."""
    return F.array(F.concat(F.lit("X"), (F.length(symbol) % 3).cast("string")), F.lit("ALL"))


def daily_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming_daily_quotes layer built from the trades.

    Per (symbol, date): open/close = first/last trade in (event_time, event_id)
    order, high/low, previous close = close of the symbol's previous date.
    """
    t = trades(spark, sf_dir)
    # (event_time, event_id) as one exact decimal key: keeps a hash aggregate
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").try_cast(
        "timestamp_ntz"), F.col("event_time"))
    seq = pack_order(micros, "event_id")
    daily = (t.groupBy("symbol", F.col("event_time").cast("date").alias("d"))
             .agg(first_by("price", seq).alias("open_price"),
                  last_by("price", seq).alias("current_price"),
                  F.max("price").alias("high_price"),
                  F.min("price").alias("low_price"),
                  last_by("timestamp_ms", seq).alias("api_timestamp")))
    prev = lag_value("current_price", ["symbol"], ["d"])
    return (daily.withColumn("prev_close", prev)
            .select(
                "symbol",
                exchanges_of("symbol").alias("exchange"),
                "current_price",
                (F.col("current_price") - F.col("prev_close")).alias("change"),
                pct_change("current_price", "prev_close").alias("change_pct"),
                "high_price", "low_price", "open_price", "prev_close", "api_timestamp",
                F.date_format("d", "yyyy-MM-dd").alias("quote_date")))


# ------------------------------------------------------- rows that must fail

def day_number(date: str = "trade_date"):
    return F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))


def dirty_bars(bars_df: DataFrame) -> DataFrame:
    """Bars with one defect on some days, so that every quality rule fails
    somewhere; which defect follows from the day number modulo 23."""
    k = day_number() % 23
    bad = F.lit(None)
    return bars_df.withColumns({
        "open_price": F.when(k == 1, 0.0).otherwise(F.col("open_price")),
        "high_price": F.when(k == 2, -1.0).when(k == 3, F.col("low_price") / 2).otherwise(F.col("high_price")),
        "low_price": F.when(k == 4, bad.cast("double")).otherwise(F.col("low_price")),
        "close_price": F.when(k == 5, 0.0).otherwise(F.col("close_price")),
        "volume": F.when(k == 6, bad.cast("bigint")).when(k == 7, F.lit(-5).cast("bigint")).otherwise(F.col("volume")),
        "trade_date": F.when(k == 8, bad.cast("date")).otherwise(F.col("trade_date")),
    })


def dirty_quotes(quotes: DataFrame) -> DataFrame:
    """Raw quote documents as (symbol, exchange, quote, quote_date) with defects
    by the day of the month: no price, price 0, no date, no symbol."""
    day = F.substring("quote_date", 9, 2).cast("int")
    return quotes.select(
        F.when(day % 7 != 1, F.col("symbol")).alias("symbol"), "exchange",
        F.struct(F.when(day % 7 == 2, F.lit(0.0)).when(day % 7 != 3, F.col("current_price")).alias("c"),
                 F.col("change").alias("d"), F.col("change_pct").alias("dp"), F.col("high_price").alias("h"),
                 F.col("low_price").alias("l"), F.col("open_price").alias("o"), F.col("prev_close").alias("pc"),
                 F.col("api_timestamp").alias("t")).alias("quote"),
        F.when(day % 7 == 4, F.lit("")).otherwise(F.col("quote_date")).alias("quote_date"))


def dirty_trades(trades_df: DataFrame) -> DataFrame:
    """Trades without a price, with price 0 or a negative one, by the event id."""
    k = F.col("event_id") % 9
    return trades_df.withColumn("price", F.when(k == 1, F.lit(None).cast("double")).when(k == 2, 0.0)
                                .when(k == 3, -F.col("price")).otherwise(F.col("price")))


def dirty_snapshot(snapshot: DataFrame) -> DataFrame:
    """A snapshot where some symbols have no previous close, 0, or no exchange list."""
    k = F.length("symbol") % 5
    return snapshot.withColumns({
        "prev_close": F.when(k == 0, F.lit(None).cast("double")).when(k == 1, 0.0).otherwise(F.col("prev_close")),
        "exchange": F.when(k == 3, F.array().cast("array<string>")).otherwise(F.col("exchange"))})


def bar_text(bars_df: DataFrame) -> DataFrame:
    """Bars as CSV lines (line, ticker, exchange), with bad cells by the day
    number modulo 17: another date format, text for a price, an empty close,
    a volume with a decimal point, text for a volume."""
    k = day_number() % 17
    volume = F.col("volume").cast("string")
    cells = [F.when(k == 1, F.date_format("trade_date", "yyyy/MM/dd")).otherwise(F.date_format("trade_date", "dd-MM-yyyy")),
             F.col("low_price").cast("string"), F.when(k == 2, "abc").otherwise(F.col("open_price").cast("string")),
             F.when(k == 3, "n/a").when(k == 4, F.concat(volume, F.lit(".0"))).otherwise(volume),
             F.col("high_price").cast("string"), F.when(k == 5, "").otherwise(F.col("close_price").cast("string")),
             F.col("adjusted_close_price").cast("string")]
    return bars_df.select(F.concat_ws(",", *cells).alias("line"), "ticker", "exchange_name")


def read_bar_text(lines: DataFrame, min_date: str) -> DataFrame:
    """Bronze rows from ``bar_text`` lines, by the same declared schema and casts as files."""
    ddl = ", ".join(f"`{f.name}` STRING" for f in BAR_CSV.fields)
    raw = lines.select(F.from_csv("line", ddl).alias("r"), "ticker", "exchange_name")
    return parse_bars(raw.select("r.*", "ticker", "exchange_name"), F.col("ticker"), F.col("exchange_name"), min_date)


def _one_file_each(df: DataFrame, writer, by: list[str], root: str, place) -> None:
    """Write one file per value of ``by`` and move it to ``<root>/<place(values)>``."""
    spark, staging = df.sparkSession, f"{root.rstrip('/')}-staging"
    writer(df.repartition(*by).write.partitionBy(*by)).save(staging)

    def down(path: str, values: list[str]) -> None:
        for entry in folders.entries(spark, path):
            name, sep, value = entry.name.partition("=")
            if sep and len(values) < len(by):
                down(f"{path}/{entry.name}", [*values, unquote(value)])
            elif entry.name.startswith("part-") and len(values) == len(by):
                folders.move(spark, f"{path}/{entry.name}", f"{root.rstrip('/')}/{place(*values)}")

    down(staging, [])


def write_bar_files(bars_df: DataFrame, root: str) -> None:
    """Bars as the original files, ``<root>/<exchange>/csv/<TICKER>.csv``; one file
    per ticker and exchange (a ticker's bars of an exchange are one row a day)."""
    cells = [F.date_format("trade_date", "dd-MM-yyyy").alias("Date"), F.col("low_price").alias("Low"), F.col("open_price").alias("Open"),
             F.col("volume").alias("Volume"), F.col("high_price").alias("High"), F.col("close_price").alias("Close"),
             F.col("adjusted_close_price").alias("Adjusted Close")]
    _one_file_each(bars_df.select("exchange_name", "ticker", *cells), lambda w: w.format("csv").option("header", True),
                   ["exchange_name", "ticker"], root, lambda exchange, ticker: f"{exchange}/csv/{ticker}.csv")


def write_quote_files(quotes: DataFrame, root: str) -> None:
    """Quotes as the original documents, ``<root>/<yyyy-MM-dd>/quotes.json``: one
    JSON array over many lines a day, with one element per listed symbol."""
    quote = F.struct(*[F.col(c).alias(k) for k, c in (
        ("c", "current_price"), ("d", "change"), ("dp", "change_pct"), ("h", "high_price"), ("l", "low_price"),
        ("o", "open_price"), ("pc", "prev_close"), ("t", "api_timestamp"))])
    days = quotes.groupBy("quote_date").agg(F.to_json(
        F.collect_list(F.struct("symbol", "exchange", quote.alias("quote"))), {"pretty": "true"}).alias("value"))
    _one_file_each(days, lambda w: w.format("text"), ["quote_date"], root, lambda day: f"{day}/quotes.json")


def daily_snapshots(quotes: DataFrame) -> DataFrame:
    """Quotes as snapshots that hold from the midnight (UTC) their date begins."""
    return quotes.select("symbol", "exchange", "prev_close", F.col("quote_date").cast("timestamp_ntz").alias("valid_from"))


SNAPSHOT_JSON = "symbol string, exchange array<string>, prev_close double, valid_from timestamp_ntz"


def replay(spark: SparkSession, trades_df: DataFrame, question, path: str, slices: int = 3,
           start=start_upsert, snapshots: DataFrame | None = None) -> str:
    """Run a stream question over the trades as message files, slice by slice in
    time order; the folder of window results.

    Each slice is written, then drained by an ``availableNow`` run that goes on
    from the checkpoint of the one before.  The last slice also holds a copy of
    the first slice's earliest trades; they are late and must be dropped.
    ``start`` is the runner to use.  With ``snapshots`` the question gets a second
    stream: each slice then brings the snapshots that begin to hold in its time.
    """
    cuts = trades_df.select(F.percentile_approx("timestamp_ms", [k / slices for k in range(1, slices)], 10_000)).first()[0]
    bounds = [None, *cuts, None]
    messages, out = f"{path}/messages", f"{path}/windows"
    first = trades_df.agg(F.min("timestamp_ms")).first()[0]

    def between(df: DataFrame, ms: Column, low: int | None, high: int | None) -> DataFrame:
        if low is not None:
            df = df.where(ms >= low)
        return df if high is None else df.where(ms < high)

    for low, high in zip(bounds[:-1], bounds[1:]):
        part = between(trades_df, F.col("timestamp_ms"), low, high)
        if high is None:
            part = part.unionByName(trades_df.where(F.col("timestamp_ms") < first + 60_000))
        trade_payloads(part).select("value").write.mode("append").text(messages)
        streams = [decode_trades(trade_stream(spark, "text", messages))]
        if snapshots is not None:
            between(snapshots, ntz_to_epoch_ms("valid_from"), low, high).write.mode("append").json(f"{path}/snapshots")
            streams.append(spark.readStream.schema(SNAPSHOT_JSON).json(f"{path}/snapshots"))
        start(question(*streams), out, f"{path}/checkpoint").awaitTermination()
    return out
