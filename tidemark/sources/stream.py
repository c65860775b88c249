"""Trade stream sources and payload decoding.

The same decoding runs on a streaming frame (Kafka or a file source) and on a
batch frame, so every stream question has a batch twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expr import epoch_ms_to_ntz


def trade_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                 options: dict | None = None) -> DataFrame:
    """A streaming frame with one message per row in a ``value`` column.

    source="kafka": ``options`` carries ``kafka.bootstrap.servers``,
    ``subscribe`` and ``startingOffsets`` (the caller chooses; there is no
    default, so a restart never silently skips data).
    source="text": one JSON message per line in files under ``path`` (tests,
    replays, backfills).
    """
    reader = spark.readStream.format(source)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path) if path is not None else reader.load()


def decode_trades(raw: DataFrame, value: str = "value") -> DataFrame:
    """Message value (JSON bytes or text) -> symbol, price, timestamp_ms,
    volume, event_time (TIMESTAMP_NTZ, UTC).  Malformed messages become rows
    of NULLs, which the trade rules drop later."""
    d = F.from_json(F.col(value).cast("string"), schemas.TRADE).alias("d")
    return (raw.select(d).select("d.*")
            .withColumn("event_time", epoch_ms_to_ntz("timestamp_ms")))


def flatten_trade_envelopes(raw: DataFrame, value: str = "value") -> DataFrame:
    """Provider envelopes ``{"type": "trade", "data": [{s, p, t, v}, ...]}`` ->
    one trade row per element.  Other message types and elements without a
    symbol are dropped; a missing volume becomes 0."""
    env = F.from_json(F.col(value).cast("string"), schemas.TRADE_ENVELOPE).alias("e")
    trades = (raw.select(env)
              .filter(F.col("e.type") == "trade")
              .select(F.explode("e.data").alias("x"))
              .select(F.col("x.s").alias("symbol"), F.col("x.p").alias("price"),
                      F.col("x.t").alias("timestamp_ms"),
                      F.coalesce(F.col("x.v"), F.lit(0.0)).alias("volume"))
              .filter(F.col("symbol").isNotNull() & (F.col("symbol") != "")))
    return trades.withColumn("event_time", epoch_ms_to_ntz("timestamp_ms"))


def trade_payloads(trades: DataFrame) -> DataFrame:
    """Encode trade rows as JSON message values (the producer side)."""
    body = F.struct("symbol", "price", "timestamp_ms", "volume")
    return trades.select(F.col("symbol").alias("key"), F.to_json(body).alias("value"))


def trade_envelopes(trades: DataFrame, non_trade_symbol: str = "error") -> DataFrame:
    """Wrap each trade in a provider envelope; rows of ``non_trade_symbol``
    become non-trade messages, so flattening has something to drop."""
    kind = F.when(F.col("symbol") == non_trade_symbol, F.lit("ping")).otherwise(F.lit("trade"))
    item = F.struct(F.col("symbol").alias("s"), F.col("price").alias("p"),
                    F.col("timestamp_ms").alias("t"), F.col("volume").alias("v"))
    return trades.select(F.to_json(F.struct(kind.alias("type"),
                                            F.array(item).alias("data"))).alias("value"))
