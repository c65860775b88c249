"""File sources: per-ticker bar CSVs, daily quote JSON documents, Parquet layers.

Text is read with the declared schemas of ``tidemark.schemas`` and cast with
ANSI-safe casts, so a bad value becomes NULL (and is then dropped by the
quality rules) instead of failing the job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark import constants as C
from tidemark import schemas
from tidemark.functions.expr import safe_cast, safe_date
from tidemark.plans.layers import flatten_quotes

EXCHANGES = C.EXCHANGES

EXCHANGE_DIM_SCHEMA = StructType([
    StructField("exchange_id", IntegerType(), False),
    StructField("exchange_name", StringType(), False),
])


BRONZE_SCHEMA = ("ticker string, date date, open double, high double, low double, close double, "
                 "adjusted_close double, volume bigint, source_exchange string, "
                 "ingestion_timestamp timestamp")


def exchange_dim(spark: SparkSession, exchanges: Sequence[tuple[int, str]] = EXCHANGES
                 ) -> DataFrame:
    """The literal exchange dimension (a handful of rows)."""
    return spark.createDataFrame(list(exchanges), EXCHANGE_DIM_SCHEMA)


def file_path_part(pattern: str, group: int = 1):
    """A piece of the source file path (e.g. the ticker from the file stem),
    percent-decoded."""
    return F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


def _braces(names: Sequence[str]) -> str:
    """A path glob that matches just these folder names."""
    escaped = [re.sub(r"([\\{}\[\]*?,])", r"\\\1", n) for n in names]
    return escaped[0] if len(escaped) == 1 else "{" + ",".join(escaped) + "}"


def read_bars_csv(spark: SparkSession, root: str, exchanges: Sequence[str] | None = None,
                  min_date: str | None = C.MIN_TRADE_DATE) -> DataFrame:
    """Bronze bars from ``<root>/<exchange>/csv/<TICKER>.csv``.

    Only the folders of ``exchanges`` (by default the names of ``EXCHANGES``)
    are listed and read, in one scan, so the many small files are packed into
    splits by the file source.  A folder that does not exist contributes
    nothing; if none exists the result is empty.  Output: ticker, date, open,
    high, low, close, adjusted_close, volume, source_exchange,
    ingestion_timestamp.
    """
    names = [n for _, n in EXCHANGES] if exchanges is None else list(exchanges)
    reader = spark.read.schema(schemas.BAR_CSV).option("header", True).option("mode", "PERMISSIVE")
    try:
        raw = reader.csv(f"{root.rstrip('/')}/{_braces(names)}/csv/*.csv") if names else None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = None
    if raw is None:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return parse_bars(raw, file_path_part(C.TICKER_FROM_PATH), file_path_part(r"/([^/]+)/csv/[^/]+$"), min_date)


def parse_bars(raw: DataFrame, ticker: Column, exchange: Column,
               min_date: str | None = C.MIN_TRADE_DATE) -> DataFrame:
    """Bar text columns (``schemas.BAR_CSV``) -> typed bronze rows; a bad value
    becomes NULL, rows before ``min_date`` or without a date are dropped."""
    out = raw.select(
        ticker.alias("ticker"),
        safe_date("Date").alias("date"),
        safe_cast("Open", "double").alias("open"),
        safe_cast("High", "double").alias("high"),
        safe_cast("Low", "double").alias("low"),
        safe_cast("Close", "double").alias("close"),
        safe_cast("Adjusted Close", "double").alias("adjusted_close"),
        safe_cast("Volume", "bigint").alias("volume"),
        exchange.alias("source_exchange"),
        F.current_timestamp().alias("ingestion_timestamp"))
    if min_date is not None:
        out = out.filter(F.col("date") >= F.lit(min_date).cast("date"))
    return out


def bars_from_bronze(bronze: DataFrame, dim: DataFrame) -> DataFrame:
    """Bronze rows -> the bar model (trade_date, *_price, exchange_id).

    The exchange id comes from a join with the dimension (a literal of a few
    rows, which Spark broadcasts by its size estimate; no hint, so a large
    dimension would be shuffled instead); an unknown folder name gets a NULL
    id, as the code mapping did.
    """
    return (bronze.join(dim, F.col("source_exchange") == F.col("exchange_name"), "left")
            .select("ticker", F.col("date").alias("trade_date"),
                    F.col("open").alias("open_price"), F.col("high").alias("high_price"),
                    F.col("low").alias("low_price"), F.col("close").alias("close_price"),
                    F.col("adjusted_close").alias("adjusted_close_price"), "volume",
                    "exchange_id", F.col("source_exchange").alias("exchange_name")))


def read_quotes_json(spark: SparkSession, glob: str) -> DataFrame:
    """Daily quote documents ``<yyyy-MM-dd>/quotes.json`` (multi-line JSON)
    -> the streaming_daily_quotes layer; the date comes from the path."""
    raw = (spark.read.schema(schemas.QUOTE_JSON).option("multiLine", True).json(glob)
           .withColumn("quote_date",
                       F.regexp_extract(F.col("_metadata.file_path"), C.QUOTE_DATE_FROM_PATH, 1)))
    return flatten_quotes(raw)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer; partition columns are discovered from the folders."""
    return spark.read.parquet(path)
