"""tidemark: market time-series analytics as plain Spark DataFrame operators.

Layout
------
functions/  Column -> Column expressions (guarded ratios, direction, casts)
operators/  DataFrame -> DataFrame building blocks (quality, windows, aggregates, joins)
sources/    readers, writers and the adapters over the provided test tables
plans/      layer builds (silver, daily, monthly, yearly, quotes) and the ten questions
streaming/  the five windowed trade questions, stream sources and idempotent sinks

Every operator works on any DataFrame with the named columns; nothing collects
to the driver and nothing reads the environment.
"""

__version__ = "0.1.0"
