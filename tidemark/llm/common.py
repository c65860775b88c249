"""Helpers shared by the operators: scratch tables, reading inputs, Arrow maps."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BATCH_BYTES = 16 * 1024 ** 2

# Rows handed to Python at once.  Python looks at a slice of this many rows, so
# its memory follows a few documents and not a whole Arrow batch.
SLICE_ROWS = 64


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, below the shared checkpoint
    folder (a cluster session without one raises)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-llm/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors' Python workers, once a session,
    and keep the Arrow batches they get to ``BATCH_BYTES``."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for folder, _, names in os.walk(PACKAGE):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
        target = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark.zip")
        with open(target, "wb") as out:
            out.write(packed.getvalue())
        context.addPyFile(target)
        _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that read the written
    files and nothing before them.  The file size also tells Spark how large
    the table is, so a later join broadcasts it only where it is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8_bytes(text: Column) -> Column:
    """Length of the text in UTF-8 bytes."""
    return F.octet_length(text).cast("long")


def map_rows(df: DataFrame, columns: list[str], schema: str,
             make: Callable[[], Callable[[list], list]], end: Callable[[], None] | None = None) -> DataFrame:
    """Run a Python function over slices of rows, with bounded memory.

    ``make`` runs once per task and returns a function from one list per input
    column to one list per output column.  ``end`` runs after a task's last row:
    the worker process stays for other tasks, with all that its modules hold.
    """
    ship_package(df.sparkSession)
    out_schema = df.sparkSession.createDataFrame([], schema).schema
    arrow_schema = _arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(start, SLICE_ROWS)
                    out = step(*[c.to_pylist() for c in part.columns])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t.type) for v, t in zip(out, arrow_schema, strict=True)],
                        schema=arrow_schema)
        finally:
            if end:
                end()

    return df.select(*columns).mapInArrow(run, out_schema)


def map_stream(df: DataFrame, columns: list[str], schema: str,
               run: Callable[[Iterator[tuple]], Iterator[tuple]], flush_bytes: int = BATCH_BYTES) -> DataFrame:
    """Run a generator over a task's rows, one at a time; it may yield any number of rows."""
    ship_package(df.sparkSession)
    out_schema = df.sparkSession.createDataFrame([], schema).schema
    arrow_schema = _arrow_schema(out_schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield tuple(c[k].as_py() for c in batch.columns)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(zip(*held), arrow_schema, strict=True)],
                                          schema=arrow_schema)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in run(rows(batches)):
            held.append(row)
            size += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if size >= flush_bytes or len(held) >= 10_000:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return df.select(*columns).mapInArrow(job, out_schema)


def _arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
