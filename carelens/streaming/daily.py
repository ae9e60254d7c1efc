"""Daily pulls as an incremental stream.

The reference fetches "today's" rows of each source table once a day.  With
sources that land as files, Structured Streaming does the same job with
exactly-once bookkeeping: each run picks up only the files that arrived
since the last run (``trigger(availableNow=True)``), types them like the
batch readers, and appends them to a parquet table partitioned by day.  The
stream's progress lives in a checkpoint under ``spark.checkpoint.dir``, so a
restarted or failed run neither skips nor repeats a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.sources.readers import canonical_columns, coerce_types
from carelens.sources.schemas import SCHEMAS
from carelens.sources.sinks import checkpoint_root


def read_landing(spark: SparkSession, path: str, source: str, fmt: str = "parquet",
                 schema=None, keep=()) -> DataFrame:
    """Streaming scan of a landing folder, renamed and typed like the batch
    readers.  File sources need a schema up front: the canonical one (plus
    ``keep`` columns) unless given."""
    if schema is None:
        schema = SCHEMAS[source]
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    return coerce_types(canonical_columns(df, source, keep), source)


def ingest_daily(spark: SparkSession, stream: DataFrame, date_col: str, table_path: str,
                 name: str) -> None:
    """Append every not-yet-seen row of ``stream`` to ``table_path``,
    partitioned by the calendar day of ``date_col``.  Blocks until the files
    present now are processed."""
    out = stream.withColumn("day", F.to_date(F.col(date_col)))
    query = (
        out.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", f"{checkpoint_root(spark)}/carelens/streams/{name}")
        .partitionBy("day")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
