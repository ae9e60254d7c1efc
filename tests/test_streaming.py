"""The daily pull as a file stream: each file is ingested exactly once."""

from pyspark.sql import functions as F

from carelens.sources import sinks as SK
from carelens.sources.fixtures import calls_view
from carelens.streaming.daily import ingest_daily, read_landing

SF = "/root/testdata/sf0.001"


def test_incremental_ingest_exactly_once(spark):
    calls = calls_view(spark, SF)
    landing = SK.scratch_path(spark, "landing-calls")
    table = SK.scratch_path(spark, "calls-table")
    days = sorted(r[0] for r in calls.select(F.to_date("PostingDate")).distinct().collect())
    first, second = days[: len(days) // 2], days[len(days) // 2:]
    day = F.to_date("PostingDate")
    calls.where(day.isin(first)).write.mode("append").parquet(landing)
    schema = calls.schema
    name = landing.rsplit("/", 1)[-1]

    ingest_daily(spark, read_landing(spark, landing, "calls", schema=schema, keep=["event_id"]),
                 "PostingDate", table, name)
    n1 = spark.read.parquet(table).count()
    assert n1 == calls.where(day.isin(first)).count()

    calls.where(day.isin(second)).write.mode("append").parquet(landing)
    ingest_daily(spark, read_landing(spark, landing, "calls", schema=schema, keep=["event_id"]),
                 "PostingDate", table, name)
    got = spark.read.parquet(table)
    assert got.count() == calls.count()
    assert got.select("event_id").distinct().count() == calls.count()
    # a rerun with nothing new adds nothing
    ingest_daily(spark, read_landing(spark, landing, "calls", schema=schema, keep=["event_id"]),
                 "PostingDate", table, name)
    assert spark.read.parquet(table).count() == calls.count()
