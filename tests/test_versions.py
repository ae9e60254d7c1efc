"""Versioned result tables: what readers see while writers work, die or race."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from carelens.sources import versions as V


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/table"


def values(df):
    return sorted(r.id for r in df.collect())


def test_versions_follow_one_another(spark, root):
    assert V.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        V.read(spark, root)
    assert V.publish(spark.range(3), root) == 1
    first = V.read(spark, root)
    assert V.publish(spark.range(5).withColumn("t", F.lit("a,\"b\"")), root, "csv") == 2
    assert V.read(spark, root).dtypes == [("id", "bigint"), ("t", "string")]
    assert values(V.read(spark, root)) == [0, 1, 2, 3, 4] and V.read(spark, root).first()["t"] == 'a,"b"'
    # The older version stays readable, by number and through an open reader.
    assert values(V.read(spark, root, 1)) == values(first) == [0, 1, 2]
    with pytest.raises(FileNotFoundError):
        V.read(spark, root, 9)


def test_a_killed_writer_leaves_nothing_visible(spark, root, tmp_path):
    V.publish(spark.range(3), root)
    broken = spark.range(1000, numPartitions=8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        V.publish(broken, root)
    assert V.versions(spark, root) == [1] and values(V.read(spark, root)) == [0, 1, 2]
    # One that died while it wrote its manifest: data is there, the file is cut.
    with open(tmp_path / "table" / "versions" / f"{2:010d}", "w") as f:
        f.write('{"snapshot": "abc", "form')
    assert V.versions(spark, root) == [1] and values(V.read(spark, root)) == [0, 1, 2]
    # Its number is not used again.
    assert V.publish(spark.range(7), root) == 3
    assert V.versions(spark, root) == [1, 3] and len(values(V.read(spark, root))) == 7


def test_two_writers_get_a_number_each(spark, root):
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda n: (V.publish(spark.range(n), root), n), [10, 20, 30, 40]))
    assert sorted(v for v, _ in numbers) == [1, 2, 3, 4] == V.versions(spark, root)
    for v, n in numbers:
        assert V.read(spark, root, v).count() == n
    latest = max(numbers)
    assert V.read(spark, root).count() == latest[1]


def test_a_number_taken_meanwhile_is_not_overwritten(spark, root, monkeypatch):
    V.publish(spark.range(1), root)
    seen = V._manifests(spark, root)
    V.publish(spark.range(2), root)
    stale = iter([seen])  # the writer looked before version 2 came
    real = V._manifests
    monkeypatch.setattr(V, "_manifests", lambda s, r: next(stale, None) or real(s, r))
    assert V.publish(spark.range(3), root) == 3
    assert [V.read(spark, root, v).count() for v in (1, 2, 3)] == [1, 2, 3]


def test_vacuum_keeps_the_last_versions(spark, root, tmp_path):
    for n in (1, 2, 3):
        V.publish(spark.range(n), root)
    os.makedirs(tmp_path / "table" / "data" / "left-by-a-dead-writer")
    gone = V.vacuum(spark, root, keep=2)
    assert len(gone) == 2 and "left-by-a-dead-writer" in gone
    assert V.versions(spark, root) == [2, 3] and V.read(spark, root, 2).count() == 2
    assert V.vacuum(spark, root, keep=1) and V.versions(spark, root) == [3]
    assert V.publish(spark.range(9), root) == 4


def test_the_job_keeps_the_last_result_when_it_fails(spark, small_sources, root):
    from carelens import job

    V.publish(spark.range(2), root)
    bad = small_sources.with_frames(calls=small_sources.calls.withColumn("CustomerCode", F.lit("not a number")))
    with pytest.raises(Exception):
        job.run_job(spark, bad, root, f"{root}-clusters")
    assert values(V.read(spark, root)) == [0, 1] and V.versions(spark, f"{root}-clusters") == []
