"""Writers for the feature and cluster tables (S5, S6) and the shared
scratch location used to cut lineage between stages."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    It is read from the session; a private folder is made only for a local
    master that leaves it unset (``carelens.session.ensure_checkpoint_dir``)."""
    from carelens.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark).rstrip("/")


# Scratch tables written by this driver and not yet released, and the names
# of those that are in the session's catalogue.
_scratch: list[str] = []
_named: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder; ``release`` removes it."""
    path = f"{checkpoint_root(spark)}/carelens/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch tables this driver has made (from the ``since``-th
    on, see ``scratch_mark``) once their consumers have been written; returns
    how many were removed.  Only paths handed out by ``scratch_path`` go."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    gone = _scratch[since:]
    del _scratch[since:]
    for p in gone:
        for named in [n for n in _named if n == p or n.startswith(f"{p}/")]:
            spark.sql(f"DROP TABLE IF EXISTS {_named.pop(named)}")
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(gone)


def scratch_mark() -> int:
    """How many scratch tables exist now: pass it to ``release`` later."""
    return len(_scratch)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", compression: str | None = None) -> str:
    """Write a table.  CSV gets a header row and ISO timestamps; no
    ``coalesce(1)``: every task writes its own part file.  ``compression`` is a
    codec of the format (default: its own)."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    w.format(fmt).save(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: cuts the lineage, so a lost executor recomputes from the
    written table and not from the raw inputs."""
    path = write_table(df, scratch_path(spark, name), compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def write_buckets(df: DataFrame, path: str, buckets: int, keys: Sequence[str], sort: Sequence[str] | None = None) -> str:
    """Write ``df`` under ``path`` (unique to it) as a table bucketed by
    ``keys`` and sorted by them (or by ``sort``) inside a bucket; returns the
    table's name.  A ``df`` that is hash partitioned by ``keys`` into
    ``buckets`` (or AQE's joins of those) gives one file a bucket, any other
    one a file for each task, which only buckets without a sort are read as."""
    table = _table_name(path)
    w = df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, *keys)
    if sort is None or len(sort):
        w = w.sortBy(*(sort or keys))
    w.saveAsTable(table)
    _named[path] = table
    return table


def bucket_table(spark: SparkSession, root: str, schema: StructType, parts: Mapping[str, str], buckets: int, keys: Sequence[str]) -> str:
    """The name of a table of what ``write_buckets`` wrote with ``keys`` to the
    paths ``parts`` under ``root``, in this session or another: one bucketed
    table with a partition (column ``_part``) for each."""
    table = "carelens_" + hashlib.md5("|".join(parts.values()).encode()).hexdigest()
    if not spark.catalog.tableExists(table):
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {table} ({schema.toDDL()}, _part STRING) USING parquet PARTITIONED BY (_part) "
                  f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{root}/{table}'")
        for part, path in parts.items():
            spark.sql(f"ALTER TABLE {table} ADD PARTITION (_part = '{part}') LOCATION '{path}'")
        _named[f"{root}/{table}"] = table
    return table


def _table_name(path: str) -> str:
    return "carelens_" + "_".join(path.split("/")[-2:]).replace("-", "_")


def materialize_buckets(spark: SparkSession, df: DataFrame, name: str, buckets: int, keys: Sequence[str],
                        sort: Sequence[str] | None = None) -> DataFrame:
    """``materialize`` as a table bucketed and sorted by ``keys`` (or by
    ``sort``): groupings and joins by them read it without an exchange."""
    return spark.table(write_buckets(df, scratch_path(spark, name), buckets, keys, sort))
