"""SparkSession with the settings the feature plans assume."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the plans rely on.  Shuffle-partition count is a per-deployment
# knob: the default suits local runs; on a cluster set it so one shuffle
# partition stays around 128-256 MB (AQE coalesces small ones).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast decisions: at planning time only sides whose estimated size
    # is under Spark's conservative 10 MB default; at run time AQE broadcasts
    # a side once its *measured* shuffle output is under 32 MB.  Anything
    # larger stays a sort-merge join (with skew splitting).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "carelens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The deployment's ``spark.checkpoint.dir``.

    Only a local master may leave it unset (tests, notebooks): there the
    driver's disk is the executors' disk, so a private temporary folder is
    shared by definition.  Any other master must name a shared folder."""
    sc = spark.sparkContext
    current = (
        sc.getConf().get("spark.checkpoint.dir", None)
        or spark.conf.get("spark.checkpoint.dir", None)
        or sc.getCheckpointDir()
    )
    if not current:
        if not _is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="carelens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers of ``spark``, once per
    application, through Spark's own file server.  The archive is code, not
    data: it is built in the driver's temporary folder and never read there
    by executors."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="carelens-code-"), "carelens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("carelens", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)
