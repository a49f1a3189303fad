"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every job in the library: AQE re-plans joins from
# measured shuffle sizes (broadcast only when the measured side is small) and
# splits skewed partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Wide projections (dozens of string expressions per row) generate large
    # methods; above ~8000 bytes of bytecode HotSpot does not JIT-compile a
    # method, so let Spark split such stages instead (measured ~2x faster on
    # the 32-column validation projection).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "upcheck",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    On a cluster it must be configured (a distributed file system path); a
    machine-local temporary folder is only created for local-mode sessions
    where the setting is absent, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder "
                "(e.g. an object-store or HDFS path) for this cluster")
        path = tempfile.mkdtemp(prefix="upcheck-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location below the shared folder."""
    return "/".join([shared_dir(spark), "upcheck", *parts, uuid.uuid4().hex])
