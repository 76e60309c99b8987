"""Session factory and session guards.

The warehouse relies on a UTC session time zone: bronze timestamps are
UTC instants and the staging layer converts them to local wall-clock time
explicitly.  Any other session zone would shift dates twice.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "metroflux",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for the warehouse."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        # Re-apply runtime SQL settings on a reused session (static ones are fixed at start).
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Raise when the session zone is not UTC (localisation assumes it)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"session time zone must be UTC, got {tz!r}")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a scratch folder is
    created and registered; on a cluster the configured shared path wins.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a local temp folder is "
                               "not visible to other executors")
        path = tempfile.mkdtemp(prefix="metroflux-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
           shuffle_bytes: int | None = None, reducer_bytes: int = 1 << 30) -> dict:
    """Shuffle and scan settings for an input size and cluster.

    Scan splits of ``target_partition_bytes``, twice that from 10 TB on.  Reducers
    are sized by what is shuffled, not by what is read: ``shuffle_bytes`` defaults
    to a tenth of the input, as scans are pruned to a few columns and aggregates
    are combined before the shuffle; a join that ships most of its input should
    pass its own figure.  A shuffle has (map tasks x reducers) blocks, so reducers
    of about ``reducer_bytes`` keep their number and the blocks' size workable:
    100 TB on 8,000 cores gives 16,000 reducers, not hundreds of thousands.
    AQE coalesces small ones and splits skewed ones.
    """
    shuffled = input_bytes // 10 if shuffle_bytes is None else shuffle_bytes
    split = target_partition_bytes * (2 if input_bytes >= 10 * 10**12 else 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(max(2 * total_cores, -(-int(shuffled) // reducer_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * reducer_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
