"""Session and shared-folder helpers.

The shared folder is the one the cluster names in ``spark.checkpoint.dir``.
Every job that must cut lineage or stage data (token vault, landing zones,
streaming checkpoints) writes below it, so an executor lost mid-job never
takes data with it. A folder of our own is only set when the setting is
absent and Spark runs in local mode (tests, the bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every session of this library relies on. AQE re-plans joins at
# runtime from measured sizes (broadcast only below the threshold) and splits
# skewed shuffle partitions; UTC keeps timestamps equal to the oracle's.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


PARTITION_BYTES = 256 << 20


def cluster_conf(input_bytes: int) -> dict[str, str]:
    """Settings for a large cluster, sized from the bytes a job reads.

    AQE merges small shuffle partitions but only splits those of skewed
    joins, so the number to start from must follow the input: one partition
    per 256 MB (100 TB: about 400,000). Scans split at 256 MB as well; runtime
    broadcasts go by measured bytes.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // PARTITION_BYTES))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "32m",
        # Streaming state (S4's per-key dedupe within the delay) grows with the
        # keys seen in the delay: keep it in RocksDB, off the JVM heap, with
        # changelog checkpoints to the checkpoint location.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def build_session(master: str = "local[*]", app_name: str = "laketide",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, input_bytes: int | None = None) -> SparkSession:
    """A session with this library's settings.

    ``input_bytes`` (of a cluster job) adds ``cluster_conf``.
    ``spark.checkpoint.dir`` must then name a shared folder (see ``shared_dir``).
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    if input_bytes is not None:
        conf.update(cluster_conf(input_bytes))
    for k, v in conf.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of ``SESSION_CONF`` to a given session."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.ui."):
            continue
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written intermediates.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set and the master is local, a folder is created and set;
    on a cluster a missing setting, or a ``file:`` folder, is an error.
    """
    local = spark.sparkContext.master.startswith("local")
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if path:
        if path.startswith("file:") and not local:
            raise RuntimeError("spark.checkpoint.dir names a machine's own folder; name a shared one")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
        return path.rstrip("/")
    if not local:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for the cluster")
    path = tempfile.mkdtemp(prefix="laketide-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder."""
    root = shared_dir(spark)
    return f"{root}/laketide/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Read one lake table, under its declared schema when one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{sf_dir}/{name}.parquet")
