"""Session construction and the shared scratch / checkpoint folder.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``; it is read from the running session. Only when
that setting is absent (local runs, tests) is a local folder created and
registered as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that matter for the plans in this library. Values that depend on
# data volume (shuffle partitions, broadcast threshold) are only defaults for
# local runs; a cluster job passes its own through ``extra``.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one extra shuffle
    # (e.g. a join whose output feeds an aggregation on the same key).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Speed-layer state lives in RocksDB (off-heap, spills to local disk)
    # with changelog checkpointing, so state size is not bound by executor
    # heap. Fixed in the checkpoint at a query's first start.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ratinglens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; otherwise, on a
    local master only (tests, local runs), a fresh local folder is registered
    as the checkpoint dir. A cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ratinglens-ckpt-"))
    else:
        # A folder on the driver's disk is invisible to executors.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder below the shared checkpoint root.

    Every run gets its own folder, so nothing is ever cleared or overwritten
    while another reader may use it.
    """
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{purpose}-{uuid.uuid4().hex[:12]}"


def at_once(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Results of jobs that do not need each other, each submitted from a
    thread of its own: where one has fewer tasks than the cluster has cores,
    another uses the rest. All have ended when a failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]


def scale_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_fraction: float = 0.1,
    shuffle_partition_bytes: int = 128 << 20,
    scan_partition_bytes: int = 256 << 20,
    broadcast_bytes: int = 64 << 20,
) -> dict[str, str]:
    """Partition sizing for a cluster run.

    Scans are split at ``scan_partition_bytes``. Shuffles carry the data
    left after column pruning and map-side partial aggregation — estimated as
    ``shuffle_fraction`` of the input — cut into ~``shuffle_partition_bytes``
    partitions, at least two waves of the cluster's cores.
    AQE then coalesces small partitions and splits skewed ones at runtime.

    A join side whose measured size stays under ``broadcast_bytes`` (e.g. a
    player dimension of some hundred thousand rows) is broadcast, so the fact
    side is not shuffled for it; anything larger falls back to a sort-merge
    join — the planner checks the size, not this library."""
    wanted = -(-int(input_bytes * shuffle_fraction) // shuffle_partition_bytes)
    shuffle = max(2 * total_cores, wanted)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(1 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }
