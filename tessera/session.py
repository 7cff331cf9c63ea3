"""Session construction and the shared working folder.

Intermediate tables (cut lineage, round trips) go under the folder the cluster
names in ``spark.checkpoint.dir``. We only pick our own folder when that setting
is absent, which is the case in local tests. ``intermediates`` removes such tables when
the results that read them are written.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts from
# runtime sizes, splits skewed join partitions, and converts sort-merge joins to
# broadcast joins only when the measured side is under the threshold.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # delete checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MB = 1 << 20


def cluster_conf(input_bytes: float, executors: int, cores_per_executor: int,
                 shuffle_fraction: float = 0.2, shuffle_partition_bytes: int = 128 * MB,
                 scan_partition_bytes: int = 256 * MB) -> dict:
    """Partition sizing for a cluster run, to pass as ``get_spark(conf=...)``.

    The largest shuffle is estimated as ``shuffle_fraction`` of the input
    (after column pruning; about a fifth for the flight joins). Shuffles start
    with enough partitions for ``shuffle_partition_bytes`` each, and never
    fewer than 3 tasks per core, and AQE coalesces small ones and splits
    skewed ones. Scan splits are ``scan_partition_bytes``.
    For 100 TB on 1,000 executors of 8 cores this gives 163,840 shuffle
    partitions and 256 MB scan splits (about 410,000 scan tasks).
    """
    cores = executors * cores_per_executor
    shuffle = max(3 * cores, int(-(-input_bytes * shuffle_fraction // shuffle_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.default.parallelism": str(3 * cores),
    }


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the defaults above.

    ``master`` is left to the launcher when None (spark-submit sets it).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, choosing a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


@contextlib.contextmanager
def shuffles_of(spark: SparkSession, n: int) -> Iterator[None]:
    """In this block shuffles have ``n`` partitions, so Spark does not deal out again, for
    more tasks, the sides of a join that are dealt into ``n``."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written or collected in this block removes its shuffle files when it is done.
    Else they stay on disk until the driver's garbage collection finds their DataFrame
    unused, which a driver with memory to spare may not do while a query runs."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession, name: str, unique: bool = True, keep: bool = False) -> str:
    """A path under the shared checkpoint folder for an intermediate table. Inside
    ``intermediates`` the folder goes at the end of the block, unless ``keep``: later
    queries read it, or the caller named it (``unique=False``)."""
    base = ensure_checkpoint_dir(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = base.rstrip("/") + "/tessera/" + leaf if "://" in base else os.path.join(base, "tessera", leaf)
    if _scopes and unique and not keep:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the intermediate tables made in this block at its end, whether it fails or not:

        with intermediates(spark):
            rank_postings(post).write.parquet(out)

    A DataFrame made in the block reads those tables, so it has to be written (or
    collected) inside. Blocks may be nested. Only folders that ``shared_dir`` named in the
    block are deleted, through the file system that holds them. A job that dies leaves
    them; they have names of their own, so a new run is not disturbed."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.remove(made)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in made:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
