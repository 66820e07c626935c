"""Session construction and shared-storage helpers."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins from real shuffle sizes
# (runtime broadcast of small sides, skew-join splitting, partition
# coalescing) and ANSI mode makes bad casts fail loudly, as the source
# pipeline's engine does.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20
# Bounds of the sizing rules below.
SHUFFLED_SHARE = 0.25                 # of the input that a typical mart shuffles, after projection and map-side combine
LEAST_SPLIT, MOST_SPLIT = 128 * MB, 1024 * MB
MAP_TASKS = 100_000                   # wanted at most; splits grow to reach it, up to MOST_SPLIT
REDUCER_BYTES = 256 * MB
LEAST_REDUCERS, MOST_REDUCERS = 8, 20_000


def split_bytes_for(input_bytes: int) -> int:
    """Bytes of a file split: ``input_bytes / MAP_TASKS`` within [128 MB, 1 GB]."""
    return min(MOST_SPLIT, max(LEAST_SPLIT, math.ceil(input_bytes / MAP_TASKS)))


def partitions_for(input_bytes: int, shuffled_share: float = SHUFFLED_SHARE) -> int:
    """Shuffle partitions: ``input_bytes * shuffled_share / 256 MB`` within [8, 20 000].

    The bound keeps the number of shuffle blocks (map tasks x partitions) one
    that the driver can track: 100 TB gives 102 400 splits of 1 GB and 20 000
    partitions of about 1.3 GB, which spill where memory is short. AQE
    coalesces small partitions and splits skewed ones at run time.
    """
    return min(MOST_REDUCERS, max(LEAST_REDUCERS, math.ceil(input_bytes * shuffled_share / REDUCER_BYTES)))


def build_session(master: str | None = "local[8]", app: str = "sunlight",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let the launcher decide, and give
    ``input_bytes`` (the size of the largest input): split size and shuffle
    partitions follow from it. Without it a local session takes 8 partitions,
    and a cluster session three for each core it has (never a fixed small
    number, which AQE could not raise).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes is not None:
        shuffle_partitions = shuffle_partitions or partitions_for(input_bytes)
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(REDUCER_BYTES)
        conf["spark.sql.files.maxPartitionBytes"] = str(split_bytes_for(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in conf:
        spark.conf.set("spark.sql.shuffle.partitions", str(default_partitions(spark)))
    ensure_checkpoint_dir(spark)
    return spark


def default_partitions(spark: SparkSession) -> int:
    """Shuffle partitions where no input size is given."""
    if spark.sparkContext.master.startswith("local"):
        return LEAST_REDUCERS
    return min(MOST_REDUCERS, max(200, 3 * spark.sparkContext.defaultParallelism))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only when the
    setting is absent *and* the master is local (tests, a laptop) is a
    private scratch folder made; on a cluster a missing setting is an error,
    because a machine-local folder is not visible to other executors.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                           "distributed file system)")
    local = tempfile.mkdtemp(prefix="sunlight-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def _session_scratch(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"sunlight-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables.

    All folders of a session lie in one, which ``clear_scratch`` removes.
    """
    return os.path.join(_session_scratch(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def clear_scratch(spark: SparkSession) -> bool:
    """Remove the tables this session wrote with ``scratch_path``: call it when no
    frame that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_scratch(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
