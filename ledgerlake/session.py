"""Session helpers: a local session for tests/bench and the shared scratch folder.

Library code never creates or stops a session; jobs receive one from the caller.
Scratch data (checkpoints, round-trip files) lives under ``spark.checkpoint.dir``,
which on a cluster names a shared folder. Only a local-mode session without that
setting (tests, bench) gets a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Groups with sketches that a task keeps in a hash table before it sorts its rows instead: the
#: calendar cells (hours x types) are fewer, at about a KB each.
SKETCH_GROUPS = 8192


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake") -> SparkSession:
    """A local session configured like the tests expect (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(SKETCH_GROUPS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; set a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{_CHECKPOINT_CONF} is not set: a cluster job needs a shared folder for checkpoints"
        )
    local_dir = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/ledgerlake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores`` executor cores.

    Scan splits of ~256 MB, an initial shuffle width of ~input/target (at least
    3 waves of the cores) that AQE coalesces down to 128 MB partitions, and skew
    splitting for joins and rebalanced writes. A rule, not a measurement: at
    100 TB on 8,000 cores this gives ~400k initial shuffle partitions.
    """
    waves = 3 * max(1, total_cores)
    shuffle = max(waves, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": str(SKETCH_GROUPS),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def apply_sizing(spark: SparkSession, input_bytes: int, total_cores: int) -> dict[str, str]:
    """Set the sizing keys the session does not set already; returns what was applied."""
    applied = {}
    for key, value in sizing_conf(input_bytes, total_cores).items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
            applied[key] = value
    return applied
