"""Session settings every job of this package relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Results depend on these two: calendar days are UTC days, and overflow or a
# division by zero must fail instead of giving null.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plans depend on these: AQE sizes partitions, turns small sides into broadcasts
# by their measured size, and splits skewed join partitions even when that
# costs one more shuffle (several joins here share order_id).
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Sizes are estimated from files, where a row of ids and repeating texts takes a twentieth
    # of what it takes in memory, or less: 7 MB can be millions of rows, and a broadcast holds
    # all of them on the driver and in each executor.
    "spark.sql.sources.fileCompressionFactor": "20",
    # Shuffled rows are measured as they are compressed: 3 MB of order ids and dates are a hash
    # table of 50 MB on the driver, and a refresh has several at once.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    # A refresh writes dozens of tables. Without this the shuffle files of each stay on the
    # executors' disks until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"

# Wide order lines of 140 bytes make partitions of 35 MB, which are sorted and hashed in memory.
ROWS_A_PARTITION = 250_000


def partitions_for(rows: int) -> int:
    """Shuffle partitions that stay in a task's memory when a table of ``rows`` is shuffled."""
    return max(1, -(-rows // ROWS_A_PARTITION))


def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the settings above to a session somebody else created.

    AQE merges small shuffle partitions, but it does not split those of an aggregation.
    So ``initial_partitions`` has to fit the largest shuffle: its bytes by about 128 MB,
    for example 40,000 for 5 TB of shuffled order lines, or ``partitions_for`` its rows.
    Without it Spark starts from ``spark.sql.shuffle.partitions``. Partitions are merged by
    their compressed bytes, of which 64 MB can be gigabytes of a hash table; so a large shuffle
    keeps the number it started from, and only one of less than 1 MB a partition has fewer.
    """
    for key, value in {**SEMANTICS, **PLANNING}.items():
        spark.conf.set(key, value)
    if initial_partitions is not None:
        spark.conf.set(INITIAL_PARTITIONS, str(initial_partitions))
        spark.conf.set(LEAST_PARTITIONS, str(initial_partitions))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # No call-site capture per column expression: requests build their
        # frames anew each time, and the capture costs more than the planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only on a local master a fresh
    temporary folder takes its place where that is unset: executors of a cluster would
    each write to a disk of their own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder all executors see")
        app = context.applicationId
        if app not in _own_folder:
            _own_folder[app] = tempfile.mkdtemp(prefix="tallyhouse-")
        folder = _own_folder[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
