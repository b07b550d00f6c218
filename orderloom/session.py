"""Session settings, shuffle sizing and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings the results or the skew handling rely on. forceOptimizeSkewedJoin lets AQE
# split a hot join key even when the next operator then needs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that lie by order id already are joined on the order and a further key where they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Parquet decodes to roughly four times its size on disk.
EXPANSION = 4
MB = 1024 * 1024
LARGEST_PARTITION = 128 * MB
SMALLEST_PARTITION = MB // 4
# Limits on the number of tasks, which the driver has to keep account of. Where they take hold
# (about 6 TB stored for shuffles, 25 TB for scans), partitions grow beyond 128 MB instead.
MOST_PARTITIONS = 200_000
MOST_SCAN_TASKS = 200_000
SCAN_SIZE = "spark.sql.files.maxPartitionBytes"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# A task sorts the rows that are left once it has so many files open.
MOST_OPEN_WRITERS = 16
HASHED_SIZE = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

_fallback_roots: dict[str, str] = {}
_sized: dict[tuple[str, str], int] = {}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stored_bytes(spark: SparkSession, input_path: str) -> int:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(input_path)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def shuffle_sizes(
    stored: int,
    cores: int,
    most_partitions: int = MOST_PARTITIONS,
    most_scan_tasks: int = MOST_SCAN_TASKS,
) -> tuple[int, int, int]:
    """Shuffle partition size, their starting count, and scan split, for an input's stored size.

    Shuffle partitions grow with the input up to 128 MB; small inputs still occupy every
    core. AQE merges what turns out smaller than the set size and splits what turns out
    skewed. Beyond the two limits partitions grow further; raise the limits with the driver.
    """
    decoded = stored * EXPANSION
    size = min(LARGEST_PARTITION, max(SMALLEST_PARTITION, decoded // (4 * cores)))
    size = max(size, -(-decoded // most_partitions))
    count = max(cores, -(-decoded // max(size, LARGEST_PARTITION)))
    return size, count, max(LARGEST_PARTITION, stored // most_scan_tasks)


def prepare(
    spark: SparkSession,
    input_path: str,
    most_partitions: int = MOST_PARTITIONS,
    most_scan_tasks: int = MOST_SCAN_TASKS,
) -> SparkSession:
    """Settings and sizes for an input, whose files are listed once per application."""
    apply_settings(spark)
    key = (spark.sparkContext.applicationId, input_path)
    if key not in _sized:
        _sized[key] = stored_bytes(spark, input_path)
    cores = spark.sparkContext.defaultParallelism
    size, count, scan = shuffle_sizes(_sized[key], cores, most_partitions, most_scan_tasks)
    spark.conf.set(ADVISORY_SIZE, str(size))
    spark.conf.set(INITIAL_PARTITIONS, str(count))
    spark.conf.set(SCAN_SIZE, str(scan))
    return spark


@contextmanager
def _meanwhile(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffled_by(spark: SparkSession, partitions: int) -> AbstractContextManager[None]:
    """Meanwhile jobs shuffle to so many partitions: what is written in as many buckets lies right after a join."""
    return _meanwhile(spark, {INITIAL_PARTITIONS: str(partitions)})


def for_many_steps(spark: SparkSession) -> AbstractContextManager[None]:
    """Settings for a run of many steps, each of which writes what the next one reads.

    A step's shuffle files go when it ends, not when the driver comes to collect its garbage; a frame that is used
    again makes them anew. Rows are written to their few partitions without being sorted by them first. A join's side of
    which each shuffle partition stays below AQE's size is hashed, and neither side sorted.
    """
    size = spark.conf.get(ADVISORY_SIZE)
    return _meanwhile(spark, {CLEANUP: "true", OPEN_WRITERS: str(MOST_OPEN_WRITERS), HASHED_SIZE: size})


def work_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a private temp folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _fallback_roots:
        root = tempfile.mkdtemp(prefix="orderloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _fallback_roots[app] = root
    return _fallback_roots[app]


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{work_root(spark)}/orderloom/{purpose}-{uuid.uuid4().hex}"


def run_together(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs side by side, so that small ones do not queue."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local-mode session for tests and the benchmark, with Spark's own broadcast threshold."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)
