"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every runway session wants; sizes are per deployment and stay overridable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A whole-stage method above the JVM's JIT limit (8000 bytecodes) runs interpreted;
    # past this size Spark falls back to per-operator code, which stays compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # remove reliable-checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "runway",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with runway's defaults.

    On a cluster leave ``master`` as None so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def private_folder_allowed(master: str) -> bool:
    """Whether a machine-local folder can serve as the shared one: only when all runs in one process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a private folder; on a
    cluster each executor would write to its own disk, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not private_folder_allowed(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="runway-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


#: the intermediate tables written inside the current ``intermediates`` blocks, innermost last;
#: kept per thread and task, so that jobs at the same time do not see each other's
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("runway_intermediates", default=())


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/runway-{name}-{uuid.uuid4().hex[:12]}"
    for scope in _scopes.get()[-1:]:
        scope.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system it is; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside the block at its end, also on failure.

    For work that ends with a written result; a query that returns a lazy
    DataFrame still needs its tables.  Blocks can be nested.
    """
    written: list[str] = []
    token = _scopes.set((*_scopes.get(), written))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in written:
            delete_path(spark, path)


@contextmanager
def fixed_partitions(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside the block keep the partitioning they state, and their checkpoints remember it.

    Adaptive execution would merge partitions at run time and hide the partitioning
    from whoever reads the checkpoint.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return os.cpu_count() or 8
