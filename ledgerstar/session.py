"""Session helpers and the shared storage root.

On a cluster every job writes below the shared folder named by
``spark.checkpoint.dir``. That setting is read from the session; a folder of
our own is only set where it is unset (local tests and benchmarks).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerstar", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    ``spark.checkpoint.dir`` when the cluster names one; otherwise the
    checkpoint directory already set on the context; otherwise (local runs
    only) a fresh temporary folder, which is then also set as checkpoint dir.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # no context object (e.g. a remote session): settings only
        if conf_dir:
            return conf_dir.rstrip("/")
        raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
    conf_dir = conf_dir or context.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not context.getCheckpointDir():  # named as a session setting only
            context.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerstar-"))
    # Spark adds a unique subfolder; every call returns that same path.
    return context.getCheckpointDir().rstrip("/")


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A new, unique folder below the shared root (one per run)."""
    return f"{shared_root(spark)}/ledgerstar/{tag}-{uuid.uuid4().hex[:12]}"


def run_concurrently(tasks: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent Spark actions from separate threads; Spark schedules
    their jobs side by side. Results keep the input order; the first error
    is raised once every task has finished."""
    if len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        wait(futures.values())
    return {name: future.result() for name, future in futures.items()}
