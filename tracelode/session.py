"""Session set-up for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "tracelode") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings of the jobs.

    A record that repeats a key is loaded with its last value. Keys of the re-delivery check
    live in RocksDB, so a day of keys need not fit the executors' heap.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def together(spark: SparkSession, calls: list[Callable[[], Result]], at_once: int = 8) -> list[Result]:
    """The results of calls that do not depend on each other, in order. They run at the same time, so that the tasks of one
    job fill the cores that the last tasks, the planning and the commit of another leave idle.

    All calls have ended when this returns or raises the first failure.
    """
    if not calls:
        return []
    with ThreadPoolExecutor(min(at_once, len(calls))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [call.result() for call in running]


class InTurn:
    """Blocks of calls that run together, of which only one runs at a time. After one has failed no other begins: the calls
    that come later fail too, whatever order they come in.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._failed: BaseException | None = None

    def __enter__(self) -> None:
        self._lock.acquire()
        if self._failed is not None:
            self._lock.release()
            raise RuntimeError("not begun, as another failed") from self._failed

    def __exit__(self, kind, failed: BaseException | None, trace) -> None:
        self._failed = failed
        self._lock.release()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local temporary folder is only good enough while driver and executors
    share one machine, so it is refused for every other master.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tracelode/{name}-{uuid.uuid4().hex}"
