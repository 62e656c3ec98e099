"""Session and shared-storage helpers.

Jobs never use a machine-local temporary folder on a cluster: every
lineage cut, streaming checkpoint and landing file lives under the shared
folder the cluster names in ``spark.checkpoint.dir``. Only when a session
has no such setting (unit tests, a laptop) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import SparkSession

# The dates the registered queries use in place of
# current_date(), so results are reproducible.
DEFAULT_AS_OF = date(2005, 1, 1)
DEFAULT_ORDER_DATE = date(2000, 1, 1)
DEFAULT_REGISTRATION_DATE = date(2020, 1, 1)

#: How tables are stored: zstd takes about three quarters of the bytes of Spark's default.
STORED = {"compression": "zstd"}

#: Shuffle files go at the end of the job that wrote them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "retailflow",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session used by tests and the bench. On a cluster, submit with the
    cluster's own settings instead; nothing here is required by the jobs."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root folder on shared storage, from ``spark.checkpoint.dir``.

    Sets a temporary one only where the session has none (as in tests),
    and makes sure ``DataFrame.checkpoint()`` writes below it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext
            current = None
        if not current:
            master = spark.conf.get("spark.master", "")
            if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
                raise RuntimeError(
                    "spark.checkpoint.dir is not set: point it at a folder on shared "
                    "storage (tables, stream checkpoints and lineage cuts go below it)"
                )
            current = tempfile.mkdtemp(prefix="retailflow-shared-")
        root = current
    root = root.rstrip("/")
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:
        pass
    return root


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared root for one run."""
    return f"{shared_root(spark)}/retailflow/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs and streams started in here free their shuffle files when they
    end. Spark else keeps them until the driver's garbage collection finds
    their plans gone, so a run of many tables holds the shuffles of all on
    disk at once. For runs that write: a DataFrame that is run a second time
    in here has to shuffle again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
