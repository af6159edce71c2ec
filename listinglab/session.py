"""Session helpers: defaults for scale, shared work folders."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings we want on any cluster. Each is applied only when the session has
# no value of its own, so a cluster's tuned configuration always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE may turn a shuffle join into a broadcast join only when the
    # materialised side is measured below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # HotSpot never compiles a method of over 8,000 bytes: a stage whose generated
    # method is larger runs operator by operator, in methods that Spark splits.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: By session: how many are inside :func:`own_shuffles`, and the setting that stood before the first of them.
_INSIDE: dict[str, tuple[int, str | None]] = {}
_LOCK = threading.Lock()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _DEFAULTS.items():
        try:
            current = spark.conf.get(key, None)
        except Exception:  # pragma: no cover - conf not readable
            current = None
        if current is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "listinglab") -> SparkSession:
    """Session for tests and the local benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LISTINGLAB_DRIVER_MEM", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one that all its machines share; without it this
    raises. Only a local session gets a temporary folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="listinglab-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/listinglab-work/{name}-{uuid.uuid4().hex[:12]}"


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that its writer made for itself."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes and collects run inside go as each of them ends: their result is stored elsewhere.

    Otherwise they stay on the disks until the driver's JVM happens to collect
    their plan. For plans that run once: one that ran again would make them anew."""
    key = spark._jsparkSession.sessionUUID()
    with _LOCK:
        inside, before = _INSIDE.get(key) or (0, spark.conf.get(_DROP_SHUFFLES, None))
        _INSIDE[key] = (inside + 1, before)
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _LOCK:
            inside, before = _INSIDE.pop(key)
            if inside > 1:   # another thread, or a caller, is inside still
                _INSIDE[key] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss), for
    counts and keys; rows of a table's size are :func:`stored`.

    The plan is persisted first so that writing the checkpoint reads the
    cached rows instead of computing the plan a second time."""
    from pyspark import StorageLevel

    checkpoint_root(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder: lineage is cut as by :func:`cut_lineage`.

    The plan runs once, in the write; columns are stored encoded and compressed,
    and neither a cached copy nor the plan's shuffle files stay beside them."""
    spark = df.sparkSession
    path = work_path(spark, "stored")
    with own_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, as ``--py-files`` would, once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_listinglab_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._listinglab_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
