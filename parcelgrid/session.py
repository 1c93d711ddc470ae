"""Session settings, shipping to executors, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

class _Written(threading.local):
    """Folders that this thread's :func:`materialise` wrote and nobody has dropped yet."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_written = _Written()


def local_session(cpus: int | str = "*", app: str = "parcelgrid", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # small inputs with much work per byte still use every local core
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        # call-site capture costs more than the planning itself for long expressions
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without it: there one machine runs every task,
    so a fresh temporary folder is set as the checkpoint folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="parcelgrid-"))
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def register(path: str) -> str:
    """Have ``path`` deleted with the intermediates of this thread."""
    _written.paths.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` does, survives the loss of
    executors, and gives later plans true file sizes to choose joins by. The
    folder stays until the ``intermediates`` block around it ends, or
    :func:`drop_intermediates` is called.
    """
    path = register(shared_path(df.sparkSession, label))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession, since: int = 0) -> None:
    """Delete what :func:`materialise` wrote in this thread, from the ``since``-th folder on.

    No later plan may read it.
    """
    for path in _written.paths[since:]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    del _written.paths[since:]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """A block whose intermediates go when it ends, in success or failure."""
    since = len(_written.paths)
    try:
        yield
    finally:
        drop_intermediates(spark, since)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Needed where it is not installed on them: Python functions that run there
    import it by name.
    """
    context = spark.sparkContext
    if getattr(context, "_parcelgrid_shipped", False):
        return
    folder = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="parcelgrid-ship-")) / "parcelgrid.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(folder.rglob("*.py")):
            out.write(file, file.relative_to(folder.parent))
    context.addPyFile(str(archive))
    context._parcelgrid_shipped = True
