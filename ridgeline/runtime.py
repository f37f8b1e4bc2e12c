"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "ridgeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    AQE coalesces small shuffle partitions and splits skewed join partitions,
    so ``spark.sql.shuffle.partitions`` can be set for the largest shuffle.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Image rows are large: bound an Arrow batch by bytes, not only by rows.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        # Corpora are many small files: pack hundreds into a task, not thirty.
        "spark.sql.files.openCostInBytes": str(512 << 10),
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the session's executors, once, where they do not have it installed.

    Functions that run in tasks are pickled by reference, so the workers must be able to import them.
    """
    context = spark.sparkContext
    if getattr(context, "_ridgeline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ridgeline-package-"), "ridgeline-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("ridgeline", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._ridgeline_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own: there
    driver and executors are one process.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ridgeline-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path under the shared folder; never reused, so retries cannot mix."""
    return f"{shared_dir(spark)}/ridgeline/{kind}-{uuid.uuid4().hex}"


# Folders written since :func:`discarding` began, if it did.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialize(df: DataFrame, kind: str, session: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and freezes values
    that depend on the physical layout (partition ids, sampled ranges). ``session``
    reads it back elsewhere: a micro-batch's own session plans without AQE.
    """
    spark = session or df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    if (written := _written.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what :func:`materialize` wrote inside.

    For jobs that finish there, such as a micro-batch: nothing lazy may be left
    that still reads those tables.
    """
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
