"""Reading files by a stored plan, so that tasks follow the bytes behind a row, not the rows.

A table of paths is small whatever lies behind it, and a shuffle of it tells Spark nothing
about the reading to come. Here a job adds up the bytes along the paths, cuts the sum into
bins of equal size and writes the plan, one folder for each bin; the data source then has one
input partition for each bin. The driver knows the number of bins, and no file.

Folders are listed in tasks too, one level after the other: the folders found in a round are
the rows of the next.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ridgeline.operators.running import running_by_range
from ridgeline.runtime import materialize, scratch_path

# Bytes a task reads, and what opening a file costs in bytes: a task takes longer to start than some
# hundred small files take to read.
TARGET_BYTES = 128 << 20
OPEN_BYTES = 64 << 10
# Bins, each a folder of the plan, that one task writes.
_BINS_PER_TASK = 32
# Files and bytes that are handed on together.
_BATCH_FILES, _BATCH_BYTES = 64, 32 << 20
# Entries of a folder that a listing holds at once.
_BATCH_ENTRIES = 10_000
# Folders a listing task is given.
FOLDERS_PER_TASK = 32

FORMAT = "planned_files"
_FILES = "path string, length long"
_CONTENT = pa.schema([("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("content", pa.binary())])


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI and the name in it; paths are as Spark writes them, with blanks and all."""
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(quote(uri, safe="/:@%?&=+,;"))


def _prefix(uri: str, name: str) -> str:
    """What to put before a name of the store to have a URI again."""
    if uri.startswith(("/", "file:")):
        return "file:"
    return unquote(uri)[: -len(name)] if name and unquote(uri).endswith(name) else uri.split("://")[0] + "://"


def bins_by_bytes(df: DataFrame, size: str, order: list[str], target: int, name: str = "bin") -> DataFrame:
    """Adds the bin of each row: rows in ``order``, as many to a bin as ``target`` bytes hold, one row at least.

    The sum runs over ranges of the order, in as many tasks as there are; the result is written, so that
    its bins can be counted and read again.
    """
    summed = running_by_range(df.withColumn("_all", F.lit(0)), ["_all"], order, {"_sum": ("sum", F.col(size).cast("long"))})
    before = F.col("_sum") - F.col(size)
    return materialize(summed.withColumn(name, F.floor(before / target).cast("int")).drop("_all", "_sum"), "bins", df.sparkSession)


def deal_by_bytes(df: DataFrame, size: str, order: list[str], target: int) -> DataFrame:
    """``df`` in partitions of some ``target`` bytes by ``size``: their number is stated, so that AQE does not merge them."""
    binned = bins_by_bytes(df, size, order, target, "_bin")
    # Bins of rows larger than the target leave numbers out: close the gaps.
    used = binned.select("_bin").distinct()
    n = used.count()
    if not n:
        return df
    placed = running_by_range(used.withColumn("_all", F.lit(0)), ["_all"], ["_bin"], {"_nth": ("sum", F.lit(1).cast("long"))})
    return binned.join(placed.select("_bin", "_nth"), "_bin").repartitionById(n, (F.col("_nth") - 1).cast("int")).drop("_bin", "_nth")


class _Bin(InputPartition):
    """One folder of the plan."""

    def __init__(self, folder: str):
        super().__init__(folder)


class PlannedFiles(DataSource):
    """Options ``plan`` (the folder of a plan) and ``bins`` (their numbers: 0 to ``bins - 1``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, start long, length long, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PlanReader(self.options["plan"], int(self.options["bins"]))


class _PlanReader(DataSourceReader):
    def __init__(self, plan: str, bins: int):
        self.plan, self.bins = plan, bins

    def partitions(self) -> list[InputPartition]:
        return [_Bin(f"{self.plan}/bin={i}") for i in range(self.bins)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(partition.value)
        if store.get_file_info(folder).type == fs.FileType.NotFound:
            return
        rows = dataset.dataset(folder, filesystem=store, format="parquet").to_batches(columns=["path", "start", "length"], batch_size=_BATCH_FILES)
        for batch in rows:
            held, size, at = [], 0, 0
            for path, start, length in zip(*[c.to_pylist() for c in batch.columns]):
                content = read_range(path, start, length)
                held.append(content)
                size += len(content or b"")
                if size >= _BATCH_BYTES:
                    yield _content(batch.slice(at, len(held)), held)
                    at, held, size = at + len(held), [], 0
            if held:
                yield _content(batch.slice(at), held)


def _content(rows: pa.RecordBatch, held: list[bytes | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(held, pa.binary())], schema=_CONTENT)


def read_range(uri: str, start: int | None = None, length: int | None = None) -> bytes | None:
    """``length`` bytes of a file from ``start``, or the whole file. None where it cannot be read."""
    try:
        store, name = open_store(uri)
        with store.open_input_file(name) as f:
            if start is None:
                return f.read()
            f.seek(start)
            return f.read(length)
    except (OSError, pa.ArrowInvalid):
        return None


def with_lengths(paths: DataFrame) -> DataFrame:
    """``(path, length)``: sizes asked for in tasks; 0 for a file that is not there."""

    def run(batches):
        for batch in batches:
            sizes = []
            for uri in batch.column(0).to_pylist():
                try:
                    store, name = open_store(uri)
                    sizes.append(store.get_file_info(name).size or 0)
                except (OSError, pa.ArrowInvalid):
                    sizes.append(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["path", "length"])

    return paths.select("path").mapInArrow(run, _FILES)


def read_planned(files: DataFrame, target_bytes: int = TARGET_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """``(path, start, length, content)`` of files ``(path, length)``, or of their ranges ``(path, start, length)``.

    Without ``start`` files are read whole, whatever their length is now: it only plans. Each task reads some ``target_bytes``; opening a file counts as ``open_bytes``. Equal rows are
    read each. A file that cannot be read has null content; null paths are left out. A task that is
    run again reads its bin of the plan again.
    """
    spark = files.sparkSession
    start = F.col("start") if "start" in files.columns else F.lit(None)
    rows = files.where("path is not null").select("path", start.cast("long").alias("start"), F.col("length").cast("long").alias("length"))
    costed = rows.withColumn("_cost", F.coalesce("length", F.lit(0)) + open_bytes)
    binned = bins_by_bytes(costed, "_cost", ["path", "start"], target_bytes)
    last = binned.agg(F.max("bin")).first()[0]
    if last is None:
        return spark.createDataFrame([], "path string, start long, length long, content binary")
    plan = scratch_path(spark, "plan")
    # A bin belongs to one writing task, and a task has some bins: stated, for the few bytes of a plan would all be merged into one task.
    tasks = -(-(last + 1) // _BINS_PER_TASK)
    binned.drop("_cost").repartitionById(tasks, F.col("bin") % tasks).write.partitionBy("bin").parquet(plan)
    spark.dataSource.register(PlannedFiles)
    return spark.read.format(FORMAT).option("plan", plan).option("bins", str(last + 1)).load()


def _entries(store: fs.FileSystem, name: str) -> Iterator[tuple[str, int, bool]]:
    """``(path, length, is a folder)`` of what lies in a folder; a missing folder has nothing.

    A local folder is walked entry by entry; other stores hand over a folder whole.
    """
    if isinstance(store, fs.LocalFileSystem):
        try:
            found = os.scandir(name)
        except FileNotFoundError:
            return
        with found:
            for entry in found:
                if not entry.name.startswith(("_", ".")):
                    folder = entry.is_dir()
                    yield entry.path, 0 if folder else _size(entry), folder
    else:
        for info in store.get_file_info(fs.FileSelector(name, allow_not_found=True)):
            if not info.base_name.startswith(("_", ".")):
                yield info.path, info.size or 0, info.type == fs.FileType.Directory


def _size(entry: os.DirEntry) -> int:
    """Bytes of a file; 0 for one that has gone or a link to nothing."""
    try:
        return entry.stat().st_size
    except FileNotFoundError:
        return 0


def list_tree(spark: SparkSession, root: str, folders_per_task: int = FOLDERS_PER_TASK) -> DataFrame:
    """``(path, length)`` of all files below a folder, listed in tasks, level by level.

    Names that begin with ``_`` or ``.`` are left out, as Spark's own readers do; a missing folder
    gives no rows. A round costs one small table; the files of a single folder are listed in one task.
    """

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, name = open_store(uri)
                prefix = _prefix(uri, name)
                entries = _entries(store, name)
                while some := list(islice(entries, _BATCH_ENTRIES)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([prefix + path for path, _, _ in some], pa.string()), pa.array([size for _, size, _ in some], pa.int64()),
                        pa.array([folder for _, _, folder in some], pa.bool_()),
                    ], names=["path", "length", "folder"])

    folders, n = spark.createDataFrame([(root,)], "path string"), 1
    files = spark.createDataFrame([], _FILES)
    while n:
        tasks = -(-n // folders_per_task)
        # Rows of a written table have no order to count by: their hash deals them.
        dealt = folders.repartitionById(tasks, F.pmod(F.xxhash64("path"), F.lit(tasks)).cast("int"))
        found = materialize(dealt.mapInArrow(run, f"{_FILES}, folder boolean"), "listing")
        files = files.unionByName(found.where("not folder").select("path", "length"))
        folders = found.where("folder").select("path")
        n = folders.count()
    return files
