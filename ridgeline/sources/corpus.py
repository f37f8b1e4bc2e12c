"""Image corpora: two modality folders of bitmap files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.names import file_name, subject_id_strict
from ridgeline.sources.planned import TARGET_BYTES, list_tree, read_planned, with_lengths

# Modality folders and the extensions read from each.
MODALITIES = ("iris", "fingerprint")
EXTENSIONS = "*.{bmp,BMP}"
# Shares of files a task goes through, as long as each core has some tasks.
SHARES_PER_TASK = 8
TASKS_PER_CORE = 4

_EMPTY = (
    "path string, modality string, name string, "
    "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
)


def _modality(path: Column) -> Column:
    """The nearest of the two folders a file lies in, at any depth."""
    return F.regexp_extract(path, r".*/(iris|fingerprint)/[^/]*$", 1)


def _wanted() -> Column:
    """Fingerprint names may be upper case, iris names may not."""
    return (F.col("modality") == "fingerprint") | (
        (F.col("modality") == "iris") & F.col("name").endswith(".bmp")
    )


def _packed(files: DataFrame) -> DataFrame:
    """The same rows in fewer tasks, where there are many of them.

    Spark gives a task 32 small files, which are read faster than the task starts. A task now goes
    through several such shares one after the other, and holds no more than before.
    """
    shares = files.rdd.getNumPartitions()
    spread = min(shares, TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism)
    return files.coalesce(max(spread, -(-shares // SHARES_PER_TASK), 1))


def _read(spark: SparkSession, root: str, fmt: str) -> DataFrame | None:
    reader = spark.read.format(fmt).option("pathGlobFilter", EXTENSIONS).option("recursiveFileLookup", "true")
    try:
        return _packed(reader.load(root))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def list_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modality, name, length)`` of every image; contents stay unread."""
    files = _read(spark, root, "binaryFile")
    if files is None:
        return spark.createDataFrame([], "path string, modality string, name string, length long")
    return files.select(
        "path", _modality(F.col("path")).alias("modality"), file_name("path").alias("name"), "length"
    ).where(_wanted())


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modality, name, content)``: the bytes, for bitmaps decoded in tasks.

    Several times faster than :func:`scan_corpus`, which builds each image pixel
    by pixel but knows more formats.
    """
    files = _read(spark, root, "binaryFile")
    if files is None:
        return spark.createDataFrame([], "path string, modality string, name string, content binary")
    return files.select(
        "path", _modality(F.col("path")).alias("modality"), file_name("path").alias("name"), "content"
    ).where(_wanted())


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """:func:`list_corpus` with the folders listed in tasks: no file index on the driver, for trees of any size."""
    return _named(list_tree(spark, root), "length").where(F.lower("name").endswith(".bmp") & _wanted())


def read_manifest(
    manifest: DataFrame, path_col: str = "path", modality: str | None = None, target_bytes: int = TARGET_BYTES,
) -> DataFrame:
    """:func:`read_corpus` for a table of file URIs, however many: no listing, no index on the driver.

    Files are planned into tasks of some ``target_bytes`` (:func:`read_planned`); a manifest
    with a ``length`` saves asking for sizes. A file that cannot be read has NULL ``content`` and counts
    as failed later. ``modality`` leaves the other one unread.
    """
    known = "length" in manifest.columns and path_col != "length"
    given = manifest.select(F.col(path_col).alias("path"), *(["length"] if known else []))
    named = _named(given, *(["length"] if known else [])).where(_wanted())
    if modality is not None:
        named = named.where(F.col("modality") == modality)
    sized = named.select("path", "length") if known else with_lengths(named)
    contents = read_planned(sized, target_bytes)
    return _named(contents, "content").select("path", "modality", "name", "content")


def read_tree(spark: SparkSession, root: str, modality: str | None = None) -> DataFrame:
    """:func:`read_corpus` with listing and reading planned in tasks."""
    return read_manifest(list_files(spark, root), modality=modality)


def _named(files: DataFrame, *keep: str) -> DataFrame:
    return files.select("path", _modality(F.col("path")).alias("modality"), file_name("path").alias("name"), *keep)


def scan_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modality, name, image)`` with images decoded by Spark.

    A file that does not decode has height -1. A missing folder gives no rows.
    """
    images = _read(spark, root, "image")
    if images is None:
        return spark.createDataFrame([], _EMPTY)
    origin = F.col("image.origin")
    return images.select(
        origin.alias("path"), _modality(origin).alias("modality"),
        file_name(origin).alias("name"), "image",
    ).where(_wanted())


def with_subject(files: DataFrame) -> DataFrame:
    """Adds the strict subject id and drops files without one."""
    return files.withColumn("subject_id", subject_id_strict("name")).where("subject_id is not null")


def verify_corpus(files: DataFrame) -> DataFrame:
    """Files per modality; a corpus is valid if it has both."""
    iris, finger = (F.count_if(F.col("modality") == m) for m in MODALITIES)
    return files.agg(
        iris.alias("iris"), finger.alias("fingerprint"), ((iris > 0) & (finger > 0)).alias("valid")
    )


def split_modalities(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Iris rows and fingerprint rows."""
    return tuple(files.where(F.col("modality") == m) for m in MODALITIES)
