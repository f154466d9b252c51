"""What the session tells us about the cluster: scratch folder and size checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A joined side is broadcast only when its counted size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rough in-memory cost of one row besides its strings.
ROW_BYTES = 96


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, or else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_rankloom"


# What an application has put into scratch folders and the catalog, and how to remove it.
_made: dict[str, list[Callable[[], None]]] = {}


def at_drop(spark: SparkSession, remove: Callable[[], None]) -> None:
    """``drop_scratch`` will call ``remove``."""
    _made.setdefault(spark.sparkContext.applicationId, []).append(remove)


def drop_scratch(spark: SparkSession) -> None:
    """Removes every scratch table and scratch index of this application.

    To be called when no result that was computed from them is to be read any more: results are
    read lazily, so nothing here can know by itself when that is.
    """
    for remove in reversed(_made.pop(spark.sparkContext.applicationId, [])):
        remove()


def fresh_folder(spark: SparkSession) -> str:
    path = f"{scratch_folder(spark)}/rankloom-{uuid.uuid4().hex}"
    at_drop(spark, lambda: remove_folder(spark, path))
    return path


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the scratch folder, so that later jobs read it instead of redoing it.

    A Parquet table keeps statistics and columns apart, which an RDD checkpoint does
    not, and needs no setting on the user's context.
    """
    path = fresh_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_file(spark: SparkSession, name: str):
    """``(file system, path)`` of a file that a DataFrame lists."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def of_files(files: list[str], ask: Callable[[str], object]) -> list:
    """``ask`` of every file, several at a time."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(ask, files))


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads; 0 where there are none."""
    spark = df.sparkSession

    def size(file: str) -> int:
        fs, path = hadoop_file(spark, file)
        return fs.getFileStatus(path).getLen()

    return sum(of_files(df.inputFiles(), size))


def first_bytes(spark: SparkSession, name: str, size: int) -> bytes:
    """The first bytes of a file as a reader gets them, decompressed."""
    fs, path = hadoop_file(spark, name)
    io = spark._jvm.org.apache.commons.io
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    stream = fs.open(path)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        return bytes(io.IOUtils.toByteArray(io.input.BoundedInputStream(stream, size)))
    finally:
        stream.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of whichever file system ``path`` names; nothing there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_materialised(df: DataFrame) -> None:
    """Deletes the files behind what ``materialise`` returned; nothing may read it afterwards."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("rankloom-"):
            remove_folder(df.sparkSession, folder)


def any_of(column: str, values: list):
    """``column`` equals one of ``values``, as a balanced OR.

    Parquet gets every single value this way; a long IN list is pushed down as
    one min/max range, which prunes little.
    """
    if not values:
        return F.lit(False)
    tests = [F.col(column) == F.lit(v) for v in sorted(values)]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i]
                 for i in range(0, len(tests), 2)]
    return tests[0]
