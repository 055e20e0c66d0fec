"""File listings and metadata operations.

Listing goes through the Hadoop ``FileSystem`` API of the session, so the
same code works on local disk, HDFS and object stores. The listing carries
metadata only (path, length, modification time); data is always read by
Spark tasks.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LISTING_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("mtime", T.LongType()),
])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, root: str, threads: int = 16) -> DataFrame:
    """Every file below ``root`` (recursive), including empty and hidden
    ones, as ``(file_path, length, mtime)``. Folder placeholders are not
    files and never appear. Folders are listed level by level, several at a
    time."""
    p, fs = _fs(spark, root)

    def ls(folder) -> tuple[list, list]:
        # listStatus per folder: no block locations are fetched (listFiles with
        # located statuses was ~7x slower on the same tree)
        dirs, files = [], []
        for st in fs.listStatus(folder):
            if st.isDirectory():
                dirs.append(st.getPath())
            else:
                files.append((st.getPath().toString(), int(st.getLen()), int(st.getModificationTime())))
        return dirs, files

    rows, level = [], [p] if fs.exists(p) else []
    with ThreadPoolExecutor(threads) as pool:
        while level:
            found = list(pool.map(ls, level))
            rows += [f for _, files in found for f in files]
            level = [d for dirs, _ in found for d in dirs]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def delete_path(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def move_files(spark: SparkSession, moves: list[tuple[str, str]], threads: int = 16) -> int:
    """Rename files (metadata operations), several at a time."""
    def one(move: tuple[str, str]) -> bool:
        s, fs = _fs(spark, move[0])
        d, _ = _fs(spark, move[1])
        fs.mkdirs(d.getParent())
        return bool(fs.rename(s, d))
    with ThreadPoolExecutor(threads) as pool:
        return sum(pool.map(one, moves))


def rename_new(spark: SparkSession, src: str, dst: str) -> bool:
    """Publish ``src`` as ``dst``; False if ``dst`` exists."""
    s, fs = _fs(spark, src)
    d, _ = _fs(spark, dst)
    return not fs.exists(d) and bool(fs.rename(s, d))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    n = fs.getFileStatus(p).getLen()
    data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(fs.open(p), n)
    return bytes(data).decode()


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, root: str, dirs: bool = False) -> list[str]:
    """Names of the files (or folders) directly in ``root``."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory() == dirs]


def list_dirs(spark: SparkSession, root: str) -> list[str]:
    return list_names(spark, root, dirs=True)
