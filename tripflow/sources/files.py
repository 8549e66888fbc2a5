"""File listing and moves through the Hadoop file system of the session.

Only names, lengths and times pass through the driver here, never rows. Spark's own file
sources list the same way, but they hide empty files, which ingestion has to see.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileInfo:
    path: str
    length: int


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


# Hadoop's names for file systems that Arrow opens under another name.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}


def is_arrow_path(path: str) -> bool:
    scheme = re.match(r"^([a-zA-Z0-9+.-]+):", path)
    return scheme is None or scheme[1] == "file" or scheme[1] in _ARROW_SCHEMES


def arrow_file_system(path: str):
    """Arrow's file system for a Hadoop path, and the path in it."""
    from urllib.parse import quote

    from pyarrow import fs

    if re.match(r"^(file:)?/", path):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    scheme, _, rest = path.partition("://")
    return fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}://{quote(rest, safe='/@:')}")


def is_hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def is_parquet_name(name: str) -> bool:
    return name.lower().endswith(".parquet")


def literal(path: str) -> str:
    """The path with glob characters escaped, for readers that expand patterns."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_file(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path), _path(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def make_dirs(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def delete_tree(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def list_files(spark: SparkSession, directory: str) -> list[FileInfo]:
    """Regular, visible files directly in ``directory``, in name order."""
    fs, target = _fs(spark, directory), _path(spark, directory)
    if not fs.exists(target):
        return []
    found = []
    entries = fs.listStatusIterator(target)
    while entries.hasNext():
        status = entries.next()
        if status.isFile() and not is_hidden(status.getPath().getName()):
            found.append(FileInfo(status.getPath().toString(), int(status.getLen())))
    return sorted(found, key=lambda f: f.path)


def list_dirs(spark: SparkSession, directory: str) -> list[str]:
    fs, target = _fs(spark, directory), _path(spark, directory)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory())


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    out = _fs(spark, path).create(_path(spark, path), True)
    out.write(content)
    out.close()


def move_file(spark: SparkSession, source: str, target: str) -> bool:
    """Rename, replacing an older target. False when an earlier attempt already moved it."""
    fs, src, dst = _fs(spark, source), _path(spark, source), _path(spark, target)
    if not fs.exists(src):
        if fs.exists(dst):
            return False
        raise FileNotFoundError(source)
    if fs.exists(dst):
        fs.delete(dst, False)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")
    return True


def _list_batches(batches):
    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        for folder in batch.column("path").to_pylist():
            filesystem, inner = arrow_file_system(folder)
            selector = fs.FileSelector(inner, allow_not_found=True)
            found = [f for f in filesystem.get_file_info(selector) if f.is_file and not is_hidden(f.base_name)]
            prefix = "file:" if folder.startswith(("/", "file:")) else folder.split("://")[0] + "://"
            yield pa.RecordBatch.from_pydict(
                {"path": [prefix + f.path for f in found], "length": [f.size for f in found]},
                schema=pa.schema([("path", pa.string()), ("length", pa.int64())]),
            )


def listing_frame(spark: SparkSession, directory: str):
    """Regular, visible files directly in ``directory``, empty ones too, as ``path`` and ``length``.

    A task lists the folder, so that the driver gets only what the caller collects. File systems that
    Arrow doesn't know are listed by the driver.
    """
    if not is_arrow_path(directory):
        return file_frame(spark, list_files(spark, directory))
    folder = spark.createDataFrame([(directory,)], "path string")
    return folder.mapInArrow(_list_batches, "path string, length bigint")


def file_frame(spark: SparkSession, files: list[FileInfo]):
    """A listing as a frame of ``path`` and ``length``."""
    return spark.createDataFrame([(f.path, f.length) for f in files], "path string, length bigint")
