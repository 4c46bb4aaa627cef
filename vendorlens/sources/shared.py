"""Staged tables in the folder all executors share.

A staged table cuts lineage: later plans scan Parquet (with column pruning and filter
push-down) and a lost executor costs a re-read, not a re-run of the plan before it.
"""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a scratch folder is set only where none is named."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vendorlens-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def application_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/vendorlens/{spark.sparkContext.applicationId}"


def _path(spark: SparkSession, path: str):
    """A path and its file system, whichever that is."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def entries(spark: SparkSession, path: str) -> list[tuple[str, bool, int, int]]:
    """Path, whether it is a folder, bytes and time of change of everything directly in a folder."""
    place, files = _path(spark, path)
    return [(s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in files.listStatus(place)]


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _path(spark, path)
    return files.exists(place)


def write_file(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, on whichever file system the path names."""
    place, files = _path(spark, path)
    out = files.create(place)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> bytes:
    """All of a small file."""
    place, files = _path(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Whether a file got another name; not where that name is taken."""
    place, files = _path(spark, path)
    return bool(files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(to)))


def remove_folder(spark: SparkSession, path: str) -> None:
    place, files = _path(spark, path)
    files.delete(place, True)


def release(spark: SparkSession) -> None:
    """Remove what this application has staged; its staged tables cannot be read any more."""
    remove_folder(spark, application_dir(spark))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the tasks of an application, once; it need not be installed there."""
    package = Path(__file__).resolve().parents[1]
    if spark.sparkContext.applicationId in _shipped or not package.is_dir():
        return
    archive, content = f"{application_dir(spark)}/code-{uuid.uuid4().hex}/vendorlens.zip", io.BytesIO()
    with zipfile.ZipFile(content, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    write_file(spark, archive, content.getvalue())
    spark.sparkContext.addPyFile(archive)
    _shipped.add(spark.sparkContext.applicationId)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files when it ends; else they stay until the driver happens to collect garbage."""
    before = spark.conf.get(FREE_KEY, None)
    spark.conf.set(FREE_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_KEY) if before is None else spark.conf.set(FREE_KEY, before)


def store(df: DataFrame, path: str, add: bool = False) -> None:
    """Write ``df`` as Parquet (``add``: beside what is there); its shuffle files go with the end of the write."""
    with _shuffles_freed(df.sparkSession):
        df.write.mode("append" if add else "errorifexists").option("compression", "zstd").parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    return stage_parts([df], name)


def stage_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """`stage` for rows that come as frames of one schema, each written before the next is asked for."""
    path = schema = spark = None
    for part in parts:
        if path is None:
            spark, schema = part.sparkSession, part.schema
            path = f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"
        store(part, path, add=True)
    out = spark.read.schema(schema).parquet(path)
    out.__dict__["_staged"] = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Remove the folders of frames that `stage` returned, once what is made of them is written; they cannot be read again."""
    for frame in frames:
        remove_folder(frame.sparkSession, frame.__dict__["_staged"])
