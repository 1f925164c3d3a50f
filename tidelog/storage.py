"""Where jobs keep intermediate tables, and small file-system checks.

Every path goes through the Hadoop file-system API, so the same code works on a
local disk, HDFS or an object store.
"""

from __future__ import annotations

import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: driver and executors then
    share one machine, and a temporary folder is used.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidelog-")
    spark.conf.set(CHECKPOINT_SETTING, local)
    return local


_folders: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder (and the open :func:`scratch_folder`); nothing exists there yet."""
    return "/".join([shared_dir(spark), *_folders[-1:], f"{name}-{uuid.uuid4().hex}"])


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """What :func:`scratch` names inside goes at the end: for a step that writes its result elsewhere.

    Folders do not nest: an inner one lies beside the outer one, and goes first.
    """
    folder = f"{name}-{uuid.uuid4().hex}"
    _folders.append(folder)
    try:
        yield
    finally:
        _folders.pop()
        drop(spark, f"{shared_dir(spark)}/{folder}")


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that this session's file systems give it."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table that :func:`scratch` named, once nothing reads it any more."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not below the shared folder")
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when the path does not exist."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


VERSION = "version="
# Written by us after the files of a version: not every committer leaves a mark.
_DONE = "_COMPLETE"


def version_path(path: str, version: int) -> str:
    return f"{path}/{VERSION}{version:08d}"


def complete_version(spark: SparkSession, path: str, version: int) -> None:
    """Make a written version visible."""
    write_text(spark, f"{version_path(path, version)}/{_DONE}", "")


def newest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version below ``path``; 0 when there is none."""
    complete = [
        int(name[len(VERSION):])
        for name in child_names(spark, path)
        if name.startswith(VERSION) and exists(spark, f"{path}/{name}/{_DONE}")
    ]
    return max(complete, default=0)


def _files_below(fs, hadoop_path) -> list:
    found, pending = [], [hadoop_path]
    while pending:
        for status in fs.listStatus(pending.pop()):
            (pending if status.isDirectory() else found).append(status.getPath())
    return found


def _last_modified(fs, hadoop_path) -> int:
    times = [fs.getFileStatus(f).getModificationTime() for f in _files_below(fs, hadoop_path)]
    return max(times, default=0)


def reveal_in_order(spark: SparkSession, staging: str, target: str, prefix: str) -> None:
    """Move the directories ``<prefix><number>`` of ``staging`` to ``target`` by number.

    Their files get modification times that rise with the number and come after
    those already in ``target``. Only names and times change, no data is read.
    """
    fs, staging_path = _resolve(spark, staging)
    make_path = spark._jvm.org.apache.hadoop.fs.Path
    numbers = sorted(
        int(name[len(prefix):]) for name in child_names(spark, staging) if name.startswith(prefix)
    )
    earlier = sorted(
        (int(name[len(prefix):]), name) for name in child_names(spark, target) if name.startswith(prefix)
    )
    last = _last_modified(fs, make_path(f"{target}/{earlier[-1][1]}")) if earlier else 0
    first_time = max(int(time.time() * 1000) - len(numbers), last) + 1
    fs.mkdirs(make_path(target))

    def set_times(step: int) -> None:
        for file_path in _files_below(fs, make_path(f"{staging}/{prefix}{numbers[step]}")):
            fs.setTimes(file_path, first_time + step, -1)

    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(set_times, range(len(numbers))))
    for number in numbers:
        source, destination = make_path(f"{staging}/{prefix}{number}"), make_path(f"{target}/{prefix}{number}")
        if fs.exists(destination):
            raise FileExistsError(f"{destination} is there already")
        if not fs.rename(source, destination):
            raise OSError(f"could not move {source} to {destination}")
    fs.delete(staging_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file from the driver (never rows of a table)."""
    fs, hadoop_path = _resolve(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small file."""
    fs, hadoop_path = _resolve(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write one small file that is not there yet; false if it is.

    The file system creates it exclusively, so that of several writers one succeeds.
    """
    fs, hadoop_path = _resolve(spark, path)
    try:
        stream = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def drop_older(spark: SparkSession, path: str, before: datetime) -> None:
    """Remove the files directly below ``path`` that were written before a time (UTC)."""
    fs, hadoop_path = _resolve(spark, path)
    if fs.exists(hadoop_path):
        limit = before.replace(tzinfo=timezone.utc).timestamp() * 1000
        for status in fs.listStatus(hadoop_path):
            if status.isFile() and status.getModificationTime() < limit:
                fs.delete(status.getPath(), False)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    marker = "spark.tidelog.shipped"
    if spark.conf.get(marker, None) == spark.sparkContext.applicationId:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidelog-code-")) / "tidelog.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))
    spark.conf.set(marker, spark.sparkContext.applicationId)


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few driver-side rows (positions, ledger events) as a local relation.

    Going through Arrow keeps the size known to the optimizer and needs no job.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    arrays = [
        pa.array(list(values), type=to_arrow_type(field.dataType))
        for values, field in zip(columns, schema.fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.fieldNames()), schema)
