"""Stage tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import hashlib
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where it is set.

    Unset, a local master gets a temporary folder of its own and any other master a folder in the warehouse.
    """
    global _local_dir
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_phaseloom"
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="phaseloom-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return f"file://{_local_dir}"


def own_dir(spark: SparkSession) -> str:
    """This application's stage tables lie below one folder, so that clear() can remove them together."""
    return f"{shared_dir(spark)}/stages-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, fixes what is not repeatable, survives lost executors."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """df for a join that shuffles both sides. Column files may be far smaller than their rows in memory, or only a few of a file's columns
    count, so Spark takes tables that grow with the input for small enough to be broadcast and collects them on the driver.
    """
    return df.hint("merge")


def file_system(spark: SparkSession, path: str):
    """The file system and the path as Hadoop has them, of any store that Spark knows."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where it is missing."""
    fs, at = file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = file_system(spark, path)
    stream = fs.create(at, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def arrow_batches(df: DataFrame, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """df in its order as Arrow batches of at most `rows` rows on the driver, which holds one file's rows at a time.

    The rows are stored in files of so many rows, which Spark then hands over one after the other; the files go at the end.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, "batches")
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    try:
        for name in listed(spark, path):
            if name.startswith("part-"):
                yield from spark.read.schema(df.schema).parquet(f"{path}/{name}").coalesce(1).toArrow().to_batches(rows)
    finally:
        delete(spark, path)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a small file unless it is there; of several sessions that try, one succeeds, and nobody sees half a file.

    A file of another name is written and then linked (local disks) or renamed (HDFS and the like, where a rename to a name
    that is taken fails). Object stores without such a rename need one that creates conditionally.
    """
    fs, at = file_system(spark, path)
    other = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    write_text(spark, other, text)
    if fs.getScheme() == "file":
        try:
            os.link(file_system(spark, other)[1].toUri().getPath(), at.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            delete(spark, other)
        return True
    if fs.exists(at) or not fs.rename(file_system(spark, other)[1], at):
        delete(spark, other)
        return False
    return True


def inputs_key(spark: SparkSession, paths: list[str], parameters: dict) -> str:
    """A digest of the parameters and of what files there are at the paths (globs too): name, length and time of change."""
    found = []
    for path in paths:
        fs, at = file_system(spark, path)
        for top in fs.globStatus(at) or []:
            if top.isFile():
                found.append((str(top.getPath()), top.getLen(), top.getModificationTime()))
                continue
            inside = fs.listFiles(top.getPath(), True)
            while inside.hasNext():
                x = inside.next()
                found.append((str(x.getPath()), x.getLen(), x.getModificationTime()))
    return hashlib.sha256(json.dumps([sorted(found), parameters], sort_keys=True).encode()).hexdigest()[:20]


@dataclass(frozen=True)
class Stages:
    """Named stage tables that stay: root/key/name. One that is complete is read again instead of being made."""

    spark: SparkSession
    root: str
    key: str

    def __call__(self, make: DataFrame | Callable[[], DataFrame], name: str) -> DataFrame:
        path = f"{self.root.rstrip('/')}/{self.key}/{name}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            df = make() if callable(make) else make
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def unnamed(make: DataFrame | Callable[[], DataFrame], name: str) -> DataFrame:
    """A stage table of this run alone."""
    return stored(make() if callable(make) else make, name)


def clear(spark: SparkSession) -> None:
    """Removes this application's stage tables, once the results that read them are written."""
    delete(spark, own_dir(spark))
