"""Table access and staging of intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Partitions of tables that models are fitted on, whatever the size or the cluster.
FIT_PARTS = 32

_local_folder: str | None = None
_removed_at_exit: set[str] = set()
_shipped: dict[str, bool] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, small_bytes: int = 1 << 30) -> DataFrame:
    """Deal a small table out over all cores before costly work on single rows.

    A small file is often a single row group, hence one task. Tables whose files
    exceed ``small_bytes`` are left alone: their scan has tasks enough, and a
    shuffle of the raw rows would only cost. Only for work whose result does not
    depend on the partitions; see ``dealt``.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > small_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def dealt(df: DataFrame, key: str, parts: int = FIT_PARTS) -> DataFrame:
    """Deal rows by a hash of their key into ``parts`` partitions, in order of the key.

    For fits that depend on the partitions (samples, models per partition): they then
    see the same rows in the same places at every size and on every cluster.
    """
    return df.repartition(parts, key).sortWithinPartitions(key)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine and die with it.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="plainloom-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for functions that run there."""
    context = spark.sparkContext
    if _shipped.get(context.applicationId):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="plainloom-")) / "plainloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    _shipped[context.applicationId] = True


def _stage_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/plainloom-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, removed at the application's end."""
    root = _stage_root(spark)
    if root not in _removed_at_exit:
        folder, files = _folder(spark, root)
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _removed_at_exit.add(root)
    return f"{root}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and never a re-run with
    different partition boundaries. Parquet keeps later column pruning.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def release_staged(spark: SparkSession) -> None:
    """Delete everything this application staged; the application's end does the same.

    For long-lived applications, once the results that read it are stored.
    """
    folder, files = _folder(spark, _stage_root(spark))
    files.delete(folder, True)
