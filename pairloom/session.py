"""Session settings the library is tuned for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # A shuffled join hashes a side whose every partition turned out to be at most this large.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Repeated keys in a JSON object: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local-mode session may fall back to a folder of its own: on a cluster a
    machine-local folder is invisible to the other machines and lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


_owned: ContextVar[tuple[list[str], ...]] = ContextVar("owned", default=())   # folders of the open blocks


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged and folders made inside go when the block ends; write what must stay elsewhere before."""
    folders: list[str] = []
    token = _owned.set((*_owned.get(), folders))
    try:
        yield
    finally:
        _owned.reset(token)
        for path in folders:
            remove_folder(spark, path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    path = os.path.join(shared_folder(spark).rstrip("/"), f"{name}-{uuid.uuid4().hex}")
    if _owned.get():
        _owned.get()[-1].append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a folder beside ``path`` and move it there when it is complete; a failed write leaves the old one.

    The old folder is set aside, not deleted, until the new one is in its place; ``recover_folder`` puts it back
    where a run ended between the two moves.
    """
    path = path.rstrip("/")
    recover_folder(spark, path)
    fresh = os.path.join(os.path.dirname(path), f"_new-{uuid.uuid4().hex}")
    try:
        write(fresh)
    except BaseException:
        remove_folder(spark, fresh)
        raise
    where, files = _file_system(spark, path)
    aside, _ = _file_system(spark, _aside(path))
    if files.exists(where) and not files.rename(where, aside):
        raise OSError(f"{path} could not be set aside")
    if not files.rename(_file_system(spark, fresh)[0], where):
        recover_folder(spark, path)
        raise OSError(f"{fresh} could not be moved to {path}")
    files.delete(aside, True)


def _aside(path: str) -> str:
    return os.path.join(os.path.dirname(path), f"_old-{os.path.basename(path)}")


def recover_folder(spark: SparkSession, path: str) -> None:
    """Finish a replacement that was cut off: the folder set aside comes back, or goes if the new one is in its place."""
    path = path.rstrip("/")
    aside, files = _file_system(spark, _aside(path))
    if files.exists(aside):
        where, _ = _file_system(spark, path)
        if files.exists(where):
            files.delete(aside, True)
        elif not files.rename(aside, where):
            raise OSError(f"{path} could not be put back")


def recover_folders(spark: SparkSession, root: str, depth: int = 5) -> None:
    """``recover_folder`` for everything set aside below ``root``, down to ``depth`` levels; for the start of a run."""
    for level in range(1, depth + 1):
        pattern, files = _file_system(spark, os.path.join(root, *["*"] * (level - 1), "_old-*"))
        for found in files.globStatus(pattern) or []:
            aside = found.getPath().toString()
            recover_folder(spark, os.path.join(os.path.dirname(aside), os.path.basename(aside).removeprefix("_old-")))


def configure(spark: SparkSession) -> None:
    """Set what the operators' results depend on; the plans call it on any session."""
    for key in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
        spark.conf.set(key, SETTINGS[key])


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage and lets several consumers share one evaluation; the table outlives
    lost executors. Works like any table write: the result has the same rows and columns.
    It stays until its folder is removed, or until the end of the ``scratch`` block around it.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hand_over(df: DataFrame, name: str = "result") -> DataFrame:
    """Stage ``df`` so that it outlives the innermost ``scratch`` block; the block around that one owns it."""
    token = _owned.set(_owned.get()[:-1])
    try:
        return stage(df, name)
    finally:
        _owned.reset(token)
