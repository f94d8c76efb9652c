"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the operators are planned for. A cluster's own session may override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: str | int = "*", app: str = "acreage", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what runs or is started inside; a stream keeps those it was started with."""
    before = spark.conf.getAll
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one: it gets a temporary folder. On a cluster a
    folder of one machine would be lost with it, so a missing setting is an error there.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if named:
        if named.startswith("file:") and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names a folder of one machine; name one that every executor can reach")
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="acreage-")
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder this library wrote under the shared one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, such as a schema, to a path of the cluster's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def share_code(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per session.

    Workers that were started elsewhere than in the repository find it then too. A cluster that
    has the package installed does not need it, and is not harmed.
    """
    context = spark.sparkContext
    if getattr(context, "_acreage_shared", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='acreage-code-')}/acreage", "zip", root, "acreage")
    context.addPyFile(archive)
    context._acreage_shared = True
