"""Session helpers: the session used by tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "siltbed", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the package is written for. Extra ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for work tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own. On a cluster a
    machine-local folder would be invisible to the other executors, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="siltbed-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_home(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{scratch_root(spark)}/siltbed-{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path in the application's scratch that no other call gets."""
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder in whatever file system the path belongs to, unless it is there."""
    files, folder = _folder(spark, path)
    files.mkdirs(folder)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where there is no folder."""
    files, folder = _folder(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder its final name, under which it appears whole."""
    files, folder = _folder(spark, path)
    target = _folder(spark, to)[1]
    files.mkdirs(target.getParent())
    if not files.rename(folder, target):
        raise OSError(f"{path} cannot be moved to {to}")


def drop_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch. Results that were not written elsewhere cannot be read after it."""
    drop_folder(spark, scratch_home(spark))
