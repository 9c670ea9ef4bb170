"""Session defaults and the shared folder that job state is written to."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "docledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package relies on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # A second copy of a running task would repeat its transport calls.
        "spark.speculation": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a folder
    would be private to one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docledger-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder name inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the tasks of a session, once per application."""
    context = spark.sparkContext
    if getattr(context, "_docledger_shipped", None):
        return
    package = Path(__file__).resolve().parent
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh_dir(spark, 'docledger')}.zip")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(target)
    stream.write(bytearray(content.getvalue()))
    stream.close()
    context.addPyFile(fs.makeQualified(target).toString())
    context._docledger_shipped = True
