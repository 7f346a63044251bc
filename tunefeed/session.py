"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tunefeed") -> SparkSession:
    """Session for tests and the bench. On a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Small test data: keep all cores busy after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder all executors share.

    That is ``spark.checkpoint.dir``, or what was set on the context. Only a
    local session may lack both; then a temporary folder of this machine is set.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tunefeed-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/tunefeed/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package where it is not installed.

    Once per Spark context the package's modules (a few kilobytes) are zipped on the
    driver, from where Spark itself hands them out.
    """
    context, root = spark.sparkContext, Path(__file__).parent
    if getattr(context, "_tunefeed_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tunefeed-")) / "tunefeed.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tunefeed_shipped = True
