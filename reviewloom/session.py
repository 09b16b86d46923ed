"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on. Partition counts are left to the cluster and to AQE, which
# splits skewed shuffle partitions and merges small ones from their measured sizes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # keeps the state of streams on local disk and its changes in the checkpoint, not in the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "reviewloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above; extra settings are keyword arguments with ``__`` for
    dots, for example ``spark__sql__shuffle__partitions=8``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without that setting; it then gets a temporary folder. On a
    cluster a machine-local folder would lose data with its machine, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="reviewloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package, also where it is not installed and the session was
    started without ``--py-files``: a zip of it is added to the session, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="reviewloom-py-")) / "reviewloom.zip"
        with zipfile.ZipFile(path, "w") as out:
            for file in root.rglob("*.py"):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(path))  # Spark's own file service carries it to the executors
        _SHIPPED.add(context.applicationId)
