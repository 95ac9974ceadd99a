"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    # Wall-clock text becomes an instant through this zone, then shifts to UTC.
    "spark.sql.session.timeZone": "UTC",
    # Text that cannot be read is null by try_cast; any other loss is an error.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # A hot key on one side of a join is split even when an aggregate on the
    # same key follows and has to pay one more exchange for it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="daybook-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()

#: Rows go to Python workers in batches of this many bytes; a batch is held on
#: both sides of each step, and long texts make large ones.
ARROW_BATCH_BYTES = 8 << 20


def prepare_workers(spark: SparkSession) -> None:
    """Bound the batches for Python workers and send them this package.

    The package is sent once per application; workers then need neither an
    installed copy nor the driver's working folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="daybook-"), "daybook")
    context.addPyFile(
        shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    )
    _shipped.add(context.applicationId)
