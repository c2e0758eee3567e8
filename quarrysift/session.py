"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that hold at any size. Shuffle partitions start high and AQE merges
# small ones, so the number never has to be guessed per data set.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The second pass of a search looks up to this many paths up by value.
    "spark.sql.parquet.pushdown.inFilterThreshold": "2000",
}


def get_session(app: str = "quarrysift", master: str | None = None, **conf: object) -> SparkSession:
    """Build or reuse a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at storage every executor can reach.
    Only where it is unset (local runs, tests) is a temporary folder chosen.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarrysift-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared scratch root, one per run."""
    return f"{scratch_root(spark)}/quarrysift/{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if getattr(context, "_quarrysift_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quarrysift-"), "quarrysift.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._quarrysift_shipped = True


def ship_module(spark: SparkSession, module: str) -> None:
    """Send a user's single-file module to the executors, so that tasks can import it."""
    path = getattr(sys.modules.get(module), "__file__", None)
    if path and path.endswith(".py") and "." not in module and "site-packages" not in path:
        spark.sparkContext.addPyFile(path)
