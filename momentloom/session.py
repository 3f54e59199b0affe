"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "momentloom", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``.

    Where it is not set, a session in one JVM takes a folder beside its warehouse. On a cluster
    that is an error, as the executors share no local folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
    context.setCheckpointDir(folder)
