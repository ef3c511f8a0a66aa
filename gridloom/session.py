"""Session helpers: a local builder for tests and bench, and the shared folder for materialised state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Method size above which the JVM stops compiling generated code; wide projections then run as several
# small methods, which it does compile. Worth setting on a cluster too.
RECOMMENDED_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def local_session(app: str = "gridloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder all executors can reach for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only in a local session, where driver and executors are
    one, is a temporary folder chosen when that is unset; elsewhere executors would each write to their own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="gridloom-ckpt-"))
        current = context.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a table written and read back."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
