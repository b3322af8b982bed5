"""Session helpers."""

import tempfile

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the session names; only a local test session gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession, prefix: str) -> str:
    """A new folder that every executor reaches: below the checkpoint folder, or a temporary one in a
    local session."""
    import uuid
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return f"{folder.rstrip('/')}/{prefix}{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=prefix)
