"""Where intermediate tables live."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

from linkrank import folders


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="linkrank-")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors share one machine, may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir is {folder}, which each machine of a cluster has to itself")
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path of its own for one run, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_folder`` named, or one inside it; anything else is refused."""
    inner = path.removeprefix(f"{shared_folder(spark)}/")
    if inner == path or ".." in inner.split("/") or not re.match(r".*-[0-9a-f]{32}(/|$)", inner):
        raise ValueError(f"{path} is no folder of a run")
    folders.remove(spark, path)


def stored(df, path: str):
    """Write ``df`` to ``path`` and read it back: its lineage starts at the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
