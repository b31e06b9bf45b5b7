"""Session builder, table loader and the few helpers every job needs."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(app: str = "folia", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the queries are tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Spark's default and what is set in its place: batches between JVM and Python hold whole texts, so they stay short.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000")}


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder it was loaded from; batches to them are kept short."""
    for key, (usual, short) in BATCHES.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, short)
    env = spark.sparkContext.environment
    have = [p for p in (env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])
    # one pool for all memory of a worker, so that what a task frees can go back to the system
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


#: Temporary folders of applications whose setting names none.
_OWN: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The folder for tables in between: spark.checkpoint.dir, which all executors share. Where that is unset, as in tests, a temporary folder of this machine, for a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-folia-")
    return _OWN[app]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; a file or a folder of files."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
