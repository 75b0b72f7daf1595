"""Session for tests and benchmarks, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Single-machine session. A cluster brings its own session and settings."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("docfold")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="docfold-")
    return _local_folders[context.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    For inputs that several branches of one job use: each branch then reads only the columns it needs, and a lost
    executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/docfold/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def written_together(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Several independent :func:`written` jobs submitted at once, so that small ones do not leave executors idle."""
    with ThreadPoolExecutor(len(frames)) as pool:
        return dict(zip(frames, pool.map(written, frames.values(), frames)))
