"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", app: str = "qanat") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a local one where it is unset and the session is local (tests)."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if known:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(known)
        return known
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), "qanat-shared"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and go on from there: it is computed once and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    """Partitions for an explicit repartition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
