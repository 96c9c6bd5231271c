"""Session helpers: defaults for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the library is tested under."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that outlives an executor, as named by ``spark.checkpoint.dir``.

    A local session that names none gets a temporary one. On a cluster that would
    be a folder of one machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="wardline-checkpoint-"))
    return sc.getCheckpointDir()


def computed_once(df: DataFrame) -> DataFrame:
    """An aggregate that several branches of a query read, written once to the shared folder.

    Column pruning gives each branch its own version of a shared sub-plan, so the
    engine would scan the big input once per branch. The checkpoint stops that,
    and a lost executor does not repeat the scan either. Only for results that are
    small beside their input.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
