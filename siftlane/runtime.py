"""Session helpers shared by all operators.

Lineage is cut only with ``DataFrame.checkpoint`` into the folder named by
``spark.checkpoint.dir``, which all executors share. A folder of our own is
used only where that setting is missing, as in local tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def session(app: str = "siftlane", cores: str = "*") -> SparkSession:
    """A local session for tests, the bench and the command line."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Set the checkpoint folder from the session's setting; a folder of our own only where there is none and the session is local.

    On a cluster the folder must be shared, so a session without the setting is refused.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not named and not sc.master.split("[")[0] == "local":
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siftlane-checkpoint-"))


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it from there: the plan is cut, executors may be lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores, if it is read in fewer parts than there are; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
