"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files of a checkpoint go once nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The JVM does not compile methods over 8,000 bytes of bytecode; beyond that, generated code that Spark
    # splits into small methods runs several times faster than one large method for the whole stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "tidemark", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the library expects; `conf` wins over the defaults.

    `shuffle_partitions` stays with the cluster's own setting unless given: AQE coalesces small
    partitions but never splits the initial number for an aggregation, so large runs should set it
    from the log size (about 200 MB of shuffled data per partition).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by spark.checkpoint.dir; fall back to a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the data survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows up to which a table that is derived from a log may be sent to all tasks.
FEW_ROWS = 20_000


def is_few(df: DataFrame, limit: int = FEW_ROWS) -> bool:
    """Whether `df` has at most `limit` rows; no task computes more than `limit` + 1 of them."""
    return df.limit(limit + 1).count() <= limit


def joinable(df: DataFrame, few: bool) -> DataFrame:
    """`df` for the side of a join that Spark might broadcast; unless it has few rows, the join has to shuffle.

    What is read from JSON is estimated far too small: a parsed row counts as no larger than its text, and its narrow
    columns as a small part of it. By such estimates Spark would broadcast millions of rows.
    """
    return df if few else df.hint("merge")
