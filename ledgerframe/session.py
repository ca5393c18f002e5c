"""Session construction."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI stays on (lenient parsing is spelled try_*),
# AQE re-plans joins from runtime sizes and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    # fall back from whole-stage codegen when a fused method would exceed HotSpot's JIT
    # limit (8000 bytes of bytecode); such methods otherwise run interpreted. The wide
    # contract checks of the load jobs produce them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # remove reliable-checkpoint files once no DataFrame references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[8]", app: str = "ledgerframe",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own config."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``. Only a
    local session without it gets a scratch folder."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerframe-shared-")
    return folder.rstrip("/")
