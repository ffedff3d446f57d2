"""Session helpers: building a session and finding the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app_name: str = "sparkrec",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a session of one
    machine (``local[...]``, as in tests) may leave it unset and gets a fresh
    local folder; elsewhere executors could not see such a folder, so we raise.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="sparkrec-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:  # RDD checkpoints (MLlib) use the same folder; absent on Spark Connect
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001
        pass
    return path


def app_id(spark: SparkSession) -> str:
    """The application id, read from the session conf (works on any session)."""
    return spark.conf.get("spark.app.id", None) or "app"


#: Rows that one task sorts or aggregates, about.
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, rows: int, *keys: str, per_task: int | None = None) -> DataFrame:
    """`df` dealt by `keys` over as many tasks as `rows` of them ask for.

    A partition count that is named is not merged by AQE, which counts compressed
    bytes: 64 MB of them are gigabytes in a task that sorts or multiplies the rows."""
    least = min(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(least, -(-rows // (per_task or ROWS_PER_TASK))), *keys)


def materialize(df: DataFrame, name: str = "tmp") -> DataFrame:
    """Write `df` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: later stages read the written table instead of
    recomputing it, so every consumer sees the same rows even when the plan
    holds non-deterministic parts (sampled range bounds, row positions), and
    a lost executor does not force a re-run from the sources.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/sparkrec/{app_id(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
