"""Session helpers: recommended settings and lineage cuts.

The library never creates a session on its own; callers pass one in. These
helpers only read the session's configuration.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are tuned for. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tenure"):
    """A SparkSession builder with the recommended settings (local use, tests, bench)."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    return (
        b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, or None when unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        # make sure the RDD layer agrees with the SQL setting
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` when one is configured.

    Used where a frame is reused by several branches of a long plan. The
    checkpoint lives on shared storage, so it survives executor loss
    (``localCheckpoint`` would not). Without a configured folder the frame is
    returned unchanged, with a warning, and Spark recomputes it from lineage.
    """
    if checkpoint_dir(df.sparkSession) is None:
        warnings.warn("spark.checkpoint.dir is not set: lineage is not cut and may be recomputed", stacklevel=2)
        return df
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the same shared folder, read back.

    For a large frame of which later steps read some columns each: ``cut_lineage`` keeps
    whole rows, uncompressed, and every reader reads all of them. Without a configured
    folder as there.
    """
    folder = checkpoint_dir(df.sparkSession)
    if folder is None:
        return cut_lineage(df)
    path = f"{folder.rstrip('/')}/tenure/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
