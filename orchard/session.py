"""Session helpers: the caller owns the session; these only fill gaps."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for repeatable results (UTC timestamps) and
# for runtime re-planning at scale (AQE coalescing and skew-join splitting).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orchard") -> SparkSession:
    """A local session for tests and the bench; clusters pass their own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("ORCHARD_DRIVER_MEM", "8g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured (local tests) do we create a
    fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not conf_dir:
        if not sc.master.startswith("local"):
            # On a cluster only a shared folder will do; without one, trees and
            # ALS run without checkpoints rather than on a machine-local path.
            import warnings
            warnings.warn("spark.checkpoint.dir is not set; lineage will not be cut")
            return ""
        conf_dir = tempfile.mkdtemp(prefix="orchard-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir
