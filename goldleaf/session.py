"""Session construction and the shared working folder.

All files the library writes (lake tables, snapshots, marks) go under the folder the cluster names in
``spark.checkpoint.dir``. A local default is created only when the session has none (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from compressed-file size guesses (they once chose the line table as a build side).
    # Broadcasts come from explicit row-count checks (goldleaf.operators.joins) or from AQE, which
    # converts a join only when the measured size of the finished build side is below the bound below.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Independent jobs of one application (tables of a stage) share the cluster instead of queueing.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.showConsoleProgress": "false",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "goldleaf", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    settings = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # In one JVM every shuffle read is local already; AQE's local shuffle reader then only ties
            # post-join parallelism to the number of map tasks (1 for a single-row-group input file).
            settings["spark.sql.adaptive.localShuffleReader.enabled"] = "false"
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors: ``spark.checkpoint.dir`` of the session.

    When the session has none (local tests), a fresh local folder is created and registered as the
    checkpoint directory, so later calls and ``DataFrame.checkpoint()`` use the same place.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="goldleaf-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root for one run of one job."""
    return f"{shared_root(spark)}/goldleaf/{name}-{uuid.uuid4().hex[:12]}"
