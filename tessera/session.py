"""Session helpers: the SQL settings the semantics depend on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.utils import AnalysisException

# Settings the results depend on.  They are runtime SQL confs, so they can be
# applied to any session handed to us (the driver's, a notebook's, a test's).
SEMANTIC_CONF = {
    # Timestamps are UTC instants; dates and `dt` strings are UTC days.
    "spark.sql.session.timeZone": "UTC",
    # `dt=2024-01-05` must stay a STRING partition value, not a DATE.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # `INSERT OVERWRITE` / `mode("overwrite")` on a partitioned table replaces
    # only the partitions present in the input.  Must be a session setting:
    # `insertInto` ignores the per-write option (and would replace the whole
    # table), and toggling it per write would race with concurrent writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A JSON object with a repeated key keeps the last value (as json.loads does).
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Execution settings that matter at scale; only applied when building a session.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (idempotent)."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with semantic and execution settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return ensure_conf(spark)


def path_missing(exc: Exception) -> bool:
    """Whether a read failed because nothing lies at its path (and for no other reason)."""
    return isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared, reliable folder the cluster names in ``spark.checkpoint.dir``.

    A cluster sets it; only when it is unset (local runs, tests) do we choose
    one ourselves, and only for a local master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"
