"""Session factory.

One session time zone (UTC) and one explicit shift to local time in the
expressions (see functions.time) - never both, which is what made the old
jobs show local time twice.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # let one parse of a JSON column feed many projected fields
    "spark.sql.optimizer.enableJsonExpressionOptimization": "true",
    # batch jobs: skip the Python stack capture PySpark does on every API call
    # (it only enriches error messages and costs ~1 ms per column expression)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def create_session(
    app_name: str = "leadlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.

    ``conf`` is applied after the defaults, so table-format extensions and
    catalogs (``spark.sql.extensions``, ``spark.sql.catalog.<name>.*``) are
    passed here by the caller; nothing about a particular catalog is assumed.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session; ``fallback`` is used only when it is
    unset (local tests), and is then installed on the context.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and fallback:
        spark.conf.set("spark.checkpoint.dir", fallback)
        current = fallback
    if current:
        try:
            sc = spark.sparkContext
            if sc.getCheckpointDir() is None:  # each call would add a new sub-folder
                sc.setCheckpointDir(current)
        except (AttributeError, NotImplementedError):
            pass  # Spark Connect: the server applies spark.checkpoint.dir itself
    return current or None


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``.  Only a local master may
    go without the setting and then gets a temporary folder; on a cluster it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="leadlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
