"""Session settings and durable scratch tables.

All jobs assume a UTC session (timestamps are rendered as ISO strings) and ANSI
mode (Spark 4 default).  Intermediate results that must not be recomputed —
model answers above all, since a second evaluation may give a different answer —
are written as Parquet under ``spark.checkpoint.dir``, the shared folder the
cluster names.  Only when that setting is unset (local runs, tests) do we pick a
folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(master: str | None = None, app: str = "voxtide",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings every job expects (UTC, AQE, Arrow, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # the status store keeps the plans of past executions on the driver's heap, with the web page off too
        "spark.sql.ui.retainedExecutions": "50",
        "spark.ui.retainedJobs": "200",
        "spark.ui.retainedStages": "200",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``voxtide`` importable in Python workers (pandas UDFs,
    ``mapInPandas``): zip the package once per application and add it with
    ``addPyFile``, Spark's own code-shipping path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="voxtide-code-")
    archive = shutil.make_archive(os.path.join(out, "voxtide"), "zip", os.path.dirname(pkg), "voxtide")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone; ISO renderings and `as_of` cut-offs depend on it."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for durable intermediates.

    Read from ``spark.checkpoint.dir`` (cluster setting).  If unset — local runs
    and tests only — create one folder per session and register it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        key = sc.applicationId
        root = _LOCAL_FALLBACK.get(key)
        if root is None:
            root = tempfile.mkdtemp(prefix="voxtide-ckpt-")
            _LOCAL_FALLBACK[key] = root
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/voxtide/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint root and read it back.

    Cuts lineage (a lost executor re-reads files instead of re-running the
    upstream, including any model calls) and pins non-deterministic columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (local or shared store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
