"""Session construction and cluster-wide settings.

Every operator in the library takes and returns DataFrames and never creates
a session itself; this module is only used by entry points, the bench and
tests.  The settings here are the ones the operators rely on at scale:

* AQE with partition coalescing and skew-join splitting, so hot keys in joins
  are split at run time and tiny shuffles are merged.
* Arrow batches sized for array-heavy rows (latents, pixels): the default
  10,000-row batch would be gigabytes for image tensors.
* The UI is off (no web server is started).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows per Arrow batch for Python operators over array columns.  A (4,64,64)
# latent is 64 KiB, so 512 rows is ~32 MiB per batch.
ARROW_BATCH_ROWS = 512


def build_session(master: str | None = None, app: str = "latentforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_BATCH_ROWS),
        "spark.python.worker.reuse": "true",
        # no Python stack is taken for every column expression that is built
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``latentforge`` importable by the executors' Python workers.

    Python stages (``mapInPandas``, pandas UDFs) run functions defined in
    this package, so the workers must import it.  The package is zipped once
    and registered with ``addPyFile``, which distributes it with the tasks —
    the same as ``--py-files`` at submit time.  Done once per application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="latentforge-pyfiles-"), "latentforge.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``.  Only when that setting
    is absent *and* the master is local (tests, the bench) is a local
    temporary folder created and registered as the checkpoint dir.
    """
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if conf_dir:
        if not current:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if current:
        return current.rstrip("/")
    master = sc.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    local = tempfile.mkdtemp(prefix="latentforge-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")

