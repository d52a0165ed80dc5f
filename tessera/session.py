"""Session builder and shared-folder helpers.

The settings are the ones every analytic here relies on:

* ``spark.sql.session.timeZone=UTC`` so epoch -> calendar conversions do not depend on the host.
* ANSI mode stays on (the Spark 4 default); operators use ``try_cast`` / ``try_to_timestamp``
  where the input may be malformed instead of switching ANSI off.
* AQE on, with partition coalescing and skew-join splitting, so a hot key (a third of the rows
  in one group) is split at runtime rather than landing in one task.
* No UI server.

Scratch output (round-trip tests of sources/sinks, keyed-document stores, lineage cuts) goes
under ``spark.checkpoint.dir``: the shared folder the cluster names.  Only in local mode, where one
machine runs everything, is a folder made when that setting is unset; on a cluster it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in every Python worker (executors on a cluster).

    Stages that run Python in tasks (the detector in ``mapInPandas``, the stateful marker) refer to
    functions of this package; workers import them by name.  The package is zipped once per
    application and added with ``addPyFile``, which Spark serves to every executor.  The zip is
    staged under the shared checkpoint folder when that is a file-system path (else next to the
    driver, from where Spark serves it).  Set ``tessera.shipPackage=false`` when the package is
    installed on the executors already.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or spark.conf.get("tessera.shipPackage", "true").lower() == "false":
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    shared = spark.conf.get("tessera.shared.dir", None) or ""
    if shared.startswith("file:"):
        shared = shared[len("file:"):]
    if shared and "://" not in shared and os.path.isdir(shared):
        stage = os.path.join(shared, "pyfiles", f"{app}-{uuid.uuid4().hex[:8]}")
        os.makedirs(stage, exist_ok=True)
    else:
        stage = tempfile.mkdtemp(prefix="tessera-pkg-")
    zip_path = os.path.join(stage, "tessera.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zip_path)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; in local mode one is made when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None) \
        or sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        current = _own_folder(sc.master)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    # setCheckpointDir appends a per-application sub-folder; scratch lives next to it.
    spark.conf.set("tessera.shared.dir", current)
    return current


def _own_folder(master: str) -> str:
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share "
                           f"(master {master})")
    return tempfile.mkdtemp(prefix="tessera-ckpt-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one write under the shared checkpoint folder."""
    base = spark.conf.get("tessera.shared.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
