"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of the package relies on (UTC for the ms <-> timestamp
# boundary, AQE for runtime coalescing and skew splits, Arrow for the Python
# passes, no UI server).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files of the split pass once its DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tidewatch",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or get) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them to spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system folder and is used as
    is. Only a local master (tests, one machine) may leave it unset and gets a
    private folder; elsewhere a machine-local folder would lose state.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId  # one folder for all sessions of the application
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
        conf_dir = _LOCAL_FOLDERS[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (for state tables, stream
    checkpoints and lineage cuts)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])



_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the Python workers: the Arrow passes
    and the state processor are pickled by reference to this package's
    modules. Zipped once per application and handed to ``addPyFile``, which
    serves it to every executor (the usual alternative is ``--py-files``)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import os
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidewatch-pkg-"), "tidewatch.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            if "__pycache__" in folder:
                continue
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    zf.write(path, os.path.join("tidewatch", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
